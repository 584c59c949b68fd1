"""Level texts, their codes and the rules on codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from tablewright.functions.logic import any_of
from tablewright.functions.text import found, is_plain, replace_first

# Label and code of every level, per measure. Matching is on lower-case text.
LEVEL_CODES: dict[str, tuple[tuple[str, float], ...]] = {
    "impact": (
        ("not a threat", 0.0),
        ("negligible", 1.0),
        ("low", 2.0),
        ("medium", 3.0),
        ("high", 4.0),
        ("very high", 5.0),
        ("unknown", -1.0),
        ("not calculated", -2.0),
        ("not scored", -2.0),
        ("insignificant", 1.0),
    ),
    "scope": (
        ("not a threat", 0.0),
        ("negligible", 1.0),
        ("small", 2.0),
        ("restricted", 3.0),
        ("large", 4.0),
        ("pervasive", 5.0),
        ("unknown", -1.0),
        ("not calculated", -2.0),
        ("not scored", -2.0),
        ("insignificant", 1.0),
    ),
    "severity": (
        ("neutral or potential benefit", 0.0),
        ("negligible", 1.0),
        ("slight", 2.0),
        ("moderate", 3.0),
        ("serious", 4.0),
        ("extreme", 5.0),
        ("unknown", -1.0),
        ("not calculated", -2.0),
        ("not scored", -2.0),
        ("insignificant", 1.0),
    ),
    "timing": (
        ("not a threat", 0.0),
        ("negligible", 1.0),
        ("low", 2.0),
        ("moderate", 3.0),
        ("high", 4.0),
        ("unknown", -1.0),
        ("not calculated", -2.0),
        ("not scored", -2.0),
        ("insignificant", 1.0),
    ),
}
LEVEL_MEASURES = tuple(LEVEL_CODES)
LEVEL_SENTINEL = "-- Uncertainty Ranges --"
SEVERAL_LEVELS = 100.0
NO_LEVEL = 99.0

# Parents 1 to 11 of the category vocabulary, how many children each has, and the
# children that only the newer version of the classification knows.
CHILDREN_OF_PARENT = {1: 3, 2: 4, 3: 3, 4: 4, 5: 4, 6: 3, 7: 3, 8: 6, 9: 6, 10: 3, 11: 5}
NEWER_CHILDREN = ("8.4", "8.5", "8.6", "11.5")
PARENTS = tuple(str(parent) for parent in CHILDREN_OF_PARENT)
CATEGORIES = tuple(
    number
    for parent, children in CHILDREN_OF_PARENT.items()
    for number in (str(parent), *(f"{parent}.{child}" for child in range(1, children + 1)))
)


def _shortened(text: str) -> str:
    return text.replace("very high", "very", 1)


def _comparable(col: Column) -> Column:
    """Lower case, with the first "very high" cut to "very" so that it does not also read as "high"."""
    text = F.lower(col)
    return F.when(found(text, "very high"), replace_first(text, "very high", "very")).otherwise(text)


def recode_levels(col: Column, codes: Sequence[tuple[str, float]]) -> Column:
    """The code of the level named in a text.

    Two levels (a range) give the mean of their codes, more than two give 100 and none gives 99.
    Null stays null. The codes found are one bit each, and what a set of codes stands for is looked up,
    so the text is prepared once per row and all of it stays in generated code.
    """
    text = _comparable(col)
    distinct = list(dict.fromkeys(code for _, code in codes))
    found = reduce(
        Column.bitwiseOR,
        [
            F.contains(text, F.lit(_shortened(label))).cast("int") * F.lit(1 << distinct.index(code))
            for label, code in codes
        ],
    )

    def meaning(found_set: int) -> float:
        held = [code for bit, code in enumerate(distinct) if found_set >> bit & 1]
        return NO_LEVEL if not held else sum(held) / len(held) if len(held) <= 2 else SEVERAL_LEVELS

    return F.get(F.lit([meaning(found_set) for found_set in range(1 << len(distinct))]), found)


def fails_levels(col: Column, codes: Sequence[tuple[str, float]], sentinel: str = LEVEL_SENTINEL) -> Column:
    """True where a text names no level. A null or a sentinel text never fails."""
    accepted = [_shortened(label) for label, _ in codes] + [sentinel.lower()]
    pattern = "|".join(r"\Q" + text + r"\E" for text in accepted)
    return F.coalesce(~_comparable(col).rlike(pattern), F.lit(False))


def derive_impact(impact: Column, scope: Column, severity: Column) -> Column:
    """A missing impact from scope and severity; the first rule that applies wins."""
    derived = (
        F.when((scope == 1) | (severity == 1), F.lit(1.0))
        .when((scope == 0) | (severity == 0), F.lit(0.0))
        .when((scope == -1) | (severity == -1), F.lit(-1.0))
        .when((scope == -2) | (severity == -2), F.lit(-2.0))
        .when(scope.isNull() != severity.isNull(), F.lit(-1.0))
    )
    return F.coalesce(impact, derived)


def flag_identified(impact: Column) -> Column:
    """0 for a null or zero impact, else 1 (unknown and not calculated count as identified)."""
    return F.when(impact.isNull() | (impact == 0), F.lit(0.0)).otherwise(F.lit(1.0))


# Misspelt level texts and what they stand for, in the order in which they are applied.
LEVEL_FIXES = (
    ("Hig$", "High"),
    ("Ongoing", "High"),
    ("Smal$", "Small"),
    ("Neutral or potentially beneficial", "Neutral or potential benefit"),
    ("Unkown", "Unknown"),
    ("Sight", "Slight"),
    ("Neglibible", "Negligible"),
)
SCOPE_FIXES = (("Medium", "Restricted"), ("Serious - Moderate", "Large - Restricted"))


def fix_levels(col: Column, fixes: Sequence[tuple[str, str]] = LEVEL_FIXES) -> Column:
    """Misspellings repaired in order; a text without any of them is looked at only once."""
    fixed = col
    for pattern, label in fixes:
        fixed = replace_first(fixed, pattern, label)
    return F.when(any_of(found(col, pattern) for pattern, _ in fixes), fixed).otherwise(col)


# Older names of sub-types, and doubled commas, repaired before lists are classified.
SUBTYPE_SYNONYMS = (
    ("manage human threats", "regulate human activities"),
    ("manage predation", "Manage native species negatively impacting species at risk"),
)
DOUBLED_COMMAS = (",,", ", ,")


def repair_subtypes(col: Column, commas: bool = False, synonyms=SUBTYPE_SYNONYMS) -> Column:
    """Synonyms rewritten, each on its first match; on request the first doubled comma made single.

    A text that holds none of them is looked at, but not rewritten.
    """
    repaired = col
    for old, new in synonyms:
        repaired = replace_first(repaired, old, new, ignore_case=True)
    if commas:
        repaired = replace_first(repaired, "|".join(DOUBLED_COMMAS), ",")
    if not all(is_plain(old) and old.isascii() for old, _ in synonyms):
        return repaired
    # Letters beyond ASCII may be the upper case of plain ones, so texts with such letters are always gone through.
    due = [F.octet_length(col) > F.char_length(col), *[F.contains(F.lower(col), F.lit(old.lower())) for old, _ in synonyms]]
    due += [F.contains(col, F.lit(doubled)) for doubled in DOUBLED_COMMAS if commas]
    return F.when(any_of(due), repaired).otherwise(col)


# Sub-types of one type that are looked for one by one; more of them stay one pattern, which keeps the expression small.
PLAIN_SUBTYPES = 50


def classify_list(col: Column, taxonomy: Mapping[str, Sequence[str]], sep: str = ", ") -> Column:
    """The types whose sub-types occur in the text, joined in taxonomy order; none gives null.

    Sub-types are used as patterns, without escaping; those of a type that are all plain text are looked for as such.
    """
    text = F.lower(col)

    def named(subtypes: Sequence[str]) -> Column:
        patterns = [subtype.lower() for subtype in subtypes]
        if len(patterns) <= PLAIN_SUBTYPES and all(map(is_plain, patterns)):
            return any_of(found(text, pattern) for pattern in patterns)
        return text.rlike("|".join(patterns))

    types = [F.when(named(subtypes), F.lit(kind)) for kind, subtypes in taxonomy.items()]
    return F.nullif(F.concat_ws(sep, *types), F.lit(""))


def impute_version(uses_tool: Column, version: Column, newer_category: Column) -> Column:
    """A missing version where the tool was used: 2.3 if the newer category is filled in, else 1.1."""
    missing = (uses_tool == 1) & version.isNull()
    return (
        F.when(missing & newer_category.isNotNull(), F.lit(2.3))
        .when(missing & newer_category.isNull(), F.lit(1.1))
        .otherwise(version)
    )


def any_positive(columns: Sequence[Column]) -> Column:
    """Whether the values add up to more than zero, nulls skipped."""
    return reduce(add, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns]) > 0


def rollup_flag(parent: Column, children: Sequence[Column]) -> Column:
    """A parent flag of 0 becomes 1 if any child is flagged; any other parent value stays."""
    if not children:
        return parent
    return F.when((parent == 0) & any_positive(children), F.lit(1).cast("double")).otherwise(parent)
