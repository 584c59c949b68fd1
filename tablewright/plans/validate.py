"""Rules of a data contract, checked on a table.

A single kind of rule that only counts bad rows is one aggregate. Rules that name offenders, and the whole
report, turn only offending cells into rows, so a clean table shuffles nothing; the report reads the table
once for all rules, and once more for columns that must be unique.

Rules over a wide family are loops over arrays of its cells, and the rules that a row breaks are the bits of a few whole
numbers: a plan has a handful of expressions however many columns there are, equal masks are counted before they move,
and only masks and cells that break a rule are decoded.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tablewright.functions.dates import YEAR_FIRST_FORMATS, first_parsed
from tablewright.functions.logic import any_of
from tablewright.functions.names import literals, matching, number_in, quoted, ref, refs
from tablewright.functions.text import pieces, trimmed
from tablewright.operators.aggregates import counts_long
from tablewright.plans import completeness
from tablewright.plans.completeness import Scope
from tablewright.plans.taxonomy import flag_name, wide_name
from tablewright.sources.delimited import read_csv
from tablewright.sources.snapshots import read_snapshot, write_snapshot

# Limits of plausible dates and years, and the values of flags and of coded levels.
EARLIEST_DATE = "1980-01-01"
YEAR_LIMITS = (1980, 2100)
FLAG_VALUES = ("0", "1", "2", "NE")
LEVEL_VALUES = tuple(half / 2 for half in range(-4, 11))
# The columns whose lists are compared after cleaning.
LOOSE_COLUMNS = ("CC_action_subtype", "action_subtype")
WORD_BITS = 62  # rules in one word of a row's mask
DOMAIN_RULES = ("domain", "domain_loose", "family_domain")


@dataclass(frozen=True)
class ContractRow:
    column: str
    values: tuple[str, ...]
    expectation: str
    na_allowed: bool

    def expects(self, word: str) -> bool:
        return word in self.expectation


def read_contract(spark: SparkSession, path: str) -> list[ContractRow]:
    """A contract file (colnms, vals, expectation, na_allowed), one row per column; its rows become a plan."""
    text = T.StringType()
    schema = T.StructType([T.StructField(c, text) for c in ("colnms", "vals", "expectation", "na_allowed")])
    rows = read_csv(spark, path, schema).collect()
    return [
        ContractRow(r["colnms"], tuple((r["vals"] or "NA").split(", ")), r["expectation"], r["na_allowed"] != "0")
        for r in rows
    ]


def as_text_sql(df: DataFrame, column: str) -> str:
    name = quoted(column)
    if isinstance(df.schema[column].dataType, T.FractionalType):
        return (
            f"CASE WHEN {name} = floor({name}) AND abs({name}) < 1e15"
            f" THEN string(try_cast({name} AS bigint)) ELSE string({name}) END"
        )
    return f"string({name})"


def as_text(df: DataFrame, column: str) -> Column:
    """A value as the contract writes it: whole numbers without decimals."""
    return F.expr(as_text_sql(df, column))


def _strict_items(text: Column) -> Column:
    return pieces(F.coalesce(text, F.lit("NA")))


def _loose_items(text: Column) -> Column:
    def clean(item: Column) -> Column:
        return F.lower(F.regexp_replace(trimmed(item), r"^([^,]*),", "$1"))

    items = F.transform(pieces(text), clean)
    return F.coalesce(F.filter(items, lambda i: i != ""), F.array(F.lit("NA")))


def _offenders(df: DataFrame, cells: Sequence[Column]) -> DataFrame:
    """Offending values per rule and column, with the number of rows; ``cells`` are arrays of (rule, column, value)."""
    return (
        df.select(F.inline(F.concat(*cells)))
        .groupBy("rule", "column_name", "value")
        .agg(F.count(F.lit(1)).alias("n_bad"))
    )


def _cell(rule: str, column: str, value: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), value.alias("value"))


def items_outside(df: DataFrame, domains: Mapping[str, Sequence[str]], loose: bool = False) -> dict[str, Column]:
    """Per column an array of the items outside its allowed values."""
    items = _loose_items if loose else _strict_items
    return {
        c: F.array_except(items(as_text(df, c)), F.expr(f"array({', '.join(literals(allowed))})")) for c, allowed in domains.items()
    }


def domain_cells(df: DataFrame, domains: Mapping[str, Sequence[str]], loose: bool = False) -> list[Column]:
    """The same as cells that name rule and column."""
    rule = "domain_loose" if loose else "domain"

    def cells(c: str, bad: Column) -> Column:
        return F.transform(bad, lambda v: _cell(rule, c, v))

    return [cells(c, bad) for c, bad in items_outside(df, domains, loose).items()]


def domain_offenders(df: DataFrame, domains: Mapping[str, Sequence[str]], loose: bool = False) -> DataFrame:
    """Items outside a column's allowed values. Lists are split; a null reads as "NA".

    Loose: items are trimmed, lose their first comma, become lower case, and empty ones are ignored.
    """
    return _offenders(df, domain_cells(df, domains, loose))


_NO_OFFENDERS = "CAST(array() AS array<struct<place:int,number:double,text:string>>)"


@dataclass(frozen=True)
class FamilyCells:
    """The cells of a family as arrays, and the places of those outside their values, as SQL text."""

    columns: tuple[str, ...]
    arrays: dict[str, str]
    offenders: str  # array<struct<place int, number double, text string>>
    doubts: tuple[str, ...] = ()  # of each array how many different values may be outside


def family_cells(df: DataFrame, family: str = "^X") -> FamilyCells:
    """Flags and coded levels of a family; notes are left out.

    Doubles are one array for flags and one for levels; columns of other types give their offending values as text.
    """
    columns = matching(matching(df.columns, family), "comments|note", negate=True)
    kinds = {c: df.schema[c].dataType for c in columns}
    doubles = [c for c in columns if isinstance(kinds[c], T.DoubleType)]
    flags = [c for c in doubles if "identified" in c]
    levels = [c for c in doubles if "identified" not in c]
    others = [c for c in columns if c not in set(doubles)]
    flag_numbers = ", ".join(f"{float(v)!r}D" for v in FLAG_VALUES if v != "NE")
    level_numbers = ", ".join(f"{v!r}D" for v in LEVEL_VALUES)

    def other(c: str) -> str:
        name, numeric = quoted(c), isinstance(kinds[c], T.NumericType)
        if "identified" in c:
            allowed = f"{name} IN ({flag_numbers})" if numeric else f"{name} IN ({', '.join(literals(FLAG_VALUES))})"
        else:
            allowed = f"try_cast({name} AS double) IN ({level_numbers})"
        return f"CASE WHEN {name} IS NOT NULL AND NOT coalesce({allowed}, false) THEN {as_text_sql(df, c)} END"

    held = {
        "flags": (flags, [quoted(c) for c in flags], f"x NOT IN ({flag_numbers})", f"{flag_numbers}, CAST(NULL AS double)"),
        "levels": (levels, [quoted(c) for c in levels], f"x NOT IN ({level_numbers})", f"{level_numbers}, CAST(NULL AS double)"),
        "others": (others, [other(c) for c in others], "x IS NOT NULL", "CAST(NULL AS string)"),
    }
    listed, found, arrays, doubts = [], [], {}, []
    for name, (group, cells, outside, allowed) in held.items():
        if not group:
            continue
        arrays[name] = f"array({', '.join(cells)})"
        value = "CAST(NULL AS double) AS number, x AS text" if name == "others" else "x AS number, CAST(NULL AS string) AS text"
        cell = f"CASE WHEN {outside} THEN struct(i + {len(listed)} AS place, {value}) END"
        # A compiled test first: the loop, which Spark interprets, is for rows that have such a cell.
        some = f"size(array_except({name}, array({allowed}))) > 0"
        doubts.append(f"size(array_except({arrays[name]}, array({allowed})))")
        found.append(f"if({some}, filter(transform({name}, (x, i) -> {cell}), o -> o IS NOT NULL), {_NO_OFFENDERS})")
        listed += group
    return FamilyCells(tuple(listed), arrays, f"concat({', '.join(found)})" if found else _NO_OFFENDERS, tuple(doubts))


def _names(names: Sequence[str], place: str) -> Column:
    """The name at a place of a list, which may be long."""
    return F.expr(f"array({', '.join(literals(names))})[{place}]" if names else "CAST(NULL AS string)")


# A number as the contract writes it, from a double.
_NUMBER_TEXT = (
    "CASE WHEN number = floor(number) AND abs(number) < 1e15 THEN string(try_cast(number AS bigint)) ELSE string(number) END"
)


def family_offenders(df: DataFrame, family: str = "^X") -> DataFrame:
    """Flags and coded levels outside their values; null is allowed, notes are not looked at."""
    cells = family_cells(df, family)
    held = df.selectExpr(*[f"{text} AS {name}" for name, text in cells.arrays.items()]).select(F.expr(cells.offenders).alias("o"))
    counts = held.select(F.inline("o")).groupBy("place", "number", "text").agg(F.count(F.lit(1)).alias("n_bad"))
    return counts.select(
        F.lit("family_domain").alias("rule"),
        _names(cells.columns, "place").alias("column_name"),
        F.expr(f"coalesce(text, {_NUMBER_TEXT})").alias("value"),
        "n_bad",
    )


Counts = dict[tuple[str, str], Column]


def type_counts(df: DataFrame, expected: Mapping[str, str]) -> Counts:
    """All rows count as bad where a column is not text, or not numeric, as expected."""
    result: Counts = {}
    for column, kind in expected.items():
        dtype = df.schema[column].dataType
        fits = isinstance(dtype, T.StringType if kind == "is.character" else T.NumericType)
        result[(kind, column)] = F.lit(not fits)
    return result


def date_counts(df: DataFrame, columns: Sequence[str]) -> Counts:
    """Values that are no date, or not after the earliest plausible one."""
    result: Counts = {}
    for c in columns:
        value = ref(c)
        parsed = value.cast("date")
        if isinstance(df.schema[c].dataType, T.StringType):
            parsed = first_parsed(F.regexp_replace(value, r"[/. ]", "-"), YEAR_FIRST_FORMATS)
        late = parsed > F.lit(EARLIEST_DATE).cast("date")
        result[("plausible_date", c)] = value.isNotNull() & ~F.coalesce(late, F.lit(False))
    return result


def year_counts(columns: Sequence[str]) -> Counts:
    low, high = YEAR_LIMITS
    return {("plausible_year", c): ~((ref(c) > low) & (ref(c) < high)) for c in columns}


def required_counts(columns: Sequence[str], rule: str = "required", where: Column | None = None) -> Counts:
    """Nulls in required columns, in the rows that meet a condition."""
    scope = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    return {(rule, c): scope & ref(c).isNull() for c in columns}


def conditional_required(scopes: Sequence[Scope]) -> Counts:
    result: Counts = {}
    for scope in scopes:
        result |= required_counts(scope.required, f"required_{scope.name}", scope.condition)
    return result


def document_requirements(author: str = "report_writers") -> list[Scope]:
    """What each document kind of the curated table must have filled in."""
    kind, action = ref("doc_type"), ref("CC_action") == 1
    return [
        Scope("sr", (author, *completeness.STATUS_REPORT_COLUMNS), kind == completeness.STATUS_REPORT),
        Scope("rs", completeness.STRATEGY_COLUMNS, kind == completeness.STRATEGY),
        Scope("rs_cc", completeness.ACTION_COLUMNS, (kind == completeness.STRATEGY) & action),
        Scope("mp", completeness.PLAN_COLUMNS, kind == completeness.PLAN),
        Scope("mp_cc", completeness.ACTION_COLUMNS, (kind == completeness.PLAN) & action),
    ]


def family_required_counts(parents: Sequence[str] | None = None, children: Sequence[str] | None = None) -> Counts:
    """Nulls in the flags that every row must have."""
    return required_counts(parents or completeness.PARENT_FLAGS, "required_level1") | required_counts(
        children or completeness.CHILD_FLAGS, "required_level2"
    )


def rule_counts(df: DataFrame, counts: Mapping[tuple[str, str], Column]) -> DataFrame:
    """Bad rows per rule and column, in one scan; rules without any are left out."""
    return counts_long(df, counts, ["rule", "column_name"], "n_bad").filter("n_bad > 0")


def unique_offenders(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows repeat a value of a column that must be unique (null is one value).

    All columns are checked in one scan and one shuffle, as (column, value) rows counted before they move.
    """
    cells = [F.struct(F.lit(c).alias("column_name"), ref(c).cast("string").alias("value")) for c in columns]
    counts = df.select(F.inline(F.array(*cells))).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    repeated = counts.filter("n > 1").groupBy("column_name").agg(F.sum(F.col("n") - 1).alias("n_bad"))
    return repeated.select(F.lit("unique").alias("rule"), "column_name", "n_bad")


def implied_required(df: DataFrame, row_id: str, condition: Column, required: str) -> DataFrame:
    """Ids of rows that meet a condition but lack the value it implies."""
    return df.filter(condition & ref(required).isNull()).select(ref(row_id))


def contradictions(
    not_mentioned: Column, is_threat: Column, unknown: Column, relative_impact: Column
) -> dict[str, Column]:
    """Pairs of statements that cannot both hold."""
    return {
        "not_mentioned_but_threat": (not_mentioned == 1) & (is_threat == 1),
        "not_mentioned_but_unknown": (not_mentioned == 1) & (unknown == 1),
        "threat_without_impact": (is_threat == 1) & ((relative_impact == 0) | relative_impact.isNull()),
        "impact_without_threat": (is_threat == 0) & (relative_impact > 0),
    }


def contradicting_rows(df: DataFrame, row_id: str, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, row id) of every row that breaks a rule; all rules in one scan."""
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    return df.filter(any_of(rules.values())).select(F.explode(broken).alias("rule"), ref(row_id))


def unflagged_rows(df: DataFrame, ids: Sequence[str], numbers: Sequence[str] | None = None) -> DataFrame:
    """(ids, number) of categories not flagged although scope, severity and timing say that they should be."""
    if numbers is None:
        flags = matching(df.columns, "identified")
        numbers = [f"{number_in(c):g}" for c in flags]
    arrays = {
        "flag": [flag_name(n) for n in numbers],
        **{m: [wide_name(n, m) for n in numbers] for m in ("scope", "severity", "timing")},
    }
    held = df.select(
        *refs(ids), *[F.expr(f"array({', '.join(f'CAST({quoted(c)} AS double)' for c in cs)})").alias(f"__{m}") for m, cs in arrays.items()]
    )
    wrong = "__flag[i] = 0 AND __scope[i] <> 0 AND __severity[i] <> 0 AND __timing[i] > 2"
    places = F.expr(f"explode(filter(sequence(0, {len(numbers) - 1}), i -> {wrong}))")
    return held.select(*refs(ids), places.alias("__place")).select(*refs(ids), _names(numbers, "__place").alias("threat_num"))


def contract_counts(df: DataFrame, contract: Sequence[ContractRow]) -> Counts:
    """All rules of a contract that only count rows."""
    kinds = {(r.column, k): k for r in contract for k in ("is.character", "is.numeric") if r.expects(k)}
    counts: Counts = {}
    for (column, kind) in kinds:
        counts |= type_counts(df, {column: kind})
    counts |= date_counts(df, [r.column for r in contract if r.expects("date")])
    counts |= year_counts([r.column for r in contract if r.expects("year")])
    counts |= required_counts([r.column for r in contract if not r.na_allowed])
    return counts


def _rules_of(
    df: DataFrame,
    contract: Sequence[ContractRow],
    scopes: Sequence[Scope],
    row_rules: Mapping[str, Column] | None,
    family: str | None,
    loose: Sequence[str],
) -> tuple[Counts, dict[tuple[str, str], Column], FamilyCells]:
    """Conditions that count rows, lists of items outside their values, and the cells of the family."""
    counts = contract_counts(df, contract) | conditional_required(scopes)
    counts |= {(name, "row"): test for name, test in (row_rules or {}).items()}
    domains = {r.column: r.values for r in contract if r.expectation == "vals"}
    outside = {("domain", c): x for c, x in items_outside(df, {c: v for c, v in domains.items() if c not in loose}).items()}
    outside |= {("domain_loose", c): x for c, x in items_outside(df, {c: v for c, v in domains.items() if c in loose}, True).items()}
    return counts, outside, family_cells(df, family) if family else FamilyCells((), {}, _NO_OFFENDERS)


def validation_report(
    df: DataFrame,
    contract: Sequence[ContractRow],
    scopes: Sequence[Scope] = (),
    row_rules: Mapping[str, Column] | None = None,
    family: str | None = None,
    loose: Sequence[str] = LOOSE_COLUMNS,
) -> DataFrame:
    """Every broken rule as (rule, column_name, n_bad, message).

    ``row_rules`` are conditions that no row may meet. The message of a domain rule gives the number of
    distinct offending values and the first of them.
    """
    counts, outside, cells = _rules_of(df, contract, scopes, row_rules, family, loose)
    # Places of rules: conditions, then lists, then the family's columns.
    rules = [*counts, *outside, *[("family_domain", c) for c in cells.columns]]
    first_list, first_cell = len(counts), len(counts) + len(outside)

    tests = list(counts.values())
    words = {f"tests{w}": F.array(*tests[at : at + WORD_BITS]) for w, at in enumerate(range(0, len(tests), WORD_BITS))}
    held = df.select(
        *[tests.alias(name) for name, tests in words.items()],
        F.array(F.array().cast("array<string>"), *outside.values()).alias("lists"),  # the first is none
        *[F.expr(text).alias(name) for name, text in cells.arrays.items()],
    )
    masks = [f"if(array_contains({name}, true), aggregate(reverse({name}), 0L, (m, t) -> m * 2 + if(t, 1L, 0L)), 0L)" for name in words]
    broken = held.selectExpr(
        f"CAST(array({', '.join(masks)}) AS array<bigint>) AS mask",
        "if(size(flatten(lists)) > 0, flatten(transform(lists, (x, i) -> transform(x, v ->"
        f" struct(i - 1 + {first_list} AS place, CAST(NULL AS double) AS number, v AS text)))), {_NO_OFFENDERS}) AS items",
        f"transform({cells.offenders}, x -> struct(x.place + {first_cell} AS place, x.number AS number, x.text AS text)) AS cells",
    )
    # Masks and offending cells of a row in one list, so that the table is read once; equal ones are counted before they move.
    none = "CAST(NULL AS array<bigint>) AS mask"
    listed = (
        "concat(if(exists(mask, m -> m <> 0),"
        " array(struct(CAST(NULL AS int) AS place, CAST(NULL AS double) AS number, CAST(NULL AS string) AS text, mask)), array()),"
        f" transform(concat(items, cells), x -> struct(x.place AS place, x.number AS number, x.text AS text, {none})))"
    )
    seen = broken.selectExpr(f"inline({listed})").groupBy("mask", "place", "number", "text").agg(F.count(F.lit(1)).alias("n"))
    bits = f"filter(sequence(0, {max(len(counts) - 1, 0)}), i -> getbit(mask[CAST(i DIV {WORD_BITS} AS int)], i % {WORD_BITS}) = 1)"
    decoded = seen.selectExpr(f"explode(if(mask IS NULL, array(place), {bits})) AS place", "number", "text", "n")
    by_rule = decoded.groupBy("place").agg(
        F.sum("n").alias("n_bad"), F.count(F.lit(1)).alias("__values"), F.min(F.expr(f"coalesce(text, {_NUMBER_TEXT})")).alias("__first")
    )
    by_rule = by_rule.select(
        _names([rule for rule, _ in rules], "place").alias("rule"),
        _names([c for _, c in rules], "place").alias("column_name"),
        "n_bad", "__values", "__first",
    )
    message = F.when(
        F.col("rule").isin(*DOMAIN_RULES),
        F.concat(F.col("__values").cast("string"), F.lit(" values, e.g. "), F.col("__first")),
    ).otherwise(F.concat(F.col("n_bad").cast("string"), F.lit(" rows")))
    report = by_rule.select("rule", "column_name", "n_bad", message.alias("message"))
    unique = [r.column for r in contract if r.expects("unique")]
    if unique:
        report = report.unionByName(unique_offenders(df, unique).withColumn("message", F.lit("repeated values")))
    return report


def write_checked(
    df: DataFrame,
    path: str,
    date: str,
    contract: Sequence[ContractRow],
    scopes: Sequence[Scope] = (),
    row_rules: Mapping[str, Column] | None = None,
    family: str | None = None,
    loose: Sequence[str] = LOOSE_COLUMNS,
) -> DataFrame:
    """Write a dated version of a table and give its report, as :func:`validation_report`.

    Whether any rule is broken is observed while the rows are written, so a table that keeps its contract is not read
    again but for the columns that must be unique. Otherwise the report is made from the rows that were written.
    """
    counts, outside, cells = _rules_of(df, contract, scopes, row_rules, family, loose)
    broken = [F.count_if(test) for test in counts.values()]
    broken += [F.sum(F.size(items)) for items in outside.values()]
    broken += [F.max(F.expr(doubt)) for doubt in cells.doubts]
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[b.alias(f"b{i}") for i, b in enumerate(broken)])
    write_snapshot(observed, path, date)
    rows = read_snapshot(df.sparkSession, path, date)
    if any(n for name, n in seen.get.items() if name != "rows"):
        return validation_report(rows, contract, scopes, row_rules, family, loose)
    unique = [r.column for r in contract if r.expects("unique")]
    if unique:
        found = unique_offenders(rows, unique).withColumn("message", F.lit("repeated values"))
        return found.select("rule", "column_name", "n_bad", "message")
    return df.sparkSession.createDataFrame([], "rule string, column_name string, n_bad bigint, message string")


def require_valid(report: DataFrame) -> None:
    """Raise with all of the report's messages if any rule is broken; a report has a row per rule and column."""
    rows = report.orderBy("rule", "column_name").collect()
    if rows:
        lines = [f"{r['rule']} {r['column_name']}: {r['message']}" for r in rows]
        raise ValueError("the table breaks its contract:\n" + "\n".join(lines))
