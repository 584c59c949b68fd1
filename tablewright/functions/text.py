"""Text expressions. Patterns are Java regular expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def _literal(replacement: str) -> str:
    return replacement.replace("\\", "\\\\").replace("$", "\\$")


def replace_first(col: Column, pattern: str, replacement: str, ignore_case: bool = False) -> Column:
    """Replace only the first match; Spark's own function replaces all."""
    flags = "(?iu)" if ignore_case else ""
    return F.regexp_replace(col, rf"{flags}^((?s:.*?))(?:{pattern})", "$1" + _literal(replacement))


def is_plain(pattern: str) -> bool:
    """Whether a pattern stands for nothing but its own letters."""
    return re.search(r"[\\.\[\](){}*+?^$|]", pattern) is None


def found(col: Column, pattern: str) -> Column:
    """Whether a pattern occurs. Plain letters are looked for as such, several times faster than as a pattern; so are
    those of a pattern that only adds the end of the text, which is then tried where they occur."""
    letters = pattern.removesuffix("$")
    if not is_plain(letters):
        return col.rlike(pattern)
    held = F.contains(col, F.lit(letters))
    return held if letters == pattern else held & col.rlike(pattern)


def replace_all(col: Column, pattern: str, replacement: str, ignore_case: bool = False) -> Column:
    flags = "(?iu)" if ignore_case else ""
    return F.regexp_replace(col, flags + pattern, _literal(replacement))


def squish(col: Column) -> Column:
    """Trim, and collapse every run of white space to one space."""
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


def trimmed(col: Column) -> Column:
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def sentence_case(col: Column) -> Column:
    """First letter upper case, the rest lower case (one sentence per value)."""
    return F.concat(F.upper(F.left(col, F.lit(1))), F.lower(F.substring(col, 2, 2147483647)))


def extract(col: Column, pattern: str, group: int = 0) -> Column:
    """The matched text, or null where nothing matches."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


# Latin letters that have no plain letter inside them, and letters that become two.
UNLIKE = {"Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "Ł": "L", "ł": "l", "Ø": "O", "ø": "o", "Ŧ": "T", "ŧ": "t"}
TWO_LETTER = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Þ": "TH", "þ": "th"}


def _plain_letters() -> dict[str, str]:
    """Accented letters of the Latin-1, Extended-A and Extended-B blocks and the plain letter each is made from."""
    plain = dict(UNLIKE)
    for letter in map(chr, range(0xC0, 0x250)):
        base = unicodedata.normalize("NFD", letter)[0]
        if base != letter and base.isascii():
            plain[letter] = base
    return plain


PLAIN_LETTERS = _plain_letters()


def to_ascii(col: Column) -> Column:
    out = F.translate(col, "".join(PLAIN_LETTERS), "".join(PLAIN_LETTERS.values()))
    for letter, plain in TWO_LETTER.items():
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return out


def derive_url(name: Column, prefix: str) -> Column:
    """A search address from a name: spaced hyphens, plain letters, a few signs percent-encoded."""
    out = to_ascii(F.replace(name, F.lit("-"), F.lit(" - ")))
    out = F.replace(out, F.lit("/"), F.lit("%20%2F%20"))
    out = F.replace(out, F.lit("'"), F.lit("%27"))
    return F.concat(F.lit(prefix), F.regexp_replace(out, r"(?U)\s", "%20"))


def status_normalise(col: Column, labels: Sequence[str] = ("Special Concern",)) -> Column:
    """Trimmed, in sentence case, with labels of several capitals restored."""
    out = sentence_case(trimmed(col))
    for label in labels:
        out = replace_first(out, label[:1].upper() + label[1:].lower(), label)
    return out


# Spacing round hyphens and slashes, in two passes because matches may overlap.
SPACED_HYPHEN = " -| - |- "
SPACED_SLASH = " /| / |/ "


def canonical_name(
    col: Column,
    drop_brackets: bool = True,
    corrections: Sequence[tuple[str, str]] = (),
    exact: Mapping[str, str] | None = None,
) -> Column:
    """A name in the form under which two sources agree.

    ``corrections`` are (pattern, replacement) pairs, each on its first match, applied in order to the
    lower-case name; ``exact`` maps whole names.
    """
    out = F.regexp_replace(col, r"\(|\)", "") if drop_brackets else col
    out = F.replace(out, F.lit("’"), F.lit("'"))
    for _ in range(2):
        out = F.regexp_replace(out, SPACED_HYPHEN, "-")
    out = F.replace(out, F.lit(" – "), F.lit("-"))
    for _ in range(2):
        out = F.regexp_replace(out, SPACED_SLASH, "/")
    out = squish(F.lower(out))
    for pattern, replacement in corrections:
        out = replace_first(out, pattern, replacement)
    if exact:
        out = map_values(out, exact, unmapped="keep")
    return out


def map_values(col: Column, mapping: Mapping, unmapped: str = "null") -> Column:
    """Exact value to label; a value without a label becomes null, stays, or is an error."""
    out = None
    for value, label in mapping.items():
        out = (F if out is None else out).when(col == F.lit(value), F.lit(label))
    if unmapped == "null":
        return out
    if unmapped == "keep":
        return out.otherwise(col)
    if unmapped == "error":
        message = F.concat(F.lit("no label for value "), col.cast("string"))
        return out.when(col.isNotNull(), F.raise_error(message))
    raise ValueError(f"unmapped must be null, keep or error, not {unmapped}")


def null_unless(condition: Column, col: Column) -> Column:
    """The value where the condition holds, null elsewhere."""
    return F.when(condition, col)


def null_sentinel(col: Column, sentinel: str) -> Column:
    """The whole value becomes null if it holds the sentinel text."""
    return F.when(~F.contains(col, F.lit(sentinel)), col)


def null_tokens(col: Column, tokens: Sequence[str]) -> Column:
    """Null for a value that is one of the tokens standing for "no value"."""
    return F.when(~col.isin(*tokens), col)


def pieces(col: Column, sep: str = ", ") -> Column:
    """Items of a delimited text; ``sep`` is plain text."""
    return F.split(col, r"\Q" + sep + r"\E")


def joined(columns: Sequence[Column], sep: str = ", ", null_text: str | None = "NA") -> Column:
    """Values pasted together; a null is written as ``null_text``, or skipped when that is None."""
    texts = [c.cast("string") for c in columns]
    if null_text is not None:
        texts = [F.coalesce(c, F.lit(null_text)) for c in texts]
    return F.concat_ws(sep, *texts)
