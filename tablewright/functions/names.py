"""Helpers on column names. Names may hold dots, so every reference is back-quoted."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F, types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str, alias: str | None = None) -> Column:
    return F.col(quoted(name) if alias is None else f"{alias}.{quoted(name)}")


def refs(names: Iterable[str]) -> list[Column]:
    return [ref(name) for name in names]


def literals(values: Iterable[str]) -> list[str]:
    """Texts as SQL literals: lists of hundreds are slow to build one call at a time."""
    return ["'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values]


def matching(names: Iterable[str], pattern: str, negate: bool = False) -> list[str]:
    """Names in which the pattern is found (or, negated, not found), in their order."""
    return [name for name in names if (re.search(pattern, name) is not None) != negate]


def union(*groups: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(name for group in groups for name in group))


def intersect(left: Iterable[str], right: Iterable[str]) -> list[str]:
    keep = set(right)
    return [name for name in dict.fromkeys(left) if name in keep]


def difference(left: Iterable[str], right: Iterable[str]) -> list[str]:
    skip = set(right)
    return [name for name in dict.fromkeys(left) if name not in skip]


def number_in(name: str) -> float | None:
    """The first one- or two-digit number, with an optional decimal digit, inside a name."""
    found = re.search(r"\d\d?\.?\d?", name)
    return float(found.group().rstrip(".")) if found else None


def vocabulary_order(
    columns: Sequence[str], blocks: Sequence[Sequence[str]], family: str = "^X"
) -> list[str]:
    """Named blocks first, then a numbered family by the number in each name, measures as they come."""
    leading = [name for block in blocks for name in block]
    numbered = [name for name in columns if re.search(family, name)]
    measures = union(re.sub(r"\d\d?\.?\d?", "", name, count=1) for name in numbered)
    rank = {measure: i for i, measure in enumerate(measures)}
    numbered.sort(key=lambda name: (number_in(name), rank[re.sub(r"\d\d?\.?\d?", "", name, count=1)]))
    return union(intersect(leading, columns), numbered)


def renaming(
    columns: Sequence[str],
    explicit: Mapping[str, str] | None = None,
    prefix: tuple[str, Sequence[str]] | None = None,
    patterns: Sequence[tuple[str, str]] = (),
    each: Callable[[str], str] | None = None,
) -> dict[str, str]:
    """Old-to-new names: explicit pairs, a prefix on a set, regex rules on all, then a function on all."""
    explicit = dict(explicit or {})
    unknown = difference(list(explicit) + list(prefix[1] if prefix else ()), columns)
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    result = {}
    for old in columns:
        new = explicit.get(old, old)
        if prefix and old in prefix[1]:
            new = prefix[0] + new
        for pattern, replacement in patterns:
            new = re.sub(pattern, replacement, new)
        result[old] = each(new) if each else new
    if len(set(result.values())) < len(result):
        raise ValueError("two columns would get the same name")
    return {old: new for old, new in result.items() if old != new}


# First rule whose pattern is found in the column name wins; the rest are read as text.
NAME_TYPE_RULES = (("Date|DATE|date", T.DateType()), ("year|ID", T.DoubleType()))


def schema_from_names(
    names: Sequence[str],
    rules: Sequence[tuple[str, T.DataType]] = NAME_TYPE_RULES,
    override: Mapping[str, T.DataType] | None = None,
) -> T.StructType:
    """A type for every column, chosen by its name."""
    override = override or {}

    def type_of(name: str) -> T.DataType:
        if name in override:
            return override[name]
        return next((dtype for pattern, dtype in rules if re.search(pattern, name)), T.StringType())

    return T.StructType([T.StructField(name, type_of(name)) for name in names])
