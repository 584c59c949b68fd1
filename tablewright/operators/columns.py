"""Choosing, adding, ordering and changing columns, and keeping rows by a family of columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions import names
from tablewright.functions.logic import any_of
from tablewright.functions.names import ref, refs


def select_columns(df: DataFrame, columns: Sequence[str], first: Sequence[str] = ()) -> DataFrame:
    """The named columns, key columns first."""
    return df.select(refs(names.union(first, columns)))


def drop_columns(df: DataFrame, columns: Sequence[str] = (), pattern: str | None = None) -> DataFrame:
    """Remove columns by name and by pattern."""
    gone = list(columns) + (names.matching(df.columns, pattern) if pattern else [])
    return df.select(refs(names.difference(df.columns, gone)))


def select_matching(
    df: DataFrame, pattern: str, negate: bool = False, first: Sequence[str] = ()
) -> DataFrame:
    """The columns whose names match a pattern, after the columns named in ``first``."""
    return df.select(refs(names.union(first, names.matching(df.columns, pattern, negate))))


def add_missing_columns(df: DataFrame, columns: Sequence[str], value: Column) -> DataFrame:
    """Add the columns that are not there yet, all with one constant."""
    absent = names.difference(columns, df.columns)
    return df.select(*refs(df.columns), *[value.alias(name) for name in absent])


def reorder_by_vocabulary(df: DataFrame, blocks: Sequence[Sequence[str]], family: str = "^X") -> DataFrame:
    return df.select(refs(names.vocabulary_order(df.columns, blocks, family)))


def rename_columns(df: DataFrame, **rules) -> DataFrame:
    """Rename by the rules of :func:`tablewright.functions.names.renaming`."""
    return df.withColumnsRenamed(names.renaming(df.columns, **rules))


def derive(df: DataFrame, columns: Mapping[str, Column], keep_only_new: bool = False) -> DataFrame:
    """Constants and computed columns, added to the row or in its place."""
    if keep_only_new:
        return df.select([value.alias(name) for name, value in columns.items()])
    replaced = [columns[name].alias(name) if name in columns else ref(name) for name in df.columns]
    added = [columns[name].alias(name) for name in names.difference(columns, df.columns)]
    return df.select(*replaced, *added)


def apply_across(
    df: DataFrame,
    change: Callable[[Column], Column],
    columns: Sequence[str] | None = None,
    pattern: str | None = None,
    of_type: str | None = None,
) -> DataFrame:
    """One expression over many columns, chosen by name, pattern or type (all that are given must hold)."""
    chosen = [
        name
        for name, dtype in df.dtypes
        if (columns is None or name in columns)
        and (pattern is None or names.matching([name], pattern))
        and (of_type is None or dtype == of_type)
    ]
    return derive(df, {name: change(ref(name)) for name in chosen})


def keep_if_any(df: DataFrame, pattern: str, test: Callable[[Column], Column] = Column.isNotNull) -> DataFrame:
    """Rows in which at least one column of the family passes the test."""
    return df.filter(any_of(test(ref(c)) for c in names.matching(df.columns, pattern)))


def keep_if_all(df: DataFrame, pattern: str, test: Callable[[Column], Column] = Column.isNotNull) -> DataFrame:
    """Rows in which every column of the family passes the test."""
    fails = (F.coalesce(~test(ref(c)), F.lit(True)) for c in names.matching(df.columns, pattern))
    return df.filter(~any_of(fails))


def domain_rank(col: Column, levels: Sequence[str], reverse: bool = False) -> Column:
    """Position of a value among declared levels; null for a value outside them."""
    ordered = list(reversed(levels)) if reverse else list(levels)
    rank = F.when(col == ordered[0], F.lit(1))
    for position, level in enumerate(ordered[1:], start=2):
        rank = rank.when(col == level, F.lit(position))
    return rank


def set_difference_count(df: DataFrame, left: Column, right: Column) -> DataFrame:
    """How many rows meet exactly one of two conditions; zero means that the two row sets are equal."""
    differs = F.coalesce(left, F.lit(False)) != F.coalesce(right, F.lit(False))
    return df.agg(F.count_if(differs).alias("n_differ"))
