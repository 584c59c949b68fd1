"""Filters that look at a row's group, and numbering.

Groups are reduced to one row per key first and then joined back, so no task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.functions.names import ref, refs
from tablewright.operators.joins import anti_join, drop_matching, semi_join
from tablewright.session import written


def latest_in_group(df: DataFrame, keys: Sequence[str], year: str, strict: bool = True) -> DataFrame:
    """Rows whose year is the greatest of their group, ties kept.

    Strict: a group with a null year is dropped, since its greatest year is not known.
    """
    latest = df.groupBy(*refs(keys)).agg(
        F.max(ref(year)).alias("__latest"),
        F.count(ref(year)).alias("__known"),
        F.count(F.lit(1)).alias("__rows"),
    )
    if strict:
        latest = latest.filter("__known = __rows")
    same_key = reduce(and_, [ref(k, "l").eqNullSafe(ref(k, "r")) for k in keys])
    return df.alias("l").join(
        latest.alias("r"), same_key & (ref(year, "l") == F.col("r.__latest")), "left_semi"
    )


def superseded_filter(df: DataFrame, keys: Sequence[str], superseded: Column) -> DataFrame:
    """Drop the rows that look superseded from groups of more than one row.

    A row for which the condition is null is dropped as well, as a filter on the negated condition does.
    """
    repeated = df.groupBy(*refs(keys)).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1")
    return drop_matching(df, repeated.select(refs(keys)), keys, superseded)


def group_without(df: DataFrame, keys: Sequence[str], prop: Column) -> DataFrame:
    """Rows of groups in which no row has the property; a null that might be one drops its group."""
    return anti_join(df, df.filter(F.coalesce(prop, F.lit(True))), keys)


def group_not_all(df: DataFrame, keys: Sequence[str], column: str, values: Sequence) -> DataFrame:
    """Rows of groups that hold at least one value outside the set."""
    outside = ~F.coalesce(ref(column).isin(*values), F.lit(False))
    return semi_join(df, df.filter(outside), keys)


def sequence_ids(
    df: DataFrame,
    order_by: Sequence[str],
    id_column: str,
    start: int = 1,
    within: Sequence[str] = (),
    rows_per_range: int = 1_000_000,
    check: bool = True,
) -> DataFrame:
    """Consecutive ids in a declared order, from ``start``, in all or separately per ``within`` group.

    Rows are sorted by range over the cluster, in as many ranges as their number asks for, and written
    once; each row's id is its place in its range plus the number of rows in the ranges before, so nothing
    passes through one task. ``order_by`` must identify a row (within its group), or the ids would not be
    defined; that is checked first, with the count of rows, on the keys alone.
    """
    session = df.sparkSession
    keys = refs([*within, *order_by])
    if check:
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        rows, most = counted.agg(F.sum("__n"), F.max("__n")).first()
        if (most or 0) > 1:
            raise ValueError(f"{[*within, *order_by]} does not identify a row: one value is held by {most} rows")
    else:
        rows = df.count()
    least = int(session.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(least, -(-(rows or 0) // rows_per_range))
    placed = written(
        df.repartitionByRange(partitions, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__place", F.monotonically_increasing_id())
    )
    blocks = placed.groupBy(*refs(within), "__part").agg(
        F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    # One row per range (and per group value, if there are any) from here on.
    before = (
        Window.partitionBy(*refs(within)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = blocks.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    if not within:
        blocks = F.broadcast(blocks)  # at most ``partitions`` rows
    same = [ref(k, "l").eqNullSafe(ref(k, "r")) for k in within]
    joined = placed.alias("l").join(
        blocks.alias("r"), reduce(and_, same, F.col("l.__part") == F.col("r.__part")), "inner"
    )
    number = F.col("l.__place") - F.col("r.__first") + F.col("r.__before") + F.lit(start)
    return joined.select(*[ref(c, "l") for c in df.columns], number.cast("bigint").alias(id_column))


def next_id(df: DataFrame, column: str) -> int:
    """One more than the greatest id."""
    greatest = df.agg(F.max(ref(column))).first()[0]
    return int(greatest or 0) + 1


def distinct_keep_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool = False
) -> DataFrame:
    """One whole row per key: the first, or last, in a declared order.

    Each task keeps one row per key before the shuffle.
    """
    rest = [c for c in df.columns if c not in {*keys, *order_by}]
    order = [c for c in order_by if c not in keys]
    pick = F.max if last else F.min
    row = F.struct(*refs(order), *refs(rest))
    best = df.groupBy(*refs(keys)).agg(pick(row).alias("__row"))
    out = [ref(c) if c in keys else ref(c, "__row").alias(c) for c in df.columns]
    return best.select(out)
