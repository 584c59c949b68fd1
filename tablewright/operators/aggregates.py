"""Counts, distinct values and other aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.names import ref, refs
from tablewright.functions.text import pieces


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Keys held by more than one row (a null counts as a value)."""
    return count_by(df, keys, count).filter(ref(count) > 1)


def unique_or_error(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """One row per key with the other columns; a key held by more than one row fails the query.

    The check is part of the plan: rows are reduced by key, and the key is named when its count is read.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        rest_struct = F.struct(F.lit(None).alias("__none"))
    else:
        rest_struct = F.struct(*refs(rest))
    one = df.groupBy(*refs(keys)).agg(F.count(F.lit(1)).alias("__rows"), F.max(rest_struct).alias("__row"))
    once = F.when(F.col("__rows") == 1, F.col("__row")).otherwise(
        F.raise_error(key_message(f"keys {list(keys)} of the {what} are not unique, e.g. ", refs(keys)))
    )
    checked = one.filter(once.isNotNull())
    return checked.select([ref(c) if c in keys else ref(c, "__row").alias(c) for c in df.columns])


def key_message(text: str, keys: Sequence[Column]) -> Column:
    """A message with the values of a key."""
    values = [F.coalesce(k.cast("string"), F.lit("null")) for k in keys]
    return F.concat(F.lit(text), F.concat_ws(", ", *values))


def count_by(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    return df.groupBy(*refs(keys)).agg(F.count(F.lit(1)).alias(count))


def first_in_group(df: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[str]) -> DataFrame:
    """The value of each group's first row in a declared order."""
    return df.groupBy(*refs(keys)).agg(F.min_by(ref(value), F.struct(*refs(order_by))).alias(value))


def n_distinct(df: DataFrame, columns: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """How many distinct values there are; null is a value."""
    return df.select(refs(columns)).distinct().agg(F.count(F.lit(1)).alias(name))


def string_agg(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    sep: str = ", ",
    name: str | None = None,
    order_by: Sequence[str] = (),
    distinct: bool = False,
    null_text: str | None = "NA",
    large_groups: bool = False,
) -> DataFrame:
    """The values of each group as one delimited text, repeats kept, in a declared order.

    Without ``order_by`` the values order themselves. ``distinct`` keeps one of equal values (which then
    are their own order) and reduces the rows before they are gathered. A null is written as
    ``null_text``, or skipped if that is None. The text of a group is one cell, as long as its values.

    With ``large_groups`` rows are first sorted by range over the cluster, so that a large group is sorted and put
    together by several tasks; only the texts of its ranges, in their order, meet in one.
    """
    text = ref(value).cast("string")
    rows = df.select(
        *refs(keys),
        (text if null_text is None else F.coalesce(text, F.lit(null_text))).alias("__value"),
        *[ref(c).alias(f"__order{i}") for i, c in enumerate(() if distinct else order_by)],
    )
    order = "__value" if distinct or not order_by else ", ".join(f"__order{i}" for i in range(len(order_by)))
    if distinct:
        rows = rows.distinct()
    quoted_sep = sep.replace("\\", "\\\\").replace("'", "\\'")
    listed = F.expr(f"listagg(__value, '{quoted_sep}') WITHIN GROUP (ORDER BY {order})")
    if large_groups:
        # As many ranges as a shuffle has: their number must be given, or small ones would be joined.
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        columns = [c.strip() for c in order.split(",")]
        ranged = rows.repartitionByRange(ranges, *refs(keys), *columns).withColumn("__range", F.spark_partition_id())
        parts = ranged.groupBy(*refs(keys), "__range").agg(listed.alias("__part"))
        whole = F.expr(f"listagg(__part, '{quoted_sep}') WITHIN GROUP (ORDER BY __range)")
        return parts.groupBy(*refs(keys)).agg(F.coalesce(whole, F.lit("")).alias(name or value))
    return rows.groupBy(*refs(keys)).agg(F.coalesce(listed, F.lit("")).alias(name or value))


def distinct_values(df: DataFrame, column: str, sep: str | None = None) -> DataFrame:
    """The distinct values of a column, after splitting lists."""
    if sep is None:
        return df.select(ref(column)).distinct()
    return df.select(F.explode_outer(pieces(ref(column), sep)).alias(column)).distinct()


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Least and greatest value of each column, nulls skipped."""
    sides = [f(ref(c)).alias(f"{label}_{c}") for c in columns for label, f in (("min", F.min), ("max", F.max))]
    return df.agg(*sides)


def counts_long(
    df: DataFrame, counts: Mapping[tuple[str, ...], Column], labels: Sequence[str], count: str
) -> DataFrame:
    """Many conditional counts in one scan, as one row per count.

    ``counts`` maps the label values of a result row to a Boolean column; rows where it is true are
    counted.
    """
    aggregated = df.agg(*[F.count_if(test).alias(f"c{i}") for i, test in enumerate(counts.values())])
    rows = [
        F.struct(*[F.lit(v).alias(label) for label, v in zip(labels, values)], F.col(f"c{i}").alias(count))
        for i, values in enumerate(counts)
    ]
    return aggregated.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Columns with nulls and how many, in one scan."""
    scope = F.lit(True) if where is None else where
    tests = {(name,): scope & ref(name).isNull() for name in columns}
    return counts_long(df, tests, ["column_name"], "n_missing").filter("n_missing > 0")
