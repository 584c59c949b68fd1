"""Tables kept by key, so that a round of changes moves the batch and rewrites only what it touches.

A table is partitioned by a hash of its key and bucketed by the key in each partition. A batch names its partitions; only
these are read, joined bucket by bucket without a shuffle of the table, and written back, each partition as a whole and
by renaming, so readers see the old or the new rows of a partition. Files of other partitions are not opened. Keys must
not be null, and a key is held by one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.functions.names import quoted, ref, refs
from tablewright.operators.aggregates import key_message, unique_or_error

PART = "key_part"


def _part(key: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*refs(key)), F.lit(parts)).cast("int")


def _properties(spark: SparkSession, name: str) -> tuple[list[str], int, int]:
    """Key, partitions and buckets of a table."""
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return held["keyed.key"].split("\n"), int(held["keyed.parts"]), int(held["keyed.buckets"])


def create_keyed(
    df: DataFrame, name: str, key: Sequence[str], parts: int = 64, buckets: int = 8, path: str | None = None
) -> None:
    """Save ``df`` as a new table kept by ``key``. ``path``: where, if not in the warehouse.

    Choose ``parts`` by how much of the table a batch touches, ``buckets`` by the size of a partition.
    """
    absent = reduce(or_, [ref(k).isNull() for k in key])
    message = key_message(f"null in the key {list(key)}: ", refs(key))
    sound = unique_or_error(df, key, "table").filter(F.when(absent, F.raise_error(message).cast("boolean")).otherwise(True))
    rows = sound.withColumn(PART, _part(key, parts)).repartition(buckets, *refs(key))
    writer = rows.write.partitionBy(PART).bucketBy(buckets, *key).sortBy(*key).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    held = {"keyed.key": "\n".join(key), "keyed.parts": parts, "keyed.buckets": buckets}
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in held.items())
    df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def keyed_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(PART)


def touched_parts(batch: DataFrame, key: Sequence[str], parts: int) -> list[int]:
    """Partitions that hold a key of the batch: at most ``parts`` numbers."""
    return sorted(r[0] for r in batch.select(_part(key, parts)).distinct().collect())


def next_rows(
    spark: SparkSession, name: str, batch: DataFrame, change: Callable[..., DataFrame], **options
) -> tuple[DataFrame, list[int]]:
    """The next rows of the partitions that a batch touches, and these partitions' numbers."""
    key, parts, _ = _properties(spark, name)
    touched = touched_parts(batch, key, parts)
    current = spark.table(name).filter(F.col(PART).isin(touched)).drop(PART)
    return change(current, batch, key, null_keys=False, **options), touched


def change_keyed(
    spark: SparkSession, name: str, batch: DataFrame, change: Callable[..., DataFrame], **options
) -> list[int]:
    """Apply ``change`` (``rows_update``, ``rows_patch``, ``rows_insert``, ``rows_delete`` or ``route_changes``, with its
    options) to a kept table; gives the partitions that were rewritten.

    Rows whose key is null in the batch match nothing.
    """
    key, parts, buckets = _properties(spark, name)
    columns = spark.table(name).columns
    rows, touched = next_rows(spark, name, batch, change, **options)
    if not touched:
        return []
    after = rows.withColumn(PART, _part(key, parts)).select(*refs(columns))
    # A partition that loses all its rows is not among those written, so it has to be dropped.
    left = {r[0] for r in after.select(PART).distinct().collect()} if change.__name__ in ("rows_delete", "route_changes") else set(touched)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        after.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)
    for part in touched:
        if part not in left:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({quoted(PART)} = {part})")
    spark.catalog.refreshTable(name)
    return touched
