"""Dated versions of a table, what differs between two of them, and rejected rows kept beside it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.functions.names import literals, quoted, ref, refs
from tablewright.sources.delimited import write_csv

BUCKET = "key_bucket"


def snapshot_path(path: str, date: str) -> str:
    return f"{path.rstrip('/')}/snapshot={date}"


def write_snapshot(df: DataFrame, path: str, date: str, file_format: str = "parquet") -> str:
    """Write one dated version; a version that is there already is never overwritten."""
    target = snapshot_path(path, date)
    if file_format == "csv":
        write_csv(df, target)
    else:
        df.write.mode("errorifexists").format(file_format).save(target)
    return target


def read_snapshot(spark: SparkSession, path: str, date: str) -> DataFrame:
    return spark.read.parquet(snapshot_path(path, date))


def _digests(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, and two sums of row digests, by bucket. The order of rows does not matter; repeated rows do not cancel out."""
    # A hash passes over nulls, so that they are hashed by place as well.
    nulls = F.expr(f"concat({', '.join(f'int(isnull({quoted(c)}))' for c in columns)})")
    first, second = (F.xxhash64(F.lit(i), *refs(columns), nulls) for i in (0, 1))
    return df.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(first).alias("x"), F.sum(F.shiftrightunsigned(second, 32).cast("decimal(20,0)")).alias("s")
    )


def write_digested(df: DataFrame, path: str, date: str, ids: Sequence[str], buckets: int = 256) -> str:
    """Write one dated version in buckets of the key, with a digest of each beside them.

    Buckets are folders, so that a later comparison opens only those that differ.
    """
    target = snapshot_path(path, date)
    bucket = F.pmod(F.xxhash64(*refs(ids)), F.lit(buckets)).cast("int")
    rows = df.withColumn(BUCKET, bucket).repartition(BUCKET)
    rows.write.mode("errorifexists").partitionBy(BUCKET).parquet(f"{target}/rows")
    schema = rows.schema
    spark = df.sparkSession
    _digests(spark.read.schema(schema).parquet(f"{target}/rows"), df.columns).write.parquet(f"{target}/digests")
    return target


def read_digested(spark: SparkSession, path: str, date: str) -> DataFrame:
    return spark.read.parquet(f"{snapshot_path(path, date)}/rows").drop(BUCKET)


def differing_buckets(spark: SparkSession, path: str, old: str, new: str) -> list[int]:
    """Buckets whose digests differ: numbers below the number of buckets."""
    left, right = (spark.read.parquet(f"{snapshot_path(path, date)}/digests") for date in (old, new))
    same = reduce(and_, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("n", "x", "s")])
    joined = left.alias("l").join(right.alias("r"), F.col(f"l.{BUCKET}") == F.col(f"r.{BUCKET}"), "full")
    return sorted(r[0] for r in joined.filter(~same).select(F.coalesce(f"l.{BUCKET}", f"r.{BUCKET}")).collect())


def snapshot_diff(
    spark: SparkSession, path: str, old: str, new: str, ids: Sequence[str], names: tuple[str, str] = ("old_value", "new_value")
) -> DataFrame:
    """What changed between two versions, as (ids, change, column_name, old, new).

    ``change`` is ``changed`` for a cell of a row that is in both, nulls included, and ``added`` or ``removed`` for a row
    that is in one, without column and values. Only buckets whose digests differ are read. Both versions must have been
    written with the same key and number of buckets; columns that only one of them has are not compared.
    """
    differing = differing_buckets(spark, path, old, new)
    sides = [spark.read.parquet(f"{snapshot_path(path, d)}/rows").filter(F.col(BUCKET).isin(differing)) for d in (old, new)]
    shared = [c for c in sides[0].columns if c in sides[1].columns and c not in (*ids, BUCKET)]
    left, right = (s.select(*refs(ids), *refs(shared), F.lit(True).alias("__there")) for s in sides)
    same = reduce(and_, [ref(k, "l").eqNullSafe(ref(k, "r")) for k in ids])
    joined = left.alias("l").join(right.alias("r"), same, "full")
    listed = ", ".join(
        f"struct({name} AS column_name, string(l.{quoted(c)}) AS a, string(r.{quoted(c)}) AS b)"
        for name, c in zip(literals(shared), shared, strict=True)
    )
    none = "array(struct(CAST(NULL AS string) AS column_name, CAST(NULL AS string) AS a, CAST(NULL AS string) AS b))"
    cells = f"filter(array({listed}), c -> NOT (c.a <=> c.b))" if shared else f"filter({none}, c -> false)"
    change = F.when(ref("__there", "r").isNull(), "removed").when(ref("__there", "l").isNull(), "added").otherwise("changed")
    found = joined.select(
        *[F.coalesce(ref(k, "l"), ref(k, "r")).alias(k) for k in ids],
        change.alias("change"),
        F.expr(f"CASE WHEN l.__there AND r.__there THEN {cells} ELSE {none} END").alias("__cells"),
    )
    rows = found.select(*refs(ids), "change", F.inline("__cells"))
    return rows.withColumnsRenamed({"a": names[0], "b": names[1]})


def split_off(df: DataFrame, reject: Column, keep_null: bool = False) -> tuple[DataFrame, DataFrame]:
    """Kept and rejected rows. A row for which the condition is null is in neither, unless kept."""
    kept = F.coalesce(~reject, F.lit(True)) if keep_null else ~reject
    return df.filter(kept), df.filter(reject)


def write_split(df: DataFrame, reject: Column, kept_path: str, rejected_path: str) -> None:
    """Write the rejected rows first, then the table without them."""
    kept, rejected = split_off(df, reject)
    rejected.write.mode("errorifexists").parquet(rejected_path)
    kept.write.mode("errorifexists").parquet(kept_path)
