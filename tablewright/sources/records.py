"""Records of delimited files whose quoted fields may span lines, read in parallel.

Files are read as lines, split between tasks as usual. Whether a line starts inside a quoted field depends on all quotes
before it, but only on their number's parity: each split gives the parity of its quotes, and a running exclusive or over
the splits of a file, one row per split, tells each split how it starts. A task then goes through its lines once and puts
together those of a record. A record that crosses splits is left in fragments, at most two per split; only these are
brought together.

A quote inside a field is doubled, as the writer does; one inside an unquoted field has to be as well. A file that ends
inside a field gives what it has as its last record. Empty lines between records are no records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

WHOLE, HEAD, THROUGH, TAIL = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str) -> DataFrame:
    # With this separator a carriage return stays, so that fields keep theirs.
    lines = spark.read.option("lineSep", "\n").text(path)
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), odd.alias("odd"), "value"
    )


def _splits(lines: DataFrame) -> DataFrame:
    """Per split whether it starts inside a field, and whether its whole file is valid UTF-8. One row per split."""
    own = lines.groupBy("file", "block").agg(
        F.bit_xor(F.col("odd").cast("int")).alias("parity"), F.bool_and(F.is_valid_utf8("value")).alias("valid")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1
    valid = F.min("valid").over(Window.partitionBy("file"))
    return own.select("file", "block", inside.alias("inside"), valid.alias("valid"))


def _put_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records and fragments of the splits of a task, whose lines come in order."""
    at, kind, held, is_first = None, WHOLE, [], False
    out: list[tuple] = []

    def open_record() -> list[tuple]:
        """What is left of a split's last record."""
        if not held:
            return []
        return [(*at, THROUGH if kind == HEAD else TAIL, is_first, "\n".join(held))]

    for batch in batches:
        for file, block, odd, value, inside in batch.itertuples(index=False, name=None):
            if at != (file, block):
                out += open_record()
                at, held = (file, block), []
                kind, is_first = (HEAD, False) if inside else (WHOLE, block == 0)
                open_field = inside
            open_field ^= odd
            held.append(value)
            if not open_field:
                out.append((*at, kind, is_first, "\n".join(held)))
                kind, held, is_first = WHOLE, [], False
        if out:
            yield pd.DataFrame(out, columns=["file", "block", "kind", "is_first", "record"])
            out = []
    out += open_record()
    if out:
        yield pd.DataFrame(out, columns=["file", "block", "kind", "is_first", "record"])


def csv_records(spark: SparkSession, path: str, encoding: str = "UTF-8", fallback: str | None = None) -> DataFrame:
    """Records as (file, is_first, record); ``is_first`` marks the first of each file.

    With ``fallback``, files that are not valid UTF-8 as a whole are read in that encoding, others as UTF-8.
    """
    lines = _lines(spark, path)
    splits = F.broadcast(_splits(lines))  # one row per split
    with_state = lines.join(splits, ["file", "block"])
    raw = F.col("value").cast("binary")
    text: Column = F.col("value") if encoding.upper() == "UTF-8" else F.decode(raw, encoding)
    if fallback is not None:
        text = F.when(F.col("valid"), F.col("value")).otherwise(F.decode(raw, fallback))
    rows = with_state.select("file", "block", "odd", text.alias("value"), "inside")
    # The task reads its splits in order, and a join with a broadcast table keeps it.
    found = rows.mapInPandas(_put_together, "file string, block bigint, kind int, is_first boolean, record string")
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    # A tail opens a record; heads and splits that lie within it follow. At most two rows per split.
    opened = F.sum((F.col("kind") == TAIL).cast("int")).over(order)
    fragments = found.filter(F.col("kind") != WHOLE).withColumn("number", opened)
    parts = F.sort_array(F.collect_list(F.struct("block", "kind", "record")))
    joined = fragments.groupBy("file", "number").agg(
        F.max("is_first").alias("is_first"), F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record")
    )
    records = found.filter(F.col("kind") == WHOLE).select("file", "is_first", "record")
    records = records.unionByName(joined.select("file", "is_first", "record"))
    return records.withColumn("record", F.regexp_replace("record", "\r$", "")).filter("record <> ''")
