"""Delimited files: encodings, missing-value tokens, banner rows and fixed ranges."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tablewright.functions.names import quoted, ref, schema_from_names
from tablewright.functions.text import null_tokens
from tablewright.operators.columns import apply_across
from tablewright.sources.records import csv_records

# Fixed value: the text that stands for a missing value in the files.
NA = "NA"


def _csv_options(encoding: str) -> dict[str, object]:
    return {
        "header": True,
        "quote": '"',
        "escape": '"',
        "nullValue": NA,
        "encoding": encoding,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }


def _text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns in their declared types; a value that does not fit becomes null."""
    return df.select(
        [ref(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    encoding: str = "UTF-8",
    multi_line: bool = False,
    na_tokens: Sequence[str] = (NA,),
    fallback: str | None = None,
) -> DataFrame:
    """Files with a header row.

    Without a schema, types follow the column names. Files are split between tasks, also with ``multi_line=True``, where
    quoted fields may span lines (see :mod:`tablewright.sources.records`). With ``fallback``, files that are not valid
    UTF-8 are read in that encoding; this too reads records.
    """
    reader = spark.read.options(**_csv_options(encoding))
    if schema is None:
        # Only the header is looked at: a schema is built from it, and data are not sampled.
        names = first_record(spark, path, fallback) if fallback else reader.option("multiLine", multi_line).csv(path).columns
        schema = schema_from_names(names)
    if multi_line or fallback:
        options = {k: v for k, v in _csv_options(encoding).items() if k not in ("header", "encoding")}
        body = csv_records(spark, path, encoding, fallback).filter(~F.col("is_first"))
        row = F.from_csv("record", F.lit(_text_schema(schema).toDDL()), {**options, "multiLine": True})
        texts = body.select(row.alias("row")).select([ref(f.name, "row").alias(f.name) for f in schema.fields])
        return _typed(drop_tokens(texts, na_tokens), schema)
    return _typed(drop_tokens(reader.schema(_text_schema(schema)).csv(path), na_tokens), schema)


def first_record(spark: SparkSession, path: str, fallback: str) -> list[str]:
    """The header of files of two encodings, which must agree on it; two are enough to see that they differ."""
    found = [r["record"] for r in csv_records(spark, path, fallback=fallback).filter("is_first").select("record").distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"expected one header, found {'none' if not found else 'several'}")
    return next(csv.reader(io.StringIO(found[0], newline="")))


def drop_tokens(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Null for every text value that is one of the tokens."""
    return apply_across(df, lambda c: null_tokens(c, list(tokens)), of_type="string") if tokens else df


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(**_csv_options(encoding)).csv(path)


def recode_csv(
    spark: SparkSession, source: str, target: str, encoding: str = "ISO-8859-1", multi_line: bool = False
) -> None:
    """Rewrite files of another encoding as UTF-8, all values as text; files that are UTF-8 already are not recoded again."""
    names = first_record(spark, source, encoding)
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    write_csv(read_csv(spark, source, text, multi_line=multi_line, na_tokens=(), fallback=encoding), target)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as (value, file, line_no), numbered from 0 in each file.

    Files are split as usual. A line's number is its place in its split plus the lines of the splits
    before it, so only one row per split is brought together.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    splits = lines.groupBy("file", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return lines.join(splits, ["file", "block"]).select(
        "value", "file", (F.col("place") - F.col("first") + F.col("before")).alias("line_no")
    )


def header_names(spark: SparkSession, path: str, skip: int) -> list[str]:
    """The header below the banner rows; of several files, which must agree, the first one's.

    Only the first split of each file is read, and of it one line is kept; a header further down than the
    first split is an error.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    first = lines.filter("block = 0").withColumn("place", F.monotonically_increasing_id())
    start = first.groupBy("file").agg(F.min(F.struct("place")).alias("start")).select("file", "start.place")
    wanted = start.select(F.col("file").alias("of"), (F.col("place") + F.lit(skip)).alias("at"))
    headers = first.join(wanted, (F.col("file") == F.col("of")) & (F.col("place") == F.col("at"))).select("value").distinct()
    found = [row["value"] for row in headers.limit(2).collect()]  # two are enough to see that they differ
    if len(found) != 1:
        raise ValueError(f"expected one header after {skip} rows, found {'none' if not found else 'several'}")
    return next(csv.reader(found))


def read_range(
    spark: SparkSession,
    path: str,
    skip: int = 0,
    schema: T.StructType | None = None,
    n_columns: int | None = None,
    n_rows: int | None = None,
    na_tokens: Sequence[str] = (NA,),
) -> DataFrame:
    """A table below ``skip`` banner rows: its first ``n_columns`` columns and ``n_rows`` rows, or all.

    This is how an exported sheet, or a fixed range of one, is read. Rows are lines, so fields must not
    span lines.
    """
    columns = header_names(spark, path, skip)
    if schema is None:
        schema = schema_from_names(columns)
    body = numbered_lines(spark, path).filter(F.col("line_no") > skip)
    if n_rows is not None:
        body = body.filter(F.col("line_no") <= skip + n_rows)
    ddl = ", ".join(f"{quoted(c)} string" for c in columns)
    options = {"quote": '"', "escape": '"', "nullValue": NA}
    parsed = body.filter("value <> ''").select(F.from_csv("value", F.lit(ddl), options).alias("row"))
    kept = schema.fields[: n_columns or len(schema.fields)]
    texts = parsed.select([ref(f.name, "row").alias(f.name) for f in kept])
    return _typed(drop_tokens(texts, na_tokens), T.StructType(kept))


def inline_table(spark: SparkSession, rows: Sequence[Sequence], columns: Sequence[str]) -> DataFrame:
    """A small literal table; Spark knows its size, so joins to it need no hint."""
    return spark.createDataFrame(pa.table([list(values) for values in zip(*rows)], names=list(columns)))
