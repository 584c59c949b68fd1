"""Readers and writers, as round trips through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tablewright.functions.dates import date_text
from tablewright.operators.joins import left_join
from tablewright.queries.registry import query
from tablewright.session import scratch_path
from tablewright.sources import delimited, snapshots

_LONG, _TEXT, _DOUBLE = T.LongType(), T.StringType(), T.DoubleType()


def _schema(**types) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in types.items()])


@query("src1_csv_source", "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents")
def _(t):
    path = scratch_path(t.spark, "documents")
    delimited.write_csv(t.documents, path)
    schema = _schema(doc_id=_LONG, text=_TEXT, lang=_TEXT, source=_TEXT, n_chars=_LONG)
    df = delimited.read_csv(t.spark, path, schema, multi_line=True)  # texts hold line breaks
    return df.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@query(
    "src2_csv_encoding",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, replace(c_name, 'u', 'û') AS c_name,
              concat(c_mktsegment, ' é') AS c_mktsegment FROM customer""",
)
def _(t):
    latin, utf8 = scratch_path(t.spark, "latin"), scratch_path(t.spark, "utf8")
    df = t.customer.select(
        "c_custkey",
        F.replace("c_name", F.lit("u"), F.lit("û")).alias("c_name"),
        F.concat("c_mktsegment", F.lit(" é")).alias("c_mktsegment"),
    )
    delimited.write_csv(df, latin, encoding="ISO-8859-1")
    delimited.recode_csv(t.spark, latin, utf8)
    return delimited.read_csv(t.spark, utf8)


@query(
    "src2_mixed_encodings",
    """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, replace(c_name, 'u', 'û') AS c_name,
              concat(c_mktsegment, ' é') AS c_mktsegment FROM customer""",
)
def _(t):
    """Files of two encodings in one folder; those that are UTF-8 already are taken as they are."""
    path = scratch_path(t.spark, "mixed")
    df = t.customer.select(
        "c_custkey",
        F.replace("c_name", F.lit("u"), F.lit("û")).alias("c_name"),
        F.concat("c_mktsegment", F.lit(" é")).alias("c_mktsegment"),
    )
    delimited.write_csv(df.filter("c_custkey % 3 = 0"), path, encoding="ISO-8859-1")
    delimited.write_csv(df.filter("c_custkey % 3 <> 0"), path, mode="append")
    schema = _schema(c_custkey=_LONG, c_name=_TEXT, c_mktsegment=_TEXT)
    return delimited.read_csv(t.spark, path, schema, fallback="ISO-8859-1")


def _write_sheet(t, df, banner):
    """Export rows as text files, each with banner rows and a header above its rows."""
    path = scratch_path(t.spark, "sheet")
    cells = [F.concat(F.lit('"'), F.coalesce(F.col(c).cast("string"), F.lit("NA")), F.lit('"')) for c in df.columns]
    line = F.concat_ws(",", *cells)
    top = "".join(f"{row}\n" for row in [*banner, ",".join(df.columns)])
    is_first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    df.select(F.when(is_first, F.concat(F.lit(top), line)).otherwise(line).alias("value")).write.text(path)
    return path


@query(
    "src3_skip_rows",
    """SELECT CAST(o_orderkey AS DOUBLE) AS "orderID", strftime(o_orderdate, '%Y-%m-%d') AS date_text, o_orderpriority
       FROM orders""",
)
def _(t):
    df = t.orders.select(
        F.col("o_orderkey").alias("orderID"), date_text(F.col("o_orderdate")).alias("orderDate"), "o_orderpriority"
    )
    path = _write_sheet(t, df, ["Orders, as exported", '"all years"'])
    read = delimited.read_range(t.spark, path, skip=2)
    return read.select("orderID", date_text(F.col("orderDate")).alias("date_text"), "o_orderpriority")


@query(
    "src4_sheet_range",
    """SELECT p_partkey, nullif(p_brand, 'Brand#2') AS p_brand, CASE WHEN p_size % 5 <> 0 THEN p_type END AS p_type
       FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) AS rn FROM part) WHERE rn <= (SELECT count(*) // 2 FROM part)""",
)
def _(t):
    """The first half of the rows and three of the columns of one sheet, as a fixed cell range."""
    df = t.part.select(
        "p_partkey",
        F.when(F.col("p_brand") == "Brand#2", F.lit("-")).otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("p_type"),
        "p_size",
        "p_retailprice",
    )
    half = df.count() // 2
    path = _write_sheet(t, df.coalesce(1).sortWithinPartitions("p_partkey"), ["Parts"])
    schema = _schema(p_partkey=_LONG, p_brand=_TEXT, p_type=_TEXT, p_size=_LONG, p_retailprice=_DOUBLE)
    return delimited.read_range(t.spark, path, 1, schema, n_columns=3, n_rows=half, na_tokens=["NA", "-"])


@query(
    "src6_inline_table",
    "SELECT o_orderkey, label FROM orders LEFT JOIN (VALUES ('F', 'finished'), ('O', 'open')) v(code, label) ON o_orderstatus = code",
)
def _(t):
    labels = delimited.inline_table(t.spark, [("F", "finished"), ("O", "open")], ["code", "label"])
    return left_join(t.orders.select("o_orderkey", "o_orderstatus"), labels, {"o_orderstatus": "code"}).drop("o_orderstatus")


@query("snk1_snapshot_sink", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 0")
def _(t):
    path = scratch_path(t.spark, "snapshots")
    table = t.customer.select("c_custkey", "c_name", "c_acctbal")
    snapshots.write_snapshot(table, path, "2022-03-07")
    first = snapshots.read_snapshot(t.spark, path, "2022-03-07")
    snapshots.write_snapshot(first.filter("c_acctbal >= 0"), path, "2022-03-14")
    return snapshots.read_snapshot(t.spark, path, "2022-03-14")


@query(
    "snk2_side_output",
    """SELECT o_orderkey, CASE WHEN status = '5-LOW' THEN 'rejected' ELSE 'kept' END AS side
       FROM (SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS status FROM orders)
       WHERE status IS NOT NULL""",
)
def _(t):
    kept, rejected = scratch_path(t.spark, "kept"), scratch_path(t.spark, "rejected")
    df = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("status"))
    snapshots.write_split(df, F.col("status") == "5-LOW", kept, rejected)
    sides = [
        t.spark.read.parquet(path).select("o_orderkey", F.lit(side).alias("side"))
        for path, side in ((kept, "kept"), (rejected, "rejected"))
    ]
    return sides[0].unionByName(sides[1])
