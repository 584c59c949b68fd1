"""Keyed changes to a table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablewright.operators import changes
from tablewright.operators.joins import left_join
from tablewright.queries.registry import query
from tablewright.session import scratch_path
from tablewright.sources import keyed

_NULLED = "(SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS c_acctbal FROM customer)"
_BATCH = """(SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal + 1000 END AS c_acctbal
             FROM customer WHERE c_custkey % 2 = 0)"""


def _nulled(t):
    return t.customer.select(
        "c_custkey", "c_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("c_acctbal")
    )


def _batch(t):
    return t.customer.filter("c_custkey % 2 = 0").select(
        "c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal") + 1000).alias("c_acctbal")
    )


@query(
    "chg1_rows_update",
    f"""SELECT x.c_custkey, x.c_name,
              round(CASE WHEN y.c_custkey IS NOT NULL THEN y.c_acctbal ELSE x.c_acctbal END, 2) AS c_acctbal
        FROM {_NULLED} x LEFT JOIN {_BATCH} y ON x.c_custkey IS NOT DISTINCT FROM y.c_custkey""",
)
def _(t):
    out = changes.rows_update(_nulled(t), _batch(t), ["c_custkey"])
    return out.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query(
    "chg2_rows_patch",
    f"""SELECT x.c_custkey, x.c_name, round(coalesce(x.c_acctbal, y.c_acctbal), 2) AS c_acctbal
        FROM {_NULLED} x LEFT JOIN {_BATCH} y ON x.c_custkey IS NOT DISTINCT FROM y.c_custkey""",
)
def _(t):
    out = changes.rows_patch(_nulled(t), _batch(t), ["c_custkey"])
    return out.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query(
    "chg3_rows_insert",
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
       UNION ALL SELECT c_custkey + 1000000, c_name, NULL, c_acctbal FROM customer WHERE c_acctbal < 0""",
)
def _(t):
    new = t.customer.filter("c_acctbal < 0").select(
        (F.col("c_custkey") + 1000000).alias("s_suppkey"),
        F.col("c_acctbal").alias("s_acctbal"),
        F.col("c_name").alias("s_name"),
    )
    return changes.rows_insert(t.supplier, new, ["s_suppkey"])


@query(
    "chg4_rows_delete",
    """SELECT * FROM orders o WHERE NOT EXISTS (
         SELECT 1 FROM customer c WHERE c.c_acctbal < 0 AND c.c_custkey IS NOT DISTINCT FROM o.o_custkey)""",
)
def _(t):
    gone = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return changes.rows_delete(t.orders, gone, ["o_custkey"], unmatched="ignore")


_VERB = """CASE s_suppkey % 6 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'new data already extracted'
             WHEN 3 THEN 'please remove' WHEN 4 THEN '' ELSE 'TC exist elsewhere' END"""


@query(
    "chg5_change_router",
    f"""WITH b AS (
          SELECT s_suppkey, {_VERB} AS verb, CASE WHEN s_suppkey % 5 <> 1 THEN upper(s_name) END AS s_name,
                 CASE WHEN s_suppkey % 4 <> 1 THEN CAST(round(s_acctbal * 10, 1) AS VARCHAR) END AS s_acctbal
          FROM supplier),
        f AS (
          SELECT s_suppkey, verb, s_name,
                 CASE WHEN verb IN ('no', 'new data already extracted')
                      THEN coalesce(s_acctbal, 'NE') ELSE s_acctbal END AS s_acctbal FROM b)
        SELECT s.s_suppkey, s.s_nationkey,
               CASE WHEN f.verb IN ('yes', 'no', 'new data already extracted') THEN f.s_name ELSE s.s_name END AS s_name,
               CASE WHEN f.verb IN ('yes', 'no', 'new data already extracted') THEN f.s_acctbal
                    ELSE CAST(s.s_acctbal AS VARCHAR) END AS s_acctbal
        FROM supplier s LEFT JOIN f ON s.s_suppkey IS NOT DISTINCT FROM f.s_suppkey
        WHERE NOT contains(f.verb, 'remove')""",
)
def _(t):
    key = F.col("s_suppkey")
    verbs = ["yes", "no", "new data already extracted", "please remove", "", "TC exist elsewhere"]
    batch = t.supplier.select(
        "s_suppkey",
        F.get(F.array(*[F.lit(v) for v in verbs]), (key % 6).cast("int")).alias("change_made"),
        F.when(key % 5 != 1, F.upper("s_name")).alias("s_name"),
        F.when(key % 4 != 1, F.round(F.col("s_acctbal") * 10, 1).cast("string")).alias("s_acctbal"),
        F.when(key % 4 == 1, F.lit("s_acctbal, Level 1 threats")).otherwise(F.lit("")).alias("miss_all"),
    )
    table = t.supplier.withColumn("s_acctbal", F.col("s_acctbal").cast("string"))
    return changes.route_changes(table, batch, ["s_suppkey"])


@query(
    "chg6_fill_sentinel",
    """SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 THEN coalesce(CAST(l.quality AS VARCHAR), 'NE')
                             ELSE CAST(l.quality AS VARCHAR) END AS quality,
              CASE WHEN d.doc_id % 2 = 0 AND d.lang = 'en' THEN 'NE' WHEN d.lang = 'en' THEN '' ELSE d.lang END AS lang,
              l.toxic
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t):
    d = t.documents.select(
        "doc_id", F.when(F.col("lang") == "en", F.lit("")).otherwise(F.col("lang")).alias("lang")
    )
    df = left_join(d, t.labels, ["doc_id"]).withColumn(
        "miss_all", F.when(F.col("quality").isNull(), F.lit("quality, endemic_NA, Level 2 threats")).otherwise("")
    )
    columns = changes.sentinel_columns(df, "^miss", df.columns, also=["lang"])
    return changes.fill_sentinel(df, columns, F.col("doc_id") % 2 == 0).drop("miss_all")


_ROUND = """(SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice * 2 END AS o_totalprice, 'P' AS o_orderstatus
             FROM orders WHERE o_custkey % 40 = 3)"""


@query(
    "chg1_keyed_table",
    f"""SELECT o.o_orderkey, o.o_custkey, CASE WHEN b.o_orderkey IS NULL THEN o.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
               coalesce(b.o_orderstatus, o.o_orderstatus) AS o_orderstatus, o.o_orderpriority
        FROM orders o LEFT JOIN {_ROUND} b ON o.o_orderkey = b.o_orderkey
        WHERE o.o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 50 = 7)
        UNION ALL SELECT o_orderkey + 100000000, o_custkey, NULL, NULL, o_orderpriority FROM orders WHERE o_custkey % 60 = 11""",
)
def _(t):
    """Rounds of updates, deletions and insertions on a table that is kept by its key."""
    name = f"orders_{uuid.uuid4().hex}"
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    keyed.create_keyed(orders, name, ["o_orderkey"], parts=16, buckets=4, path=scratch_path(t.spark, "keyed"))
    price = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") * 2).alias("o_totalprice")
    batch = t.orders.filter("o_custkey % 40 = 3").select("o_orderkey", price, F.lit("P").alias("o_orderstatus"))
    keyed.change_keyed(t.spark, name, batch, changes.rows_update)
    gone = t.orders.filter("o_custkey % 50 = 7").select("o_orderkey")
    keyed.change_keyed(t.spark, name, gone, changes.rows_delete)
    new = t.orders.filter("o_custkey % 60 = 11").select(
        (F.col("o_orderkey") + 100000000).alias("o_orderkey"), "o_custkey", "o_orderpriority"
    )
    keyed.change_keyed(t.spark, name, new, changes.rows_insert)
    return keyed.keyed_table(t.spark, name)
