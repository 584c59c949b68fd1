"""Aggregates, filters by group, and numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions.levels import any_positive
from tablewright.operators import aggregates as agg, grouped
from tablewright.queries.registry import query


@query(
    "agg1_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def _(t):
    return agg.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("agg2_count_by", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def _(t):
    return agg.count_by(t.lineitem, ["l_returnflag", "l_linestatus"])


@query(
    "agg3_first_in_group",
    """SELECT o_custkey, o_orderpriority FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
       WHERE rn = 1""",
)
def _(t):
    return agg.first_in_group(t.orders, ["o_custkey"], "o_orderpriority", ["o_orderdate", "o_orderkey"])


@query(
    "agg4_n_distinct",
    "SELECT count(*) AS n_distinct FROM (SELECT DISTINCT nullif(l_partkey, 3) FROM lineitem)",
)
def _(t):
    return agg.n_distinct(t.lineitem.select(F.nullif("l_partkey", F.lit(3)).alias("k")), ["k"])


@query(
    "agg5_string_agg",
    """SELECT p_brand, string_agg(coalesce(nullif(p_type, 'PROMO'), 'NA'), ', ' ORDER BY p_size, p_partkey) AS types
       FROM part GROUP BY p_brand""",
)
def _(t):
    df = t.part.withColumn("p_type", F.nullif("p_type", F.lit("PROMO")))
    return agg.string_agg(df, ["p_brand"], "p_type", name="types", order_by=["p_size", "p_partkey"])


@query(
    "agg5_string_agg_large",
    """SELECT l_returnflag, md5(string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY l_orderkey, l_linenumber)) AS orders_md5,
              count(*) AS n FROM lineitem GROUP BY l_returnflag""",
)
def _(t):
    """Three groups that hold the whole table between them."""
    texts = agg.string_agg(
        t.lineitem, ["l_returnflag"], "l_orderkey", ",", "orders", ["l_orderkey", "l_linenumber"], large_groups=True
    )
    items = F.size(F.split("orders", ",")).cast("bigint")
    return texts.select("l_returnflag", F.md5("orders").alias("orders_md5"), items.alias("n"))


@query(
    "agg5_string_agg_distinct",
    """SELECT p_brand, string_agg(p_type, ', ' ORDER BY p_type) AS types
       FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY p_brand""",
)
def _(t):
    return agg.string_agg(t.part, ["p_brand"], "p_type", name="types", distinct=True)


@query("agg6_distinct_values", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS p_name FROM part")
def _(t):
    return agg.distinct_values(t.part, "p_name", sep=" ")


@query(
    "agg7_min_max",
    """SELECT min(c_custkey) AS min_c_custkey, max(c_custkey) AS max_c_custkey, min(c_acctbal) AS min_c_acctbal,
              max(c_acctbal) AS max_c_acctbal FROM customer""",
)
def _(t):
    return agg.min_max(t.customer, ["c_custkey", "c_acctbal"])


_HOLES = """SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS a, nullif(o_orderstatus, 'F') AS "X1.1_b",
              o_custkey AS c, o_orderstatus FROM orders"""


@query(
    "agg8_null_counts",
    f"""SELECT * FROM (SELECT 'a' AS column_name, count(*) FILTER (a IS NULL AND o_orderstatus <> 'P') AS n_missing
                       FROM ({_HOLES})
        UNION ALL SELECT 'X1.1_b', count(*) FILTER ("X1.1_b" IS NULL AND o_orderstatus <> 'P') FROM ({_HOLES})
        UNION ALL SELECT 'c', count(*) FILTER (c IS NULL AND o_orderstatus <> 'P') FROM ({_HOLES}))
        WHERE n_missing > 0""",
)
def _(t):
    df = t.orders.select(
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("a"),
        F.nullif("o_orderstatus", F.lit("F")).alias("X1.1_b"),
        F.col("o_custkey").alias("c"),
        "o_orderstatus",
    )
    return agg.null_counts(df, ["a", "X1.1_b", "c"], F.col("o_orderstatus") != "P")


@query(
    "agg9_row_any",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE WHEN coalesce(nullif(l_discount, 0.05), 0) + coalesce(l_tax, 0) > 0 THEN 1 ELSE 0 END AS any_positive
       FROM lineitem""",
)
def _(t):
    columns = [F.nullif("l_discount", F.lit(0.05)), F.col("l_tax")]
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", any_positive(columns).cast("int").alias("any_positive")
    )


_YEARS = """SELECT o_orderkey, o_custkey,
              CASE WHEN o_orderkey % 50 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS y FROM orders"""


def _years(t):
    return t.orders.select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 50 != 0, F.year("o_orderdate")).alias("y")
    )


@query(
    "w1_latest_in_group",
    f"""SELECT o_orderkey, o_custkey, y FROM (
          SELECT *, max(y) OVER w AS latest, count(y) OVER w AS known, count(*) OVER w AS n FROM ({_YEARS})
          WINDOW w AS (PARTITION BY o_custkey)) WHERE known = n AND y = latest""",
)
def _(t):
    return grouped.latest_in_group(_years(t), ["o_custkey"], "y")


@query(
    "w2_superseded_filter",
    """WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS y,
                   CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS web_pub_date,
                   CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 1 END AS final FROM orders),
       b AS (SELECT * EXCLUDE n FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey, y) AS n FROM a)
             WHERE NOT (n > 1 AND web_pub_date IS NULL))
       SELECT o_orderkey, o_custkey, y FROM (
         SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS n FROM b)
       WHERE NOT (n > 1 AND final = 0 AND web_pub_date IS NULL)""",
)
def _(t):
    key = F.col("o_orderkey")
    df = t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.year("o_orderdate").alias("y"),
        F.when(key % 3 != 0, F.col("o_orderdate")).alias("web_pub_date"),
        F.when(key % 5 == 1, 0).when(key % 5 != 0, 1).alias("final"),
    )
    unpublished = F.col("web_pub_date").isNull()
    df = grouped.superseded_filter(df, ["o_custkey", "y"], unpublished)
    df = grouped.superseded_filter(df, ["o_custkey", "o_orderstatus"], (F.col("final") == 0) & unpublished)
    return df.select("o_orderkey", "o_custkey", "y")


@query(
    "w3_group_without",
    """SELECT o_orderkey, o_custkey FROM (
         SELECT *, bool_or(p) OVER w AS hit, bool_or(p IS NULL) OVER w AS unknown FROM (
           SELECT *, CASE WHEN o_orderkey % 40 <> 0 THEN o_orderpriority = '1-URGENT' END AS p FROM orders)
         WINDOW w AS (PARTITION BY o_custkey)) WHERE NOT coalesce(hit, false) AND NOT unknown""",
)
def _(t):
    urgent = F.when(F.col("o_orderkey") % 40 != 0, F.col("o_orderpriority") == "1-URGENT")
    return grouped.group_without(t.orders, ["o_custkey"], urgent).select("o_orderkey", "o_custkey")


@query(
    "w4_group_not_all",
    """SELECT o_orderkey, o_custkey FROM (
         SELECT *, bool_and(coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'), false))
           OVER (PARTITION BY o_custkey) AS all_in FROM orders) WHERE NOT all_in""",
)
def _(t):
    values = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
    kept = grouped.group_not_all(t.orders, ["o_custkey"], "o_orderpriority", values)
    return kept.select("o_orderkey", "o_custkey")


@query(
    "w5_sequence_ids",
    "SELECT c_custkey, c_name, 499 + row_number() OVER (ORDER BY c_acctbal, c_custkey) AS row_id FROM customer",
)
def _(t):
    df = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return grouped.sequence_ids(df, ["c_acctbal", "c_custkey"], "row_id", 500).drop("c_acctbal")


@query(
    "w5_sequence_ids_after_max",
    """SELECT s_suppkey, s_name, (SELECT max(c_custkey) FROM customer) + row_number() OVER (
         PARTITION BY s_nationkey ORDER BY s_suppkey) AS row_id FROM supplier""",
)
def _(t):
    start = grouped.next_id(t.customer, "c_custkey")
    df = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return grouped.sequence_ids(df, ["s_suppkey"], "row_id", start, within=["s_nationkey"]).drop("s_nationkey")


@query(
    "w6_distinct_keep_first",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rn FROM orders)
       WHERE rn = 1""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return grouped.distinct_keep_first(df, ["o_custkey"], ["o_totalprice", "o_orderkey"])
