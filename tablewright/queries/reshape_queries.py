"""Long and wide form, lists and rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import reshape
from tablewright.queries.registry import query
from tablewright.session import scratch_path
from tablewright.sources import snapshots

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

_CELLS = ", ".join(
    f"""count(*) FILTER (event_type = '{e}') AS {e}_n,
        CAST(sum(CAST(value AS DECIMAL(18, 2))) FILTER (event_type = '{e}') AS DOUBLE) AS {e}_total,
        max(nullif(props, '{{"k": 99}}')) FILTER (event_type = '{e}') AS {e}_props"""
    for e in EVENT_TYPES
)


@query("rsh1_pivot_wider_multi", f"SELECT user_id, {_CELLS} FROM events GROUP BY user_id")
def _(t):
    measures = {
        "n": F.count(F.lit(1)),
        "total": F.sum(F.col("value").cast("decimal(18,2)")).cast("double"),
        "props": F.max(F.nullif("props", F.lit('{"k": 99}'))),
    }
    return reshape.pivot_wider(t.events, ["user_id"], "event_type", EVENT_TYPES, measures, {"n": 0})


@query(
    "rsh2_pivot_longer",
    """SELECT * FROM (
         SELECT l_orderkey, l_linenumber, l_partkey, 'X1_tax' AS name, l_tax AS value FROM lineitem
         UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'X1.1_discount', l_discount FROM lineitem)
       WHERE value > 0""",
)
def _(t):
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    df = t.lineitem.select(*ids, F.col("l_tax").alias("X1_tax"), F.col("l_discount").alias("X1.1_discount"))
    return reshape.pivot_longer(df, ids, ["X1_tax", "X1.1_discount"]).filter("value > 0")


@query(
    "rsh3_separate_rows",
    """SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part WHERE p_size <> 7
       UNION ALL SELECT p_partkey, NULL FROM part WHERE p_size = 7""",
)
def _(t):
    df = t.part.select("p_partkey", F.when(F.col("p_size") != 7, F.col("p_name")).alias("word"))
    return reshape.separate_rows(df, "word", sep=" ")


@query(
    "rsh4_separate",
    """SELECT p_partkey, split_part(p_name, ' ', 1) AS code, split_part(p_name, ' ', 2) AS definition,
              CAST(NULL AS VARCHAR) AS more FROM part""",
)
def _(t):
    df = t.part.select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(": ")).alias("value"))
    return reshape.separate(df, "value", ["code", "definition", "more"])


@query(
    "rsh5_unite",
    """SELECT p_partkey, concat(coalesce(nullif(p_brand, 'Brand#2'), 'NA'), ', ', p_type, ', ', p_size) AS miss
       FROM part""",
)
def _(t):
    df = t.part.select("p_partkey", F.nullif("p_brand", F.lit("Brand#2")).alias("brand"), "p_type", "p_size")
    return reshape.unite(df, "miss", ["brand", "p_type", "p_size"])


def _sql_lists(table: str, key: str, columns: str, size: int) -> str:
    return f"""(SELECT *, (row_number() OVER (PARTITION BY {key} ORDER BY {columns}) - 1) // {size} AS list_no FROM {table})"""


@query(
    "rsh6_nest",
    f"""SELECT p_brand, CAST(list_no AS BIGINT) AS list_no, string_agg(concat(p_type, ':', p_size), ', ' ORDER BY p_type, p_size)
              AS rows_text, count(*) AS n
        FROM {_sql_lists('part', 'p_brand', 'p_type, p_size', 10_000)} GROUP BY p_brand, list_no""",
)
def _(t):
    nested = reshape.nest(t.part, ["p_brand"], ["p_type", "p_size"])
    texts = F.transform("data", lambda r: F.concat(r["p_type"], F.lit(":"), r["p_size"].cast("string")))
    return nested.select(
        "p_brand", "list_no", F.array_join(texts, ", ").alias("rows_text"), F.size("data").cast("bigint").alias("n")
    )


@query(
    "rsh6_nest_large_groups",
    f"""SELECT l_returnflag, CAST(list_no AS BIGINT) AS list_no, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total
        FROM {_sql_lists('lineitem', 'l_returnflag', 'l_linestatus, l_linenumber', 500)} GROUP BY l_returnflag, list_no""",
)
def _(t):
    nested = reshape.nest(t.lineitem, ["l_returnflag"], ["l_linestatus", "l_linenumber"], rows_per_list=500)
    inner = F.aggregate("data", F.lit(0).cast("bigint"), lambda a, r: a + r["l_linenumber"])
    return nested.select("l_returnflag", "list_no", F.size("data").cast("bigint").alias("n"), inner.alias("total"))


_COLUMNS = {
    "c_name": ("c_name", "CASE WHEN c_custkey % 4 = 0 THEN upper(c_name) ELSE c_name END"),
    "c_acctbal": (
        "CAST(c_acctbal AS VARCHAR)",
        "CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN '0.5' ELSE CAST(c_acctbal AS VARCHAR) END",
    ),
    "c_mktsegment": ("c_mktsegment", "c_mktsegment"),
}
_DIFF = " UNION ALL ".join(
    f"SELECT c_custkey, '{c}' AS column_name, {a} AS old_value, {b} AS new_value FROM customer"
    for c, (a, b) in _COLUMNS.items()
)


@query("rsh7_source_diff", f"SELECT * FROM ({_DIFF}) WHERE old_value <> new_value")
def _(t):
    key = F.col("c_custkey")
    old = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    new = t.customer.select(
        "c_custkey",
        F.when(key % 4 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(key % 3 != 0, F.when(key % 5 == 0, 0.5).otherwise(F.col("c_acctbal"))).alias("c_acctbal"),
        "c_mktsegment",
    )
    return reshape.source_diff(old, new, ["c_custkey"], ("old_value", "new_value"))


_NEXT = """(SELECT o_orderkey, CASE WHEN o_orderkey % 400 = 2 THEN NULL WHEN o_orderkey % 200 = 3 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                   CASE WHEN o_orderkey % 300 = 7 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey
            FROM orders WHERE o_orderkey % 500 <> 5
            UNION ALL SELECT o_orderkey + 100000000, o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 700 = 1)"""


def _sql_cells(column: str) -> str:
    return f"""SELECT o_orderkey, 'changed' AS change, '{column}' AS column_name, CAST(x.{column} AS VARCHAR) AS old_value,
               CAST(y.{column} AS VARCHAR) AS new_value FROM orders x JOIN {_NEXT} y USING (o_orderkey)
               WHERE x.{column} IS DISTINCT FROM y.{column}"""


@query(
    "rsh7_snapshot_diff",
    f"""{_sql_cells("o_orderstatus")} UNION ALL {_sql_cells("o_custkey")}
        UNION ALL SELECT o_orderkey, 'removed', NULL, NULL, NULL FROM orders WHERE o_orderkey % 500 = 5
        UNION ALL SELECT o_orderkey + 100000000, 'added', NULL, NULL, NULL FROM orders WHERE o_orderkey % 700 = 1""",
)
def _(t):
    """Two versions written in buckets with digests; only buckets that differ are read again."""
    path, key = scratch_path(t.spark, "versions"), F.col("o_orderkey")
    old = t.orders.select("o_orderkey", "o_orderstatus", "o_custkey")
    status = F.when(key % 400 == 2, None).when(key % 200 == 3, "X").otherwise(F.col("o_orderstatus"))
    customer = F.when(key % 300 == 7, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    new = old.filter(key % 500 != 5).select(key, status.alias("o_orderstatus"), customer.alias("o_custkey"))
    new = new.unionByName(old.filter(key % 700 == 1).withColumn("o_orderkey", key + 100000000))
    snapshots.write_digested(old, path, "2020-01-01", ["o_orderkey"], buckets=32)
    snapshots.write_digested(new, path, "2020-02-01", ["o_orderkey"], buckets=32)
    return snapshots.snapshot_diff(t.spark, path, "2020-01-01", "2020-02-01", ["o_orderkey"])
