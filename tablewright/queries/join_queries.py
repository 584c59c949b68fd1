"""Joins with null-safe keys. Keys are made null for some rows, so that nulls meet nulls."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import joins
from tablewright.queries.registry import query

_CUSTOMER = "(SELECT c_custkey, nullif(c_nationkey, 3) AS nation_key, c_mktsegment FROM customer)"
_NATION = "(SELECT CASE n_nationkey WHEN 3 THEN NULL WHEN 7 THEN 107 ELSE n_nationkey END AS n_key, n_name FROM nation)"


def _customer(t):
    return t.customer.select(
        "c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation_key"), "c_mktsegment"
    )


def _nation(t):
    key = F.col("n_nationkey")
    return t.nation.select(F.when(key == 7, key + 100).when(key != 3, key).alias("n_key"), "n_name")


@query(
    "jn1_left_join",
    f"""SELECT c.*, n.n_name FROM {_CUSTOMER} c LEFT JOIN {_NATION} n ON c.nation_key IS NOT DISTINCT FROM n.n_key""",
)
def _(t):
    return joins.left_join(_customer(t), _nation(t), {"nation_key": "n_key"})


@query(
    "jn1_left_join_repeated",
    """SELECT c.c_custkey, c.c_acctbal, o.o_orderkey, o.o_totalprice FROM customer c
       LEFT JOIN orders o ON c.c_custkey IS NOT DISTINCT FROM o.o_custkey""",
)
def _(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return joins.left_join(t.customer.select("c_custkey", "c_acctbal"), orders, {"c_custkey": "o_custkey"})


@query(
    "jn2_full_join",
    """SELECT coalesce(d.k, l.k) AS k, d.lang, l.quality FROM
         (SELECT CASE WHEN doc_id % 3 = 1 THEN -doc_id ELSE nullif(doc_id, 5) END AS k, lang FROM documents) d
       FULL JOIN (SELECT nullif(doc_id, 6) AS k, quality FROM labels) l ON d.k IS NOT DISTINCT FROM l.k""",
)
def _(t):
    key = F.col("doc_id")
    d = t.documents.select(F.when(key % 3 == 1, -key).otherwise(F.nullif(key, F.lit(5))).alias("k"), "lang")
    return joins.full_join(d, t.labels.select(F.nullif("doc_id", F.lit(6)).alias("k"), "quality"), ["k"])


@query(
    "jn3a_semi_join",
    """SELECT doc_id, lang FROM documents d WHERE EXISTS (
         SELECT 1 FROM (SELECT nullif(doc_id, 6) AS k FROM labels) l WHERE l.k IS NOT DISTINCT FROM nullif(d.doc_id, 5))""",
)
def _(t):
    labelled = t.labels.select(F.nullif("doc_id", F.lit(6)).alias("k"))
    keyed = t.documents.withColumn("key", F.nullif("doc_id", F.lit(5)))
    return joins.semi_join(keyed, labelled, {"key": "k"}).select("doc_id", "lang")


@query(
    "jn3b_anti_join",
    """SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (
         SELECT 1 FROM (SELECT nullif(o_custkey, 8) AS k FROM orders) o
         WHERE o.k IS NOT DISTINCT FROM nullif(c.c_custkey, 9))""",
)
def _(t):
    ordered = t.orders.select(F.nullif("o_custkey", F.lit(8)).alias("k"))
    keyed = t.customer.withColumn("key", F.nullif("c_custkey", F.lit(9)))
    return joins.anti_join(keyed, ordered, {"key": "k"}).select("c_custkey", "c_name")


_YEARS = "(SELECT o_custkey, o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)"


def _years(t):
    return t.orders.select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("y"))


@query(
    "jn4_inner_join_inequality",
    f"""SELECT l.o_custkey, l.o_orderkey AS "o_orderkey.x", r.o_orderkey AS "o_orderkey.y", l.y AS "y.x", r.y AS "y.y"
        FROM {_YEARS} l JOIN {_YEARS} r ON l.o_custkey IS NOT DISTINCT FROM r.o_custkey AND l.y > r.y""",
)
def _(t):
    return joins.inner_join(_years(t), _years(t), ["o_custkey"], lambda left, right: left("y") > right("y"))


@query(
    "jn4_keys_with_earlier",
    f"""SELECT o_custkey, o_orderkey, y FROM {_YEARS} l WHERE EXISTS (
          SELECT 1 FROM (SELECT l_orderkey % 100 AS k, CAST(year(l_shipdate) AS INTEGER) AS shipped FROM lineitem) r
          WHERE r.k = l.o_custkey AND l.y >= r.shipped)""",
)
def _(t):
    shipped = t.lineitem.select((F.col("l_orderkey") % 100).alias("k"), F.year("l_shipdate").alias("shipped"))
    return joins.keys_with_earlier(_years(t), shipped, {"o_custkey": "k"}, "y", "shipped")


_DOCS = """(SELECT CASE WHEN doc_id % 7 = 2 THEN -doc_id ELSE doc_id END AS doc_id,
    CASE WHEN doc_id % 4 <> 0 THEN lang END AS lang, source FROM documents)"""
_COPY = """(SELECT CASE WHEN doc_id % 5 = 1 THEN doc_id + 1000000000 ELSE doc_id END AS doc_id,
    concat('copy-', lang) AS lang, n_chars FROM documents)"""


def _docs(t):
    key = F.col("doc_id")
    own = F.when(key % 7 == 2, -key).otherwise(key)
    return t.documents.select(own.alias("doc_id"), F.when(key % 4 != 0, F.col("lang")).alias("lang"), "source")


def _copy(t):
    key = F.col("doc_id")
    own = F.when(key % 5 == 1, key + 1_000_000_000).otherwise(key)
    return t.documents.select(own.alias("doc_id"), F.concat(F.lit("copy-"), "lang").alias("lang"), "n_chars")


@query(
    "jn5_coalesce_join",
    f"""SELECT coalesce(x.doc_id, y.doc_id) AS doc_id, coalesce(x.lang, y.lang) AS lang, x.source, y.n_chars
        FROM {_DOCS} x FULL JOIN {_COPY} y ON x.doc_id IS NOT DISTINCT FROM y.doc_id""",
)
def _(t):
    return joins.coalesce_join(_docs(t), _copy(t), ["doc_id"])


@query(
    "jn5_coalesce_join_left",
    f"""SELECT x.doc_id, coalesce(x.lang, y.lang) AS lang, x.source, y.n_chars
        FROM {_DOCS} x LEFT JOIN {_COPY} y ON x.doc_id IS NOT DISTINCT FROM y.doc_id""",
)
def _(t):
    return joins.coalesce_join(_docs(t), _copy(t), ["doc_id"], how="left")


@query(
    "jn6_join_chain",
    """SELECT d.doc_id, d.lang, l.quality, a.long_text, b.junk FROM documents d
       LEFT JOIN labels l ON d.doc_id IS NOT DISTINCT FROM l.doc_id
       LEFT JOIN (SELECT doc_id, 1 AS long_text FROM documents WHERE n_chars > 2000) a
         ON d.doc_id IS NOT DISTINCT FROM a.doc_id
       LEFT JOIN (SELECT doc_id, 1 AS junk FROM documents WHERE text LIKE '%!!%') b
         ON d.doc_id IS NOT DISTINCT FROM b.doc_id""",
)
def _(t):
    d = t.documents
    long_text = d.filter("n_chars > 2000").select("doc_id", F.lit(1).alias("long_text"))
    junk = d.filter(d.text.like("%!!%")).select("doc_id", F.lit(1).alias("junk"))
    tables = [d.select("doc_id", "lang"), t.labels.select("doc_id", "quality"), long_text, junk]
    return joins.join_chain(tables, ["doc_id"])


@query(
    "jn4_asof_join",
    """SELECT event_id, user_id, ts, click_id, click_value FROM (
         SELECT e.event_id, e.user_id, e.ts, c.event_id AS click_id, c.value AS click_value,
                row_number() OVER (PARTITION BY e.event_id ORDER BY c.ts DESC NULLS LAST, c.event_id DESC) AS rn
         FROM events e LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON e.user_id = c.user_id AND c.ts <= e.ts)
       WHERE rn = 1""",
)
def _(t):
    """Every event with its user's last click so far."""
    clicks = t.events.filter("event_type = 'click'").selectExpr("user_id", "ts AS at", "event_id AS click_id", "value AS click_value")
    events = t.events.select("event_id", "user_id", "ts")
    return joins.asof_join(events, clicks, ["user_id"], "ts", "at", ["click_id", "click_value"], ties=["click_id"])
