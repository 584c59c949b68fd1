"""Projections, filters and predicates, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import names, text
from tablewright.functions.dates import date_text
from tablewright.operators import columns as op
from tablewright.queries.registry import query


@query("prj1_select", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def _(t):
    return op.select_columns(t.orders, ["o_orderkey", "o_totalprice", "o_custkey"], first=["o_custkey"])


@query("prj2_drop", "SELECT p_partkey, p_brand, p_type FROM part")
def _(t):
    return op.drop_columns(t.part, ["p_name"], pattern="price$|size")


@query("prj3_select_matching", "SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(t):
    df = op.select_matching(t.lineitem, "key$|flag|status")
    return op.select_matching(df, "quantity|price", negate=True)


@query(
    "prj4_column_set_ops",
    """SELECT c_custkey, c_acctbal, c_mktsegment, n_nationkey, n_name
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def _(t):
    c, n = t.customer, t.nation
    wanted = names.union(c.columns, n.columns)
    wanted = names.difference(wanted, ["c_name", "n_regionkey"])
    wanted = names.difference(wanted, names.intersect(wanted, ["c_nationkey", "r_name"]))
    return c.join(n, c.c_nationkey == n.n_nationkey).select(names.refs(wanted))


@query(
    "prj5_add_missing_columns",
    """SELECT s_suppkey, s_name, CAST(0 AS DOUBLE) AS "X1.1_flag", CAST(0 AS DOUBLE) AS "X2_flag", 'NE' AS status
       FROM supplier""",
)
def _(t):
    df = t.supplier.select("s_suppkey", "s_name")
    df = op.add_missing_columns(df, ["s_name", "X1.1_flag", "X2_flag"], F.lit(0.0))
    return op.add_missing_columns(df, ["status", "s_suppkey"], F.lit("NE"))


@query(
    "prj6_reorder_by_vocab",
    """SELECT p_partkey, p_size % 2 AS "X1_flag", p_size % 3 AS "X1.1_flag", p_size AS "X10_flag",
              p_size + 1 AS "X2_flag" FROM part""",
)
def _(t):
    size = F.col("p_size")
    df = t.part.select(
        size.alias("X10_flag"),
        (size % 3).alias("X1.1_flag"),
        "p_partkey",
        (size + 1).alias("X2_flag"),
        (size % 2).alias("X1_flag"),
    )
    return op.reorder_by_vocabulary(df, [["p_partkey"]])


@query(
    "prj7_rename",
    """SELECT c_custkey AS "entity_id", c_name AS "src_name", c_nationkey AS "nationkey",
              c_acctbal AS "src_acctbal", c_mktsegment AS "mkt_segment" FROM customer""",
)
def _(t):
    return op.rename_columns(
        t.customer.withColumnRenamed("c_mktsegment", "C_mkt segment"),
        explicit={"c_custkey": "entity id"},
        prefix=("src", ["c_name", "c_acctbal"]),
        patterns=[("^[cC]_", ""), ("^srcc", "src"), (" ", "_")],
        each=str.lower,
    )


@query(
    "prj8_derive",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year_published, 'order' AS doc_type,
              CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS large,
              strftime(o_orderdate, '%Y-%m-%d') AS date_text FROM orders""",
)
def _(t):
    return op.derive(
        t.orders,
        {
            "o_orderkey": F.col("o_orderkey"),
            "year_published": F.year("o_orderdate"),
            "doc_type": F.lit("order"),
            "large": F.when(F.col("o_totalprice") > 250000, 1).otherwise(0),
            "date_text": date_text(F.col("o_orderdate")),
        },
        keep_only_new=True,
    )


@query(
    "prj9_map_values",
    """SELECT o_orderkey,
              CASE o_orderpriority WHEN '1-URGENT' THEN 'top' WHEN '2-HIGH' THEN 'top' WHEN '5-LOW' THEN 'rest' END
                AS label_or_null,
              CASE o_orderpriority WHEN '1-URGENT' THEN 'top' WHEN '2-HIGH' THEN 'top' WHEN '5-LOW' THEN 'rest'
                ELSE o_orderpriority END AS label_or_same,
              CASE o_orderstatus WHEN 'F' THEN 'Status' WHEN 'O' THEN 'Recovery' WHEN 'P' THEN 'Plan' END AS kind
       FROM orders""",
)
def _(t):
    groups = {"1-URGENT": "top", "2-HIGH": "top", "5-LOW": "rest"}
    kinds = {"F": "Status", "O": "Recovery", "P": "Plan"}
    priority = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey",
        text.map_values(priority, groups).alias("label_or_null"),
        text.map_values(priority, groups, unmapped="keep").alias("label_or_same"),
        text.map_values(F.col("o_orderstatus"), kinds, unmapped="error").alias("kind"),
    )


@query(
    "prj10_apply_across",
    """SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand, upper(p_type) AS p_type,
              CAST(p_size AS VARCHAR) AS p_size, round(p_retailprice * 2, 2) AS p_retailprice FROM part""",
)
def _(t):
    df = op.apply_across(t.part, F.upper, of_type="string")
    df = op.apply_across(df, lambda c: F.round(c * 2, 2), pattern="price")
    return op.apply_across(df, lambda c: c.cast("string"), columns=["p_size"])


@query(
    "prj11_null_unless",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1996 AND o_orderstatus = 'F' THEN o_totalprice END
         AS price_when_status FROM orders""",
)
def _(t):
    holds = (F.year("o_orderdate") == 1996) & (F.col("o_orderstatus") == "F")
    return t.orders.select(
        "o_orderkey", text.null_unless(holds, F.col("o_totalprice")).alias("price_when_status")
    )


@query(
    "flt1_filter",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderstatus IN ('F', 'P') AND NOT o_orderpriority IN ('5-LOW') AND o_totalprice >= 1000
         AND nullif(o_orderpriority, '3-MEDIUM') IS NOT NULL""",
)
def _(t):
    o = t.orders
    return o.filter(
        o.o_orderstatus.isin("F", "P")
        & ~o.o_orderpriority.isin("5-LOW")
        & (o.o_totalprice >= 1000)
        & F.nullif(o.o_orderpriority, F.lit("3-MEDIUM")).isNotNull()
    ).select("o_orderkey", "o_orderpriority")


@query(
    "flt2_filter_regex",
    "SELECT doc_id, source FROM documents WHERE regexp_matches(text, '[0-9]{3}') AND NOT regexp_matches(source, '^src1[0-4]')",
)
def _(t):
    d = t.documents
    return d.filter(d.text.rlike("[0-9]{3}") & ~d.source.rlike("^src1[0-4]")).select("doc_id", "source")


_FAMILY = """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 1.0::DOUBLE END AS "X1_iucn_scope",
       CASE WHEN o_orderkey % 3 = 0 THEN 2.0::DOUBLE END AS "X1.1_iucn_scope",
       CASE WHEN o_orderkey % 5 = 0 THEN 3.0::DOUBLE END AS "X2_iucn_timing" FROM orders"""


def _family(t):
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey",
        F.when(key % 2 == 0, 1.0).alias("X1_iucn_scope"),
        F.when(key % 3 == 0, 2.0).alias("X1.1_iucn_scope"),
        F.when(key % 5 == 0, 3.0).alias("X2_iucn_timing"),
    )


@query(
    "flt3_if_any",
    f"""SELECT * FROM ({_FAMILY}) WHERE "X1_iucn_scope" IS NOT NULL OR "X1.1_iucn_scope" IS NOT NULL
        OR "X2_iucn_timing" IS NOT NULL""",
)
def _(t):
    return op.keep_if_any(_family(t), "X.*iucn")


@query(
    "flt3_if_all",
    f"""SELECT o_orderkey FROM ({_FAMILY}) WHERE "X1_iucn_scope" IS NULL AND "X1.1_iucn_scope" IS NULL
        AND "X2_iucn_timing" IS NULL""",
)
def _(t):
    return op.keep_if_all(_family(t), "X.*iucn", lambda c: c.isNull()).select("o_orderkey")


@query(
    "flt4_null_sentinel",
    """SELECT o_orderkey, CASE WHEN NOT contains(o_orderpriority, 'NOT SPECIFIED') THEN o_orderpriority END AS level
       FROM orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey", text.null_sentinel(F.col("o_orderpriority"), "NOT SPECIFIED").alias("level")
    )


@query("srt1_arrange", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey")
def _(t):
    return t.customer.select("c_custkey", "c_name").orderBy("c_custkey")


@query(
    "srt2_domain_order",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '2-HIGH' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '5-LOW' THEN 3 END
         AS level_rank,
       CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 3 END AS reversed_rank
       FROM orders ORDER BY 2, 1""",
)
def _(t):
    levels = ["2-HIGH", "1-URGENT", "5-LOW"]
    priority = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey",
        op.domain_rank(priority, levels).alias("level_rank"),
        op.domain_rank(priority, levels, reverse=True).alias("reversed_rank"),
    ).orderBy("level_rank", "o_orderkey")


@query(
    "set1_union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def _(t):
    c = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    s = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return c.unionByName(s, allowMissingColumns=True)


@query("set2_distinct", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def _(t):
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query(
    "set3_set_equal",
    """SELECT count(*) FILTER (coalesce(o_orderpriority = '4-NOT SPECIFIED', false)
                <> (CASE WHEN NOT contains(o_orderpriority, 'NOT') THEN o_orderpriority END IS NULL)) AS n_differ
       FROM orders""",
)
def _(t):
    priority = F.col("o_orderpriority")
    return op.set_difference_count(
        t.orders, priority == "4-NOT SPECIFIED", text.null_sentinel(priority, "NOT").isNull()
    )


@query(
    "fn_extract",
    """SELECT c_custkey, nullif(regexp_extract(c_name, '[1-9][0-9]*$'), '') AS number,
              nullif(regexp_extract(c_mktsegment, '^(A|B)(.)', 2), '') AS second FROM customer""",
)
def _(t):
    return t.customer.select(
        "c_custkey",
        text.extract(F.col("c_name"), "[1-9][0-9]*$").alias("number"),
        text.extract(F.col("c_mktsegment"), "^(A|B)(.)", 2).alias("second"),
    )
