"""Rounds of maintenance, and the rows that are no longer listed, as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import levels
from tablewright.operators.joins import left_join
from tablewright.plans import maintain, taxonomy
from tablewright.plans.taxonomy import wide_name
from tablewright.queries.reconcile_queries import MISSING_FROM_REGISTRY, registry_inputs
from tablewright.queries.registry import query
from tablewright.queries.taxonomy_queries import RECORDS, TAXONOMY, coded_sql, records, sql_types, wide_sql
from tablewright.sources.snapshots import split_off

PREFIX = "https://registry.example.org/?q="
# Expressions that Spark and DuckDB both read.
_TABLE = {
    "rowID": "o_orderkey",
    "common_name": "CASE WHEN o_orderkey % 6 <> 0 THEN replace(c_name, '#', '-') END",
    "sara_status": "CASE WHEN o_orderpriority = '5-LOW' THEN 'Not listed' WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'Threatened' END",
    "listing_date": "CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "url": "CASE WHEN o_orderkey % 3 = 0 THEN 'given' END",
    "action_subtype": "CASE WHEN o_orderkey % 2 = 0 THEN 'old list' END",
    "action_type": "CASE WHEN o_orderkey % 2 = 0 THEN 'old type' END",
    "taxonomic_group": "c_mktsegment",
}
_FIRST = {
    "rowID": "o_orderkey",
    "common_name": "replace(c_name, '#', '-')",
    "change_made": "CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE '' END",
    "miss_all": "'common_name, url'",
}
_SECOND = {
    "rowID": "o_orderkey",
    "change_made": "CASE o_orderkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'remove' ELSE '' END",
    "sara_status": "CASE WHEN o_orderkey % 10 < 5 THEN ' special CONCERN ' ELSE 'Not Listed' END",
    "listing_date": "CASE WHEN o_orderkey % 7 <> 0 THEN '(3-02-2017)' END",
    "miss_dates": "'listing_date, Level 1 threats'",
    "common_name": "replace(c_name, '#', '-')",
    "action_subtype": "CASE o_orderkey % 4 WHEN 0 THEN 'promoo, standard' WHEN 1 THEN 'econmy, economy' WHEN 2 THEN 'other' END",
}
# Batch records: those of some orders, with a note and a name of the other level system.
_BATCH_RECORDS = {"docID": "rowID", "speciesID": "uID", "threat_num": "threat_num", "impact": "impact", "scope": "scope",
                  "severity": "CASE WHEN severity IS NULL THEN 'Neutral' ELSE severity END", "timing": "timing",
                  "comments": "'checked'"}
_NEUTRAL = [("^Neutral$", "Neutral or potential benefit")]
_SPELLING = [("promoo", "promo"), ("econmy", "economy")]
_BATCHED = "rowID % 16 < 3"


def _sql(columns, where: str) -> str:
    listed = ", ".join(f'{value} AS "{name}"' for name, value in columns.items())
    return f"(SELECT {listed} FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE {where})"


_CELLS = [wide_name(n, m) for m in taxonomy.WIDE_MEASURES for n in levels.CATEGORIES]


def _wide(coded: str, name: str) -> str:
    return f"SELECT rowID AS {name}, {wide_sql(levels.CATEGORIES, taxonomy.WIDE_MEASURES)} FROM ({coded}) GROUP BY rowID"


_RECORDED = _wide(coded_sql(RECORDS), "row")
_CHECKED = _wide(
    coded_sql(
        f"""SELECT rowID, uID, threat_num, impact, scope, timing, 'checked' AS comments,
              regexp_replace(coalesce(severity, 'Neutral'), '^Neutral$', 'Neutral or potential benefit') AS severity
            FROM ({RECORDS}) WHERE {_BATCHED}"""
    ),
    "row",
)
_SPELT = "regexp_replace(regexp_replace(action_subtype, 'promoo', 'promo'), 'econmy', 'economy')"
_ROUTED = "s.change_made IN ('yes', 'no')"


def _changed(column: str, new: str) -> str:
    return f'CASE WHEN {_ROUTED} THEN {new} ELSE first."{column}" END AS "{column}"'


@query(
    "maintain_curated_table",
    f"""WITH t AS (SELECT * FROM {_sql(_TABLE, 'true')}),
          first AS (
            SELECT t.* REPLACE (coalesce(t.common_name, f.common_name) AS common_name,
                   coalesce(t.url, '{PREFIX}' || replace(replace(f.common_name, '-', ' - '), ' ', '%20')) AS url)
            FROM t LEFT JOIN {_sql(_FIRST, "o_orderkey % 2 = 0 AND o_orderkey % 9 < 6")} f ON t."rowID" = f."rowID"),
          batch0 AS (SELECT * REPLACE ({_SPELT} AS action_subtype) FROM {_sql(_SECOND, "o_orderkey % 8 < 6")}),
          batch AS (SELECT *, {sql_types('action_subtype')} AS action_type,
                           '{PREFIX}' || replace(replace(common_name, '-', ' - '), ' ', '%20') AS url FROM batch0),
          old AS ({_RECORDED}), new AS ({_CHECKED}),
          second AS (
            SELECT first."rowID", {_changed('common_name', 's.common_name')}, {_changed('url', 's.url')},
                   {_changed('action_subtype', 's.action_subtype')}, {_changed('action_type', 's.action_type')},
                   first.taxonomic_group,
                   {_changed('sara_status', """CASE WHEN s."rowID" % 10 < 5 THEN 'Special Concern' ELSE 'Not listed' END""")},
                   {_changed('listing_date', "CASE WHEN s.listing_date IS NOT NULL THEN '2017-02-03' END")},
                   {', '.join(f'CASE WHEN {_ROUTED} THEN new."{c}" ELSE old."{c}" END AS "{c}"' for c in _CELLS)}
            FROM first LEFT JOIN batch s ON first."rowID" = s."rowID"
            LEFT JOIN old ON old.row = first."rowID" LEFT JOIN new ON new.row = first."rowID"
            WHERE NOT coalesce(contains(s.change_made, 'remove'), false))
        SELECT * FROM second WHERE sara_status <> 'Not listed'""",
)
def _(t):
    """Two rounds: patch names and addresses; then a batch with categories, lists, verbs and dates."""
    named = left_join(t.orders, t.customer, {"o_custkey": "c_custkey"})

    def rows(columns, where):
        return named.filter(where).selectExpr(*[f"{value} AS `{name}`" for name, value in columns.items()])

    recorded = taxonomy.taxonomy_pivot(records(t), ["rowID"], spread=False)
    table = left_join(rows(_TABLE, "true"), recorded, ["rowID"])
    table = maintain.patch_round(table, rows(_FIRST, "o_orderkey % 9 < 6"), ["rowID"], PREFIX)
    checked = records(t).filter(_BATCHED).selectExpr(*[f"{v} AS {n}" for n, v in _BATCH_RECORDS.items()])
    wide = maintain.batch_categories(checked.drop("speciesID"), {"docID": "rowID"}, {"severity": _NEUTRAL}, spread=False)
    batch = maintain.prepared_batch(
        rows(_SECOND, "o_orderkey % 8 < 6"),
        table,
        ["rowID"],
        PREFIX,
        lists={"action_subtype": "action_type"},
        types=TAXONOMY,
        repairs={"action_subtype": _SPELLING},
    )
    table = maintain.change_round(table, batch, ["rowID"], wide, date_pattern="_date$")
    listed, _ = split_off(table, F.col("sara_status") == "Not listed")
    return listed


_HEADERS = {"REGISTRY NAME": "registry_name", "ASSESSED": "assessed", "REGISTRY ID": "registry_id"}


@query("maintain_registry_round", MISSING_FROM_REGISTRY)
def _(t):
    """The third round: what a registry, under its own headings, shows to be missing."""
    table, registry, options = registry_inputs(t)
    given = registry.withColumnsRenamed({new: old for old, new in _HEADERS.items()})
    return maintain.registry_round(table, given, _HEADERS, **options)
