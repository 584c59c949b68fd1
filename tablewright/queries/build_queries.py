"""The build of the curated table as one query, and its output held against a contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import levels
from tablewright.plans import build, reconcile, taxonomy, validate
from tablewright.plans.completeness import PLAN, STATUS_REPORT, STRATEGY
from tablewright.plans.taxonomy import flag_name, wide_name
from tablewright.plans.validate import ContractRow
from tablewright.queries.documents_view import SUBTYPES, _case, _pick
from tablewright.queries.registry import query
from tablewright.queries.taxonomy_queries import (
    RECORDS,
    TAXONOMY,
    coded_sql,
    fixed_sql,
    records,
    rolled_sql,
    sql_types,
    taxonomy_table,
    wide_sql,
)
from tablewright.queries.validate_queries import kept_contract

PREFIX = "https://registry.example.org/?q="
STARTS = {STATUS_REPORT: 10_000_000_000, STRATEGY: 11_000_000_000, PLAN: 12_000_000_000}
INSERTED = 13_000_000_000

# Expressions that Spark and DuckDB both read. Newer documents are orders, older entities customers.
_NEWER = {
    "docID": "o_orderkey",
    "uID": "o_custkey",
    "doc_type": _case("o_orderstatus", {"F": STATUS_REPORT, "O": STRATEGY, "P": PLAN}),
    "common_name": "CASE WHEN o_orderkey % 40 = 0 THEN 'Unknown being' END",
    "year_published": "CAST(year(o_orderdate) AS INTEGER)",
    "web_pub_date": "CASE WHEN o_orderkey % 23 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "doc_citation": "CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END",
    "final": "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 2 AS INTEGER) END",
    "threat_calculator": "CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 2 AS INTEGER) END",
    "TC_version": "CASE WHEN o_orderkey % 5 = 0 THEN CAST(1.1 AS DOUBLE) END",
    "TC_date": "CASE WHEN o_orderkey % 2 = 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "action_subtype": f"CASE WHEN o_orderkey % 15 <> 0 THEN {_pick(['promo,, standard', *SUBTYPES, 'Manage Human Threats'])} END",
    "CC_action_subtype": f"CASE WHEN o_orderkey % 13 <> 0 THEN {_pick(['economy', *SUBTYPES, 'manage PREDATION'])} END",
    "CC_unknown_scope": "CASE o_orderkey % 3 WHEN 0 THEN 'Nr' WHEN 1 THEN 'NR' END",
}
_NAMES = {"uID": "c_custkey", "common_name": "replace(c_name, '#', ' - ')", "species": "lower(c_mktsegment)"}
_KINDS = {
    STATUS_REPORT: (
        "c_custkey % 2 = 0",
        {"year_published": "CAST(1993 + c_custkey % 6 AS INTEGER)", "final": "1", "threat_calculator": "CAST(c_custkey % 3 AS INTEGER)"},
    ),
    STRATEGY: (
        "c_custkey % 3 = 0",
        {"year_published": "CAST(1992 + c_custkey % 7 AS INTEGER)", "final": "CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END"},
    ),
    PLAN: ("c_custkey % 4 = 1", {"year_published": "CAST(1994 + c_custkey % 5 AS INTEGER)", "final": "0"}),
}
_OLDER_COLUMNS = ("uID", "common_name", "species", "year_published", "final", "threat_calculator", "TC_version", "action_subtype")
_UPDATES = ("c_custkey % 5 = 0", {"uID": "c_custkey", "doc_type": f"'{STATUS_REPORT}'", "threat_calculator": "1", "TC_version": "CASE WHEN c_custkey % 2 = 0 THEN CAST(2.0 AS DOUBLE) END"})
_PATCHES = ("c_custkey % 7 = 0", {"uID": "c_custkey", "doc_type": f"'{STRATEGY}'", "final": "0", "action_subtype": "'widget'"})
_INSERTS = ("c_custkey % 9 < 2", {"uID": "c_custkey", "doc_type": f"'{PLAN}'", "year_published": "1999", "final": "1"})
_REGISTRY = {
    "registry_name": "upper(replace(c_name, '#', '-'))",
    "taxonomic_group": _case("c_mktsegment", {"AUTOMOBILE": "Fishes (marine)", "BUILDING": "Reptiles", "FURNITURE": "Mosses"}),
    "cosewic_status": "CASE WHEN c_custkey % 6 <> 0 THEN 'Threatened' END",
    "examined": "CAST(1993 + c_custkey % 6 AS INTEGER)",
}
_COARSE = {"Fishes (marine)": "Marine Fishes", "Reptiles": "Herpetofauna", "Mosses": "Plants"}
_BLOCKS = [
    ["uID", "common_name", "species", "docID", "doc_type", "doc_citation", "url", "web_pub_date", "year_published", "final",
     "taxonomic_group", "large_group", "cosewic_status", "action_subtype", "CC_action_subtype", "action_type", "CC_action_type",
     "CC_unknown_scope", "threat_calculator", "TC_version", "TC_date"],
]
_DOCUMENT_OF_RECORD = "CASE WHEN rowID % 10 <> 3 THEN rowID END"


def _select(columns, source: str, where: str = "true") -> str:
    return f"(SELECT {', '.join(f'{v} AS "{n}"' for n, v in columns.items())} FROM {source} WHERE {where})"


def _rows(df, columns, where: str = "true"):
    return df.filter(where).selectExpr(*[f"{v} AS `{n}`" for n, v in columns.items()])


def categories(t):
    all_records = records(t).selectExpr("*", f"{_DOCUMENT_OF_RECORD} AS docID")
    hand, machine = all_records.filter("rowID % 4 <> 0"), all_records.filter("rowID % 4 = 0")
    return build.category_table(hand, machine, ["uID", "threat_num", "docID"], ["uID", "docID"], order_by=["rowID"], spread=False)


def built(t, stored=None):
    """Every step, over all measures; ``stored`` as in :func:`build.with_categories`."""
    newer = build.complete_documents(_rows(t.orders, _NEWER), ["web_pub_date", "doc_citation"])
    newer = build.named_documents(newer, _rows(t.customer, _NAMES))
    known = taxonomy.read_taxonomy(taxonomy_table(t), "kind", "subtype", ["place"])
    listed = {"action_subtype": "action_type", "CC_action_subtype": "CC_action_type"}
    newer = taxonomy.classify_columns(newer, known, listed, repair_commas=["action_subtype"])
    shared = {"uID": F.col("c_custkey"), **{c: F.expr(_NAMES[c]) for c in ("common_name", "species")}}
    shared |= {"TC_version": F.lit(None).cast("double"), "action_subtype": F.lit(None).cast("string")}
    kinds = {
        kind: (F.expr(where), shared | {c: F.expr(v) for c, v in values.items()}) for kind, (where, values) in _KINDS.items()
    }
    batches = [_rows(t.customer, columns, where) for where, columns in (_UPDATES, _PATCHES, _INSERTS)]
    older = build.older_documents(t.customer, kinds, _OLDER_COLUMNS, STARTS, *batches, INSERTED)
    absent = [c for c in newer.columns if c not in older.columns]
    older = older.select("*", *[F.lit(None).cast(newer.schema[c].dataType).alias(c) for c in absent])
    documents = build.own_categories(newer).unionByName(build.orphan_categories(older))
    documents = build.current_documents(documents)
    documents = reconcile.reconcile_registry(
        documents,
        _rows(t.customer, _REGISTRY),
        "common_name",
        "registry_name",
        "taxonomic_group",
        guarded=["cosewic_status"],
        applies=(F.col("examined") == F.col("year_published")) & (F.col("doc_type") == STATUS_REPORT),
        drop=["examined"],
    )
    table = build.with_categories(documents, categories(t), stored=stored)
    return build.finished(table, _BLOCKS, PREFIX, ["CC_unknown_scope"], {"docID": "rowID", "uID": "speciesID"})


def _sql_name(column: str) -> str:
    return f"lower(replace(replace({column}, ' - ', '-'), '#', '-'))"


def _sql_older() -> str:
    rows = " UNION ALL ".join(
        f"""SELECT {start} - 1 + row_number() OVER (ORDER BY c_custkey) AS "docID", c_custkey AS "uID", '{kind}' AS doc_type,
              {_NAMES['common_name']} AS common_name, {_NAMES['species']} AS species, {values['year_published']} AS year_published,
              {values['final']} AS final, {values.get('threat_calculator', 'CAST(NULL AS INTEGER)')} AS threat_calculator,
              CAST(NULL AS DOUBLE) AS "TC_version", CAST(NULL AS VARCHAR) AS action_subtype
            FROM customer WHERE {where}"""
        for (kind, (where, values)), start in zip(_KINDS.items(), STARTS.values(), strict=True)
    )
    return f"""older0 AS ({rows}),
      older1 AS (SELECT o.* REPLACE (
                   CASE WHEN u."uID" IS NOT NULL THEN u.threat_calculator ELSE o.threat_calculator END AS threat_calculator,
                   CASE WHEN u."uID" IS NOT NULL THEN u."TC_version" ELSE o."TC_version" END AS "TC_version",
                   coalesce(o.final, p.final) AS final, coalesce(o.action_subtype, p.action_subtype) AS action_subtype)
                 FROM older0 o
                 LEFT JOIN {_select(_UPDATES[1], 'customer', _UPDATES[0])} u ON o."uID" = u."uID" AND o.doc_type = u.doc_type
                 LEFT JOIN {_select(_PATCHES[1], 'customer', _PATCHES[0])} p ON o."uID" = p."uID" AND o.doc_type = p.doc_type),
      older AS (SELECT * FROM older1 UNION ALL BY NAME
                SELECT *, {INSERTED} - 1 + row_number() OVER (ORDER BY "uID") AS "docID"
                FROM {_select(_INSERTS[1], 'customer', _INSERTS[0])} i
                WHERE NOT EXISTS (SELECT 1 FROM older0 o WHERE o."uID" = i."uID" AND o.doc_type = i.doc_type))"""


_WITH_DOCUMENT = f"(SELECT *, {_DOCUMENT_OF_RECORD} AS docID FROM ({RECORDS}))"
_MERGED = f"""SELECT * FROM {_WITH_DOCUMENT} WHERE rowID % 4 <> 0 UNION ALL SELECT * FROM {_WITH_DOCUMENT} m WHERE rowID % 4 = 0
    AND NOT EXISTS (SELECT 1 FROM {_WITH_DOCUMENT} h WHERE h.rowID % 4 <> 0 AND h.uID IS NOT DISTINCT FROM m.uID
                    AND h.threat_num IS NOT DISTINCT FROM m.threat_num AND h.docID IS NOT DISTINCT FROM m.docID)"""
_FIRST = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uID, {_DOCUMENT_OF_RECORD}, replace(threat_num, ',', '.')
    ORDER BY rowID) AS rn FROM ({_MERGED})) WHERE rn = 1"""
_MEASURED = [wide_name(n, m) for m in taxonomy.WIDE_MEASURES[1:] for n in levels.CATEGORIES]
_ANY_MEASURE = " OR ".join(f'"{c}" IS NOT NULL' for c in _MEASURED)
_GROUP = _case("taxonomic_group", _COARSE)[:-4] + " ELSE taxonomic_group END"
_LISTED = {"action_subtype": "action_type", "CC_action_subtype": "CC_action_type"}


def _sql_repaired(column: str, commas: bool) -> str:
    text = f"""regexp_replace(regexp_replace("{column}", 'manage human threats', 'regulate human activities', 'i'),
      'manage predation', 'Manage native species negatively impacting species at risk', 'i')"""
    return f"regexp_replace({text}, ',,|, ,', ',')" if commas else text


_FLAG_COLUMNS = ", ".join(
    f'{rolled_sql(n)} AS "{flag_name(n)}"' if n in levels.PARENTS else f'"{flag_name(n)}"' for n in levels.CATEGORIES
)
BUILT = f"""WITH names AS (SELECT * FROM {_select(_NAMES, 'customer')}),
      newer0 AS (SELECT d.* REPLACE (coalesce(d.common_name, n.common_name) AS common_name), n.species
                 FROM {_select(_NEWER, 'orders')} d LEFT JOIN names n ON d."uID" = n."uID"
                 WHERE web_pub_date IS NOT NULL AND doc_citation IS NOT NULL),
      newer1 AS (SELECT * REPLACE ({_sql_repaired('action_subtype', True)} AS action_subtype,
                                   {_sql_repaired('CC_action_subtype', False)} AS "CC_action_subtype") FROM newer0),
      newer AS (SELECT *, {', '.join(f'{sql_types(f'"{c}"')} AS "{k}"' for c, k in _LISTED.items())},
                       "docID" AS cat FROM newer1),
      {_sql_older()},
      documents0 AS (SELECT * FROM newer UNION ALL BY NAME
                     SELECT *, CASE WHEN doc_type = '{STATUS_REPORT}' AND threat_calculator = 1 THEN NULL ELSE -1 END AS cat
                     FROM older),
      a AS (SELECT * EXCLUDE n FROM (SELECT *, count(*) OVER (PARTITION BY "uID", year_published, doc_type) AS n FROM documents0)
            WHERE NOT (n > 1 AND web_pub_date IS NULL)),
      b AS (SELECT * EXCLUDE n FROM (SELECT *, count(*) OVER (PARTITION BY "uID", doc_type) AS n FROM a)
            WHERE NOT (n > 1 AND coalesce(final = 0 AND web_pub_date IS NULL, true))),
      registered AS (
        SELECT b.* REPLACE ({_sql_name('common_name')} AS common_name), taxonomic_group, {_GROUP} AS large_group,
               CASE WHEN examined = year_published AND doc_type = '{STATUS_REPORT}' THEN cosewic_status END AS cosewic_status
        FROM b LEFT JOIN {_select(_REGISTRY, 'customer')} r ON {_sql_name('common_name')} = lower(registry_name)),
      wide AS (SELECT * FROM (SELECT uID, docID, {wide_sql(levels.CATEGORIES, taxonomy.WIDE_MEASURES)}
                              FROM (SELECT *, {_DOCUMENT_OF_RECORD} AS docID FROM ({coded_sql(fixed_sql(_FIRST))}))
                              GROUP BY uID, docID) WHERE {_ANY_MEASURE}),
      joined AS (SELECT r.*, w.* EXCLUDE (uID, docID) FROM registered r
                 LEFT JOIN wide w ON r."uID" = w.uID AND r.cat IS NOT DISTINCT FROM w.docID)
    SELECT "docID" AS "rowID", "uID" AS "speciesID", common_name, species, doc_type, doc_citation,
           '{PREFIX}' || replace(replace(common_name, '-', ' - '), ' ', '%20') AS url, web_pub_date, year_published, final,
           taxonomic_group, large_group, cosewic_status, action_subtype, "CC_action_subtype", action_type, "CC_action_type",
           replace("CC_unknown_scope", 'Nr', 'NR') AS "CC_unknown_scope", threat_calculator, "TC_date",
           CASE WHEN threat_calculator = 1 AND "TC_version" IS NULL
                THEN CASE WHEN "{flag_name('8.4')}" IS NOT NULL THEN 2.3 ELSE 1.1 END ELSE "TC_version" END::DOUBLE AS "TC_version",
           {_FLAG_COLUMNS}, {', '.join(f'"{c}"' for c in _MEASURED)}
    FROM joined"""


@query("build_curated_table", BUILT)
def _(t):
    return built(t)


@query(
    "build_checks",
    """SELECT 'documents' AS what, CAST(o_orderkey AS VARCHAR) AS key, count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1
       UNION ALL SELECT 'records', concat(o_custkey, ', ', o_orderkey % 7), count(*) FROM orders
       GROUP BY o_custkey, o_orderkey % 7 HAVING count(*) > 1""",
)
def _(t):
    """The check on keys that are unique, and on some that are not."""
    documents = _rows(t.orders, {"docID": "o_orderkey"})
    repeated = _rows(t.orders, {"uID": "o_custkey", "docID": "o_orderkey % 7"})
    checks = build.build_checks(documents, repeated)
    return checks.withColumn("what", F.when(F.col("what") == "categories", "records").otherwise(F.col("what")))


_ALLOWED = {"doc_type": (STATUS_REPORT, STRATEGY), "large_group": ("Plants", "Marine Fishes", "NA")}
CONTRACT = [
    ContractRow("rowID", (), "unique, is.numeric", False),
    ContractRow("common_name", (), "is.character", False),
    ContractRow("web_pub_date", (), "is.character, plausible_date", True),
    ContractRow("year_published", (), "is.numeric, plausible_year", False),
    ContractRow("cosewic_status", (), "is.character", False),
    *[ContractRow(c, values, "vals", True) for c, values in _ALLOWED.items()],
]


def _sql_family() -> str:
    return " UNION ALL ".join(
        f"""SELECT 'family_domain' AS rule, '{c}' AS column_name, count(*) AS n_bad,
                   concat(count(DISTINCT "{c}"), ' values, e.g. ', min(regexp_replace(CAST("{c}" AS VARCHAR), '\\.0$', ''))) AS message
            FROM built WHERE "{c}" IS NOT NULL AND NOT (2 * "{c}" = floor(2 * "{c}") AND "{c}" BETWEEN -2 AND 5)"""
        for c in _MEASURED
        if not c.endswith("comments")
    )


@query(
    "val_built_table",
    f"""WITH built AS ({BUILT}), report AS (
          SELECT 'required' AS rule, 'cosewic_status' AS column_name, count(*) FILTER (cosewic_status IS NULL) AS n_bad,
                 concat(count(*) FILTER (cosewic_status IS NULL), ' rows') AS message FROM built
          UNION ALL SELECT 'required', 'common_name', count(*) FILTER (common_name IS NULL),
                 concat(count(*) FILTER (common_name IS NULL), ' rows') FROM built
          UNION ALL SELECT 'domain', 'doc_type', count(*), concat(count(DISTINCT doc_type), ' values, e.g. ', min(doc_type))
            FROM built WHERE doc_type NOT IN ('{STATUS_REPORT}', '{STRATEGY}')
          UNION ALL SELECT 'domain', 'large_group', count(*), concat(count(DISTINCT large_group), ' values, e.g. ', min(large_group))
            FROM built WHERE large_group NOT IN ('Plants', 'Marine Fishes')
          UNION ALL {_sql_family()})
        SELECT * FROM report WHERE n_bad > 0""",
)
def _(t):
    """The built table, written once with its categories as lists, against a contract kept in a file."""
    contract = kept_contract(t.spark, tuple(CONTRACT))
    return validate.validation_report(built(t, stored="built"), contract, family="^X")
