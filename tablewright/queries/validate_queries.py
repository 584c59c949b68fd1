"""Completeness and contract rules, on the documents view and on lineitem."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from tablewright.functions.names import ref
from tablewright.plans import completeness, validate
from tablewright.plans.completeness import CHILD_FLAGS, PARENT_FLAGS
from tablewright.plans.taxonomy import flag_name, wide_name
from tablewright.plans.validate import ContractRow
from tablewright.queries.documents_view import CODED_NUMBERS, DOCUMENTS, documents_view
from tablewright.queries.registry import query
from tablewright.session import scratch_path
from tablewright.sources.delimited import write_csv

_DOCS = f"WITH docs AS ({DOCUMENTS})"
ALWAYS = ("rowID", "speciesID", "doc_type", "sara_status", "url", "web_pub_date", "year_published")
_KIND = {
    "sr": f"doc_type = '{completeness.STATUS_REPORT}'",
    "rs": f"doc_type = '{completeness.STRATEGY}'",
    "mp": f"doc_type = '{completeness.PLAN}'",
    "rsmp_cc": f"""doc_type IN ('{completeness.STRATEGY}', '{completeness.PLAN}') AND "CC_action" = 1""",
    "rs_cc": f"""doc_type = '{completeness.STRATEGY}' AND "CC_action" = 1""",
    "mp_cc": f"""doc_type = '{completeness.PLAN}' AND "CC_action" = 1""",
    "tcv": "threat_calculator = 1",
    "all": "true",
}
_REQUIRED = {
    "all": tuple(c for c in ALWAYS if c not in ("rowID", "url")),
    "sr": ("report_writers", *completeness.STATUS_REPORT_COLUMNS),
    "rs": completeness.STRATEGY_COLUMNS,
    "mp": completeness.PLAN_COLUMNS,
    "rsmp_cc": completeness.ACTION_COLUMNS,
    "rs_cc": completeness.ACTION_COLUMNS,
    "mp_cc": completeness.ACTION_COLUMNS,
    "tcv": (completeness.VERSION_COLUMN,),
}


def _sql_listing(scope: str) -> str:
    names = ", ".join(f"CASE WHEN \"{c}\" IS NULL THEN '{c}' END" for c in _REQUIRED[scope])
    return f"CASE WHEN {_KIND[scope]} THEN concat_ws(', ', {names}) ELSE '' END AS miss_{scope}"


def _sql_family(flags, label: str, name: str) -> str:
    null = " OR ".join(f'"{c}" IS NULL' for c in flags)
    return f"CASE WHEN {null} THEN '{label}' ELSE '' END AS miss_{name}"


_LISTINGS = ", ".join(_sql_listing(s) for s in ("all", "sr", "rs", "mp", "rsmp_cc", "tcv"))
_ANY = " OR ".join(f"miss_{s} <> ''" for s in ("all", "sr", "rs", "mp", "rsmp_cc", "tcv", "th1", "th2"))


@query(
    "dom17_completeness_report",
    f"""{_DOCS} SELECT * FROM (
          SELECT "rowID", {_LISTINGS}, {_sql_family(PARENT_FLAGS, 'Level 1 threats', 'th1')},
                 {_sql_family(CHILD_FLAGS, 'Level 2 threats', 'th2')} FROM docs) WHERE {_ANY}""",
)
def _(t):
    scopes = completeness.document_scopes(ALWAYS, author="report_writers")
    report = completeness.completeness_report(documents_view(t), scopes)
    return report.select("rowID", *[f"miss_{s.name}" for s in scopes])


DOMAINS = {
    "sara_status": ("Endangered", "Threatened", "Special Concern"),
    "Critical_habitat": ("NA", "P", "Y", "N", "NE"),
    "CC_action": ("NA", "0"),
    "action_type": (
        "NA", "Research and monitoring", "Outreach and stewardship", "Habitat management", "Population management", "NE",
    ),
}
SUBTYPES = ("education", "monitoring", "feeding", "translocation", "NA")


def _sql_items(column: str) -> str:
    text = f"regexp_replace(CAST(\"{column}\" AS VARCHAR), '^(-?[0-9]+)\\.0$', '\\1')"
    return f"list_distinct(string_split(coalesce({text}, 'NA'), ', '))"


def _sql_in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _sql_domain(source: str, domains) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'domain' AS rule, '{c}' AS column_name, value, count(*) AS n_bad
            FROM (SELECT unnest({_sql_items(c)}) AS value FROM {source})
            WHERE value NOT IN ({_sql_in(allowed)}) GROUP BY value"""
        for c, allowed in domains.items()
    )


_SQL_LOOSE = " UNION ALL ".join(
    f"""SELECT 'domain_loose' AS rule, '{c}' AS column_name, value, count(*) AS n_bad FROM (
          SELECT unnest(list_distinct(CASE WHEN "{c}" IS NULL THEN ['NA'] ELSE list_transform(
            string_split("{c}", ', '), lambda x: lower(regexp_replace(trim(x), ',', ''))) END)) AS value FROM docs)
        WHERE value <> '' AND value NOT IN ({_sql_in(SUBTYPES)}) GROUP BY value"""
    for c in validate.LOOSE_COLUMNS
)


@query("val1_domain", f"{_DOCS} {_sql_domain('docs', DOMAINS)}")
def _(t):
    return validate.domain_offenders(documents_view(t), DOMAINS)


_LINE_DOMAINS = {"l_returnflag": ("A", "N"), "l_linestatus": ("O", "F"), "l_linenumber": ("1", "2", "3", "4", "5")}


@query("val1_domain_lineitem", _sql_domain("lineitem", _LINE_DOMAINS))
def _(t):
    return validate.domain_offenders(t.lineitem, _LINE_DOMAINS)


@query("val2_domain_loose", f"{_DOCS} {_SQL_LOOSE}")
def _(t):
    return validate.domain_offenders(documents_view(t), {c: SUBTYPES for c in validate.LOOSE_COLUMNS}, loose=True)


_LEVEL_COLUMNS = [wide_name(n, m) for n in CODED_NUMBERS for m in ("scope", "severity", "timing")]
_SQL_FAMILY = " UNION ALL ".join(
    f"""SELECT 'family_domain' AS rule, '{c}' AS column_name,
               regexp_replace(CAST("{c}" AS VARCHAR), '^(-?[0-9]+)\\.0$', '\\1') AS value, count(*) AS n_bad
        FROM docs WHERE "{c}" IS NOT NULL AND NOT (2 * "{c}" = floor(2 * "{c}") AND "{c}" BETWEEN -2 AND 5)
        GROUP BY 3"""
    for c in _LEVEL_COLUMNS
)


@query("val3_family_domain", f"{_DOCS} {_SQL_FAMILY}")
def _(t):
    return validate.family_offenders(documents_view(t))


def _sql_counts(rules, source: str = "docs") -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{rule}' AS rule, '{column}' AS column_name, count(*) FILTER ({test}) AS n_bad FROM {source}"""
        for (rule, column), test in rules.items()
    )
    return f"SELECT * FROM ({rows}) WHERE n_bad > 0"


TYPES = {"l_quantity": "is.character", "l_returnflag": "is.character", "l_linestatus": "is.numeric", "l_tax": "is.numeric"}
_SQL_TYPES = {
    (kind, c): f"typeof({c}) {'<>' if kind == 'is.character' else '='} 'VARCHAR'" for c, kind in TYPES.items()
}


@query("val4_type_is", _sql_counts(_SQL_TYPES, "lineitem"))
def _(t):
    return validate.rule_counts(t.lineitem, validate.type_counts(t.lineitem, TYPES))


@query(
    "val5_unique",
    f"""{_DOCS} SELECT 'unique' AS rule, 'speciesID' AS column_name, count(*) - count(DISTINCT "speciesID") AS n_bad FROM docs
        UNION ALL SELECT 'unique', 'url', count(*) - count(DISTINCT url) - 1 FROM docs""",
)
def _(t):
    return validate.unique_offenders(documents_view(t), ["rowID", "speciesID", "url"])


DATES = ("web_pub_date", "cosewic_examined_date")
_SQL_DATES = {
    ("plausible_date", c): f'"{c}" IS NOT NULL AND NOT coalesce(try_cast("{c}" AS DATE) > DATE \'1980-01-01\', false)'
    for c in DATES
}


@query("val6_plausible_date", f"{_DOCS} {_sql_counts(_SQL_DATES)}")
def _(t):
    docs = documents_view(t)
    return validate.rule_counts(docs, validate.date_counts(docs, DATES))


@query(
    "val7_plausible_year",
    """SELECT 'plausible_year' AS rule, 'y' AS column_name, count(*) FILTER (NOT (y > 1980 AND y < 2100)) AS n_bad
       FROM (SELECT CASE o_orderkey % 90 WHEN 0 THEN NULL WHEN 1 THEN 1980 WHEN 2 THEN 2101 ELSE year(o_orderdate) END AS y
             FROM orders)""",
)
def _(t):
    rest = F.col("o_orderkey") % 90
    year = F.when(rest == 1, 1980).when(rest == 2, 2101).when(rest != 0, F.year("o_orderdate"))
    return validate.rule_counts(t.orders.select(year.alias("y")), validate.year_counts(["y"]))


def _sql_required(scope: str, rule: str) -> dict:
    return {(rule, c): f'{_KIND[scope]} AND "{c}" IS NULL' for c in _REQUIRED[scope]}


_SQL_ALWAYS = {("required", c): f'"{c}" IS NULL' for c in ALWAYS}


@query("val8_required", f"{_DOCS} {_sql_counts(_SQL_ALWAYS)}")
def _(t):
    return validate.rule_counts(documents_view(t), validate.required_counts(ALWAYS))


_SQL_CONDITIONAL = {
    k: v for s in ("sr", "rs", "rs_cc", "mp", "mp_cc") for k, v in _sql_required(s, f"required_{s}").items()
}


@query("val9_conditional_required", f"{_DOCS} {_sql_counts(_SQL_CONDITIONAL)}")
def _(t):
    scopes = validate.document_requirements()
    return validate.rule_counts(documents_view(t), validate.conditional_required(scopes))


_SQL_FLAGS = {("required_level1", c): f'"{c}" IS NULL' for c in PARENT_FLAGS} | {
    ("required_level2", c): f'"{c}" IS NULL' for c in CHILD_FLAGS
}


@query("val10_family_required", f"{_DOCS} {_sql_counts(_SQL_FLAGS)}")
def _(t):
    return validate.rule_counts(documents_view(t), validate.family_required_counts())


@query(
    "val11_implied_required",
    f"""{_DOCS} SELECT "rowID" FROM docs WHERE threat_calculator = 1 AND "TC_version" IS NULL""",
)
def _(t):
    docs = documents_view(t)
    return validate.implied_required(docs, "rowID", ref("threat_calculator") == 1, "TC_version")


_SQL_CONTRADICTIONS = {
    "not_mentioned_but_threat": '"CC_not_mentioned" = 1 AND "CC_threat" = 1',
    "not_mentioned_but_unknown": '"CC_not_mentioned" = 1 AND "CC_unknown" = 1',
    "threat_without_impact": '"CC_threat" = 1 AND ("CC_relative_impact" = 0 OR "CC_relative_impact" IS NULL)',
    "impact_without_threat": '"CC_threat" = 0 AND "CC_relative_impact" > 0',
}


def _rules():
    columns = ("CC_not_mentioned", "CC_threat", "CC_unknown", "CC_relative_impact")
    return validate.contradictions(*[ref(c) for c in columns])


@query(
    "val12_contradiction",
    _DOCS
    + " UNION ALL ".join(
        f""" SELECT '{rule}' AS rule, "rowID" FROM docs WHERE {test}""" for rule, test in _SQL_CONTRADICTIONS.items()
    ),
)
def _(t):
    return validate.contradicting_rows(documents_view(t), "rowID", _rules())


@query(
    "val13_unflagged",
    _DOCS
    + " UNION ALL ".join(
        f""" SELECT "rowID", common_name, '{n}' AS threat_num FROM docs WHERE "{flag_name(n)}" = 0
             AND "{wide_name(n, 'scope')}" <> 0 AND "{wide_name(n, 'severity')}" <> 0
             AND "{wide_name(n, 'timing')}" > 2"""
        for n in CODED_NUMBERS
    ),
)
def _(t):
    return validate.unflagged_rows(documents_view(t), ["rowID", "common_name"], CODED_NUMBERS)


CONTRACT = [
    ContractRow("rowID", (), "unique, is.numeric", False),
    ContractRow("speciesID", (), "is.numeric", False),
    ContractRow("common_name", (), "is.character, is.numeric", False),
    ContractRow("web_pub_date", (), "is.character, plausible_date", False),
    ContractRow("year_published", (), "is.numeric, plausible_year", False),
    ContractRow("url", (), "unique", True),
    *[ContractRow(c, values, "vals", True) for c, values in DOMAINS.items()],
    *[ContractRow(c, SUBTYPES, "vals", True) for c in validate.LOOSE_COLUMNS],
]
@lru_cache(maxsize=8)
def kept_contract(spark, contract: tuple[ContractRow, ...]) -> list[ContractRow]:
    """A contract as it is read from its file, which is written and read once in a session."""
    rows = [(r.column, ", ".join(r.values) or None, r.expectation, "1" if r.na_allowed else "0") for r in contract]
    path = scratch_path(spark, "contract")
    columns = "colnms string, vals string, expectation string, na_allowed string"
    write_csv(spark.createDataFrame(rows, columns).coalesce(1), path)
    return validate.read_contract(spark, path)


_SQL_REPORT = (
    {("is.numeric", "common_name"): "true"}
    | {k: v for k, v in _SQL_DATES.items() if k[1] == "web_pub_date"}
    | {("required", r.column): f'"{r.column}" IS NULL' for r in CONTRACT if not r.na_allowed}
    | _SQL_CONDITIONAL
    | {(rule, "row"): test for rule, test in _SQL_CONTRADICTIONS.items()}
)


@query(
    "val14_report",
    f"""{_DOCS}, offenders AS (
          {_sql_domain('docs', DOMAINS)} UNION ALL {_SQL_LOOSE} UNION ALL {_SQL_FAMILY})
        SELECT rule, column_name, n_bad, concat(n_bad, ' rows') AS message FROM ({_sql_counts(_SQL_REPORT)})
        UNION ALL SELECT 'unique', 'url', count(*) - count(DISTINCT url) - 1, 'repeated values' FROM docs
        UNION ALL SELECT rule, column_name, CAST(sum(n_bad) AS BIGINT), concat(count(*), ' values, e.g. ', min(value))
          FROM offenders GROUP BY rule, column_name""",
)
def _(t):
    scopes = validate.document_requirements()
    contract = kept_contract(t.spark, tuple(CONTRACT))
    return validate.validation_report(documents_view(t), contract, scopes, _rules(), family="^X")


@query(
    "snk1_checked_snapshot",
    """SELECT 'domain' AS rule, 'l_returnflag' AS column_name, count(*) AS n_bad,
              concat(count(DISTINCT l_returnflag), ' values, e.g. ', min(l_returnflag)) AS message
       FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
       UNION ALL SELECT 'unique', 'l_orderkey', count(*) - count(DISTINCT l_orderkey), 'repeated values' FROM lineitem
       UNION ALL SELECT 'cheap', 'row', count(*), concat(count(*), ' rows') FROM lineitem WHERE l_extendedprice < 2 * l_quantity * l_quantity""",
)
def _(t):
    """A version written and checked in one pass over its source."""
    contract = [
        ContractRow("l_orderkey", (), "unique, is.numeric", False),
        ContractRow("l_returnflag", ("A", "N"), "vals", True),
        ContractRow("l_linestatus", ("F", "O"), "vals", True),
        ContractRow("l_quantity", (), "is.numeric", False),
    ]
    rules = {"cheap": ref("l_extendedprice") < 2 * ref("l_quantity") * ref("l_quantity")}
    return validate.write_checked(t.lineitem, scratch_path(t.spark, "checked"), "2020-01-01", contract, row_rules=rules)
