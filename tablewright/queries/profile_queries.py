"""Summary tables of the documents view, and data dictionaries made of the parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import levels
from tablewright.plans import profile
from tablewright.plans.taxonomy import flag_name
from tablewright.queries.documents_view import DOCUMENTS, documents_view
from tablewright.queries.registry import query

_SHOWN = "concat(upper(replace(doc_type, 'COSEWIC ', '')[1]), lower(replace(doc_type, 'COSEWIC ', '')[2:]))"
_LATEST = f"""WITH prepared AS (
    SELECT * REPLACE ({_SHOWN} AS doc_type, concat(upper(taxonomic_group[1]), lower(taxonomic_group[2:])) AS taxonomic_group),
           CASE WHEN doc_type LIKE '%Status%' THEN 'Status' ELSE 'Recovery' END AS doc_type2 FROM ({DOCUMENTS})),
  latest AS (
    SELECT * FROM (
      SELECT *, max(year_published) OVER w AS m, count(year_published) OVER w AS known, count(*) OVER w AS total
      FROM prepared WINDOW w AS (PARTITION BY "speciesID", doc_type2, doc_type))
    WHERE known = total AND year_published = m)"""


def _latest(t):
    return profile.latest_documents(documents_view(t))


@query("pro1_docs_by_group", f"{_LATEST} SELECT taxonomic_group, doc_type, count(*) AS n FROM latest GROUP BY ALL")
def _(t):
    return profile.docs_by_group(_latest(t))


@query(
    "pro2_entities_by_group",
    f"""{_LATEST} SELECT taxonomic_group, doc_type, doc_type2, count(*) AS n FROM (
          SELECT *, row_number() OVER (PARTITION BY "speciesID", doc_type, doc_type2 ORDER BY "rowID") AS rn FROM latest)
        WHERE rn = 1 GROUP BY ALL""",
)
def _(t):
    return profile.entities_by_group(_latest(t), order_by=["rowID"])


@query(
    "pro3_docs_by_year",
    f"{_LATEST} SELECT year_published, doc_type, doc_type2, count(*) AS n FROM latest GROUP BY ALL",
)
def _(t):
    return profile.docs_by_year(_latest(t))


@query(
    "pro1_to_pro3_profile",
    f"""{_LATEST} SELECT 'docs_by_group' AS profile, taxonomic_group, doc_type, NULL AS doc_type2, NULL AS year_published, count(*) AS n
          FROM latest GROUP BY taxonomic_group, doc_type
        UNION ALL SELECT 'entities_by_group', taxonomic_group, doc_type, doc_type2, NULL, count(*) FROM (
          SELECT *, row_number() OVER (PARTITION BY "speciesID", doc_type, doc_type2 ORDER BY "rowID") AS rn FROM latest)
          WHERE rn = 1 GROUP BY taxonomic_group, doc_type, doc_type2
        UNION ALL SELECT 'docs_by_year', NULL, doc_type, doc_type2, year_published, count(*)
          FROM latest GROUP BY year_published, doc_type, doc_type2""",
)
def _(t):
    return profile.documents_profile(_latest(t), order_by=["rowID"])


def _sql_flags(numbers, keys: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT {keys}, '{n}' AS threat, count(*) AS n FROM latest WHERE "{flag_name(n)}" = 1 GROUP BY ALL"""
        for n in numbers
    )


@query("pro4_docs_by_threat", f"{_LATEST} {_sql_flags(levels.CATEGORIES, 'doc_type')}")
def _(t):
    return profile.docs_by_threat(_latest(t))


_NAMES = " ".join(f"WHEN '{n}' THEN '{name}'" for n, name in profile.PARENT_NAMES.items())


@query(
    "pro5_docs_by_parent_threat",
    f"""{_LATEST} SELECT *, CASE threat {_NAMES} END AS name, 12 - CAST(threat AS INTEGER) AS name_rank
        FROM ({_sql_flags(levels.PARENTS, 'doc_type, doc_type2')})""",
)
def _(t):
    return profile.docs_by_parent_threat(_latest(t))


_ACTIONS = ", ".join(f"'{a}'" for a in profile.ACTION_TYPES)


@query(
    "pro6_docs_by_action",
    f"""{_LATEST} SELECT doc_type, action_type, count(*) AS n, CAST(list_position([{_ACTIONS}], action_type) AS INTEGER)
          AS action_rank
        FROM (SELECT doc_type, unnest(string_split(action_type, ', ')) AS action_type FROM latest)
        WHERE action_type IN ({_ACTIONS}) GROUP BY doc_type, action_type""",
)
def _(t):
    return profile.docs_by_action(_latest(t))


_FORMATS = ["Text", "Categorical", "Integer", "YYYY-MM-DD", "Binary", "Ordinal", "Number (units km2)", "not a format", "See sheet 3", None]
_SQL_FORMAT = (
    "(["
    + ", ".join("NULL" if f is None else f"'{f}'" for f in _FORMATS)
    + f"])[1 + p_partkey % {len(_FORMATS)}]"
)


@query(
    "pro7_column_dictionary",
    f"""WITH d AS (SELECT concat(p_name, ' ', p_partkey) AS header, p_type AS said,
                     nullif(p_brand, 'Brand#2') AS details, {_SQL_FORMAT} AS form FROM part),
          s AS (SELECT *, CASE form WHEN 'Text' THEN 'nominal' WHEN 'Categorical' THEN 'nominal' WHEN 'Integer' THEN 'ratio'
                   WHEN 'YYYY-MM-DD' THEN 'dateTime' WHEN 'Binary' THEN 'nominal' WHEN 'Ordinal' THEN 'ordinal'
                   WHEN 'not a format' THEN 'nominal' WHEN 'See sheet 3' THEN 'nominal' END AS scale FROM d)
        SELECT header AS "attributeName",
               concat(said, ' Extraction details: ', coalesce(details, 'NA')) AS "attributeDefinition",
               CASE WHEN scale = 'dateTime' THEN form END AS "formatString", said AS definition,
               CASE WHEN form LIKE '%units%' THEN 'kilometerSquared' WHEN form IS NOT NULL THEN 'dimensionless' END AS unit,
               CASE WHEN form IN ('Integer', 'Ordinal', 'Binary') THEN 'integer' WHEN form LIKE '%units%' THEN 'real' END
                 AS "numberType",
               scale AS "measurementScale",
               CASE WHEN form IN ('Text', 'not a format') THEN 'textDomain' WHEN scale = 'ratio' THEN 'numericDomain'
                    WHEN scale = 'dateTime' THEN 'dateTimeDomain' WHEN scale IN ('ordinal', 'nominal') THEN 'enumeratedDomain'
                 END AS domain FROM s""",
)
def _(t):
    formats = F.array(*[F.lit(f).cast("string") for f in _FORMATS])
    dictionary = t.part.select(
        F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("Column header"),
        F.col("p_type").alias("Description"),
        F.nullif("p_brand", F.lit("Brand#2")).alias("Extraction Details"),
        F.get(formats, (F.col("p_partkey") % len(_FORMATS)).cast("int")).alias("Format"),
    )
    return profile.column_dictionary(dictionary)


_VALUES = """(SELECT concat('col', p_partkey) AS a,
    CASE WHEN p_size % 10 <> 0 THEN CASE WHEN p_size % 4 = 0 THEN 'NA' ELSE concat(p_size, ': ', p_type) END END AS v1,
    CASE p_size % 3 WHEN 0 THEN 'NR: not reported' WHEN 1 THEN p_brand END AS v2 FROM part)"""
_FACTS = f"""(SELECT a AS "attributeName", split_part(v, ': ', 1) AS code,
      CASE WHEN contains(v, ': ') THEN split_part(v, ': ', 2) ELSE v END AS definition
    FROM (SELECT a, unnest([v1, v2]) AS v FROM {_VALUES} WHERE v1 IS NOT NULL) WHERE v IS NOT NULL)"""


def _facts(t):
    size = F.col("p_size")
    dictionary = t.part.select(
        F.concat(F.lit("col"), F.col("p_partkey").cast("string")).alias("Column header"),
        F.when(
            size % 10 != 0,
            F.when(size % 4 == 0, F.lit("NA")).otherwise(F.concat(size.cast("string"), F.lit(": "), "p_type")),
        ).alias("Possible values"),
        F.when(size % 3 == 0, F.lit("NR: not reported")).when(size % 3 == 1, F.col("p_brand")).alias("more"),
    )
    return profile.dictionary_facts(dictionary, "Column header", ["Possible values", "more"])


@query(
    "pro8_value_dictionary",
    f"""SELECT * FROM {_FACTS} WHERE "attributeName" IN (
          SELECT "attributeName" FROM {_FACTS} WHERE code NOT IN ('NA', 'NR'))
        UNION ALL SELECT a, p_brand, concat('See action sub-types: ', string_agg(p_name, ', ' ORDER BY p_partkey))
          FROM part, (VALUES ('action_type'), ('CC_action_type')) v(a)
          GROUP BY a, p_brand
        UNION ALL SELECT a, p_name, p_type FROM part, (VALUES ('action_subtype'), ('CC_action_subtype')) v(a)""",
)
def _(t):
    more = profile.taxonomy_facts(
        t.part, "p_brand", "p_name", "p_type", "action_type, CC_action_type", "action_subtype, CC_action_subtype", ["p_partkey"]
    )
    return profile.value_dictionary(_facts(t), more)


@query("pro8_missing_codes", f"SELECT * FROM {_FACTS} WHERE code IN ('NA', 'NR')")
def _(t):
    return profile.missing_facts(_facts(t))


@query(
    "pro9_coverage",
    f"""SELECT min(cosewic_examined_date) AS begin_date, '2001-12-31' AS end_date,
               count(DISTINCT "speciesID") AS n_entities, -140.99778::DOUBLE AS west, -52.6480987209::DOUBLE AS east,
               83.23324::DOUBLE AS north, 41.6751050889::DOUBLE AS south FROM ({DOCUMENTS})""",
)
def _(t):
    return profile.coverage(documents_view(t), "cosewic_examined_date", "speciesID", "2001-12-31")


@query("pro9_coverage_entities", f"""SELECT DISTINCT "speciesID" FROM ({DOCUMENTS})""")
def _(t):
    return profile.coverage_entities(documents_view(t), "speciesID")
