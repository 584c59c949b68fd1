"""Level texts, categories and list taxonomies, on records derived from the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import dates, levels
from tablewright.functions.names import ref
from tablewright.operators.joins import left_join
from tablewright.operators.reshape import flag_counts, unknown_names
from tablewright.plans import profile, taxonomy
from tablewright.plans.taxonomy import FLAG, flag_name, wide_name
from tablewright.queries.registry import query
from tablewright.sources.delimited import inline_table

# Texts that a record's measures take in turn, spelt as people spell them.
TEXTS = {
    "impact": [
        "High", "Very High", "Very High - High", "Very High - Very High", "High - Medium - Low", "Medium", "Low",
        "Hig", "", "Negligible", "Insignificant", "Not a Threat", "Unknown", "Not Calculated", "Not scored",
        "-- Uncertainty Ranges --", None, None, None,
    ],
    "scope": [
        "Large", "Pervasive", "Pervasive - Large (31-100%)", "Small", "Restricted", "Smal", "Negligible",
        "Not a threat", "Unknown", "Not Calculated", "-- Uncertainty Ranges --", None, "Medium",
    ],
    "severity": [
        "Extreme - Moderate (11-100%)", "Serious", "Slight", "Sight", "Moderate", "Neutral or Potential Benefit",
        "Neglibible", "Unknown", "Unkown", "Not Scored", None, "Extreme", "-- Uncertainty Ranges --",
        "Neutral or potentially beneficial",
    ],
    "timing": [
        "High", "Moderate", "Low", "Ongoing", "Unknown", None, "Insignificant", "-- Uncertainty Ranges --",
        "High - Low", "very high - high",
    ],
}
_FACTORS = {"impact": 7, "scope": 3, "severity": 5, "timing": 11}


def _sql_text(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _pick(values, index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {_sql_text(v)}" for i, v in enumerate(values))
    return f"CASE ({index}) % {len(values)} {cases} END"


_NUMBER = _pick(levels.CATEGORIES, "o_orderkey")
# Expressions that Spark and DuckDB both read.
_RECORD_COLUMNS = {
    "rowID": "o_orderkey",
    "uID": "o_custkey",
    "threat_num": f"CASE WHEN o_orderkey % 2 = 0 THEN replace({_NUMBER}, '.', ',') ELSE {_NUMBER} END",
    **{m: _pick(v, f"o_orderkey * {_FACTORS[m]} + o_custkey") for m, v in TEXTS.items()},
    "comments": "o_orderpriority",
}
RECORDS = "SELECT " + ", ".join(f"{value} AS {name}" for name, value in _RECORD_COLUMNS.items()) + " FROM orders"


def records(t):
    """A category record per order: entity, number (half of them with a comma), level texts, comments."""
    return t.orders.selectExpr(*[f"{value} AS {name}" for name, value in _RECORD_COLUMNS.items()])


def _sql_codes(expr: str, codes) -> str:
    text = f"regexp_replace(lower({expr}), 'very high', 'very')"
    found = ", ".join(
        f"CASE WHEN contains({text}, '{label.replace('very high', 'very')}') THEN {code}::DOUBLE END"
        for label, code in codes
    )
    return f"list_distinct([{found}])"


def sql_recode(expr: str, codes) -> str:
    found = _sql_codes(expr, codes)
    return f"""CASE WHEN {expr} IS NULL THEN NULL WHEN len({found}) = 0 THEN 99.0::DOUBLE
        WHEN len({found}) <= 2 THEN CAST(list_avg({found}) AS DOUBLE) ELSE 100.0::DOUBLE END"""


def _cleaned(measure: str) -> str:
    if measure == "impact":
        return measure
    return f"(CASE WHEN NOT contains({measure}, '{levels.LEVEL_SENTINEL}') THEN {measure} END)"


_DERIVED = """coalesce(impact0, CASE WHEN scope = 1 OR severity = 1 THEN 1 WHEN scope = 0 OR severity = 0 THEN 0
    WHEN scope = -1 OR severity = -1 THEN -1 WHEN scope = -2 OR severity = -2 THEN -2
    WHEN scope IS NULL AND severity IS NOT NULL THEN -1 WHEN scope IS NOT NULL AND severity IS NULL THEN -1 END)"""


def coded_sql(source: str) -> str:
    codes = ", ".join(
        f"{sql_recode(_cleaned(m), c)} AS {m if m != 'impact' else 'impact0'}" for m, c in levels.LEVEL_CODES.items()
    )
    return f"""SELECT rowID, uID, threat_num, comments, scope, severity, timing, impact,
          CASE WHEN impact = 0 OR impact IS NULL THEN 0 ELSE 1 END::DOUBLE AS {FLAG}
        FROM (SELECT *, CAST({_DERIVED} AS DOUBLE) AS impact FROM (
          SELECT rowID, uID, replace(threat_num, ',', '.') AS threat_num, comments, {codes} FROM ({source})))"""


CODED = coded_sql(RECORDS)


@query(
    "dom1_recode_levels",
    "SELECT rowID, "
    + ", ".join(f"{sql_recode(m, c)} AS {m}" for m, c in levels.LEVEL_CODES.items())
    + f" FROM ({RECORDS})",
)
def _(t):
    codes = [levels.recode_levels(ref(m), c).alias(m) for m, c in levels.LEVEL_CODES.items()]
    return records(t).select("rowID", *codes)


_RANGE = "concat(min(o_orderpriority), ' - ', max(o_orderpriority))"


@query(
    "dom1_recode_range",
    f"SELECT o_custkey, level, {sql_recode('level', levels.LEVEL_CODES['impact'])} AS code FROM "
    f"(SELECT o_custkey, {_RANGE} AS level FROM orders GROUP BY o_custkey)",
)
def _(t):
    lowest_highest = F.concat(F.min("o_orderpriority"), F.lit(" - "), F.max("o_orderpriority"))
    ranges = t.orders.groupBy("o_custkey").agg(lowest_highest.alias("level"))
    return ranges.withColumn("code", levels.recode_levels(F.col("level"), levels.LEVEL_CODES["impact"]))


@query(
    "dom1_recode_report",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{m}' AS measure, {m} AS input, {sql_recode(m, c)} AS code, count(*) AS n FROM ({RECORDS}) GROUP BY {m}"
        for m, c in levels.LEVEL_CODES.items()
    )
    + ") WHERE code >= 99",
)
def _(t):
    return taxonomy.recode_report(records(t))


@query("dom2_dom3_derive_impact", f"SELECT rowID, impact, {FLAG} FROM ({CODED})")
def _(t):
    return taxonomy.code_levels(records(t)).select("rowID", "impact", FLAG)


def wide_sql(numbers, measures) -> str:
    cells = []
    for measure in measures:
        for n in numbers:
            cell = f"max({measure}) FILTER (threat_num = '{n}')"
            cells.append((f"coalesce({cell}, 0)" if measure == FLAG else cell) + f' AS "{wide_name(n, measure)}"')
    return ", ".join(cells)


# Of several records of one entity and category, the first.
FIRST_RECORDS = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uID, replace(threat_num, ',', '.') ORDER BY rowID) AS rn
    FROM ({})) WHERE rn = 1"""
_FIRST_CODED = coded_sql(FIRST_RECORDS.format(RECORDS))


@query(
    "dom4_taxonomy_pivot",
    f"SELECT uID, {wide_sql(levels.CATEGORIES, taxonomy.WIDE_MEASURES)} FROM ({_FIRST_CODED}) GROUP BY uID",
)
def _(t):
    return taxonomy.taxonomy_pivot(records(t), ids=["uID"], order_by=["rowID"])


@query(
    "dom4_duplicate_records",
    f"""SELECT uID, replace(threat_num, ',', '.') AS threat_num, count(*) AS n FROM ({RECORDS})
        GROUP BY ALL HAVING count(*) > 1""",
)
def _(t):
    return taxonomy.duplicate_records(records(t), ["uID"])


@query(
    "rsh1_unknown_names",
    f"""SELECT threat_num, count(*) AS n FROM ({RECORDS})
        WHERE threat_num NOT IN ({', '.join(f"'{n}'" for n in levels.CATEGORIES)}) GROUP BY threat_num""",
)
def _(t):
    return unknown_names(records(t), "threat_num", levels.CATEGORIES)


def _sql_fails(measure: str) -> str:
    text = f"regexp_replace(lower({measure}), 'very high', 'very')"
    none = " AND ".join(
        f"NOT contains({text}, '{label.replace('very high', 'very')}')" for label, _ in levels.LEVEL_CODES[measure]
    )
    return f"coalesce(NOT contains({text}, '{levels.LEVEL_SENTINEL.lower()}') AND {none}, false)"


_FAILING = ", ".join(f"CASE WHEN {_sql_fails(m)} THEN '{m}' END" for m in levels.LEVEL_MEASURES)


@query(
    "dom5_check_levels",
    f"""SELECT rowID, uID, impact, scope, severity, timing, coalesce({_FAILING}) AS wch,
               concat_ws(', ', {_FAILING}) AS all_failing
        FROM ({RECORDS}) WHERE coalesce({_FAILING}) IS NOT NULL""",
)
def _(t):
    return taxonomy.check_levels(records(t), ["rowID", "uID"])


def _sql_fixed(expr: str, fixes) -> str:
    for pattern, label in fixes:
        expr = f"regexp_replace({expr}, '{pattern}', '{label}')"
    return expr


def fixed_sql(source: str) -> str:
    fixed = ", ".join(
        _sql_fixed(m, levels.LEVEL_FIXES + (levels.SCOPE_FIXES if m == "scope" else ())) + f" AS {m}"
        for m in levels.LEVEL_MEASURES
    )
    return f"SELECT rowID, uID, threat_num, comments, {fixed} FROM ({source})"


@query("dom6_fix_levels", f"SELECT * EXCLUDE (uID, threat_num, comments) FROM ({fixed_sql(RECORDS)})")
def _(t):
    return taxonomy.fix_level_columns(records(t)).select("rowID", *levels.LEVEL_MEASURES)


TAXONOMY = {
    "Outreach and stewardship": ["small ring", "promo", "regulate human activities"],
    "Research and monitoring": ["widget", "an.il"],
    "Habitat management": ["economy", "standard"],
    "Population management": ["red", "manage native species negatively impacting species at risk"],
}
_ACTIONS = """SELECT p_partkey,
    CASE WHEN p_size % 9 <> 0 THEN concat(p_name, ',, ', p_type, CASE WHEN p_size % 5 = 0 THEN ', Manage Human Threats' ELSE '' END) END
      AS action_subtype,
    CASE WHEN p_size % 7 <> 0 THEN concat(p_type, CASE WHEN p_size % 4 = 0 THEN ', manage PREDATION' ELSE '' END) END
      AS "CC_action_subtype" FROM part"""
_REPAIRED = f"""SELECT p_partkey,
    regexp_replace(regexp_replace(regexp_replace(action_subtype, 'manage human threats', 'regulate human activities', 'i'),
      'manage predation', 'Manage native species negatively impacting species at risk', 'i'), ',,|, ,', ',') AS action_subtype,
    regexp_replace(regexp_replace("CC_action_subtype", 'manage human threats', 'regulate human activities', 'i'),
      'manage predation', 'Manage native species negatively impacting species at risk', 'i') AS "CC_action_subtype"
    FROM ({_ACTIONS})"""


def sql_types(column: str) -> str:
    found = ", ".join(
        f"CASE WHEN regexp_matches(lower({column}), '{'|'.join(subtypes)}') THEN '{kind}' END"
        for kind, subtypes in TAXONOMY.items()
    )
    return f"nullif(concat_ws(', ', {found}), '')"


def taxonomy_table(t):
    """The types and sub-types as a table with an order, as a workbook gives them."""
    rows = [(i, kind, subtype) for i, (kind, subtype) in enumerate((k, s) for k, v in TAXONOMY.items() for s in v)]
    return inline_table(t.spark, rows[::-1], ["place", "kind", "subtype"])


@query(
    "dom7_classify_list",
    f"""SELECT *, {sql_types('action_subtype')} AS action_type,
               {sql_types('"CC_action_subtype"')} AS "CC_action_type" FROM ({_REPAIRED})""",
)
def _(t):
    size, tail = F.col("p_size"), F.lit("")
    humans = F.when(size % 5 == 0, F.lit(", Manage Human Threats")).otherwise(tail)
    predation = F.when(size % 4 == 0, F.lit(", manage PREDATION")).otherwise(tail)
    df = t.part.select(
        "p_partkey",
        F.when(size % 9 != 0, F.concat("p_name", F.lit(",, "), "p_type", humans)).alias("action_subtype"),
        F.when(size % 7 != 0, F.concat("p_type", predation)).alias("CC_action_subtype"),
    )
    columns = {"action_subtype": "action_type", "CC_action_subtype": "CC_action_type"}
    known = taxonomy.read_taxonomy(taxonomy_table(t), "kind", "subtype", ["place"])
    return taxonomy.classify_columns(df, known, columns, repair_commas=["action_subtype"])


@query(
    "dom7_classify_by_index",
    f"""SELECT p_partkey, action_subtype, "CC_action_subtype", {sql_types('action_subtype')} AS action_type FROM ({_ACTIONS})""",
)
def _(t):
    """Types found over an index of the taxonomy, which stays a table."""
    size, tail = F.col("p_size"), F.lit("")
    humans = F.when(size % 5 == 0, F.lit(", Manage Human Threats")).otherwise(tail)
    predation = F.when(size % 4 == 0, F.lit(", manage PREDATION")).otherwise(tail)
    df = t.part.select(
        "p_partkey",
        F.when(size % 9 != 0, F.concat("p_name", F.lit(",, "), "p_type", humans)).alias("action_subtype"),
        F.when(size % 7 != 0, F.concat("p_type", predation)).alias("CC_action_subtype"),
    )
    return taxonomy.classify_by_index(df, "action_subtype", taxonomy_table(t), "action_type")


@query(
    "dom8_parse_mixed_date",
    """SELECT o_orderkey, strftime(CASE o_orderkey % 5 WHEN 0 THEN o_orderdate WHEN 1 THEN date_trunc('year', o_orderdate)
         WHEN 2 THEN o_orderdate END, '%Y-%m-%d') AS parsed FROM orders""",
)
def _(t):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit(dates.SERIAL_ORIGIN).cast("date")).cast("string")
    written = (
        F.when(key % 5 == 0, F.concat(serial, F.lit(".0")))
        .when(key % 5 == 1, F.concat(F.date_format(day, "yyyy"), F.lit(".0")))
        .when(key % 5 == 2, F.date_format(day, "yyyy-dd-MM"))
        .when(key % 5 == 3, F.lit("not known"))
    )
    return t.orders.select("o_orderkey", dates.date_text(dates.parse_mixed_date(written, 6)).alias("parsed"))


@query(
    "dom9_fix_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 9 THEN strftime(o_orderdate, '%Y-%m-%d') END AS fixed FROM orders""",
)
def _(t):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    written = (
        F.when(key % 10 == 0, F.concat(F.lit("("), F.date_format(day, "dd-MM-yyyy"), F.lit(")")))
        .when(key % 10 == 1, F.concat(F.lit(" "), F.date_format(day, "yyyy-MM-dd"), F.lit(" ")))
        .when(key % 10 == 2, F.date_format(day, "d/M/yyyy"))
        .when(key % 10 == 3, F.date_format(day, "d MMM yyyy"))
        .when(key % 10 == 4, F.date_format(day, "yyyy.MM.dd"))
        .when(key % 10 == 5, F.date_format(day, "yyyyMMdd"))
        .when(key % 10 == 6, F.date_format(day, "d-M-yy"))
        .when(key % 10 == 7, F.date_format(day, "ddMMyyyy"))
        .when(key % 10 == 8, F.date_format(day, "d MMM yy"))
        .otherwise(F.lit("in spring"))
    )
    return t.orders.select("o_orderkey", dates.date_text(dates.fix_date(written)).alias("fixed"))


@query(
    "dom15_impute_version",
    """SELECT d.doc_id, CASE WHEN toxic = 1 AND d.doc_id % 3 <> 0 AND nullif(quality, 0) IS NOT NULL THEN 2.3
                            WHEN toxic = 1 AND d.doc_id % 3 <> 0 AND nullif(quality, 0) IS NULL THEN 1.1
                            WHEN d.doc_id % 3 = 0 THEN 1.1 END::DOUBLE AS "TC_version"
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t):
    df = left_join(t.documents.select("doc_id"), t.labels, ["doc_id"])
    df = df.select(
        "doc_id",
        F.col("toxic").alias("threat_calculator"),
        F.when(F.col("doc_id") % 3 == 0, 1.1).alias("TC_version"),
        F.nullif("quality", F.lit(0)).alias("X8.4_threat_identified"),
    )
    return taxonomy.impute_versions(df).select("doc_id", "TC_version")


_FLAGS = f"SELECT uID, {wide_sql(levels.CATEGORIES, [FLAG])} FROM ({_FIRST_CODED}) GROUP BY uID"


def rolled_sql(parent: str) -> str:
    children = " + ".join(
        f'coalesce("{flag_name(c)}", 0)' for c in levels.CATEGORIES if c.startswith(f"{parent}.")
    )
    return f'CASE WHEN "{flag_name(parent)}" = 0 AND {children} > 0 THEN 1 ELSE "{flag_name(parent)}" END'


_ROLLED = (
    "SELECT uID, "
    + ", ".join(
        (f'{rolled_sql(n)} AS "{flag_name(n)}"' if n in levels.PARENTS else f'"{flag_name(n)}"')
        for n in levels.CATEGORIES
    )
    + f" FROM ({_FLAGS})"
)


def _flags(t):
    wide = taxonomy.taxonomy_pivot(records(t), ids=["uID"], measures=[FLAG], order_by=["rowID"])
    return taxonomy.rollup_parents(wide).select("uID", *[ref(flag_name(n)) for n in levels.CATEGORIES])


@query("dom16_rollup_parent_flag", _ROLLED)
def _(t):
    return _flags(t)


_USER_FLAGS = """SELECT user_id,
    CASE max(CASE WHEN event_type = 'signup' THEN CAST(value AS BIGINT) % 3 END) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2
      END::DOUBLE AS parent,
    max(CASE WHEN event_type = 'error' THEN CASE WHEN value > 100 THEN 1 ELSE 0 END END)::DOUBLE AS child1,
    max(CASE WHEN event_type = 'purchase' THEN CASE WHEN value > 100 THEN 1 ELSE 0 END END)::DOUBLE AS child2
    FROM (SELECT user_id, event_type, floor(value) AS value FROM events) GROUP BY user_id"""


@query(
    "dom16_event_flags",
    f"""SELECT user_id, CASE WHEN parent = 0 AND coalesce(child1, 0) + coalesce(child2, 0) > 0 THEN 1 ELSE parent END
          AS parent, child1, child2 FROM ({_USER_FLAGS})""",
)
def _(t):
    kind, value = F.col("event_type"), F.floor("value")

    def child(name):
        return F.max(F.when(kind == name, F.when(value > 100, 1.0).otherwise(0.0)))

    flags = t.events.groupBy("user_id").agg(
        F.max(F.when(kind == "signup", value % 3)).cast("double").alias("parent"),
        child("error").alias("child1"),
        child("purchase").alias("child2"),
    )
    return taxonomy.rollup_parents(flags, {"parent": ["child1", "child2"]})


def parent_counts(t):
    """The flagship query: records coded, widened and rolled up, then counted per parent and segment."""
    rolled = _flags(t)
    kinds = t.customer.select(F.col("c_custkey").alias("uID"), F.col("c_mktsegment").alias("kind"))
    named = left_join(rolled, kinds, ["uID"])
    tests = {n: ref(flag_name(n)) == 1 for n in levels.PARENTS}
    return flag_counts(named, ["kind"], tests, "parent").withColumn(
        "name", profile.map_values(F.col("parent"), profile.PARENT_NAMES)
    )


_PARENT_NAMES = " ".join(f"WHEN '{n}' THEN {_sql_text(v)}" for n, v in profile.PARENT_NAMES.items())
PARENT_COUNTS = (
    f"WITH rolled AS ({_ROLLED}), counted AS ("
    + " UNION ALL ".join(
        f"""SELECT c_mktsegment AS kind, '{n}' AS parent, count(*) AS n FROM rolled
            LEFT JOIN customer ON uID = c_custkey WHERE "{flag_name(n)}" = 1 GROUP BY ALL"""
        for n in levels.PARENTS
    )
    + f") SELECT kind, parent, n, CASE parent {_PARENT_NAMES} END AS name FROM counted"
)


@query("slice_parent_counts", PARENT_COUNTS)
def _(t):
    return parent_counts(t)
