"""Summary tables of a curated table, and its data dictionary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.functions import levels
from tablewright.functions.names import ref, refs
from tablewright.functions.text import map_values, pieces, replace_first, sentence_case
from tablewright.operators.aggregates import count_by, distinct_values, first_in_group, string_agg
from tablewright.operators.columns import domain_rank
from tablewright.operators.grouped import group_not_all, latest_in_group
from tablewright.operators.reshape import flag_counts, pivot_longer, separate, separate_rows

# Document kinds and kind classes in display order, action types in display order, and
# the names of the parent categories.
KINDS = ("Status reports", "Recovery strategies", "Management plans")
KIND_CLASSES = ("Status", "Recovery")
ACTION_TYPES = (
    "Outreach and stewardship",
    "Research and monitoring",
    "Habitat management",
    "Population management",
)
PARENT_NAMES = {
    "1": "Residential & commercial\ndevelopment",
    "2": "Agriculture & aquaculture",
    "3": "Energy production & mining",
    "4": "Transportation &\nservice corridors",
    "5": "Biological resource use",
    "6": "Human intrusions\n& disturbance",
    "7": "Natural system modifications",
    "8": "Invasive & other problematic\nspecies & genes",
    "9": "Pollution",
    "10": "Geological events",
    "11": "Climate change\n& severe weather",
}
# Codes that stand for "no value", and the area covered.
MISSING_CODES = ("NA", "NR")
COVERAGE_BOX = {"west": -140.99778, "east": -52.6480987209, "north": 83.23324, "south": 41.6751050889}


def latest_documents(
    df: DataFrame,
    entity: str = "speciesID",
    year: str = "year_published",
    group: str = "taxonomic_group",
    kind: str = "doc_type",
) -> DataFrame:
    """The latest documents per entity and kind, with kinds and groups in display form."""
    plain = sentence_case(replace_first(ref(kind), "COSEWIC ", ""))
    shown = F.when(plain.isin(*KINDS), plain)
    kind_class = F.when(shown == KINDS[0], F.lit(KIND_CLASSES[0])).when(shown.isNotNull(), F.lit(KIND_CLASSES[1]))
    prepared = (
        df.withColumn(group, sentence_case(ref(group))).withColumn("doc_type2", kind_class).withColumn(kind, shown)
    )
    return latest_in_group(prepared, [entity, "doc_type2", kind], year)


def docs_by_group(latest: DataFrame, group: str = "taxonomic_group", kind: str = "doc_type") -> DataFrame:
    return count_by(latest, [group, kind])


def entities_by_group(
    latest: DataFrame,
    order_by: Sequence[str],
    entity: str = "speciesID",
    group: str = "taxonomic_group",
    kind: str = "doc_type",
) -> DataFrame:
    """Entities per group and kind; an entity's group is that of its first row in the given order."""
    entities = first_in_group(latest, [entity, kind, "doc_type2"], group, order_by)
    return count_by(entities, [group, kind, "doc_type2"])


def docs_by_year(latest: DataFrame, year: str = "year_published", kind: str = "doc_type") -> DataFrame:
    return count_by(latest, [year, kind, "doc_type2"])


PROFILES = ("docs_by_group", "entities_by_group", "docs_by_year")


def documents_profile(
    latest: DataFrame,
    order_by: Sequence[str],
    entity: str = "speciesID",
    group: str = "taxonomic_group",
    kind: str = "doc_type",
    year: str = "year_published",
) -> DataFrame:
    """The three profiles above in one pass, as (profile, group, kind, doc_type2, year, n); columns that a profile does not
    count by are null.

    The first row of an entity is marked once, and grouping sets count documents and marked rows together: one reading of
    the latest rows and one shuffle of partial counts.
    """
    first = Window.partitionBy(ref(entity), ref(kind), ref("doc_type2")).orderBy(*refs(order_by))
    marked = latest.select(
        *refs([group, kind, "doc_type2", year]), (F.row_number().over(first) == 1).alias("__first")
    )
    columns = refs([group, kind, "doc_type2", year])
    sets = [[columns[0], columns[1]], columns[:3], columns[1:]]
    counted = marked.groupingSets(sets, *columns).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("__rows"), F.count_if("__first").alias("__entities")
    )
    # Bits from the left: group, kind, kind class, year; set where a column is not counted by.
    profile = F.when(F.col("__set") == 0b0011, PROFILES[0]).when(F.col("__set") == 0b0001, PROFILES[1]).otherwise(PROFILES[2])
    n = F.when(F.col("__set") == 0b0001, F.col("__entities")).otherwise(F.col("__rows"))
    return counted.select(profile.alias("profile"), *refs([group, kind, "doc_type2", year]), n.alias("n")).filter("n > 0")


def _flag_tests(df: DataFrame, numbers: Sequence[str], name: str) -> Mapping[str, Column]:
    return {n: ref(name.format(n)) == 1 for n in numbers if name.format(n) in df.columns}


def docs_by_threat(
    latest: DataFrame,
    kind: str = "doc_type",
    numbers: Sequence[str] = levels.CATEGORIES,
    flag: str = "X{}_threat_identified",
) -> DataFrame:
    """Documents per category and kind; only flags of 1 count."""
    return flag_counts(latest, [kind], _flag_tests(latest, numbers, flag), "threat")


def docs_by_parent_threat(
    latest: DataFrame,
    kind: str = "doc_type",
    names: Mapping[str, str] = PARENT_NAMES,
    flag: str = "X{}_threat_identified",
) -> DataFrame:
    """Documents per parent category, with its name and its place in display order (last name first)."""
    counts = flag_counts(latest, [kind, "doc_type2"], _flag_tests(latest, list(names), flag), "threat")
    return counts.withColumn("name", map_values(ref("threat"), names)).withColumn(
        "name_rank", domain_rank(ref("name"), list(names.values()), reverse=True)
    )


def docs_by_action(
    latest: DataFrame,
    action: str = "action_type",
    kind: str = "doc_type",
    types: Sequence[str] = ACTION_TYPES,
) -> DataFrame:
    """Documents per action type and kind; list items that are not a known type are left out."""
    kept = F.filter(pieces(ref(action)), lambda item: item.isin(*types))
    items = latest.select(ref(kind), F.explode(kept).alias(action))
    return count_by(items, [action, kind]).withColumn("action_rank", domain_rank(ref(action), types))


def column_dictionary(dictionary: DataFrame) -> DataFrame:
    """What a data dictionary (Column header, Description, Extraction Details, Format) says of each column."""
    form, said = ref("Format"), ref("Description")
    details = F.coalesce(ref("Extraction Details"), F.lit("NA"))
    units = F.contains(form, F.lit("units"))
    scale = (
        F.when(form.isin("Text", "Categorical"), F.lit("nominal"))
        .when(F.contains(form, F.lit("Integer")), F.lit("ratio"))
        .when(F.contains(form, F.lit("YYYY")), F.lit("dateTime"))
        .when(form == "Binary", F.lit("nominal"))
        .when(form == "Ordinal", F.lit("ordinal"))
        .when(F.contains(form, F.lit("not a")) | F.contains(form, F.lit("sheet")), F.lit("nominal"))
    )
    domain = (
        F.when((form == "Text") | F.contains(form, F.lit("not a")), F.lit("textDomain"))
        .when(scale == "ratio", F.lit("numericDomain"))
        .when(scale == "dateTime", F.lit("dateTimeDomain"))
        .when(scale.isin("ordinal", "nominal"), F.lit("enumeratedDomain"))
    )
    number = F.when(form.isin("Integer", "Ordinal", "Binary"), F.lit("integer")).when(units, F.lit("real"))
    return dictionary.select(
        ref("Column header").alias("attributeName"),
        F.concat(F.coalesce(said, F.lit("NA")), F.lit(" Extraction details: "), details).alias("attributeDefinition"),
        F.when(scale == "dateTime", form).alias("formatString"),
        said.alias("definition"),
        F.when(units, F.lit("kilometerSquared")).when(~units, F.lit("dimensionless")).alias("unit"),
        number.alias("numberType"),
        scale.alias("measurementScale"),
        domain.alias("domain"),
    )


def dictionary_facts(dictionary: DataFrame, attribute: str, value_columns: Sequence[str]) -> DataFrame:
    """(attribute, code, definition) of every possible value; the definition defaults to the code.

    Attributes whose first value column is empty have none.
    """
    given = dictionary.filter(ref(value_columns[0]).isNotNull())
    long = pivot_longer(given, [attribute], value_columns).filter("value is not null").drop("name")
    split = separate(long.withColumnRenamed(attribute, "attributeName"), "value", ["code", "definition"])
    return split.withColumn("definition", F.coalesce("definition", "code"))


def missing_facts(facts: DataFrame, codes: Sequence[str] = MISSING_CODES) -> DataFrame:
    return facts.filter(ref("code").isin(*codes))


def taxonomy_facts(
    taxonomy: DataFrame,
    kind: str,
    subtype: str,
    description: str,
    kind_columns: str,
    subtype_columns: str,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Facts on types (which list their sub-types, in the taxonomy's order) and on sub-types, for each column that
    holds them."""
    listed = string_agg(taxonomy, [kind], subtype, ", ", "__subtypes", order_by=order_by)
    kinds = listed.select(
        F.lit(kind_columns).alias("attributeName"),
        ref(kind).alias("code"),
        F.concat(F.lit("See action sub-types: "), ref("__subtypes")).alias("definition"),
    )
    subtypes = taxonomy.select(
        F.lit(subtype_columns).alias("attributeName"),
        ref(subtype).alias("code"),
        ref(description).alias("definition"),
    )
    return separate_rows(kinds.unionByName(subtypes), "attributeName")


def value_dictionary(facts: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """Facts without the attributes that only have missing-value codes, and further facts."""
    kept = group_not_all(facts, ["attributeName"], "code", MISSING_CODES)
    return kept if more is None else kept.unionByName(more)


def coverage(df: DataFrame, date: str, entity: str, end: str) -> DataFrame:
    """Earliest date (nulls skipped), the given end, the number of entities, and the area covered."""
    entities = df.groupBy(ref(entity)).agg(F.min(ref(date)).alias("__first"))
    return entities.agg(
        F.min("__first").alias("begin_date"),
        F.lit(end).alias("end_date"),
        F.count(F.lit(1)).alias("n_entities"),
        *[F.lit(v).alias(k) for k, v in COVERAGE_BOX.items()],
    )


def coverage_entities(df: DataFrame, entity: str) -> DataFrame:
    """The entities covered, one row each."""
    return distinct_values(df, entity)
