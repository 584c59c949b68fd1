"""The build of the curated table: category records, documents of two periods and a registry, brought together.

Rows come from the documents alone, so every step that only needs their few columns runs before the wide
categories are joined, once and last.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.functions.names import difference, ref, refs
from tablewright.functions.text import derive_url
from tablewright.operators.aggregates import duplicate_keys
from tablewright.operators.changes import rows_insert, rows_patch, rows_update
from tablewright.operators.columns import rename_columns, reorder_by_vocabulary
from tablewright.operators.grouped import sequence_ids
from tablewright.operators.joins import anti_join, coalesce_join, semi_join
from tablewright.plans import completeness, taxonomy
from tablewright.plans.maintain import relabel_unreported
from tablewright.plans.reconcile import source_priority_merge, split_by_kind
from tablewright.session import written

# Where a document's categories are kept: its own id, or null for records that name no document.
CATEGORY_DOCUMENT = "category_document"
# Stands for "no categories" among such ids.
NO_DOCUMENT = -1


def category_table(
    hand: DataFrame,
    machine: DataFrame,
    keys: Sequence[str],
    ids: Sequence[str],
    measures: Sequence[str] = taxonomy.WIDE_MEASURES,
    order_by: Sequence[str] = (),
    spread: bool = True,
) -> DataFrame:
    """Records of two sources, the first one winning, repaired, coded and widened; empty rows are dropped.

    Two records of one id and category fail the query, unless ``order_by`` says which one to take. Without ``spread``
    the categories stay one list (of all measures), which :func:`with_categories` takes as well.
    """
    records = taxonomy.fix_level_columns(source_priority_merge(hand, machine, keys))
    return taxonomy.taxonomy_pivot(records, ids, measures=measures, order_by=order_by, filled=True, spread=spread)


def complete_documents(documents: DataFrame, required: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Documents that could be read and listed: none of the required columns is null."""
    kept = documents
    for column in required:
        kept = kept.filter(ref(column).isNotNull())
    return kept.select(refs(difference(kept.columns, drop)))


def named_documents(documents: DataFrame, names: DataFrame, entity: str = "uID") -> DataFrame:
    """Names that a document lacks, from the master list of entities."""
    return coalesce_join(documents, names, [entity], how="left")


def older_documents(
    entities: DataFrame,
    kinds: Mapping[str, tuple[Column, Mapping[str, Column]]],
    columns: Sequence[str],
    starts: Mapping[str, int],
    updates: DataFrame,
    patches: DataFrame,
    inserts: DataFrame,
    insert_start: int,
    by: Sequence[str] = ("uID", "doc_type"),
    id_column: str = "docID",
) -> DataFrame:
    """An older table with a row per entity as a table of documents, brought up to date.

    Each kind's documents are numbered from their own start. Updates overwrite and patches fill what is
    null, both only where the document is there; inserts whose document is not there are added and
    numbered from theirs. A key that a batch repeats fails the query.
    """
    split = split_by_kind(entities, kinds, columns, order_by=["uID"], id_column=id_column, starts=starts)
    updated = rows_update(split, semi_join(updates, split, by), by, unmatched="ignore")
    patched = rows_patch(updated, semi_join(patches, split, by), by, unmatched="ignore")
    new = sequence_ids(anti_join(inserts, split, by), by, id_column, insert_start)
    return rows_insert(patched, new, by, conflict="ignore")


def current_documents(
    documents: DataFrame,
    entity: str = "uID",
    year: str = "year_published",
    kind: str = "doc_type",
    published: str = "web_pub_date",
    final: str = "final",
) -> DataFrame:
    """Documents without superseded versions.

    Of several documents of one entity, kind and year those that were never published are superseded; of
    several that are then left of one entity and kind, those that are neither published nor final (or not
    known to be final). Both filters need counts only: documents are counted by year once, what the first
    filter leaves is known from these counts, and they are joined back once.
    """
    keys = [entity, kind, year]
    unpublished = ref(published).isNull()
    years = documents.groupBy(*refs(keys)).agg(
        F.count(F.lit(1)).alias("__in_year"), F.count(ref(published)).alias("__published")
    )
    left = F.when(F.col("__in_year") > 1, F.col("__published")).otherwise(F.col("__in_year"))
    # A row per year of an entity and kind.
    of_kind = F.sum(left).over(Window.partitionBy(ref(entity), ref(kind)))
    years = years.withColumn("__in_kind", of_kind)
    same = F.lit(True)
    for k in keys:
        same = same & ref(k, "l").eqNullSafe(ref(k, "r"))
    first = (F.col("r.__in_year") > 1) & ref(published, "l").isNull()
    second = (F.col("r.__in_kind") > 1) & F.coalesce((ref(final, "l") == 0) & ref(published, "l").isNull(), F.lit(True))
    joined = documents.alias("l").join(years.alias("r"), same, "inner").filter(~first & ~second)
    return joined.select([ref(c, "l") for c in documents.columns])


def own_categories(newer: DataFrame, id_column: str = "docID") -> DataFrame:
    """Newer documents have their own categories."""
    return newer.withColumn(CATEGORY_DOCUMENT, ref(id_column))


def orphan_categories(older: DataFrame, kind: str = completeness.STATUS_REPORT) -> DataFrame:
    """Records that name no document are those of the entity's older status report, if it used the tool and gives
    neither its date nor a citation; other older documents have none."""
    fits = (
        (ref("doc_type") == kind)
        & (ref("threat_calculator") == 1)
        & ref("TC_date").isNull()
        & ref("doc_citation").isNull()
    )
    none = F.lit(NO_DOCUMENT).cast("bigint")
    return older.withColumn(CATEGORY_DOCUMENT, F.when(F.coalesce(fits, F.lit(False)), F.lit(None)).otherwise(none))


def with_categories(
    documents: DataFrame, wide: DataFrame, entity: str = "uID", id_column: str = "docID", stored: str | None = None
) -> DataFrame:
    """Documents with their wide categories, versions imputed and parents rolled up.

    Categories that are still a list are joined as such and made columns after the join. ``stored`` is for a table that
    is read more than once: what was joined is written under that name, and the columns are made from it at every reading.
    """
    if set(taxonomy.spread_names()) & set(documents.columns):
        wide = taxonomy.spread_categories(wide)
    keyed = wide.withColumnRenamed(id_column, CATEGORY_DOCUMENT)
    joined = coalesce_join(documents, keyed, [entity, CATEGORY_DOCUMENT], how="left").drop(CATEGORY_DOCUMENT)
    if stored is not None:
        joined = written(joined, stored)
    return taxonomy.rollup_parents(taxonomy.impute_versions(taxonomy.spread_categories(joined)))


def finished(
    table: DataFrame,
    blocks: Sequence[Sequence[str]],
    url_prefix: str,
    unreported: Sequence[str] = (),
    renamed: Mapping[str, str] | None = None,
    name: str = "common_name",
) -> DataFrame:
    """Labels repaired, addresses from names, columns in vocabulary order and with their final names."""
    labelled = relabel_unreported(table, unreported) if unreported else table
    addressed = labelled.withColumn("url", derive_url(ref(name), url_prefix))
    ordered = reorder_by_vocabulary(addressed, blocks)
    return rename_columns(ordered, explicit=dict(renamed or {}), patterns=[(" ", "_")])


def build_checks(documents: DataFrame, wide: DataFrame, ids: Sequence[str] = ("uID", "docID")) -> DataFrame:
    """Keys that should be unique and are not, as (what, key, n); empty if all is well."""
    parts = [
        duplicate_keys(df.select(F.concat_ws(", ", *refs(keys)).alias("key")), ["key"]).select(
            F.lit(what).alias("what"), "key", "n"
        )
        for what, df, keys in (("documents", documents, [ids[1]]), ("categories", wide, list(ids)))
    ]
    return parts[0].unionByName(parts[1])
