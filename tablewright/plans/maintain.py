"""Rounds of changes that people have filled in, applied to the curated table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from tablewright.functions import levels, names
from tablewright.functions.dates import date_text, fix_date
from tablewright.functions.names import ref, refs
from tablewright.functions.text import derive_url, replace_first, status_normalise
from tablewright.operators.changes import listed_to_fill, route_changes, rows_patch
from tablewright.operators.columns import apply_across, derive, drop_columns, rename_columns
from tablewright.operators.joins import coalesce_join, left_join, semi_join
from tablewright.plans import taxonomy
from tablewright.plans.reconcile import add_missing_from_registry


def patch_round(
    table: DataFrame,
    batch: DataFrame,
    by: Sequence[str],
    url_prefix: str,
    name: str = "common_name",
    verb: str = "change_made",
    listing_pattern: str = "^miss",
) -> DataFrame:
    """Fill what the table lacks from the rows that were changed; their address follows their name."""
    table, batch = _alike(table, batch, whole=False)
    changed = drop_columns(batch.filter(ref(verb) != ""), [verb], listing_pattern)
    return rows_patch(table, changed.withColumn("url", derive_url(ref(name), url_prefix)), by)


def batch_categories(
    records: DataFrame,
    ids: Mapping[str, str],
    repairs: Mapping[str, Sequence[tuple[str, str]]] | None = None,
    spread: bool = True,
) -> DataFrame:
    """Category records of a batch in wide form, under the table's id names; level texts repaired first.

    Without ``spread`` the categories stay one list.
    """
    repaired = derive(records, {c: spelt(ref(c), rules) for c, rules in (repairs or {}).items()})
    named = rename_columns(repaired, explicit=dict(ids))
    return taxonomy.taxonomy_pivot(named, list(ids.values()), spread=spread)


def _alike(table: DataFrame, batch: DataFrame, whole: bool) -> tuple[DataFrame, DataFrame]:
    """Table and batch with their categories in one form.

    They stay lists where the batch has none or, if lists are taken ``whole``, has nothing but a list of its own.
    """
    listed = {taxonomy.CELLS, *taxonomy.spread_names()} & set(batch.columns)
    if taxonomy.CELLS in table.columns and (not listed or whole and listed == {taxonomy.CELLS}):
        return table, batch
    return taxonomy.spread_categories(table), taxonomy.spread_categories(batch)


def spelt(col: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Spelling repairs in their order, each on its first match."""
    for pattern, replacement in rules:
        col = replace_first(col, pattern, replacement)
    return col


def prepared_batch(
    batch: DataFrame,
    table: DataFrame,
    by: Sequence[str],
    url_prefix: str,
    lists: Mapping[str, str],
    types: Mapping[str, Sequence[str]],
    repairs: Mapping[str, Sequence[tuple[str, str]]] | None = None,
    name: str = "common_name",
    group: str | None = "taxonomic_group",
) -> DataFrame:
    """A batch made ready: lists spelt right and classified, the address from the name, the group from the table.

    ``lists`` maps list to type column, ``repairs`` a list column to its ordered (pattern, replacement) rules.
    """
    fixed = derive(batch, {c: spelt(ref(c), rules) for c, rules in (repairs or {}).items()})
    typed = derive(fixed, {kind: levels.classify_list(ref(c), types) for c, kind in lists.items()})
    addressed = typed.withColumn("url", derive_url(ref(name), url_prefix))
    if group is None:
        return addressed
    # Groups of the batch's keys alone, one row per key.
    groups = semi_join(table.select(*refs(by), ref(group)), batch, by)
    return left_join(addressed, groups, by)


def change_round(
    table: DataFrame,
    batch: DataFrame,
    by: Sequence[str],
    categories: DataFrame | None = None,
    status: str = "sara_status",
    date_pattern: str = "date",
    **route,
) -> DataFrame:
    """Apply a batch by its verbs, with category values where there are any, and put status and dates right.

    ``route`` goes to :func:`tablewright.operators.changes.route_changes`. Dates end as yyyy-MM-dd text,
    and what is no date as null. Where the categories of table and batch are lists, they become columns last.
    """
    if categories is not None:
        if set(taxonomy.spread_names()) & set(batch.columns):
            categories = taxonomy.spread_categories(categories)
        batch = coalesce_join(categories, batch, by)
    table, batch = _alike(table, batch, whole=True)
    if taxonomy.CELLS in table.columns:
        # A batch that fills single cells needs their columns.
        route["listed"] = listed_to_fill(batch, [*table.columns, *taxonomy.spread_names()], **route)
        if set(route["listed"]) & set(taxonomy.spread_names()):
            table, batch = taxonomy.spread_categories(table), taxonomy.spread_categories(batch)
    changed = taxonomy.spread_categories(route_changes(table, batch, by, **route))
    changed = changed.withColumn(status, status_normalise(ref(status)))
    dated = names.matching(changed.columns, date_pattern)
    return apply_across(changed, lambda c: date_text(fix_date(c)), columns=dated) if dated else changed


def registry_round(table: DataFrame, registry: DataFrame, headers: Mapping[str, str], **missing) -> DataFrame:
    """Rows for what a registry shows to be missing; its headings are renamed first.

    ``missing`` goes to :func:`tablewright.plans.reconcile.add_missing_from_registry`.
    """
    return add_missing_from_registry(table, rename_columns(registry, explicit=dict(headers)), **missing)


def relabel_unreported(df: DataFrame, columns: Sequence[str], wrong: str = "Nr", right: str = "NR") -> DataFrame:
    """The label for "not reported", repaired where it was misspelt."""
    return apply_across(df, lambda c: replace_first(c, wrong, right), columns=columns)
