"""Keyed changes: each takes a table and a batch and gives the next version of the table.

A null key matches a null key, unless ``null_keys`` is false: then keys are compared plainly, so that a table that is
bucketed by them (:mod:`tablewright.sources.keyed`) is joined where it lies.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions import names
from tablewright.functions.names import ref, refs
from tablewright.operators.aggregates import key_message, unique_or_error
from tablewright.operators.columns import derive
from tablewright.operators.joins import anti_join, key_rows

_HIT, _ROW = "__hit", "__row_mark"


def _require_subset(batch: DataFrame, table: DataFrame) -> None:
    unknown = names.difference(batch.columns, table.columns)
    if unknown:
        raise ValueError(f"the batch has columns that the table lacks: {unknown}")


def _on(by: Sequence[str], null_keys: bool) -> Column:
    return reduce(and_, [ref(k, "l").eqNullSafe(ref(k, "r")) if null_keys else ref(k, "l") == ref(k, "r") for k in by])


def _matched(
    table: DataFrame, batch: DataFrame, by: Sequence[str], unmatched: str, check: bool = True, null_keys: bool = True
) -> DataFrame:
    """The table (``l``) joined with a batch (``r``, with a hit mark) whose keys are unique.

    The checks are part of the join: a key that the batch repeats, and (unless ``unmatched`` is "ignore")
    one that the table lacks, fail the query when its row is read. One scan and one shuffle of each side.
    """
    _require_subset(batch, table)
    if check:
        batch = unique_or_error(batch, by, "batch")
    right = batch.withColumn(_HIT, F.lit(True)).alias("r")
    test = _on(by, null_keys)
    if not check or unmatched == "ignore":
        return table.alias("l").join(right, test, "left")
    return _all_known(table.withColumn(_ROW, F.lit(True)).alias("l").join(right, test, "full"), by)


def _all_known(joined: DataFrame, by: Sequence[str]) -> DataFrame:
    """Fail where a joined row has no table row."""
    message = key_message(f"batch keys {list(by)} not in the table, e.g. ", [ref(k, "r") for k in by])
    return joined.filter(F.when(F.col(f"l.{_ROW}").isNull(), F.raise_error(message).cast("boolean")).otherwise(True))


def _typed(table: DataFrame, name: str) -> Column:
    """A batch value in the type of the table's column."""
    return ref(name, "r").cast(table.schema[name].dataType)


def rows_update(
    table: DataFrame,
    batch: DataFrame,
    by: Sequence[str],
    unmatched: str = "error",
    check: bool = True,
    null_keys: bool = True,
) -> DataFrame:
    """Overwrite matching rows with the batch's values, nulls included.

    Batch keys must be unique and, unless ``unmatched`` is "ignore", all in the table. No job runs while the
    plan is built; ``check=False`` declares that both hold.
    """
    changed = set(names.difference(batch.columns, by))
    hit = F.col(f"r.{_HIT}").isNotNull()
    return _matched(table, batch, by, unmatched, check, null_keys).select(
        [
            F.when(hit, _typed(table, c)).otherwise(ref(c, "l")).alias(c) if c in changed else ref(c, "l")
            for c in table.columns
        ]
    )


def rows_patch(
    table: DataFrame,
    batch: DataFrame,
    by: Sequence[str],
    unmatched: str = "error",
    check: bool = True,
    null_keys: bool = True,
) -> DataFrame:
    """As :func:`rows_update`, but only where the table holds null."""
    changed = set(names.difference(batch.columns, by))
    return _matched(table, batch, by, unmatched, check, null_keys).select(
        [
            F.coalesce(ref(c, "l"), _typed(table, c)).alias(c) if c in changed else ref(c, "l")
            for c in table.columns
        ]
    )


def rows_insert(
    table: DataFrame, batch: DataFrame, by: Sequence[str], conflict: str = "error", null_keys: bool = True
) -> DataFrame:
    """Append rows whose key is new; a key already there is an error, or ignored on request.

    A key that the batch itself repeats is an error too (ignored on request: all its rows are appended).
    """
    _require_subset(batch, table)
    if conflict == "ignore":
        batch = anti_join(batch, table.select(refs(by)), by, null_keys)
    else:
        there = key_rows(table, by).withColumn(_ROW, F.lit(True)).alias("r")
        test = _on(by, null_keys)
        message = key_message(f"keys {list(by)} already in the table, e.g. ", [ref(k, "l") for k in by])
        new = F.when(F.col(f"r.{_ROW}").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)
        joined = unique_or_error(batch, by, "batch").alias("l").join(there, test, "left")
        batch = joined.filter(new).select([ref(c, "l") for c in batch.columns])
    return table.unionByName(batch, allowMissingColumns=True)


def rows_delete(
    table: DataFrame,
    batch: DataFrame,
    by: Sequence[str],
    unmatched: str = "error",
    check: bool = True,
    null_keys: bool = True,
) -> DataFrame:
    """Remove rows by key; other batch columns are ignored, and keys may repeat."""
    if not check or unmatched == "ignore":
        return anti_join(table, batch, by, null_keys)
    gone = key_rows(batch, by).withColumn(_HIT, F.lit(True)).alias("r")
    test = _on(by, null_keys)
    joined = _all_known(table.withColumn(_ROW, F.lit(True)).alias("l").join(gone, test, "full"), by)
    return joined.filter(F.col(f"r.{_HIT}").isNull()).select([ref(c, "l") for c in table.columns])


def sentinel_columns(
    batch: DataFrame, listing_pattern: str, columns: Sequence[str], also: Sequence[str] = ()
) -> list[str]:
    """The columns named in the batch's ", "-separated listings, and those in ``also``.

    Only names of existing columns are kept, so what reaches the driver is at most the column list.
    """
    listings = names.matching(batch.columns, listing_pattern)
    listed: list[str] = []
    if listings:
        named = F.explode(F.split(F.concat_ws(", ", *refs(listings)), ", ")).alias("name")
        rows = batch.select(named).filter(F.col("name").isin(list(columns))).distinct().collect()
        listed = sorted(row["name"] for row in rows)
    return names.intersect(names.union(listed, also), columns)


def fill_sentinel(df: DataFrame, columns: Sequence[str], flagged: Column, sentinel: str = "NE") -> DataFrame:
    """In flagged rows, null or empty values of the columns become the sentinel; the columns become text."""

    def filled(name: str) -> Column:
        text = ref(name).cast("string")
        empty = text.isNull() | (text == "")
        return F.when(flagged & empty, F.lit(sentinel)).otherwise(text)

    return derive(df, {name: filled(name) for name in columns})


def _routed(batch: DataFrame, verb: str, update: Sequence[str], fill: Sequence[str], remove_text: str) -> DataFrame:
    """Rows of a batch that do something, with what they do."""
    route = (
        F.when(ref(verb).contains(remove_text), F.lit(3))
        .when(ref(verb).isin(*fill), F.lit(2))
        .when(ref(verb).isin(*update), F.lit(1))
    )
    return batch.withColumn("__route", route).filter(F.col("__route").isNotNull())


def listed_to_fill(
    batch: DataFrame,
    columns: Sequence[str],
    verb: str = "change_made",
    update: Sequence[str] = ("yes",),
    fill: Sequence[str] = ("no", "new data already extracted"),
    remove_text: str = "remove",
    listing_pattern: str = "^miss",
    fill_also: Sequence[str] = (),
    **_,
) -> list[str]:
    """Of ``columns`` those that :func:`route_changes`, with the same options, would fill."""
    routed = _routed(batch, verb, update, fill, remove_text)
    return sentinel_columns(routed.filter("__route = 2"), listing_pattern, columns, fill_also)


def route_changes(
    table: DataFrame,
    batch: DataFrame,
    by: Sequence[str],
    verb: str = "change_made",
    update: Sequence[str] = ("yes",),
    fill: Sequence[str] = ("no", "new data already extracted"),
    remove_text: str = "remove",
    listing_pattern: str = "^miss",
    fill_also: Sequence[str] = (),
    sentinel: str = "NE",
    unmatched: str = "error",
    null_keys: bool = True,
    listed: Sequence[str] | None = None,
) -> DataFrame:
    """Apply a batch whose verb says, row by row, what to do.

    Rows to update overwrite the table; rows to fill get the sentinel in the columns that the batch
    lists as missing and then overwrite the table; rows to remove delete their key; others do nothing.
    Where one key has several verbs the outcome is that of update, fill and removal in this order.
    All of it is one join of the table. ``listed`` gives the columns to fill where they are known already.
    """
    routed = _routed(batch, verb, update, fill, remove_text)
    to_fill = listed
    if to_fill is None:
        to_fill = sentinel_columns(routed.filter("__route = 2"), listing_pattern, table.columns, fill_also)
    to_fill = names.difference(names.intersect(to_fill, batch.columns), by)
    dropped = [verb, *names.matching(batch.columns, listing_pattern)]
    values = names.difference(batch.columns, [*dropped, *by])
    routed = fill_sentinel(routed, to_fill, F.col("__route") == 2, sentinel)
    routed = routed.select(*refs(by), "__route", *refs(values))
    # One row per key: the last verb's. Two rows of one key and verb are an error.
    counts = [F.count_if(F.col("__route") == n) for n in (1, 2, 3)]
    winner = routed.groupBy(*refs(by)).agg(
        F.max(F.struct("__route", *refs(values))).alias("__row"), F.greatest(*counts).alias("__most")
    )
    message = key_message(f"keys {list(by)} of the batch are not unique, e.g. ", refs(by))
    once = F.when(F.col("__most") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    winner = winner.filter(once).select(*refs(by), F.col("__row.__route"), *[ref(c, "__row") for c in values])
    _require_subset(winner.drop("__route"), table)
    hit = F.col("r.__route").isNotNull()

    def next_value(name: str) -> Column:
        if name not in values:
            return ref(name, "l")
        if name in to_fill:
            old, new = ref(name, "l").cast("string"), ref(name, "r").cast("string")
        else:
            old, new = ref(name, "l"), _typed(table, name)
        return F.when(hit, new).otherwise(old).alias(name)

    test = _on(by, null_keys)
    if unmatched == "error":
        joined = _all_known(table.withColumn(_ROW, F.lit(True)).alias("l").join(winner.alias("r"), test, "full"), by)
    else:
        joined = table.alias("l").join(winner.alias("r"), test, "left")
    joined = joined.filter(~hit | (F.col("r.__route") < 3))
    return joined.select([next_value(c) for c in table.columns])
