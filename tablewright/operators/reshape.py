"""Between long and wide form, and between lists and rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.logic import any_of
from tablewright.functions.names import quoted, ref, refs
from tablewright.functions.text import joined, pieces
from tablewright.operators.grouped import sequence_ids


def pivot_wider(
    df: DataFrame,
    ids: Sequence[str],
    name: str,
    vocabulary: Sequence,
    measures: Mapping[str, Column],
    fill: Mapping[str, object] | None = None,
    label: Callable[[object, str], str] = lambda value, measure: f"{value}_{measure}",
    filled: Sequence[str] = (),
) -> DataFrame:
    """One row per id and, for every value of ``name`` in the vocabulary, one column per measure.

    ``measures`` are aggregates, so rows that share an id and a name are combined before the shuffle. The
    cells of an id, at most as many as the vocabulary has values, are then held by their places once, and the
    columns read from there. A name outside the vocabulary fails the query, so no cell is lost (see
    :func:`unknown_names`); a null name has no cell but keeps its id. ``fill`` is for cells that are
    absent: a null measure of a cell that is there stays null. With ``filled``, ids are left out that
    have none of these measures in any cell; that is known before the columns are made.
    """
    return spread_cells(pivot_cells(df, ids, name, vocabulary, measures, filled), vocabulary, list(measures), fill, label)


def pivot_cells(
    df: DataFrame,
    ids: Sequence[str],
    name: str,
    vocabulary: Sequence,
    measures: Mapping[str, Column],
    filled: Sequence[str] = (),
    cells: str = "__cells",
    unique: bool = False,
) -> DataFrame:
    """As :func:`pivot_wider`, but with the cells that are there as one list, which :func:`spread_cells` makes columns of.

    A list is as long as an id has cells, so it is what should be joined and sorted. ``unique`` declares that no two rows
    share an id and a name; then ``measures`` are plain columns, and rows are not combined first.
    """
    place = F.array_position(F.array(*[F.lit(v) for v in vocabulary]), ref(name)) - 1
    unknown = F.raise_error(F.concat(F.lit(f"{name} is not in the vocabulary: "), ref(name).cast("string")))
    known = F.when(place >= 0, place.cast("int")).when(ref(name).isNotNull(), unknown.cast("int")).alias("__place")
    values = F.struct(*[m.alias(f"m{i}") for i, m in enumerate(measures.values())]).alias("__cell")
    placed = df.select(*refs(ids), known, values) if unique else df.groupBy(*refs(ids), known).agg(values)
    has_cell = F.col("__place").isNotNull()
    cell = F.when(has_cell, F.struct("__place", "__cell"))
    some = any_of(F.col(f"__cell.m{i}").isNotNull() for i, m in enumerate(measures) if m in filled)
    rows = placed.groupBy(*refs(ids)).agg(F.collect_list(cell).alias(cells), F.max(has_cell & some).alias("__some"))
    return (rows.filter("__some") if filled else rows).drop("__some")


def spread_cells(
    df: DataFrame,
    vocabulary: Sequence,
    measures: Sequence[str],
    fill: Mapping[str, object] | None = None,
    label: Callable[[object, str], str] = lambda value, measure: f"{value}_{measure}",
    cells: str = "__cells",
) -> DataFrame:
    """The columns of cells in their list's place. A row without a list, as an outer join gives it, has nulls only."""
    # Cells have no null entries, which would make the whole map null.
    rows = df.withColumn("__held", F.map_from_entries(ref(cells)))
    fill = {m: v for m, v in (fill or {}).items() if v is not None}

    # As text, since hundreds of columns are slow to build one call at a time.
    def column(i: int, measure: str, k: int) -> str:
        held = f"`__held`[{k}].m{i}"
        if measure in fill:
            held = f"CASE WHEN `__held` IS NOT NULL AND `__held`[{k}] IS NULL THEN {_literal(fill[measure])} ELSE {held} END"
        return f"{held} AS {quoted(label(vocabulary[k], measure))}"

    columns = [column(i, m, k) for i, m in enumerate(measures) for k in range(len(vocabulary))]
    at = df.columns.index(cells)
    return rows.selectExpr(*map(quoted, df.columns[:at]), *columns, *map(quoted, df.columns[at + 1 :]))


def _literal(value) -> str:
    if isinstance(value, float):
        return f"{value!r}D"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "\\'") + "'"


def unknown_names(df: DataFrame, name: str, vocabulary: Sequence, count: str = "n") -> DataFrame:
    """Names outside a vocabulary and how often they occur."""
    return df.filter(~ref(name).isin(*vocabulary)).groupBy(ref(name)).agg(F.count(F.lit(1)).alias(count))


def pivot_longer(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value"
) -> DataFrame:
    """Columns to (name, value) rows."""
    return df.unpivot([quoted(c) for c in ids], [quoted(c) for c in columns], name, value)


def flag_counts(
    df: DataFrame,
    keys: Sequence[str],
    flags: Mapping[object, Column],
    name: str = "name",
    count: str = "n",
) -> DataFrame:
    """Per key and flag, how many rows have the flag; pairs without any are left out.

    The same rows as lengthening all flags, keeping those set and counting, but the table is counted
    before it is made long, so it is not multiplied by the number of flags.
    """
    wide = df.groupBy(*refs(keys)).agg(*[F.count_if(f).alias(f"f{i}") for i, f in enumerate(flags.values())])
    rows = [F.struct(F.lit(v).alias(name), F.col(f"f{i}").alias(count)) for i, v in enumerate(flags)]
    return wide.select(*refs(keys), F.inline(F.array(*rows))).filter(ref(count) > 0)


def separate_rows(df: DataFrame, column: str, sep: str = ", ") -> DataFrame:
    """One row per list item; a null list keeps its row."""
    return df.withColumn(column, F.explode_outer(pieces(ref(column), sep)))


def separate(df: DataFrame, column: str, into: Sequence[str], sep: str = ": ") -> DataFrame:
    """A text split over new columns: missing pieces are null, further ones are dropped."""
    parts = pieces(ref(column), sep)
    kept = [c for c in df.columns if c != column]
    return df.select(*refs(kept), *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(into)])


def unite(df: DataFrame, name: str, columns: Sequence[str], sep: str = ", ") -> DataFrame:
    """Columns pasted into one, nulls written as "NA"."""
    kept = [c for c in df.columns if c not in columns]
    return df.select(*refs(kept), joined(refs(columns), sep).alias(name))


def nest(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "data", rows_per_list: int = 10_000
) -> DataFrame:
    """Rows of each group gathered in numbered, sorted lists of ``rows_per_list`` rows; a group's last may be shorter.

    Lists follow the order of the rows over the whole group (list 0 first), whatever its size: rows are
    numbered over the cluster, so no task gathers a group.
    """
    rows = df.select(*refs(keys), F.struct(*refs(columns)).alias("__row"))
    # Equal rows are told apart by where they were read, so that they can be spread.
    rows = rows.withColumn("__tie", F.monotonically_increasing_id())
    numbered = sequence_ids(rows, ["__row", "__tie"], "__no", 0, within=keys, check=False)
    listed = numbered.withColumn("list_no", F.floor(F.col("__no") / F.lit(rows_per_list)).cast("bigint"))
    return listed.groupBy(*refs(keys), "list_no").agg(F.sort_array(F.collect_list("__row")).alias(name))


def source_diff(
    left: DataFrame, right: DataFrame, ids: Sequence[str], names: tuple[str, str] = ("left", "right")
) -> DataFrame:
    """Cells that differ between two versions of a table, as (ids, column, left, right) rows.

    Pairs with a null are not reported. The versions are joined once, in wide form, and only the
    differing cells become rows.
    """
    shared = [c for c in left.columns if c in right.columns and c not in ids]
    same = reduce(and_, [ref(k, "l").eqNullSafe(ref(k, "r")) for k in ids])
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                ref(c, "l").cast("string").alias(names[0]),
                ref(c, "r").cast("string").alias(names[1]),
            )
            for c in shared
        ]
    )
    differing = F.filter(cells, lambda cell: F.coalesce(cell[names[0]] != cell[names[1]], F.lit(False)))
    return (
        left.alias("l")
        .join(right.alias("r"), same, "inner")
        .select(*[ref(k, "l") for k in ids], F.inline(differing))
    )
