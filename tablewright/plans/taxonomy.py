"""Long category records with level texts, their wide form, and checks on the texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions import levels
from tablewright.functions.names import difference, ref, refs, union
from tablewright.functions.text import null_sentinel, replace_first
from tablewright.operators.aggregates import duplicate_keys, key_message
from tablewright.operators.columns import add_missing_columns, derive
from tablewright.operators.grouped import distinct_keep_first
from tablewright.operators.reshape import pivot_cells, spread_cells

FLAG = "threat_identified"
WIDE_MEASURES = (FLAG, *levels.LEVEL_MEASURES, "comments")
# The list of a row's categories where they are not spread over columns yet.
CELLS = "__categories"


def flag_name(number: str) -> str:
    return f"X{number}_{FLAG}"


def wide_name(number: str, measure: str) -> str:
    return flag_name(number) if measure == FLAG else f"X{number}_iucn_{measure}"


def code_levels(
    records: DataFrame,
    codes: Mapping[str, Sequence[tuple[str, float]]] = levels.LEVEL_CODES,
    null_impact_sentinel: bool = False,
) -> DataFrame:
    """Level texts to codes, a missing impact derived, the flag added, and the number written with a dot.

    The sentinel text is taken as null in every measure except impact (on request there too).
    """
    cleaned = {
        m: null_sentinel(ref(m), levels.LEVEL_SENTINEL) if m != "impact" or null_impact_sentinel else ref(m)
        for m in codes
    }
    coded = derive(
        records,
        {"threat_num": replace_first(ref("threat_num"), ",", ".")}
        | {m: levels.recode_levels(c, codes[m]) for m, c in cleaned.items()},
    )
    coded = coded.withColumn("impact", levels.derive_impact(ref("impact"), ref("scope"), ref("severity")))
    return coded.withColumn(FLAG, levels.flag_identified(ref("impact")))


def recode_report(records: DataFrame, codes: Mapping = levels.LEVEL_CODES) -> DataFrame:
    """Level texts that name no level or more than two, with their code and how often they occur.

    Offending cells alone become rows, so a clean table shuffles nothing.
    """
    texts = {m: ref(m).alias(f"text_{m}") for m in codes}
    coded = records.select(
        *texts.values(), *[levels.recode_levels(ref(m), c).alias(f"code_{m}") for m, c in codes.items()]
    )
    cells = [
        F.when(
            F.col(f"code_{m}") >= levels.NO_LEVEL,
            F.struct(F.lit(m).alias("measure"), F.col(f"text_{m}").alias("input"), F.col(f"code_{m}").alias("code")),
        )
        for m in codes
    ]
    bad = coded.select(F.inline(F.array_compact(F.array(*cells))))
    return bad.groupBy("measure", "input", "code").agg(F.count(F.lit(1)).alias("n"))


def duplicate_records(records: DataFrame, ids: Sequence[str], number: str = "threat_num") -> DataFrame:
    """(ids, number) held by more than one record, with how many; the number is written with a dot."""
    dotted = records.withColumn(number, replace_first(ref(number), ",", "."))
    return duplicate_keys(dotted, [*ids, number])


def widen_categories(
    coded: DataFrame,
    ids: Sequence[str],
    vocabulary: Sequence[str] = levels.CATEGORIES,
    measures: Sequence[str] = WIDE_MEASURES,
    order_by: Sequence[str] = (),
    filled: bool = False,
    spread: bool = True,
) -> DataFrame:
    """One row per id with the flag, levels and comments of every category; absent flags are 0.

    Two records of one id and category fail the query, since a mixture of them would be a record that
    nobody made. With ``order_by`` the first whole record in that order is taken. A category outside the
    vocabulary fails the query as well. ``filled`` leaves out ids without any level or comment. Without ``spread``
    the categories of an id stay one list, for :func:`spread_categories` after the joins.
    """
    keys = [*ids, "threat_num"]
    if order_by:
        coded = distinct_keep_first(coded.select(*refs(union(keys, measures, order_by))), keys, order_by)
        cells = {m: ref(m) for m in measures}
    else:
        twice = F.raise_error(key_message(f"records {keys} are not unique, e.g. ", [F.max(ref(k)) for k in keys]))
        cells = {m: F.when(F.count(F.lit(1)) == 1, F.max(ref(m))).otherwise(twice) for m in measures}
    needed = [m for m in measures if m != FLAG] if filled else []
    listed = pivot_cells(coded, ids, "threat_num", vocabulary, cells, needed, CELLS, unique=bool(order_by))
    return spread_categories(listed, vocabulary, measures) if spread else listed


def spread_categories(
    df: DataFrame, vocabulary: Sequence[str] = levels.CATEGORIES, measures: Sequence[str] = WIDE_MEASURES
) -> DataFrame:
    """Flags, levels and comments as columns, where categories are a list; any other table as it is."""
    if CELLS not in df.columns:
        return df
    return spread_cells(df, vocabulary, measures, {FLAG: 0.0}, wide_name, CELLS)


def spread_names(vocabulary: Sequence[str] = levels.CATEGORIES, measures: Sequence[str] = WIDE_MEASURES) -> list[str]:
    """The columns that :func:`spread_categories` makes."""
    return [wide_name(n, m) for m in measures for n in vocabulary]


def taxonomy_pivot(
    records: DataFrame,
    ids: Sequence[str] | None = None,
    vocabulary: Sequence[str] = levels.CATEGORIES,
    measures: Sequence[str] = WIDE_MEASURES,
    order_by: Sequence[str] = (),
    filled: bool = False,
    spread: bool = True,
) -> DataFrame:
    """Level texts in long form to coded wide form, with the flags of the whole vocabulary.

    Without ``ids`` every column that is neither a measure nor the impact code identifies a row. Fewer
    ``measures`` give a narrower result and carry less through the shuffle. ``order_by``, ``filled`` and ``spread``
    as in :func:`widen_categories`; a list is of the whole vocabulary.
    """
    if ids is None:
        ids = difference(records.columns, ["threat_num", "impact_code", *levels.LEVEL_MEASURES, "comments", *order_by])
    if not spread:
        return widen_categories(code_levels(records), ids, levels.CATEGORIES, measures, order_by, filled, spread=False)
    wide = widen_categories(code_levels(records), ids, vocabulary, measures, order_by, filled)
    return add_missing_columns(wide, [flag_name(n) for n in levels.CATEGORIES], F.lit(0.0))


def check_levels(
    records: DataFrame, ids: Sequence[str], codes: Mapping = levels.LEVEL_CODES
) -> DataFrame:
    """Records with a level text that names no level: the first failing measure, and all of them."""
    fails = {m: levels.fails_levels(ref(m), c) for m, c in codes.items()}
    flagged = F.array_compact(F.array(*[F.when(f, F.lit(m)) for m, f in fails.items()]))
    checked = records.select(*refs(ids), *refs(codes), flagged.alias("__failing")).filter(F.size("__failing") > 0)
    return checked.select(
        *refs(ids),
        *refs(codes),
        F.get("__failing", F.lit(0)).alias("wch"),
        F.array_join("__failing", ", ").alias("all_failing"),
    )


def fix_level_columns(records: DataFrame) -> DataFrame:
    """Known misspellings repaired in every measure, and two more in scope."""
    fixed = {m: levels.fix_levels(ref(m)) for m in levels.LEVEL_MEASURES}
    fixed["scope"] = levels.fix_levels(fixed["scope"], levels.SCOPE_FIXES)
    return derive(records, fixed)


def classify_columns(
    df: DataFrame,
    taxonomy: Mapping[str, Sequence[str]],
    columns: Mapping[str, str],
    repair_commas: Sequence[str] = (),
) -> DataFrame:
    """Sub-type lists repaired, and their types added; ``columns`` maps list to type column."""
    repaired = {c: levels.repair_subtypes(ref(c), commas=c in repair_commas) for c in columns}
    out = derive(df, repaired)
    return derive(out, {kind: levels.classify_list(ref(c), taxonomy) for c, kind in columns.items()})


GRAM = 3  # letters by which plain sub-types are found


def _grams(text: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(text) - F.lit(GRAM - 1))
    grams = F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM)))
    return F.when(F.length(text) >= GRAM, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def classify_by_index(
    df: DataFrame,
    column: str,
    types: DataFrame,
    out: str,
    kind: str = "kind",
    subtype: str = "subtype",
    place: str = "place",
    sep: str = ", ",
) -> DataFrame:
    """As :func:`levels.classify_list` for taxonomies of any size, which stay a table.

    Every sub-type that is plain text has one of its three-letter parts as its key, the one that the fewest sub-types have.
    The parts of a text fetch the sub-types with these keys, and those are then looked for in it. Different texts are
    classified once. Sub-types that are patterns, or shorter than a key, are tried on every different text; there should be
    few. A type's place is the least of its sub-types'.
    """
    known = types.select(ref(kind).alias("kind"), F.lower(ref(subtype)).alias("pattern"), ref(place).alias("place"))
    known = known.filter("kind is not null and pattern is not null")
    order = known.groupBy("kind").agg(F.min("place").alias("place"))
    known = known.drop("place").distinct().join(order, "kind")
    plain = (F.length("pattern") >= GRAM) & ~F.col("pattern").rlike(r"[\\.\[\](){}*+?^$|]")
    parts = known.filter(plain).select("pattern", F.explode(_grams(F.col("pattern"))).alias("gram")).distinct()
    often = parts.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    keys = parts.join(often, "gram").groupBy("pattern").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    index = known.join(keys, "pattern")

    texts = df.select(F.lower(ref(column)).alias("text")).filter("text is not null").distinct()
    fetched = texts.select("text", F.explode(_grams(F.col("text"))).alias("gram")).join(index, "gram")
    hits = fetched.filter(F.contains("text", "pattern")).select("text", "place", "kind")
    tried = texts.join(known.filter(~plain), F.expr("text RLIKE pattern")).select("text", "place", "kind")
    listed = F.array_sort(F.collect_set(F.struct("place", "kind")))
    found = hits.unionAll(tried).groupBy("text").agg(F.array_join(F.transform(listed, lambda x: x["kind"]), sep).alias("__types"))
    joined = df.alias("l").join(found.alias("r"), F.lower(ref(column, "l")) == F.col("r.text"), "left")
    kept = [ref(c, "l") for c in df.columns if c != out]
    return joined.select(*kept, F.col("r.__types").alias(out))


def read_taxonomy(table: DataFrame, kind: str, subtype: str, order_by: Sequence[str]) -> dict[str, list[str]]:
    """A table of types and sub-types as a mapping, in a declared order.

    The mapping is a parameter of expressions, so the whole table reaches the driver: it is for
    vocabularies that people keep, not for data.
    """
    rows = table.orderBy(*refs(order_by)).select(ref(kind), ref(subtype)).collect()
    result: dict[str, list[str]] = {}
    for row in rows:
        result.setdefault(row[0], []).append(row[1])
    return result


def rollup_parents(
    wide: DataFrame,
    children: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Parent flags set where a child is flagged, in one projection."""
    if children is None:
        children = {
            flag_name(p): [flag_name(c) for c in levels.CATEGORIES if c.startswith(f"{p}.")]
            for p in levels.PARENTS
        }
    flags = {
        parent: levels.rollup_flag(ref(parent), refs([c for c in names if c in wide.columns]))
        for parent, names in children.items()
        if parent in wide.columns
    }
    return derive(wide, flags)


def impute_versions(
    wide: DataFrame, uses_tool: str = "threat_calculator", version: str = "TC_version", newer: str | None = None
) -> DataFrame:
    newer_flag: Column = ref(newer or flag_name(levels.NEWER_CHILDREN[0]))
    return wide.withColumn(version, levels.impute_version(ref(uses_tool), ref(version), newer_flag))
