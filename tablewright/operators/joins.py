"""Joins whose keys are equal when both are null.

``by`` is a list of key names, or a mapping from left to right names. Left, full and coalescing joins are
plain outer joins: one scan and one shuffle of each side. Adaptive execution splits a hot key on the left
of a left join, but not on the right, nor in a full join. Where the right side is known to hold a hot key
that matches many rows, ``hot_right`` builds the join from an inner join and anti joins instead, which can
be split on either side but read both sides more than once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.functions.names import difference, intersect, ref, refs
from tablewright.session import written

By = Sequence[str] | Mapping[str, str]
Side = Callable[[str], Column]


def key_pairs(by: By) -> dict[str, str]:
    return dict(by) if isinstance(by, Mapping) else {name: name for name in by}


def _left(name: str) -> Column:
    return ref(name, "l")


def _right(name: str) -> Column:
    return ref(name, "r")


def _absent(df: DataFrame) -> Side:
    types = {field.name: field.dataType for field in df.schema.fields}
    return lambda name: F.lit(None).cast(types[name])


def _condition(
    pairs: Mapping[str, str], extra: Callable[[Side, Side], Column] | None = None, null_keys: bool = True
) -> Column:
    parts = [_left(x).eqNullSafe(_right(y)) if null_keys else _left(x) == _right(y) for x, y in pairs.items()]
    if extra is not None:
        parts.append(extra(_left, _right))
    return reduce(and_, parts)


def _join(x: DataFrame, y: DataFrame, condition: Column, how: str) -> DataFrame:
    return x.alias("l").join(y.alias("r"), condition, how)


def key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys, so that a hot key crosses the network once per task."""
    return df.select(refs(keys)).distinct()


def semi_join(x: DataFrame, y: DataFrame, by: By) -> DataFrame:
    """Left rows with a match."""
    pairs = key_pairs(by)
    return _join(x, key_rows(y, list(pairs.values())), _condition(pairs), "left_semi")


def anti_join(x: DataFrame, y: DataFrame, by: By, null_keys: bool = True) -> DataFrame:
    """Left rows without a match; a null key matches a null key, unless ``null_keys`` is false."""
    pairs = key_pairs(by)
    return _join(x, key_rows(y, list(pairs.values())), _condition(pairs, null_keys=null_keys), "left_anti")


def drop_matching(x: DataFrame, keys_to_drop: DataFrame, by: By, where: Column) -> DataFrame:
    """Remove left rows that match a key and for which ``where`` is not false."""
    pairs = key_pairs(by)
    test = "__drop_test"
    flagged = x.withColumn(test, F.coalesce(where, F.lit(True)))
    kept = _join(flagged, keys_to_drop, _condition(pairs) & _left(test), "left_anti")
    return kept.drop(test)


def _combine(
    x: DataFrame,
    y: DataFrame,
    pairs: Mapping[str, str],
    how: str,
    outputs: Sequence[tuple[str, Callable[[Side, Side], Column]]],
    condition: Callable[[Side, Side], Column] | None = None,
    hot_right: bool = False,
) -> DataFrame:
    """Join and project; ``outputs`` gives each result column from accessors for the two sides."""

    def project(joined: DataFrame, left: Side, right: Side) -> DataFrame:
        return joined.select([make(left, right).alias(name) for name, make in outputs])

    if not hot_right:
        return project(_join(x, y, _condition(pairs, condition), how), _left, _right)
    parts = [project(_join(x, y, _condition(pairs, condition), "inner"), _left, _right)]
    if how in ("left", "full"):
        parts.append(project(anti_join(x, y, pairs).alias("l"), _left, _absent(y)))
    if how in ("right", "full"):
        reverse = {b: a for a, b in pairs.items()}
        parts.append(project(anti_join(y, x, reverse).alias("r"), _absent(x), _right))
    return reduce(DataFrame.unionByName, parts)


def _plain_outputs(
    x: DataFrame, y: DataFrame, pairs: Mapping[str, str], suffixes: tuple[str, str], merge_keys: bool
):
    """Left columns, then right columns that are not keys; clashing names get the suffixes."""
    right_rest = difference(y.columns, pairs.values())
    clash = set(intersect(difference(x.columns, pairs), right_rest))
    outputs = []
    for name in x.columns:
        label = name + suffixes[0] if name in clash else name
        if merge_keys and name in pairs:
            outputs.append((label, lambda l, r, n=name: F.coalesce(l(n), r(pairs[n]))))
        else:
            outputs.append((label, lambda l, r, n=name: l(n)))
    for name in right_rest:
        label = name + suffixes[1] if name in clash else name
        outputs.append((label, lambda l, r, n=name: r(n)))
    return outputs


def left_join(
    x: DataFrame,
    y: DataFrame,
    by: By,
    suffixes: tuple[str, str] = (".x", ".y"),
    hot_right: bool = False,
) -> DataFrame:
    """All left rows with the right columns; right rows that repeat a key multiply them."""
    pairs = key_pairs(by)
    return _combine(x, y, pairs, "left", _plain_outputs(x, y, pairs, suffixes, False), hot_right=hot_right)


def full_join(
    x: DataFrame, y: DataFrame, by: By, suffixes: tuple[str, str] = (".x", ".y"), hot_right: bool = False
) -> DataFrame:
    """All rows of both sides, the keys merged into one column."""
    pairs = key_pairs(by)
    return _combine(x, y, pairs, "full", _plain_outputs(x, y, pairs, suffixes, True), hot_right=hot_right)


def inner_join(
    x: DataFrame,
    y: DataFrame,
    by: By,
    condition: Callable[[Side, Side], Column] | None = None,
    suffixes: tuple[str, str] = (".x", ".y"),
) -> DataFrame:
    """Matching rows; ``condition(left, right)`` may add an inequality between the sides."""
    pairs = key_pairs(by)
    return _combine(x, y, pairs, "inner", _plain_outputs(x, y, pairs, suffixes, False), condition)


def keys_with_earlier(x: DataFrame, y: DataFrame, by: By, left: str, right: str) -> DataFrame:
    """Left rows for which some right row of their key has a value not after theirs.

    Only the least value of each right key matters, so no pair is made however often keys repeat.
    """
    pairs = key_pairs(by)
    keys = list(pairs.values())
    least = y.groupBy(*refs(keys)).agg(F.min(ref(right)).alias("__least"))
    return _join(x, least, _condition(pairs) & (_left(left) >= F.col("r.__least")), "left_semi")


def coalesce_join(
    x: DataFrame, y: DataFrame, by: By, how: str = "full", hot_right: bool = False
) -> DataFrame:
    """Join, and take every column present on both sides from the left or, where null, the right.

    The result has the left columns in their order, then the new right columns. Two types that differ
    are both read as text.
    """
    pairs = key_pairs(by)
    types_x, types_y = dict(x.dtypes), dict(y.dtypes)
    right_rest = difference(y.columns, pairs.values())
    shared = set(intersect(difference(x.columns, pairs), right_rest))

    def merged(name: str, right_name: str):
        cast = "string" if types_x[name] != types_y[right_name] else types_x[name]
        return lambda l, r: F.coalesce(l(name).cast(cast), r(right_name).cast(cast))

    outputs = []
    for name in x.columns:
        if name in pairs:
            outputs.append((name, merged(name, pairs[name])))
        elif name in shared:
            outputs.append((name, merged(name, name)))
        else:
            outputs.append((name, lambda l, r, n=name: l(n)))
    for name in right_rest:
        if name not in shared:
            outputs.append((name, lambda l, r, n=name: r(n)))
    return _combine(x, y, pairs, how, outputs, hot_right=hot_right)


def join_chain(tables: Sequence[DataFrame], by: By) -> DataFrame:
    """Fold tables into the first one by the same key."""
    return reduce(lambda x, y: left_join(x, y, by), tables)


def asof_join(
    x: DataFrame,
    y: DataFrame,
    by: Sequence[str],
    left_at: str,
    right_at: str,
    values: Sequence[str],
    ties: Sequence[str] = (),
    strict: bool = False,
    rows_per_range: int = 1_000_000,
) -> DataFrame:
    """Every left row with ``values`` of the last right row of its key that is not after it (``strict``: before it).

    No pairs are made. Rows of both sides are sorted together by key and time into ranges, so that a key of any size is
    dealt over as many tasks as it fills; in its range a row takes the last right row before it, and where the range holds
    none, that of the ranges before (a carry of at most two rows per range, since only keys at a range's ends go on).
    Of right rows at one time the greatest by ``ties`` is last. Null keys match null keys; a null time matches nothing.
    Values that the left side has names for are refused.
    """
    clash = sorted(set(values) & set(x.columns))
    if clash:
        raise ValueError(f"both sides have columns {clash}")
    keys = [F.col(f"__k{i}") for i in range(len(by))]
    # A right row goes before left rows of its time, or after them if it has to be earlier.
    ends = F.lit(1 if strict else -1), F.lit(0)
    tie_types = [y.schema[c].dataType for c in ties]
    value = F.struct(*[ref(c) for c in values]) if values else F.struct(F.lit(True).alias("__hit"))
    right = y.filter(ref(right_at).isNotNull()).select(
        *[ref(k).alias(f"__k{i}") for i, k in enumerate(by)], ref(right_at).alias("__at"), ends[0].alias("__side"),
        *[ref(c).alias(f"__t{i}") for i, c in enumerate(ties)], value.alias("__value"), F.lit(None).cast(x.schema).alias("__row"),
    )
    left = x.select(
        *[ref(k).cast(y.schema[k].dataType).alias(f"__k{i}") for i, k in enumerate(by)],
        ref(left_at).cast(y.schema[right_at].dataType).alias("__at"), ends[1].alias("__side"),
        *[F.lit(None).cast(t).alias(f"__t{i}") for i, t in enumerate(tie_types)],
        F.lit(None).cast(right.schema["__value"].dataType).alias("__value"), F.struct(*refs(x.columns)).alias("__row"),
    )
    both = right.unionByName(left)
    ranges = max(int(x.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-both.count() // rows_per_range))
    order = [F.col("__at"), F.col("__side"), *[F.col(f"__t{i}") for i in range(len(ties))]]
    placed = written(both.repartitionByRange(ranges, *keys, *order).withColumn("__part", F.spark_partition_id()), "asof")
    last_of = F.struct(*order, "__value")
    tails = placed.filter("__value is not null").groupBy(*keys, "__part").agg(F.max(last_of).alias("__last"))
    # Keys that lie in more than one range: at most one at each end of a range.
    spans = placed.groupBy(*keys).agg(F.min("__part").alias("__from"), F.max("__part").alias("__to")).filter("__from < __to")
    same_key = [F.col(f"l.__k{i}").eqNullSafe(F.col(f"r.__k{i}")) for i in range(len(by))]
    crossing = tails.alias("l").join(F.broadcast(spans.alias("r")), reduce(and_, same_key, F.lit(True)))
    carried = crossing.filter("__part < __to").select(
        *[F.col(f"l.__k{i}") for i in range(len(by))], F.explode(F.sequence(F.col("__part") + 1, F.col("__to"))).alias("__part"), "__last"
    )
    carry = written(carried.groupBy(*keys, "__part").agg(F.max("__last").alias("__carry")), "asof-carry")
    before = Window.partitionBy("__part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = placed.withColumn("__found", F.last("__value", ignorenulls=True).over(before)).filter("__row is not null")
    on = reduce(and_, same_key, F.col("l.__part") == F.col("r.__part"))
    joined = filled.alias("l").join(F.broadcast(carry).alias("r"), on, "left")
    found = F.when(F.col("l.__at").isNotNull(), F.coalesce(F.col("l.__found"), F.col("r.__carry")["__value"]))
    out = joined.select(F.col("l.__row").alias("__row"), found.alias("__found"))
    return out.select(*[F.col("__row")[c].alias(c) for c in x.columns], *[F.col("__found")[c].alias(c) for c in values])

