"""Temperature mixing: source weights from token shares raised to a power, realised as permutations of blocks.

With token shares p, weights are p^a / sum(p^a): a = 1 keeps the natural mixture, a = 0 makes all sources equal. The
exponent is found by bisection, each pass evaluating the inner points of five halvings in one aggregate over the shares:
the largest exponent whose entropy reaches the target, or, if a source would then repeat too often, the smallest one
that keeps the repetition limit.

Without a budget the total is the smallest that uses every source whole, so no document is lost: the largest source is
used once and others up to the limit. A source is cut into blocks by a hash of the id. Each epoch is a permutation of
the blocks (order them by ``place``); the last, partial epoch takes blocks in that order while the budget lasts, and of
the block that it ends in, documents in hash order. A source's plan is thus four numbers, whatever its size, and no
task holds a source: sums are pre-aggregated, and running sums go over ``RANGES`` ranges of a source's blocks, the blocks of
one range, and one block's rows.

Null sources form a source of their own; null and empty texts have no tokens. A source without tokens has no share and
each of its rows occurs once. Rows that repeat an id go the same way. An empty table gives an empty mixture.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.llm.shared import packed, text_or_empty, written

# Production parameters of the query and the stage.
TARGET_ENTROPY, MAX_REPEATS, BLOCK_TOKENS, SEED = 0.9, 2.0, 1_000_000, 17
HALVINGS, PASSES = 5, 4
RANGE_BITS = 10
RANGES = 1 << RANGE_BITS  # ranges of places that a source's blocks are first summed by


def n_words(text: str) -> Column:
    """Tokens are counted as runs of non-space characters."""
    return F.regexp_count(text_or_empty(text), F.lit(r"\S+")).cast("bigint")


def _power(shares: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """Entropy of the weights, and the most repeats, at each exponent: one row each, whatever the number of sources."""
    grid = shares.select("share", F.explode(F.array(*[F.lit(float(a)) for a in exponents])).alias("a"))
    weight = F.pow("share", F.col("a"))
    sums = grid.groupBy("a").agg(
        F.sum(weight).alias("z"),
        F.sum(weight * F.log("share")).alias("s"),
        F.min("share").alias("least"),
        F.max("share").alias("most"),
    )
    return {
        r["a"]: (math.log(r["z"]) - r["a"] * r["s"] / r["z"], (r["most"] / r["least"]) ** (1 - r["a"]))
        for r in sums.collect()
    }


def _bisect(shares: DataFrame, low_side: Callable[[float, float], bool]) -> tuple[float, float]:
    """Ends of the interval in which ``low_side(entropy, repeats)`` turns from true to false."""
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        inner = [low + (high - low) * k / 2**HALVINGS for k in range(1, 2**HALVINGS)]
        found = _power(shares, inner)
        for a in inner:  # true up to the turn
            if low_side(*found[a]):
                low = a
            else:
                high = a
                break
    return low, high


def exponent(shares: DataFrame, target_entropy: float, max_repeats: float) -> float:
    """``shares`` has one row per source with its positive ``share``; entropy is a part of its greatest value."""
    ends = _power(shares, [0.0, 1.0])
    if not ends:
        return 1.0
    # The last digits of a sum shall not decide.
    target, limit = target_entropy * ends[0.0][0] - 1e-12, max_repeats * (1 + 1e-12)
    a = 1.0
    if ends[1.0][0] < target:
        a = _bisect(shares, lambda entropy, _: entropy >= target)[0]
    if (ends[0.0][1]) ** (1 - a) > limit:
        a = _bisect(shares, lambda _, repeats: repeats > limit)[1]
    return a


def _key(id_column: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"))


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _place(source: Column, block: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed + 1), source, block, epoch)


def mixture_plan(
    slim: DataFrame,
    target_entropy: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """One row per source of ``slim`` (source, key, n_tokens): its weight, epochs, and where the last epoch ends."""
    sums = slim.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    sums = written(sums, "mixing-sums")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    shares = sums.filter("tokens > 0").select("source", "tokens", (F.col("tokens") / F.lit(float(total or 1))).alias("share"))
    a = exponent(shares, target_entropy, max_repeats)
    raised = F.pow(F.col("share"), F.lit(a))
    norm = shares.agg(F.sum(raised).alias("z"), F.max("share").alias("most")).first()
    z, most = (norm["z"] or 1.0), (norm["most"] or 1.0)
    weight = raised / F.lit(z)
    if budget is None:
        epochs = F.pow(F.col("share") / F.lit(most), F.lit(a - 1))
    else:
        epochs = weight * F.lit(float(budget)) / F.col("tokens")
    plan = shares.select(
        "source", "tokens", weight.alias("weight"), epochs.alias("epochs"),
        F.ceil(F.col("tokens") / F.lit(block_tokens)).cast("bigint").alias("blocks"),
    )
    whole = F.floor(F.col("epochs") + F.lit(1e-9)).cast("bigint")
    need = F.round((F.col("epochs") - whole) * F.col("tokens")).cast("bigint")
    empty = sums.filter("tokens <= 0 or tokens is null").select(
        "source", "tokens", F.lit(0.0).alias("weight"), F.lit(1.0).alias("epochs"), F.lit(1).cast("bigint").alias("blocks")
    )
    plan = plan.unionByName(empty).withColumn("whole", whole).withColumn("need", F.greatest(need, F.lit(0)))
    plan = written(plan, "mixing-plan")

    # The partial epoch: which block its budget ends in, then which document of that block.
    partial = plan.filter("need > 0").withColumnRenamed("source", "of")
    block = _block(F.col("key"), F.col("blocks"))
    dealt = slim.join(partial, F.col("source").eqNullSafe(F.col("of"))).withColumn("block", block)
    by_block = dealt.groupBy("of", "block", "whole", "need").agg(F.sum("n_tokens").alias("t"))
    by_block = by_block.withColumn("place", _place(F.col("of"), F.col("block"), F.col("whole"), seed))
    # First the range of places that the budget ends in, at most ``RANGES`` rows a source, then the block among its blocks.
    by_block = written(by_block.withColumn("range", F.expr(f"shiftright(place, {64 - RANGE_BITS})")), "mixing-blocks")
    before = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ranges = by_block.groupBy("of", "range", "need").agg(F.sum("t").alias("in_range")).withColumn("upto", F.sum("in_range").over(before))
    ending = ranges.filter("upto > need and upto - in_range <= need")
    ending = ending.select(F.col("of").alias("in"), F.col("range").alias("at_range"), (F.col("upto") - F.col("in_range")).alias("before"))
    last = by_block.join(ending, F.col("of").eqNullSafe(F.col("in")) & (F.col("range") == F.col("at_range")))
    order = Window.partitionBy("of").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, 0)
    crossing = last.withColumn("upto", F.col("before") + F.sum("t").over(order)).filter("upto > need and upto - t <= need")
    crossing = crossing.groupBy("of").agg(
        F.min(F.struct("place", "block", (F.col("need") - F.col("upto") + F.col("t")).alias("left"))).alias("at")
    )
    crossing = written(
        crossing.select("of", F.col("at.place").alias("end_place"), F.col("at.block").alias("end_block"), F.col("at.left").alias("left")),
        "mixing-ends",
    )
    inside = dealt.drop("tokens").join(
        crossing.withColumnRenamed("of", "in"), F.col("of").eqNullSafe(F.col("in")) & (F.col("block") == F.col("end_block"))
    )
    upto = F.sum("n_tokens").over(Window.partitionBy("of", "block").orderBy("key"))
    cut = inside.withColumn("upto", upto).filter(F.col("upto") <= F.col("left")).groupBy("of").agg(F.max("key").alias("end_key"))
    ends = crossing.join(cut.withColumnRenamed("of", "in"), F.col("of").eqNullSafe(F.col("in")), "left").drop("in")
    out = plan.join(ends, F.col("source").eqNullSafe(F.col("of")), "left").drop("of", "left")
    return written(out, "mixing-plan")


def mixed(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, **targets
) -> DataFrame:
    """The rows of ``df``, each as often as its source's plan says, with ``mix_source_weight``, ``mix_epoch``,
    ``mix_block`` and ``mix_place`` (order of the block in its epoch), which replace columns of these names. ``targets`` as
    in ``mixture_plan``."""
    key, src = _key(id_column, seed), F.col(f"`{source}`")
    slim = df.select(src.alias("source"), key.alias("key"), n_words(f"`{text}`").alias("n_tokens"))
    slim = written(slim, "mixing-rows")
    plan = mixture_plan(slim, seed=seed, **targets).withColumnRenamed("source", "of").drop("tokens")
    joined = packed(df, source=src, key=key).join(plan, F.col("source").eqNullSafe(F.col("of")))
    joined = joined.withColumn("block", _block(F.col("key"), F.col("blocks")))
    joined = joined.withColumn("place", _place(F.col("source"), F.col("block"), F.col("whole"), seed))
    here, end = F.struct("place", "block"), F.struct(F.col("end_place").alias("place"), F.col("end_block").alias("block"))
    in_last = (here == end) & (F.col("key") <= F.col("end_key"))
    # No crossing block: the partial epoch takes all, which rounding up can give.
    partial = (F.col("need") > 0) & F.when(F.col("end_place").isNull(), True).otherwise(
        (here < end) | F.coalesce(in_last, F.lit(False))
    )
    times = F.col("whole") + F.when(partial, 1).otherwise(0)
    epochs = F.when(times > 0, F.sequence(F.lit(0).cast("bigint"), times - 1))
    out = joined.select(
        "row", "source", F.col("weight").alias("mix_source_weight"), F.explode(epochs).alias("mix_epoch"), F.col("block").alias("mix_block")
    )
    place = _place(F.col("source"), F.col("mix_block"), F.col("mix_epoch"), seed)
    names = ("mix_source_weight", "mix_epoch", "mix_block", "mix_place")
    kept = [F.col(f"row.`{c}`") for c in df.columns if c not in names]
    return out.select(*kept, "mix_source_weight", "mix_epoch", "mix_block", place.alias("mix_place"))
