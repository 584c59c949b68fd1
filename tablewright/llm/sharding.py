"""Shards of nearly equal bytes by a k-d tree over document metadata; rows of equal texts stay together.

Every distinct text is a point: source and language (each as a hash, so that equal values lie together), size on a log
scale, and id, all of the row with the least id; its weight is the bytes of all its rows. A node that is to hold k shards
is cut along its widest dimension, relative to the whole table, at the weighted quantile that leaves the shares of its
first floor(k/2) and other shards on the two sides. Leaves are the shards, and rows follow their text.

Texts that weigh more than ``HEAVY`` of a shard, or have as large a share of the rows, could not be cut evenly: there are
at most 2 / ``HEAVY`` for each shard, they are dealt out first, the heaviest to the emptiest shard, and the tree fills up
what they leave. Only a text that weighs more than a whole shard is parted, by a hash of its ids, into pieces of at most
about a quarter of one.

The quantiles of all nodes of one level are found together by narrowing histograms: each pass sums bytes by node and
bin (pre-aggregated, so a hot value costs nothing), keeps the bin that holds the quantile, and bins that again, until it
is one value or weighs under ``TOLERANCE`` of a shard. Along a dimension, ties are ordered by a hash of the text, so a value
that holds a third of all rows is cut too.

The tree is one comparison per inner node, at most one less than there are shards; that and the heavy texts are all that
reaches the driver.

Null text has no bytes and lies with the empty one; null source, language or id are values like others. Repeated rows
get slots of their own. Texts of any length are read by hash and size alone. An empty table gives no rows; with fewer
texts than shards some shards stay empty. Only named columns are read, so others' names cannot clash.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.llm.shared import written

# Production parameters: parts of a shard's bytes that a cut may be off, bins of a histogram, rows of a numbering task.
TOLERANCE, BINS, ROWS_PER_PART, OVERHEAD = 0.0005, 2048, 50_000, 16
HEAVY, PIECE = 1 / 16, 1 / 4  # parts of a shard from which a text is dealt by itself, and of its pieces if it needs any
DIMENSIONS = ("source", "lang", "bytes", "number")
WIDE = 30  # bits of a coordinate; the tie order has the 32 below


class Cut(NamedTuple):
    """Keys below ``at`` along ``dimension`` go left."""

    dimension: str
    at: int


def _coordinates(id_column: str, source: str, lang: str, size: Column) -> dict[str, Column]:
    span = F.lit(1 << WIDE)

    def hashed(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{c}`")), span)

    log_size = F.floor(F.log2(size.cast("double")) / F.lit(40.0) * span).cast("bigint")
    return {"source": hashed(source), "lang": hashed(lang), "bytes": log_size, "number": F.col(f"`{id_column}`").cast("bigint")}


def _points(df: DataFrame, id_column: str, text: str, source: str, lang: str) -> DataFrame:
    """One slim row per document: id, size, text_crc32, the text's 128-bit hash, and a coordinate per dimension."""
    body = F.col(f"`{text}`").cast("string")
    size = (F.coalesce(F.octet_length(body), F.lit(0)) + F.lit(OVERHEAD)).cast("bigint")
    crc = F.crc32(F.coalesce(body, F.lit("")).cast("binary"))
    slim = df.select(
        F.col(f"`{id_column}`").alias("id"),
        size.alias("size"),
        crc.alias("text_crc32"),
        F.unhex(F.md5(F.coalesce(body, F.lit("")).cast("binary"))).alias("text_key"),
        *[c.alias(f"at_{name}") for name, c in _coordinates(id_column, source, lang, size).items()],
    )
    return written(slim, "shard-points")


def _keyed(points: DataFrame) -> DataFrame:
    """Coordinates scaled to the same whole numbers, with the tie order below them."""
    ends = points.agg(F.min("at_number").alias("low"), F.max("at_number").alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    scaled = (F.col("at_number") - F.lit(low)).cast("double") / F.lit(float(max(high - low, 1))) * F.lit((1 << WIDE) - 1)
    tie = F.pmod(F.xxhash64("text_key"), F.lit(1 << 32))
    keys = []
    for name in DIMENSIONS:
        at = F.floor(scaled).cast("bigint") if name == "number" else F.col(f"at_{name}")
        keys.append((F.coalesce(at, F.lit(0)) * F.lit(1 << 32) + tie).alias(name))
    return points.select("id", "size", "text_crc32", "text_key", *keys)


def _texts(rows: DataFrame) -> DataFrame:
    """One point per distinct text: text_key, size of all its rows, their number, and the keys of the least row."""
    least = F.min(F.struct("id", *DIMENSIONS)).alias("least")
    sums = rows.groupBy("text_key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"), least)
    return written(sums.select("text_key", "size", "rows", *[F.col("least")[d].alias(d) for d in DIMENSIONS]), "shard-texts")


def _along(dimension: Column) -> Column:
    """A row's key along the named dimension."""
    key = F.lit(None).cast("bigint")
    for name in DIMENSIONS:
        key = F.when(dimension == name, F.col(name)).otherwise(key)
    return key


def _small(rows: DataFrame, table: list[tuple], schema: str) -> DataFrame:
    """A table with a row for each open node, at most one per shard, as literals: Spark knows its size."""
    columns = [c.split() for c in schema.split(", ")]
    values = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else repr(v) for v in row) + ")" for row in table)
    names = ", ".join(f"`{name}`" for name, _ in columns)
    text = f"SELECT {', '.join(f'CAST(`{n}` AS {kind}) AS `{n}`' for n, kind in columns)} FROM VALUES {values} AS t({names})"
    return rows.sparkSession.sql(text)


def _quantiles(rows: DataFrame, wanted: dict[int, tuple[str, float]], slack: float) -> dict[int, int]:
    """For each node, the key along its dimension below which about the wanted bytes lie."""
    axes = _small(rows, [(n, d) for n, (d, _) in wanted.items()], "node bigint, dimension string")
    keyed = rows.join(axes, "node").select("node", _along(F.col("dimension")).alias("key"), "size")
    ends = keyed.groupBy("node").agg(F.min("key").alias("a"), F.max("key").alias("b"))
    # Lowest and highest key of the bin that holds each quantile, and the bytes before it.
    span = {r["node"]: (r["a"], r["b"], 0) for r in ends.collect()}
    found: dict[int, int] = {}
    while span:
        table = [(n, a, b, (b - a) // BINS + 1, t, float(wanted[n][1])) for n, (a, b, t) in span.items()]
        bins = _small(rows, table, "node bigint, a bigint, b bigint, width bigint, before bigint, need double")
        inside = keyed.join(bins, "node").filter("key between a and b")
        sums = inside.groupBy("node", F.floor((F.col("key") - F.col("a")) / F.col("width")).alias("bin")).agg(
            F.sum("size").alias("t"), F.min("key").alias("low"), F.max("key").alias("high"),
            F.first("before").alias("before"), F.first("need").alias("need"),
        )
        # At most BINS + 1 rows per node.
        order = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        upto = sums.withColumn("upto", F.col("before") + F.sum("t").over(order)).filter("upto >= need")
        hit = upto.groupBy("node").agg(F.min_by(F.struct("t", "low", "high", "upto", "need"), "upto").alias("x"))
        hits = {r["node"]: r["x"] for r in hit.collect()}
        for node in list(span):
            x = hits.get(node)
            if x is None:  # rounding only: everything lies below
                found[node] = span.pop(node)[1] + 1
            elif x["t"] <= slack or x["low"] == x["high"]:
                # The side of this last bin that is nearer.
                above, below = x["upto"] - x["need"], x["need"] - (x["upto"] - x["t"])
                found[node] = x["high"] + 1 if above <= below else x["low"]
                span.pop(node)
            else:
                span[node] = (x["low"], x["high"], x["upto"] - x["t"])
    return found


def kd_tree(rows: DataFrame, shares: Sequence[float]) -> tuple[DataFrame, dict[int, Cut], dict[int, int]]:
    """``rows`` with their ``leaf``, the cuts by node, and the shard of each leaf, numbered from left to right.

    ``shares``: the bytes that each shard should get, in proportion. The root is node 1, the children of n are 2n and 2n + 1.
    """
    whole = rows.agg(
        F.sum("size").alias("t"), *[F.min(d).alias(f"a_{d}") for d in DIMENSIONS], *[F.max(d).alias(f"b_{d}") for d in DIMENSIONS]
    ).first()
    share = (whole["t"] or 0) / len(shares)
    root = {d: max((whole[f"b_{d}"] or 0) - (whole[f"a_{d}"] or 0), 1) for d in DIMENSIONS}
    tree: dict[int, Cut] = {}
    placed = rows.withColumn("node", F.lit(1).cast("bigint"))
    leaves = {1: (0, len(shares))}  # first shard of a node, and the one after its last
    split = dict(leaves) if len(shares) > 1 else {}
    while split:
        extents = [(F.max(d) - F.min(d)).cast("double").alias(d) for d in DIMENSIONS]
        wanted = {}
        for r in placed.groupBy("node").agg(F.sum("size").alias("t"), *extents).collect():  # a row per node
            if span := split.get(r["node"]):
                a, b = span
                middle, both = (a + b) // 2, sum(shares[a:b])
                widest = max(DIMENSIONS, key=lambda d: r[d] / root[d])
                part = sum(shares[a:middle]) / both if both > 0 else (middle - a) / (b - a)
                wanted[r["node"]] = (widest, r["t"] * part)
        at = _quantiles(placed, wanted, TOLERANCE * share) if wanted else {}
        # A node without rows is cut anywhere.
        cuts = {n: Cut(wanted[n][0], at[n]) if n in at else Cut(DIMENSIONS[0], 0) for n in split}
        tree |= cuts
        table = _small(rows, [(n, *c) for n, c in cuts.items()], "node bigint, dimension string, at bigint")
        right = (_along(F.col("dimension")) >= F.col("at")).cast("bigint")
        child = F.coalesce(F.col("node") * 2 + right, F.col("node"))
        placed = placed.join(table, "node", "left").withColumn("node", child).drop("dimension", "at")
        placed = written(placed, "shard-level")
        halves = {}
        for n, (a, b) in split.items():
            halves |= {2 * n: (a, (a + b) // 2), 2 * n + 1: ((a + b) // 2, b)}
        leaves |= halves
        split = {n: (a, b) for n, (a, b) in halves.items() if b - a > 1}
    return placed.withColumnRenamed("node", "leaf"), tree, {n: a for n, (a, b) in leaves.items() if b == a + 1}


def _dealt(heavy: list[tuple[str, int, int]], shards: int) -> tuple[list[tuple[str, int, int]], list[int]]:
    """(text, piece, shard) of heavy texts or pieces (text, piece, bytes), the heaviest to the emptiest shard, and what
    each shard then holds."""
    held = [(0, shard) for shard in range(shards)]
    out, loads = [], [0] * shards
    for text, piece, size in sorted(heavy, key=lambda h: (-h[2], h[:2])):
        load, shard = heapq.heappop(held)
        loads[shard] = load + size
        heapq.heappush(held, (loads[shard], shard))
        out.append((text, piece, shard))
    return out, loads


def _assigned(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with their ``shard``."""
    texts = _texts(rows)
    total = texts.agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).first()
    share, most_rows = (total["size"] or 0) / shards, (total["rows"] or 0) / shards
    is_heavy = (F.col("size") > HEAVY * share) | (F.col("rows") > HEAVY * most_rows)
    pieces = F.when((F.col("size") > share) & (F.col("rows") > 1), F.ceil(F.col("size") / (PIECE * share))).otherwise(1)
    heavy = [
        (r["t"], r["pieces"])
        for r in texts.filter(is_heavy).select(F.hex("text_key").alias("t"), pieces.cast("int").alias("pieces")).collect()
    ]  # at most 2 / HEAVY a shard
    large = _small(rows, heavy or [("", 1)], "text string, pieces int").withColumn("text_key", F.unhex("text"))
    marked = rows.join(F.broadcast(large), "text_key", "left")
    heavy_rows = marked.filter("text is not null").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    sizes = heavy_rows.groupBy("text", "piece").agg(F.sum("size").alias("size")).collect()  # at most 2 / HEAVY + 2 / PIECE a shard
    dealt, loads = _dealt([(r["text"], r["piece"], r["size"]) for r in sizes], shards)
    places = _small(rows, dealt or [("", 0, 0)], "text string, piece int, shard int")
    columns = ["id", "size", "text_crc32", "shard"]
    first = heavy_rows.join(F.broadcast(places), ["text", "piece"]).select(*columns)
    placed, _, numbers = kd_tree(texts.filter(~is_heavy), [max(share - load, 0.0) for load in loads])
    leaves = placed.join(F.broadcast(_small(rows, list(numbers.items()), "leaf bigint, shard int")), "leaf").select("text_key", "shard")
    rest = marked.filter("text is null").join(leaves, "text_key").select(*columns)
    return written(first.unionAll(rest), "shard-rows")


def sharded(
    df: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
) -> DataFrame:
    """Per row: id, ``size``, ``text_crc32``, ``law`` (``bytes``), ``shard``, ``slot`` (place in the shard, gapless) and
    ``grown_shard`` (null: this law gives no promise for other counts).

    Give the number of shards, or the bytes that a shard should have.
    """
    rows = written(_keyed(_points(df, id_column, text, source, lang)), "shard-keys")
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, math.ceil(total / target_bytes))
    placed = _assigned(rows, shards)
    # Slots: rows are numbered in parts of a shard chosen by hash; parts are numbered by their sizes.
    parts = F.lit(max(1, math.ceil(rows.count() / shards / ROWS_PER_PART)))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("id", "text_crc32"), parts))
    sizes = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = written(sizes.select("shard", "part", F.coalesce(before, F.lit(0)).alias("before")), "shard-parts")
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "text_crc32", "size"))
    out = placed.withColumn("place", place).join(sizes, ["shard", "part"])
    return out.select(
        F.col("id").alias(id_column),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("place") - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
