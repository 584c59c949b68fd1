"""Documents whose word shingles overlap: exact Jaccard join by a blocked sparse product.

Two documents link if 100 * common >= 75 * union of their sets of five-word shingles. The document by shingle matrix is
multiplied with its transpose in blocks, and only where a link can be:

- Columns are put in one order for all: shingles found to be very frequent last, others by hash. Of two linked
  documents the larger has a common column among its first ``n - ceil(0.75 n) + 1``, and there the smaller one has it
  among its first ``n - ceil(6/7 n) + 1`` ("early"), since the sizes bound the overlap from below. So only a document's
  first columns are written, as (column, document), and only columns that an early document shares with one of at
  least its size become blocks. Blocks with the same members become one. Documents with the same set are one (a
  class): a task passes on its first of a class.
- Within a block a pair must pass bounds derived from the sizes: the smaller set is early and has 0.75 of the larger,
  and the documents' parity bitmaps (4 to 8 bits per shingle) must not differ in more bits than the sizes let the sets
  differ. No linked pair fails these; few others pass.
- Overlaps of pairs that pass are counted from the whole sets, and decide. Sets are made again from the texts of such
  documents; a bit filter of fixed size keeps most other texts out of the shuffle, and may be full without harm.

Pairs inside a group are never all made. Forest rounds come first: every document (later every component) goes to
``CHOSEN`` of its blocks, those with the least hashes, so that near copies meet; blocks, cut into parts of ``PART``
documents, give edges of a spanning forest only, verified edges make components, and blocks within one component are
done with. When a round finds fewer than ``WORTHWHILE`` links, the blocks that still hold several components are compared whole, part by part, between different
components only. Of the pairs of two components that pass the bounds, the ``PAIRS`` nearest are verified, which mostly
joins the two or leaves no pair; components for which it does neither are compared again by finer bitmaps and with more
pairs. So a link can be missing only inside a component, where it changes nothing.

Frequent shingles are found by counting all shingles in each task with a bounded table (error: the task's shingles /
``COUNTERS``). They only change the column order, which may be any; so results do not depend on them. Their number is
at most the mean set size / ``HOT_SHARE``.

A null text, or one without words, has an empty set and links with nothing; one to four words are one shingle. Rows
that repeat an id are documents of their own. A null id loses against others and is returned as null if alone. Sets are made
of whole texts of any length. An empty table gives no rows. Only id and text are read, and ``near_distinct`` packs rows, so
that names of other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tablewright.llm.components import components
from tablewright.llm.shared import in_pandas, packed, same, text_or_empty, written
from tablewright.llm.shingles import mixed, shingle_sets

PERCENT, HOT_SHARE, COUNTERS, PART, CHOSEN, WORTHWHILE, PAIRS, FINE, SEEN = (
    75, 0.002, 1 << 18, 1024, 3, 1000, 4, 16, 1 << 18
)
# Bits of the filter on documents whose sets are wanted again: 8 MB, whatever the number of documents.
FILTER_BITS = 1 << 26
_U = np.uint64


def least_overlap(sizes: int) -> int:
    """Fewest common shingles of a linked pair whose set sizes add up to ``sizes``."""
    return -(-PERCENT * sizes // (100 + PERCENT))


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1 if n else 0


def early_length(n: int) -> int:
    """As ``prefix_length``, for a partner that is not smaller."""
    return n - least_overlap(2 * n) + 1 if n else 0


def set_marks(items: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        pair = mixed(items).sum(dtype=np.uint64), mixed(items ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return tuple(int(mixed(np.array([x + _U(len(items))]))[0].astype(np.int64)) for x in pair)


def bitmap(items: np.ndarray, per_item: int = 1) -> bytes:
    """Parities of the items by their low bits: ``per_item`` bits for each, or up to twice that, a power of two in
    all."""
    bits = max(64, 1 << (per_item * len(items) - 1).bit_length())
    odd = np.bincount((items & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class Frequent:
    """Counts of frequent items in bounded memory; counts are never too high."""

    def __init__(self):
        self.items, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, items: np.ndarray) -> None:
        self.waiting.append(items)
        self.size += len(items)
        if self.size >= 2 * COUNTERS:
            self.merge()

    def merge(self) -> None:
        if not self.size:
            return
        items, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
        self.waiting, self.size = [], 0
        items, where = np.unique(np.concatenate([self.items, items]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([self.counts, counts])).astype(np.int64)
        if len(items) > COUNTERS:
            counts -= np.partition(counts, len(items) - COUNTERS - 1)[len(items) - COUNTERS - 1]
            items, counts = items[counts > 0], counts[counts > 0]
        self.items, self.counts = items, counts


def _described(rows: DataFrame) -> DataFrame:
    """Per row of (id, key, body): ``id``, ``key``, ``n``, ``mark``, ``mark2``, ``bits``; and rows of (``hot``,
    ``times``) only."""
    names = ["id", "key", "n", "mark", "mark2", "bits", "hot", "times"]

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, documents = Frequent(), 0
        for batch in batches:
            out = []
            for items in shingle_sets(list(batch["body"])):
                frequent.add(items)
                out.append((len(items), *set_marks(items), bitmap(items) if len(items) else None))
            documents += len(out)
            made = pd.DataFrame(out, columns=["n", "mark", "mark2", "bits"])
            yield made.assign(id=batch["id"].to_numpy(), key=batch["key"].to_numpy(), hot=None, times=None)[names]
        frequent.merge()
        often = frequent.counts >= max(4, int(documents * HOT_SHARE / 2))
        made = pd.DataFrame({"hot": frequent.items[often].astype(np.int64), "times": frequent.counts[often]})
        yield made.assign(id=None, key=None, n=None, mark=None, mark2=None, bits=None)[names]

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, key bigint, n bigint, mark bigint, mark2 bigint, bits binary, hot bigint, times bigint"
    return in_pandas(rows, describe, schema)


def _node(marks: tuple[int, int], twins: frozenset[int]) -> int:
    """One number for a class: its first mark, or the second where two classes share the first."""
    return marks[1] if marks[0] in twins else marks[0]


def _entries(rows: DataFrame, hot: np.ndarray, twins: frozenset[int]) -> DataFrame:
    """(``node``, ``n``, ``early``, ``columns``): each class's first columns, the first ``early`` of them early."""

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            out = []
            for items in shingle_sets(list(batch["body"])):
                if not len(items):
                    continue
                node = _node(set_marks(items), twins)
                if node in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(node)
                if len(hot):
                    late = hot[np.minimum(np.searchsorted(hot, items), len(hot) - 1)] == items
                    items = np.concatenate([items[~late], items[late]])
                n = len(items)
                out.append((node, n, early_length(n), items[: prefix_length(n)].astype(np.int64)))
            yield pd.DataFrame(out, columns=["node", "n", "early", "columns"])

    return in_pandas(rows.select("body"), first, "node bigint, n bigint, early int, columns array<bigint>")


class Member:
    """A document of a block."""

    __slots__ = ("node", "n", "early", "component", "side", "raw", "_bits")

    def __init__(self, node: int, n: int, early: bool, component: int, side: int, raw: bytes):
        self.node, self.n, self.early, self.component, self.side, self.raw = node, n, early, component, side, raw
        self._bits: dict[int, int] = {}

    def bits(self, width: int) -> int:
        """The bitmap folded to a width."""
        if width not in self._bits:
            have = 8 * len(self.raw)
            if have == width:
                self._bits[width] = int.from_bytes(self.raw, "little")
            else:
                twice = self.bits(2 * width)
                self._bits[width] = (twice >> width) ^ (twice & ((1 << width) - 1))
        return self._bits[width]


def bits_apart(x: Member, y: Member) -> int | None:
    """In how many bits two members differ; null if that or their sizes rule a link out."""
    if x.n > y.n:
        x, y = y, x
    if 100 * x.n < PERCENT * y.n or not (x.early or x.n == y.n and y.early):
        return None
    width, sizes = 8 * len(x.raw), x.n + y.n
    apart = (x.bits(width) ^ y.bits(width)).bit_count()
    return apart if apart <= sizes - 2 * least_overlap(sizes) else None


def forest(members: list[Member]) -> Iterator[tuple[int, int, bool]]:
    """Edges that may link, at most one less than there are members: each member meets the first and the last of every
    tree."""
    heads: dict[int, list[Member]] = {}
    for x in sorted(members, key=lambda m: m.n):
        mine = None
        for head, tree in list(heads.items()):
            y = next((y for y in (tree[0], tree[-1]) if bits_apart(x, y) is not None), None)
            if y is None and x.component != tree[0].component:
                continue
            if x.component != tree[0].component:
                yield x.node, y.node, False
            if mine is None:
                mine = head
                tree[1:] = [x]
            else:
                heads.pop(head)
        if mine is None:
            heads[x.node] = [x]


def crossing(most: int) -> Callable[[list[Member]], Iterator[tuple[int, int, bool]]]:
    """Pairs of different components that may link (between two parts, if there are two): of every two components the
    ``most`` nearest, and if there are more of them, one marked as such."""

    def found(members: list[Member]) -> Iterator[tuple[int, int, bool]]:
        members = sorted(members, key=lambda m: m.n)
        two_sides = len({m.side for m in members}) == 2
        pairs: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        more = set()
        for i, x in enumerate(members):
            for y in members[i + 1 :]:
                if 100 * x.n < PERCENT * y.n:
                    break
                if x.component == y.component or two_sides and x.side == y.side:
                    continue
                apart = bits_apart(x, y)
                if apart is None:
                    continue
                key = (min(x.component, y.component), max(x.component, y.component))
                nearest = pairs.setdefault(key, [])
                heappush(nearest, (-apart, x.node, y.node))
                if len(nearest) > most:
                    heappop(nearest)
                    more.add(key)
        for key, nearest in pairs.items():
            for _, a, b in nearest:
                yield a, b, key in more

    return found


def _block_edges(blocks: DataFrame, found: Callable[[list[Member]], Iterator[tuple[int, int, bool]]]) -> DataFrame:
    """Edges (a, b, more) of each block part; ``blocks`` has (block, part, node, n, early, component, side, bits)."""
    names = ["block", "part", "node", "n", "early", "component", "side", "bits"]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for batch in batches:
                yield from zip(*[batch[c].tolist() for c in names], strict=True)

        # Pairs met in several blocks are passed on once, as far as a bounded memory goes.
        seen: set[tuple[int, int, bool]] = set()
        out: list[tuple[int, int, bool]] = []
        for _, group in groupby(rows(), key=lambda r: r[:2]):
            for a, b, more in found([Member(*r[2:]) for r in group]):
                edge = (min(a, b), max(a, b), more)
                if edge not in seen:
                    out.append(edge)
                    if len(seen) < SEEN:
                        seen.add(edge)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["a", "b", "more"])
                out = []
        yield pd.DataFrame(out, columns=["a", "b", "more"])

    placed = blocks.select(names).repartition("block", "part").sortWithinPartitions("block", "part")
    edges = in_pandas(placed, each, "a bigint, b bigint, more boolean")
    return edges.groupBy("a", "b").agg(F.max("more").alias("more"))


def _verified(edges: DataFrame, sets: DataFrame, all_of_them: bool) -> DataFrame:
    """The edges whose sets overlap enough; unless all sets are needed, only those of the edges are moved."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.loc[good, ["a", "b"]]

    one = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    if not all_of_them:
        one, two = one.join(edges.select("a"), "a", "left_semi"), two.join(edges.select("b"), "b", "left_semi")
    return in_pandas(edges.join(one, "a").join(two, "b").select("a", "b", "x", "y"), check, "a bigint, b bigint")


def _filter(wanted: DataFrame) -> np.ndarray:
    """Two bits for each wanted document, in words of 64."""
    places = F.array(*[F.pmod(F.xxhash64(F.lit(i), "at_id", "at_key"), F.lit(FILTER_BITS)) for i in (0, 1)])
    at = wanted.select(F.explode(places).alias("at"))
    bit = F.expr("shiftleft(1L, cast(pmod(at, 64) as int))")
    words = at.groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for r in words.collect():  # at most as many as there are words
        out[r["word"]] = r["bits"]
    return out.view(np.uint64)


def _sets(rows: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, items) of some classes, made again from the text of a document of each."""
    wanted = classes.join(nodes, "node").select("node", F.col("first.id").alias("at_id"), F.col("first.key").alias("at_key"))
    wanted = written(wanted, "ngram-wanted")
    words = _filter(wanted)
    places = [F.pmod(F.xxhash64(F.lit(i), "id", "key"), F.lit(FILTER_BITS)).alias(f"place{i}") for i in (0, 1)]

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hit = np.ones(len(batch), dtype=bool)
            for at in (batch["place0"].to_numpy(), batch["place1"].to_numpy()):
                hit &= (words[at >> 6] >> (at & 63).astype(np.uint64)) & _U(1) == 1
            found = batch.loc[hit, ["id", "key"]]
            sets = shingle_sets(list(batch.loc[hit, "body"]))
            yield found.assign(items=[x.astype("<u8").tobytes() for x in sets])

    kind = rows.schema["id"].dataType.simpleString()
    made = in_pandas(rows.select("id", "key", "body", *places), whole, f"id {kind}, key bigint, items binary")
    here = same([F.col("id"), F.col("key")], [F.col("at_id"), F.col("at_key")])
    return made.join(wanted, here).select("node", "items")


def _fine_bits(sets: DataFrame) -> DataFrame:
    """(node, bits): bitmaps that let hardly any pair pass that does not link."""

    def fine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = [bitmap(np.frombuffer(x, dtype="<u8"), FINE) for x in batch["items"]]
            yield pd.DataFrame({"node": batch["node"], "bits": bits})

    return in_pandas(sets, fine, "node bigint, bits binary")


def _in_parts(members: DataFrame, pairs: bool) -> DataFrame:
    """Blocks cut by a hash of the node into parts of about ``PART``; with ``pairs``, every two parts meet once."""
    sizes = members.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PART).cast("bigint").alias("parts"))
    cut = members.join(written(sizes, "ngram-sizes"), "block").withColumn("own", F.pmod(F.xxhash64("node"), "parts"))
    if not pairs:
        return cut.withColumn("part", F.col("own")).withColumn("side", F.lit(0))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    number = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    return cut.withColumn("part", number).withColumn("side", (F.col("own") > F.col("other")).cast("int"))


def _open(blocks: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows of blocks that hold more than one component, with their components."""
    if labels is None:
        return blocks.withColumn("component", F.col("node"))
    labelled = blocks.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = labelled.groupBy("block").agg(F.min("component").alias("c"), F.max("component").alias("d"))
    return labelled.join(written(several.filter("c <> d").select("block"), "ngram-open"), "block")


def _chosen(live: DataFrame, turn: int) -> DataFrame:
    """One row of each component in ``CHOSEN`` of its blocks."""
    # Another member each time, and in each block.
    draw = F.xxhash64(F.lit(turn), "block", "node")
    one = live.groupBy("component", "block").agg(F.min_by(F.struct("node", "n", "early"), draw).alias("x"))
    one = written(one, "ngram-delegates")
    picks = [F.min_by("block", F.xxhash64(F.lit(turn * CHOSEN + k), "block")).alias(f"b{k}") for k in range(CHOSEN)]
    picked = one.groupBy("component").agg(*picks)
    picked = picked.select("component", F.explode(F.array_distinct(F.array(*[f"b{k}" for k in range(CHOSEN)]))).alias("block"))
    return one.join(picked, ["component", "block"]).select("block", "component", "x.*")


def _unjoined(edges: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The components of edges whose ends are in different ones."""
    for end in ("a", "b"):
        own = F.col(end).alias(f"{end}_component")
        if labels is None:
            edges = edges.select("*", own)
        else:
            component = labels.select(F.col("node").alias("of"), "component")
            joined = edges.join(component, F.col(end) == F.col("of"), "left")
            edges = joined.withColumn(f"{end}_component", F.coalesce("component", end)).drop("of", "component")
    apart = edges.filter("a_component <> b_component")
    ends = F.explode(F.array("a_component", "b_component")).alias("component")
    return apart.select(ends).distinct()


def _merged_blocks(met: DataFrame) -> DataFrame:
    """Blocks with the same members as one; ``met`` has (block, node, n, early). A member is early if it is in any."""
    rows = written(met, "ngram-met")
    marks = F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")
    marked = written(rows.groupBy("block").agg(F.count(F.lit(1)).alias("m"), *marks).filter("m > 1"), "ngram-marks")
    first = marked.groupBy("m", "x", "y").agg(F.min("block").alias("first"))
    named = marked.join(first, ["m", "x", "y"]).select("block", "first")
    merged = rows.join(named, "block").groupBy(F.col("first").alias("block"), "node")
    return written(merged.agg(F.max("n").alias("n"), F.max("early").alias("early")), "ngram-blocks")


def near_groups(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles`` (set size), ``component_id`` (smallest id reachable by links) and ``text_key``
    (64-bit hash of the text, which tells rows of one id apart)."""
    body = text_or_empty(text)
    rows = df.select(F.col(id_column).alias("id"), F.xxhash64(body).alias("key"), body.alias("body"))
    described = written(_described(rows), "ngram-rows")
    documents = described.filter("n is not null").select("id", "key", "n", "mark", "mark2", "bits")
    often = described.filter("hot is not null").groupBy("hot").agg(F.sum("times").alias("times"))
    often = often.filter(F.col("times") >= max(4, int(documents.count() * HOT_SHARE)))
    hot = np.sort(np.array([r["hot"] for r in often.select("hot").collect()], dtype=np.int64).astype(np.uint64))

    classes = documents.filter("n > 0").groupBy("mark", "mark2")
    classes = written(
        classes.agg(F.min(F.struct("id", "key")).alias("first"), F.min("id").alias("least"), F.max("n").alias("n"), F.min("bits").alias("bits")),
        "ngram-classes",
    )
    # Two sets that share 64 bits: none is expected below a billion classes.
    shared = classes.groupBy("mark").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("mark").collect()
    twins = frozenset(r["mark"] for r in shared)
    classes = classes.withColumn("node", F.when(F.col("mark").isin(*twins), F.col("mark2")).otherwise(F.col("mark")) if twins else F.col("mark"))

    entries = _entries(rows, hot, twins)
    entries = entries.select("node", "n", "early", F.posexplode("columns").alias("place", "block"))
    # Size and earliness in one number: rows are many.
    entries = entries.select("block", "node", (F.col("n") * 2 + (F.col("place") < F.col("early")).cast("int")).alias("what"))
    column, n, early = Window.partitionBy("block"), F.expr("what div 2"), F.col("what") % 2 == 1
    met = entries.withColumn("a", F.min("node").over(column)).withColumn("b", F.max("node").over(column))
    met = met.withColumn("least", F.min(F.when(early, n)).over(column)).filter("a <> b").filter(n >= F.col("least"))
    blocks = _merged_blocks(met.select("block", "node", n.alias("n"), early.alias("early")).distinct())
    bits = classes.select("node", "bits")

    sets = labels = again = None
    turn, most = 0, 0  # most: pairs of two components that an exhaustive round may verify; 0 in forest rounds
    while True:
        live = _open(blocks, labels)
        if again is not None:
            live = live.join(again, "component", "left_semi")
        rows_of = live if most else _chosen(live, turn)
        placed = _in_parts(written(rows_of, "ngram-live"), pairs=most > 0).join(bits, "node")
        edges = written(_block_edges(placed, crossing(most) if most else forest), "ngram-edges")
        ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
        if sets is not None:
            ends = ends.join(sets.select("node"), "node", "left_anti")
        more = written(ends, "ngram-ends")
        if not more.isEmpty():
            new = written(_sets(rows, classes, more), "ngram-sets")
            sets = new if sets is None else sets.unionByName(new)
        found = 0
        if not edges.isEmpty():
            good = written(_verified(edges, sets, turn == 0), "ngram-links")
            found = good.count()
        if found:
            # The components so far are stars: with them the new links are all that is needed.
            links = good if labels is None else good.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
            labels = components(links)
        turn += 1
        if not most:
            most = PAIRS if found < WORTHWHILE else 0
            continue
        again = written(_unjoined(edges.filter("more"), labels), "ngram-again")
        if again.isEmpty():
            break
        # Members of these components have all been in an edge, so their sets are there.
        bits = written(_fine_bits(sets), "ngram-fine")
        most *= PAIRS**2

    out = classes
    if labels is not None:
        known = classes.join(labels, "node").select("node", "component", "least")
        least = known.groupBy("component").agg(F.min("least").alias("component_id"))
        out = classes.join(known.join(least, "component").select("node", "component_id"), "node", "left")
    else:
        out = out.withColumn("component_id", F.col("least"))
    out = written(out.select("mark", "mark2", F.coalesce("component_id", "least").alias("component_id")), "ngram-components")
    joined = documents.drop("bits").join(
        out.withColumnsRenamed({"mark": "m1", "mark2": "m2"}),
        (F.col("mark") == F.col("m1")) & (F.col("mark2") == F.col("m2")) & (F.col("n") > 0),
        "left",
    )
    return joined.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("key").alias("text_key"),
    )


def near_distinct(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: of each group the row with the smallest id."""
    groups = near_groups(df, id_column, text)
    gone = groups.filter(~F.col(id_column).eqNullSafe(F.col("component_id")))
    gone = gone.select(F.col(id_column).alias("gone"), F.col("text_key").alias("gone_key")).distinct()
    rows = packed(df, id=F.col(id_column), key=F.xxhash64(text_or_empty(text)))
    return rows.join(
        written(gone, "ngram-gone"), same([F.col("id"), F.col("key")], [F.col("gone"), F.col("gone_key")]), "left_anti"
    ).select("row.*")
