"""Spelling variants of a corpus's words: words one inserted, deleted or replaced letter apart, found exactly.

Words are cut from whole texts and counted per task before they move. The distinct words, sorted by range, are a trie
read from left to right: a word shares with the one before it the nodes of their common prefix and makes a new node for
each letter after it, so one pass numbers all nodes; a second pass over the reversed words numbers the nodes of suffixes.
Where a range starts inside a branch, the nodes come from the last word of the range before (one row per range).

A word is then a list of integer pairs. With P(i) the node of its first i letters and S(i) that of the letters from i on:

- the pairs (P(i), S(i)) stand for the word itself, cut at i;
- the pairs (P(i), S(i + 1)) stand for the word with letter i skipped.

Equal pairs mean equal remains. Two words that skip to one pair differ by that letter alone; a word that skips to a cut
of another has one letter more. A replacement shows in one pair; a letter in a run of its like is skipped only at the
run's first, so an insertion or deletion shows in one pair too, and near words can be counted without listing them: of
the words at a pair no more than the number of them, the most frequent, the next and the one that is cut there are
needed. At most one word of each letter, so at most ``ALPHABET`` + 1, meets at a pair. Pairs are sorted over the cluster
and read in order; no text moves with them.

A word's form is its most frequent near word if that is ``factor`` times as frequent (ties: smallest by code points);
forms are followed to the last by doubling, in as many rounds as the greatest count allows.

Null and empty texts have no words. A null id counts as an empty one. Rows are counted as often as they are repeated.
Long texts are cut whole, one at a time. Empty tables give no words. Other columns are ignored, so their names cannot
clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F

from tablewright.llm.shared import in_pandas, text_or_empty, workers_find_package, written

# Production parameters: shortest word, fewest occurrences, how much more frequent a form is, and one in how many
# occurrences loses a letter.
SHORTEST, FEWEST, FACTOR, LOSES = 7, 2, 10, 31
HELD, WORDS_PER_RANGE = 200_000, 200_000  # words counted by a task before it passes them on, and words of a range
ALPHABET = 26 + 64  # letters of a word: a-z, and those from U+00C0 to U+00FF
PLACE_BITS = 40  # a node's or word's number: its range above these bits, its place in the range below
CUT, SKIP, FIRST_SKIP = 0, 1, 2

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_counts(
    df: DataFrame, id_column: str, text: str, shortest: int = SHORTEST, loses: int = LOSES
) -> DataFrame:
    """Words of at least ``shortest`` letters and how often they occur, as (word, n).

    An occurrence whose CRC-32 of ``<id>:<word>`` is a multiple of ``loses`` is read without letter CRC mod length.
    """
    # A run shorter than the shortest word cannot become one.
    runs = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for batch in batches:
            for number, body in zip(batch["id"], batch["body"], strict=True):
                seed = crc32(f"{number}:".encode())
                for run, n in Counter(runs.findall(body.encode().translate(LOWER).decode())).items():
                    drawn = crc32(run.encode(), seed)
                    if drawn % loses == 0:
                        at = drawn % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < shortest:
                            continue
                    held[run] += n
                if len(held) >= HELD:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    rows = df.select(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"), text_or_empty(text).alias("body"))
    return in_pandas(rows, count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    if b.startswith(a):
        return len(a)
    n = 0
    while n < len(b) and a[n] == b[n]:
        n += 1
    return n


def _numbered(words: DataFrame, spelling: Column, parts: int) -> tuple[DataFrame, dict[int, list[int]]]:
    """``words`` with ``place`` (the word's number in the order of its spelling) and ``nodes`` (of its prefixes, the empty
    one first) as each range sees them, and by range the nodes that its first word shares with the range before."""
    keep = [(f.name, f.dataType.simpleString()) for f in words.schema.fields]
    schema = ", ".join(f"{n} {k}" for n, k in keep) + ", spelling string, part int, place bigint, nodes array<bigint>, edge boolean"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, path, made, row = "", [0], 0, 0
        held = None  # the last row so far: an edge if nothing follows
        for batch in batches:
            if not len(batch):
                continue
            base = int(batch["part"].iloc[0]) << PLACE_BITS
            paths = []
            for word in batch["spelling"]:
                shared = _common(last, word)
                path = path[: shared + 1] + list(range(base + made + 1, base + made + 1 + len(word) - shared))
                made += len(word) - shared
                last = word
                paths.append(np.array(path))
            places = np.arange(row, row + len(batch), dtype=np.int64)
            out = batch.assign(place=places + base, nodes=paths, edge=places == 0)
            row += len(batch)
            if held is not None:
                yield held
            yield out.iloc[:-1]
            held = out.iloc[-1:]
        if held is not None:
            yield held.assign(edge=True)

    ranged = words.withColumn("spelling", spelling).repartitionByRange(parts, "spelling").sortWithinPartitions("spelling")
    placed = written(in_pandas(ranged.withColumn("part", F.spark_partition_id()), scan, schema), "spelling-trie")
    # The first and last word of each range.
    edges: dict[int, list[Row]] = {}
    for r in placed.filter("edge").select("spelling", "part", "place", "nodes").orderBy("part", "place").collect():
        edges.setdefault(r["part"], []).append(r)
    shared: dict[int, list[int]] = {}
    last, path = "", [0]
    for part, ends in edges.items():
        common = _common(last, ends[0]["spelling"])
        shared[part] = path[: common + 1]
        base = part << PLACE_BITS
        last = ends[-1]["spelling"]
        path = [path[n - base] if 0 < n - base <= common else n for n in ends[-1]["nodes"]]
    return placed, shared


def _whole(placed: DataFrame, shared: dict[int, list[int]], name: str) -> DataFrame:
    """The nodes of all ranges as those of one trie: the first that a range made are those shared with the range before."""
    carried = [(p, s) for p, s in shared.items() if len(s) > 1]
    # At most one row per range, of the letters shared by two words.
    mine = F.broadcast(placed.sparkSession.createDataFrame(carried, "part int, mine array<bigint>"))
    base = F.col("part").cast("bigint") * F.lit(1 << PLACE_BITS)
    own = F.transform(
        "nodes",
        lambda n: F.when((n > base) & (n - base < F.size("mine")), F.get("mine", (n - base).cast("int"))).otherwise(n),
    )
    return placed.join(mine, "part", "left").withColumn(name, own)


def vocabulary_tries(words: DataFrame) -> DataFrame:
    """``words`` (word, n) as (id, word, n, prefixes, suffixes): node numbers by length, the empty one first; ids rise with the word."""
    parts = max(1, -(-words.count() // WORDS_PER_RANGE))
    forward, shared = _numbered(words, F.col("word"), parts)
    forward = _whole(forward, shared, "prefixes").select(F.col("place").alias("id"), "word", "n", "prefixes")
    backward, shared = _numbered(forward.select("id", "word"), F.reverse("word"), parts)
    backward = _whole(backward, shared, "suffixes").select("id", "suffixes")
    return written(forward.join(backward, "id"), "spelling-nodes")


def _pairs(tries: DataFrame) -> DataFrame:
    """A row per cut and skip of each word: (prefix, suffix, id, n, kind)."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                yield _pairs_of(whole.slice(at, 1000))

    workers_find_package(tries)
    schema = "prefix bigint, suffix bigint, id bigint, n bigint, kind tinyint"
    return tries.select("id", "n", "word", "prefixes", "suffixes").mapInArrow(pairs, schema)


def _pairs_of(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids, counts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    before = batch.column(3).flatten().to_numpy(zero_copy_only=False)
    after = batch.column(4).flatten().to_numpy(zero_copy_only=False)
    letters = np.frombuffer("".join(batch.column(2).to_pylist()).encode("utf-32-le"), dtype="<u4")
    nodes = batch.column(3).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)  # a word's letters and one more
    start = np.cumsum(nodes) - nodes
    # Cuts: the first i letters, and the other length - i.
    row = np.repeat(np.arange(len(ids)), nodes)
    i = np.arange(len(before)) - start[row]
    rest = after[start[row] + nodes[row] - 1 - i]
    # Skips: the first i letters, and the last length - i - 1.
    at = np.flatnonzero(i < nodes[row] - 1)
    skipped = after[start[row[at]] + nodes[row[at]] - 2 - i[at]]
    same_before = np.concatenate([[False], letters[1:] == letters[:-1]]) & (i[at] > 0)
    kind = np.where(same_before, SKIP, FIRST_SKIP)
    columns = [
        np.concatenate([before, before[at]]), np.concatenate([rest, skipped]), np.concatenate([ids[row], ids[row[at]]]),
        np.concatenate([counts[row], counts[row[at]]]), np.concatenate([np.full(len(row), CUT), kind]).astype(np.int8),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["prefix", "suffix", "id", "n", "kind"])


def _near_of(prefix: np.ndarray, suffix: np.ndarray, ids: np.ndarray, n: np.ndarray, kind: np.ndarray) -> dict[str, np.ndarray]:
    """What rows of whole pairs, ordered by pair, falling n and id, tell each of their words: how many near words it meets
    there, and the first of them."""
    size, count = np.arange(len(ids)), len(ids)
    new = np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])])
    starts, group = np.flatnonzero(new), np.cumsum(new) - 1

    def first(where: np.ndarray) -> np.ndarray:
        """Place of each pair's first row of some kind, ``count`` if it has none."""
        return np.minimum.reduceat(np.where(where, size, count), starts)[group]

    def total(where: np.ndarray) -> np.ndarray:
        return np.add.reduceat(where.astype(np.int64), starts)[group]

    skips, cut = kind != CUT, kind == CUT
    best = first(skips)
    second = first(skips & (size != best))
    whole, single = first(cut), first(kind == FIRST_SKIP)
    other = np.where(size == best, second, best)  # a replaced letter
    longer = kind == FIRST_SKIP  # these have one letter more than the word cut here
    with_whole = np.where(longer, np.minimum(other, whole), other)  # rows are in the order that forms go by
    chosen = np.where(cut, single, with_whole)
    met = np.where(cut, total(longer), total(skips) - 1 + (longer & (whole < count)))
    hit = met > 0
    chosen = chosen[hit]
    return {"id": ids[hit], "met": met[hit], "best_n": n[chosen], "best": ids[chosen]}


def near_words(tries: DataFrame) -> DataFrame:
    """Per word with any: (id, n_near, best): number of near words, and (n, -id) of the most frequent."""
    columns = ("prefix", "suffix", "id", "n", "kind")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of a pair that may go on in the next batch
        for batch in batches:
            rows = [batch.column(k).to_numpy() for k in range(len(columns))]
            if held is not None:
                rows = [np.concatenate([a, b]) for a, b in zip(held, rows, strict=True)]
            if not len(rows[0]):
                continue
            goes_on = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            end = int(np.argmax(goes_on))
            held = [r[end:] for r in rows]
            if end:
                yield pa.RecordBatch.from_pydict(_near_of(*[r[:end] for r in rows]))
        if held is not None:
            yield pa.RecordBatch.from_pydict(_near_of(*held))

    pairs = _pairs(tries)
    dealt = pairs.repartition("prefix", "suffix").sortWithinPartitions("prefix", "suffix", F.desc("n"), "id")
    partial = dealt.mapInArrow(meet, "id bigint, met bigint, best_n bigint, best bigint")
    return partial.groupBy("id").agg(
        F.sum("met").alias("n_near"), F.max(F.struct(F.col("best_n").alias("n"), (-F.col("best")).alias("down"))).alias("best")
    )


def spelling_forms(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    fewest: int = FEWEST,
    factor: int = FACTOR,
    loses: int = LOSES,
) -> DataFrame:
    """Per distinct word: ``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``."""
    if factor < 2:
        raise ValueError("a form must be more frequent than its word")
    words = written(word_counts(df, id_column, text, shortest, loses).filter(F.col("n") >= fewest), "spelling-words")
    tries = vocabulary_tries(words)
    near = tries.select("id", "word", "n").join(near_words(tries), "id", "left")
    is_form = F.col("best.n") >= F.lit(factor) * F.col("n")
    near = written(
        near.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(is_form, -F.col("best.down")).alias("form_id"), F.when(is_form, F.col("best.n")).alias("form_n"),
        ),
        "spelling-near",
    )
    # A form is ``factor`` times as frequent, so the longest way to a root is the logarithm of the greatest count.
    most, hops = near.agg(F.max("n")).first()[0] or 1, 0
    while most >= fewest * factor:
        most, hops = most // factor, hops + 1
    to = near.filter("form_id is not null").select("id", F.col("form_id").alias("root_id"))
    for _ in range(max(hops - 1, 0).bit_length()):
        beyond = to.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"))
        to = written(
            to.join(beyond, "root_id", "left").select("id", F.coalesce("next_id", "root_id").alias("root_id")), "spelling-roots"
        )
    names = near.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    roots = near.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    followed = to.join(roots, "root_id").select("id", "root")
    out = near.join(names, "form_id", "left").join(followed, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
