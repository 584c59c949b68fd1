"""Importance resampling of documents towards a target text, over hashed word n-grams.

Texts are normalised (A-Z in lower case, words of ASCII letters, digits and all other characters, joined by one space)
and scanned once. The scan keeps the running CRC-32 at each word's end; the CRC of any run of words then comes from two
of them, without a second look at the text. With A the text before the run and B the run,

    crc(B) = crc(AB) xor shift(crc(A), |B|),

where shift appends |B| zero bytes, a linear map over GF(2). Maps are tables of the images of single bytes: one for each
length below ``FEW``, then one for each doubling, applied to all n-grams of a run of texts at once.

Counts by bucket cover every document and every target text; they are sums by bucket, so at most ``buckets`` rows of them
reach the driver. A document's weight is the floored mean of its features' gains; Gumbel noise drawn from a hash of its
id makes the highest scores a sample without replacement. Ranks come from a sort by range, never from one task.

Null and empty texts have no features, weight 0, and are never drawn while ``least_words`` is 1 or more. A very long text
is one array of its own size (a row is at most 2 GB); others are worked on in runs of ``CHUNK`` bytes. Repeated rows are
drawn apart: they have equal scores and follow each other. Of equal scores the smaller id goes first, a null id before
others. Empty tables give no rows; without target texts every gain measures rarity alone. Other columns are ignored, so
their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.shared import workers_find_package, written
from tablewright.operators.grouped import sequence_ids

# Production parameters: longest n-gram, buckets, percent drawn, words that a document needs, and seed of the noise.
ORDER, BUCKETS, PERCENT, LEAST_WORDS, SEED = 2, 10_000, 25, 20, 7
CHUNK = 1 << 20  # bytes of text worked on at a time
FEW = 64  # zero bytes up to which a length has a table of its own

# Fixed value: the reversed generator of CRC-32.
GENERATOR = 0xEDB88320


def _word_bytes() -> bytes:
    """Letters in lower case, digits and bytes of other characters as they are, the rest as blanks."""
    table = bytearray(range(256))
    for b in range(128):
        table[b] = ord(chr(b).lower()) if chr(b).isalnum() else 0x20
    return bytes(table)


WORD_BYTES = _word_bytes()


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(WORD_BYTES).split()


@lru_cache(maxsize=1)
def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """The CRC step of each byte, and the byte whose step has a given top byte."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & np.uint32(1), (step >> np.uint32(1)) ^ np.uint32(GENERATOR), step >> np.uint32(1))
    of_top = np.zeros(256, dtype=np.uint32)
    of_top[step >> np.uint32(24)] = np.arange(256, dtype=np.uint32)
    return step, of_top


def _look_up(tables: np.ndarray, first: np.ndarray | int, crcs: np.ndarray) -> np.ndarray:
    """Images of CRCs under linear maps: each byte's image stands in a flat table, 1024 entries for each map."""
    out = tables[first + (crcs & np.uint32(0xFF))]
    for k in (1, 2, 3):
        out ^= tables[first + 256 * k + ((crcs >> np.uint32(8 * k)) & np.uint32(0xFF))]
    return out


@lru_cache(maxsize=1)
def _few_zeros() -> np.ndarray:
    """Tables of the maps that append 0 to ``FEW`` zero bytes."""
    step, _ = _byte_tables()
    image = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    tables = [image]
    for _ in range(FEW):
        image = step[image & np.uint32(0xFF)] ^ (image >> np.uint32(8))
        tables.append(image)
    return np.concatenate(tables)


@lru_cache(maxsize=32)
def _many_zeros(doublings: int) -> np.ndarray:
    """Table of the map that appends ``FEW`` times ``2 ** doublings`` zero bytes."""
    if doublings == 0:
        return _few_zeros()[FEW * 1024 :]
    half = _many_zeros(doublings - 1)
    return _look_up(half, 0, half)


def shifted(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs after as many zero bytes as ``lengths`` says."""
    out = _look_up(_few_zeros(), (lengths % FEW) * 1024, crcs)
    many, doublings = lengths // FEW, 0
    at = np.flatnonzero(many)
    while len(at):
        odd = at[many[at] & 1 == 1]
        out[odd] = _look_up(_many_zeros(doublings), 0, out[odd])
        many = many >> 1
        at, doublings = at[many[at] > 0], doublings + 1
    return out


def _without_blank(crcs: np.ndarray) -> np.ndarray:
    """CRCs before their last byte, a blank: one step back."""
    step, of_top = _byte_tables()
    state = ~crcs
    index = of_top[state >> np.uint32(24)]
    low = (index ^ np.uint32(0x20)) & np.uint32(0xFF)
    return ~(((state ^ step[index]) << np.uint32(8)) | low)


def ngram_crcs(texts: list[list[bytes]], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of every run of 1 to ``order`` words joined by a space, and the text (by place) that it lies in."""
    line = b" ".join([w for text in texts for w in text]) + b" "
    if line == b" ":
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
    # One scan of all texts as one, a blank after each word: running CRCs, and where words start.
    crc, running = 0, [0]
    for word in line.replace(b" ", b" \n").split(b"\n")[:-1]:
        crc = crc32(word, crc)
        running.append(crc)
    before = np.array(running, dtype=np.uint32)
    after = _without_blank(before[1:])
    starts = np.concatenate([[0], np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 0x20) + 1])
    owner = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
    crcs, owners = [], []
    for n in range(1, min(order, len(after)) + 1):
        inside = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
        size = starts[inside + n] - 1 - starts[inside]
        crcs.append(after[inside + n - 1] ^ shifted(before[inside], size))
        owners.append(owner[inside])
    return np.concatenate(crcs), np.concatenate(owners)


def _runs(column: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of consecutive texts, about ``CHUNK`` bytes at a time, with the place of the first."""
    start, size, texts = 0, 0, []
    for i, text in enumerate(column):
        raw = text.as_py() or b""
        if texts and size + len(raw) > CHUNK:
            yield start, texts
            start, size, texts = i, 0, []
        texts.append(words_of(raw))
        size += len(raw)
    if texts:
        yield start, texts


def _body(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string").cast("binary"), F.lit(b""))


def bucket_counts(df: DataFrame, text: str, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """Features of all texts by bucket, as (bucket, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts in _runs(batch.column(0)):
                sums += np.bincount(ngram_crcs(texts, order)[0] % np.uint32(buckets), minlength=buckets)
        hit = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": hit, "n": sums[hit]})

    workers_find_package(df)
    partial = df.select(_body(text).alias("body")).mapInArrow(count, "bucket bigint, n bigint")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(df: DataFrame, target: DataFrame, text: str, target_text: str, order: int, buckets: int) -> np.ndarray:
    """Per bucket 1000 times the log-ratio of its smoothed share in the target to that in all documents, floored."""
    sides = bucket_counts(df, text, order, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("bigint").alias("t"))
    sides = sides.unionAll(
        bucket_counts(target, target_text, order, buckets).select("bucket", F.lit(0).cast("bigint"), F.col("n"))
    )
    counts = np.zeros((2, buckets), dtype=np.float64)
    for r in sides.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():  # at most ``buckets`` rows
        counts[:, r["bucket"]] = r["s"], r["t"]
    s, t = counts
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(df: DataFrame, gains: np.ndarray, id_column: str, text: str, order: int = ORDER) -> DataFrame:
    """Per row: id, ``n_words``, ``n_features`` and ``weight``."""
    buckets = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            words, features, sums = (np.zeros(rows, dtype=np.int64) for _ in range(3))
            for start, texts in _runs(batch.column(1)):
                crcs, owner = ngram_crcs(texts, order)
                span = slice(start, start + len(texts))
                words[span] = [len(t) for t in texts]
                features[span] = np.bincount(owner, minlength=len(texts))
                # Exact: whole numbers far below 2 ** 53.
                sums[span] = np.bincount(owner, gains[crcs % np.uint32(buckets)], minlength=len(texts)).astype(np.int64)
            weight = sums // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(features), pa.array(weight)],
                ["id", "n_words", "n_features", "weight"],
            )

    rows = df.select(F.col(f"`{id_column}`").alias("id"), _body(text).alias("body"))
    workers_find_package(df)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(weigh, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def resampled(
    df: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    order: int = ORDER,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Per row: id, ``n_features``, ``weight``, ``score`` and ``rank`` (1, 2, 3, ... of those drawn, else null).

    ``percent`` of the documents with ``least_words`` words or more are drawn, rounded down.
    """
    gains = bucket_gains(df, target, text, target_text, order, buckets)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((draw + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")
    scored = written(
        weighed(df, gains, id_column, text, order).withColumn("score", F.col("weight") + noise), "importance-scores"
    )
    able = scored.filter(F.col("n_words") >= least_words)
    wanted = able.count() * percent // 100
    # Scores are whole numbers within the gains and the noise: some ten thousand values, whatever the rows.
    heights = [(r["score"], r["n"]) for r in able.groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()]
    heights.sort(reverse=True)
    reached = list(accumulate(n for _, n in heights))
    lowest = next((score for (score, _), n in zip(heights, reached, strict=True) if n >= wanted), None)
    columns = [F.col("id").alias(id_column), "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if not wanted:
        return scored.select(*columns, none)
    hopeful = (F.col("n_words") >= least_words) & (F.col("score") >= lowest)
    # Rows that repeat are alike in all columns, so any order among them is the same.
    ranked = sequence_ids(
        scored.filter(hopeful).withColumn("__down", -F.col("score")),
        ["__down", "id", "n_features", "weight"], "rank", check=False,
    )
    drawn = F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")
    return ranked.select(*columns, drawn).unionAll(scored.filter(~hopeful).select(*columns, none))
