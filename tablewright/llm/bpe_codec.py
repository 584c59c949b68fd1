"""Byte-pair encoding and decoding in batched numpy rounds.

The symbols of all words a batch brings for the first time lie in one flat array. Each round looks up every adjacent
pair by binary search over the sorted pair keys, and merges in each word all pairs of the word's lowest rank, from left
to right, until no word has a pair left. Repeating a round is the same as merging one pair at a time, since a merge can
only make pairs that rank after it.

A null text is an empty one: no ids, an empty text. Rows are independent; repeated rows give repeated results, and there
are no ties. Long texts are cut into words whole, with a bound on the words held for the others beside them. Empty tables
give no rows. Columns other than id and text (or ids) are left out, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tablewright.llm.bpe import Vocabulary, vocabulary
from tablewright.llm.shared import in_pandas, text_or_empty

# Words whose ids a worker keeps, and the longest of them; symbols of one round; characters cut into words at a time,
# and ids passed on at a time.
REMEMBERED, REMEMBERED_LENGTH, SYMBOLS, CHARACTERS, IDS = 200_000, 64, 1 << 20, 1 << 20, 1 << 20
NONE = np.iinfo(np.int64).max


class Encoder:
    """Ids of words, as bytes of little-endian unsigned 32-bit integers."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.base = len(vocab.token_bytes)
        pairs = np.array([a * self.base + b for a, b in vocab.merges], dtype=np.int64)
        order = np.argsort(pairs)
        values = np.array(list(vocab.merges.values()), dtype=np.int64)
        self.keys, self.ranks, self.made = pairs[order], values[order, 0], values[order, 1]
        self.byte_ids = np.array(vocab.byte_ids, dtype=np.int64)
        self.special = {k: np.uint32(v).astype("<u4").tobytes() for k, v in vocab.special.items()}
        self.known: dict[str, bytes] = dict(self.special)

    def rounds(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        raw = [w.encode() for w in words]
        symbols = self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), [len(r) for r in raw])
        out_ids, out_owner = [], []
        while len(symbols):
            inside = owner[1:] == owner[:-1]
            key = symbols[:-1] * self.base + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(inside & (self.keys[at] == key), self.ranks[at], NONE)
            lowest = np.full(len(words), NONE)
            np.minimum.at(lowest, owner[:-1], rank)
            open_words = lowest[owner] != NONE
            out_ids.append(symbols[~open_words])
            out_owner.append(owner[~open_words])
            hit = (rank != NONE) & (rank == lowest[owner[:-1]])
            # Of hits that overlap (a run of one letter), every other one counts, from the left.
            starts = hit & ~np.concatenate([[False], hit[:-1]])
            run = np.maximum.accumulate(np.where(starts, np.arange(len(hit)), -1))
            hit &= (np.arange(len(hit)) - run) % 2 == 0
            first = np.flatnonzero(hit)
            symbols[first] = self.made[at[first]]
            stays = open_words
            stays[first + 1] = False
            symbols, owner = symbols[stays], owner[stays]
        ids, owners = np.concatenate(out_ids), np.concatenate(out_owner)
        order = np.argsort(owners, kind="stable")
        flat = ids[order].astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(owners, minlength=len(words)))
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, in order; words of about ``CHARACTERS`` characters of text are held at a time."""
        start, size = 0, 0
        for i, text in enumerate(texts):
            if size and size + len(text) > CHARACTERS:
                yield from self._encode(texts[start:i])
                start, size = i, 0
            size += len(text)
        yield from self._encode(texts[start:])

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        cut = [self.vocab.pieces(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known = dict(self.special)
        known = self.known
        new = list(dict.fromkeys(w for words in cut for w in words if w not in known))
        at = 0
        while at < len(new):
            end, symbols = at, 0
            while end < len(new) and (end == at or symbols + 4 * len(new[end]) <= SYMBOLS):
                symbols += 4 * len(new[end])
                end += 1
            known.update(zip(new[at:end], self.rounds(new[at:end]), strict=True))
            at = end
        for words in cut:
            yield b"".join(map(known.__getitem__, words))
        for word in new:
            if len(word) > REMEMBERED_LENGTH:
                del known[word]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no text become the replacement character."""
        tokens = self.vocab.token_bytes
        return b"".join([tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(vocabulary(path))
    return _encoders[path]


@contextmanager
def task_encoder(path: str) -> Iterator[Encoder]:
    """The worker's encoder, whose words go with the task: the worker goes on to other stages, and would hold them."""
    worker = encoder(path)
    try:
        yield worker
    finally:
        worker.known = dict(worker.special)


def encoded(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id and ``ids``, an array of token ids.

    ``path``: a byte-level vocabulary file in the JSON form, at the same place on every machine.
    """
    rows = df.select(F.col(id_column).alias("id"), text_or_empty(text).alias("body"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with task_encoder(path) as worker:
            for batch in batches:
                ids, start, size = [], 0, 0
                for x in worker.encode(list(batch["body"])):
                    ids.append(np.frombuffer(x, dtype="<u4").astype(np.int32))
                    size += len(ids[-1])
                    if size >= IDS:
                        yield pd.DataFrame({"id": batch["id"].iloc[start : start + len(ids)].to_numpy(), "ids": ids})
                        ids, start, size = [], start + len(ids), 0
                if ids:  # lists of an empty frame have no type that Arrow could take
                    yield pd.DataFrame({"id": batch["id"].iloc[start:].to_numpy(), "ids": ids})

    kind = rows.schema["id"].dataType.simpleString()
    return in_pandas(rows, encode, f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)


def decoded(df: DataFrame, path: str, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: id and the ``text`` of its ids; null ids are none."""
    rows = df.select(F.col(id_column).alias("id"), F.col(ids).alias("ids"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = encoder(path)
        for batch in batches:
            texts = ["" if x is None else worker.decode(np.asarray(x, dtype="<u4").tobytes()) for x in batch["ids"]]
            yield pd.DataFrame({"id": batch["id"], "text": texts})

    kind = rows.schema["id"].dataType.simpleString()
    return in_pandas(rows, decode, f"id {kind}, text string").withColumnRenamed("id", id_column)


def round_trip(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian 32-bit integers) and ``decoded_sha256``.

    Encodes and decodes in one pass, so ids do not travel.
    """
    rows = df.select(F.col(id_column).alias("id"), text_or_empty(text).alias("body"))

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with task_encoder(path) as worker:
            for batch in batches:
                out = []
                for ids in worker.encode(list(batch["body"])):
                    text_again = worker.decode(ids).encode()
                    out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text_again).hexdigest()))
                made = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
                yield made.assign(id=batch["id"].to_numpy())[["id", "n_tokens", "ids_sha256", "decoded_sha256"]]

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return in_pandas(rows, digests, schema).withColumnRenamed("id", id_column)
