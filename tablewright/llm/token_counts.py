"""Token counts by byte-pair merging with a heap and a linked list; no ids are made.

A word's count is its number of bytes less the merges done. The heap gives the lowest-ranked adjacent pair, the
leftmost first of equal ranks; entries that a merge has outdated are skipped when popped. A word of n bytes costs
O(n log n), so one very long word is no danger. Words repeat, so each worker keeps the counts of the words it met last.

A null text is an empty one: no bytes, no tokens. Rows are independent; repeated rows give repeated results, and there are
no ties. An empty table gives no rows. Only id and text are read, so names of other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tablewright.llm.bpe import Vocabulary, vocabulary
from tablewright.llm.shared import in_pandas, text_or_empty

# Words whose counts a worker keeps, and the longest of them: together the bound of its memory.
REMEMBERED, REMEMBERED_LENGTH = 300_000, 64


def merges_of(word: str, vocab: Vocabulary) -> int:
    """How many merges a word takes."""
    ranks, ids = vocab.merges, vocab.byte_ids
    symbols = [ids[b] for b in word.encode()]
    last = len(symbols) - 1
    heap = [(found[0], i) for i in range(last) if (found := ranks.get((symbols[i], symbols[i + 1])))]
    if not heap:
        return 0
    heapify(heap)
    after, before = list(range(1, last + 2)), list(range(-1, last))
    done = 0
    while heap:
        rank, at = heappop(heap)
        right = after[at]
        if symbols[at] < 0 or right > last:
            continue
        found = ranks.get((symbols[at], symbols[right]))
        if found is None or found[0] != rank:
            continue
        done += 1
        merged = symbols[at] = found[1]
        symbols[right] = -1
        after[at] = beyond = after[right]
        if beyond <= last:
            before[beyond] = at
            if found := ranks.get((merged, symbols[beyond])):
                heappush(heap, (found[0], at))
        if (ahead := before[at]) >= 0 and (found := ranks.get((symbols[ahead], merged))):
            heappush(heap, (found[0], ahead))
    return done


class Counts(dict):
    """Tokens of a word, worked out when first asked for."""

    def __init__(self, vocab: Vocabulary):
        super().__init__(dict.fromkeys(vocab.special, 1))
        self.vocab = vocab

    def __missing__(self, word: str) -> int:
        tokens = len(word.encode()) - merges_of(word, self.vocab)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
                self.update(dict.fromkeys(self.vocab.special, 1))
            self[word] = tokens
        return tokens


_counts: dict[str, Counts] = {}


def token_counts(
    df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", limit: int = 1024
) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``path``: a byte-level vocabulary file in the JSON form, at the same place on every machine.
    """
    rows = df.select(F.col(id_column).alias("id"), text_or_empty(text).alias("body"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path)
        counts = _counts.setdefault(path, Counts(vocab))
        for batch in batches:
            tokens = [sum(map(counts.__getitem__, vocab.pieces(body))) for body in batch["body"]]
            yield pd.DataFrame({"id": batch["id"], "n_bytes": [len(b.encode()) for b in batch["body"]], "n_tokens": tokens})

    kind = rows.schema["id"].dataType.simpleString()
    out = in_pandas(rows, count, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
