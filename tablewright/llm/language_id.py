"""Language of documents and pages by Bayesian fusion of evidence.

Four kinds of evidence meet in one posterior over the languages and "none":

- the text: a naive Bayes model over hashed byte trigrams of all its words but those with digits, fitted on a bounded sample of rows
  with a declared language (``TRAIN_ROWS`` expected for each). Trigrams of one text are not independent, so its
  log-likelihood per trigram counts for a number of trigrams that saturates at ``EFFECTIVE``. "None" makes all
  trigrams equally likely, so text unlike every language falls to it;
- the declared language (markup or column), right with probability ``DECLARED_RIGHT``;
- the country suffix of the address, right with probability ``SUFFIX_RIGHT``;
- the host: how often the text alone gave each language on the host, less the row itself, smoothed by the counts of
  its parent domain, these by those of all rows. The counts are grouped aggregates, never windows over a host.

A null text, or one without words, says nothing, and the other evidence decides. Null declarations, addresses and hosts say nothing.
A row is rejected if "none" is the most probable. Rows are judged one by one; repeated rows get equal results. Of equally
probable languages the first in the list wins, "none" last. Texts are scored whole, ``CHUNK`` characters at a time. An empty
table gives no rows. Documents and pages are first read into columns of this module's own, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.shared import in_pandas, packed, same, text_or_empty, written

# Production parameters.
LANGUAGES = ("de", "en", "es", "fr")
TRAIN_ROWS, EFFECTIVE, DECLARED_RIGHT, SUFFIX_RIGHT, NONE_PRIOR, HOST_WEIGHT = 2000, 50.0, 0.9, 0.8, 0.01, 10.0
BUCKETS, CHUNK = 1 << 15, 1 << 18  # the second: characters worked on at a time

# Country suffixes and the language most used below them.
SUFFIX_LANGUAGE = {
    "de": "de", "at": "de", "uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en", "es": "es", "mx": "es",
    "ar": "es", "cl": "es", "pe": "es", "fr": "fr",
}


def _letters_only() -> bytes:
    """A-Z as a-z, digits and the at sign as 0, other ASCII but letters as blanks."""
    table = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalpha() else ord("0") if c.isdigit() or c == "@" else ord(" ")
    return bytes(table)


LETTERS = _letters_only()


def _words(text: str) -> bytes:
    """The text's words, without numbers, codes and addresses, which belong to no language."""
    return b" ".join([w for w in text.encode().translate(LETTERS).split() if b"0" not in w])


def _trigrams(raw: bytes) -> np.ndarray:
    """Bucket of the trigram that starts at each byte but the last two."""
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    mixed = b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)
    return (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(17)


def _blocks(raw: bytes) -> Iterator[np.ndarray]:
    """Buckets of all trigrams of a text that is longer than a chunk."""
    for at in range(0, len(raw) - 2, CHUNK):
        yield _trigrams(raw[at : at + CHUNK + 2])


def _flat(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all texts in one array, and the number of each text's trigrams."""
    raw = [_words(text) + b"  " for text in texts]
    return _trigrams(b"".join(raw) + b"  "), np.array([len(r) - 2 for r in raw])


def _parts(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``CHUNK`` characters."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def fit(rows: DataFrame, languages: Sequence[str], train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Log-probabilities by bucket and language from ``rows`` (id, declared, body)."""
    counts = {r["declared"]: r["n"] for r in rows.filter(F.col("declared").isin(*languages)).groupBy("declared").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = 1 << 30
    draw = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(whole))
    taken = reduce(
        Column.__or__,
        [(F.col("declared") == k) & (draw < F.lit(int(whole * min(1.0, train_rows / n)))) for k, n in counts.items()],
        F.lit(False),
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for batch in batches:
            for k, language in enumerate(languages):
                texts = list(batch["body"][batch["declared"] == language])
                for a, b in _parts(texts):
                    if b == a + 1 and len(texts[a]) > CHUNK:
                        for buckets in _blocks(_words(texts[a]) + b"  "):
                            sums[k] += np.bincount(buckets, minlength=BUCKETS)
                        continue
                    buckets, sizes = _flat(texts[a:b])
                    ends = np.cumsum(sizes + 2)
                    inside = np.ones(len(buckets), dtype=bool)
                    inside[ends - 1] = inside[ends - 2] = False  # windows that begin in the space between texts
                    sums[k] += np.bincount(buckets[inside], minlength=BUCKETS)
        language, bucket = np.nonzero(sums)
        yield pd.DataFrame({"language": language, "bucket": bucket, "n": sums[language, bucket]})

    partial = in_pandas(rows.filter(taken).select("declared", "body"), count, "language int, bucket int, n bigint")
    model = np.full((BUCKETS, len(languages)), 0.5)
    for r in partial.groupBy("language", "bucket").agg(F.sum("n").alias("n")).collect():  # at most a row per cell
        model[r["bucket"], r["language"]] += r["n"]
    return np.log(model / model.sum(axis=0)).astype(np.float32)


def _scored(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """``rows`` with the body replaced by its number of trigrams and mean log-likelihood by language."""
    keep = [f for f in rows.schema.fields if f.name != "body"]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, grams, means = list(batch["body"]), [], []
            for a, b in _parts(texts):
                if b == a + 1 and len(texts[a]) > CHUNK:
                    raw = _words(texts[a]) + b"  "
                    size = len(raw) - 2
                    total = sum((model[x].sum(axis=0, dtype=np.float64) for x in _blocks(raw)), np.zeros(model.shape[1]))
                    grams.append(size)
                    means.append(total / max(size, 1))
                    continue
                buckets, sizes = _flat(texts[a:b])
                starts = np.cumsum(sizes + 2) - sizes - 2
                bounds = np.stack([starts, starts + sizes], axis=1).ravel()
                sums = np.add.reduceat(model[buckets], bounds, axis=0, dtype=np.float64)[::2]
                sums[sizes == 0] = 0.0
                grams += sizes.tolist()
                means += list(sums / np.maximum(sizes, 1)[:, None])
            yield batch.drop(columns="body").assign(grams=grams, means=means)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return in_pandas(rows, score, f"{schema}, grams bigint, means array<double>")


def _parent(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def language_posteriors(
    rows: DataFrame, languages: Sequence[str] = LANGUAGES, train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """``rows`` (id, declared, suffix, host, body and others, all but body kept) with ``language``, ``confidence``,
    ``text_language`` and ``rejected``."""
    count = len(languages)
    model = fit(rows, languages, train_rows)
    scored = _scored(rows, model)
    best = F.array_max("means")
    own = F.when((F.col("grams") > 0) & (best > F.lit(-float(np.log(BUCKETS)))), F.array_position("means", best).cast("int"))
    scored = written(scored.withColumn("text_number", own), "language-scores")  # from 1; null: none

    def counts(by: Column, name: str) -> DataFrame:
        sums = [F.count_if(F.col("text_number") == k + 1).cast("double") for k in range(count)]
        told = scored.filter(by.isNotNull() & F.col("text_number").isNotNull())
        return told.groupBy(by.alias(name)).agg(F.array(*sums).alias(f"{name}_n"))

    host, parent = F.col("host"), _parent(F.col("host"))
    everywhere = scored.agg(*[F.count_if(F.col("text_number") == k + 1) for k in range(count)]).first()
    total = sum(everywhere) + count
    base = F.array(*[F.lit((n + 1) / total) for n in everywhere])
    out = scored.join(counts(host, "at_host"), host == F.col("at_host"), "left")
    out = out.join(counts(parent, "at_parent"), parent == F.col("at_parent"), "left")

    def smoothed(own: str, prior: Column) -> Column:
        """Counts less the row itself, smoothed towards ``prior``."""
        none = F.array_repeat(F.lit(0.0), count)
        n = F.transform(F.coalesce(F.col(own), none), lambda x, i: x - F.when(F.col("text_number") == i + 1, 1.0).otherwise(0.0))
        whole = F.aggregate(n, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(n, prior, lambda x, p: (F.greatest(x, F.lit(0.0)) + F.lit(HOST_WEIGHT) * p) / (whole + F.lit(HOST_WEIGHT)))

    prior = smoothed("at_host_n", smoothed("at_parent_n", base))

    def told(column: str, right: float) -> Column:
        """Log-likelihood of a statement by language; a statement of another language says nothing."""
        wrong = (1 - right) / max(count - 1, 1)
        known = F.col(column).isin(*languages)
        return F.array(*[F.when(known, F.when(F.col(column) == k, F.lit(right)).otherwise(F.lit(wrong))).otherwise(F.lit(1.0)) for k in languages])

    effective = F.col("grams") / (F.lit(1.0) + F.col("grams") / F.lit(EFFECTIVE))
    logs = F.transform(
        F.arrays_zip(F.col("means"), prior.alias("p"), told("declared", DECLARED_RIGHT).alias("d"), told("suffix", SUFFIX_RIGHT).alias("s")),
        lambda x: x["means"] * effective + F.log(x["p"]) + F.log(x["d"]) + F.log(x["s"]) + F.lit(float(np.log(1 - NONE_PRIOR))),
    )
    # Under "none" every statement is as likely as a guess.
    guess = F.lit(0.0)
    for column in ("declared", "suffix"):
        guess = guess + F.when(F.col(column).isin(*languages), F.lit(-float(np.log(count)))).otherwise(F.lit(0.0))
    none = effective * F.lit(-float(np.log(BUCKETS))) + guess + F.lit(float(np.log(NONE_PRIOR)))
    out = out.withColumn("logs", F.concat(logs, F.array(none)))
    top = F.array_max("logs")
    evidence = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    names = F.array(*map(F.lit, languages), F.lit("none"))
    number = F.array_position("logs", top).cast("int")
    kept = [c for c in rows.columns if c != "body"]
    return out.select(
        *kept,
        F.element_at(names, number).alias("language"),
        (F.lit(1.0) / evidence).alias("confidence"),
        F.when(F.col("text_number").isNotNull(), F.element_at(names, F.col("text_number"))).alias("text_language"),
        (number == count + 1).alias("rejected"),
    )


def document_rows(df: DataFrame, id_column: str = "doc_id", text: str = "text", declared: str = "lang", host: str = "source") -> DataFrame:
    """Documents as rows of evidence: the language column is the declaration, the source the host."""
    return df.select(
        F.col(id_column).alias("id"), F.lower(F.col(declared)).alias("declared"), F.lit(None).cast("string").alias("suffix"),
        F.col(host).cast("string").alias("host"), text_or_empty(text).alias("body"),
    )


def page_rows(df: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as rows of evidence: the markup's language, the address's country suffix and host, the visible text."""
    host = F.nullif(F.lower(F.regexp_extract(F.col(url), "://([^/?#:]*)", 1)), F.lit(""))
    suffix = F.substring_index(host, ".", -1)
    by_suffix = F.create_map(*[F.lit(x) for pair in SUFFIX_LANGUAGE.items() for x in pair])
    markup = F.nullif(F.lower(F.regexp_extract(F.col(html), r"(?i)<html[^>]*\blang=[\"']?([A-Za-z]+)", 1)), F.lit(""))
    hidden = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    visible = F.regexp_replace(F.regexp_replace(hidden, "<[^>]*>", " "), "&[a-zA-Z#0-9]+;", " ")
    return df.select(
        F.col(id_column).alias("id"), markup.alias("declared"), by_suffix[suffix].alias("suffix"), host.alias("host"), visible.alias("body")
    )


def in_known_language(df: DataFrame, id_column: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The rows of ``df`` that are not rejected, with all their columns."""
    rows = document_rows(df, id_column, text, **names).withColumn("mark", F.xxhash64("body"))
    gone = language_posteriors(rows).filter("rejected").select(F.col("id").alias("gone"), F.col("mark").alias("gone_mark"))
    gone = written(gone.distinct(), "language-rejected")
    kept = packed(df, id=F.col(id_column), mark=F.xxhash64(text_or_empty(text)))
    return kept.join(gone, same([F.col("id"), F.col("mark")], [F.col("gone"), F.col("gone_mark")]), "left_anti").select("row.*")
