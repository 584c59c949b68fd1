"""The stages of the pipeline on odd tables, and the fusion of language evidence, against brute force."""

import math

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from support import LONG, documents, near_by_hand
from tokenizers import Tokenizer

from tablewright.llm import language_id, queries, stages

SF = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " \n", "the cat sat on the mat and the dog lay by the door", "the cat sat on the mat and the dog lay by the door",
    "the cat sat on the mat and the dog lay by the floor", LONG, "une phrase en français avec des mots", "x",
    "el perro y el gato están en la casa de la abuela", "der Hund und die Katze liegen vor der Tür", "日本語の文章", "12 34 56",
]


@pytest.fixture(scope="module")
def odd(spark):
    langs = ["en", None, "", "en", "en", "en", "en", "fr", "xx", "es", "de", None, "en"]
    sources = ["a", "a", None, "a", "b", "b", "b", "c", "", "c", "a", "a", "a"]
    docs = documents(spark, TEXTS, lang=langs, source=sources)
    return docs.union(docs.filter("doc_id in (0, 3, 7)"))  # repeated rows


def kept(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_language_keeps_columns_and_clean_rows(spark, odd):
    out = stages.language(spark, odd, SF)
    assert out.columns == odd.columns
    assert set(kept(out)) >= {3, 4, 5, 7, 9, 10}
    assert kept(out).count(3) == 2


def test_exact_keeps_the_largest_id_of_each_text(spark, odd):
    out = stages.exact(spark, odd, SF)
    assert out.columns == odd.columns
    last = {}
    for i, t in enumerate(TEXTS):
        last[t or ""] = i
    assert kept(out) == sorted(last.values())


def test_near_keeps_the_least_id_of_each_group(spark, odd):
    out = stages.near(spark, odd, SF)
    assert out.columns == odd.columns
    groups = near_by_hand(list(enumerate(TEXTS)))
    assert set(kept(out)) == {c for _, c in groups.values()}


def test_mixture_keeps_every_row(spark, odd):
    out = stages.mixture(spark, odd, SF)
    assert out.columns == odd.columns
    assert set(kept(out)) == set(range(len(TEXTS)))


def test_token_ids_are_the_library_s(spark, odd):
    library = Tokenizer.from_file(queries.vocabulary_path())
    rows = stages.token_ids(spark, odd, SF).collect()
    assert len(rows) == len(TEXTS) + 3
    assert all(r["ids"] == library.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids for r in rows)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_of_an_empty_table(spark, odd, name, stage):
    out = stage(spark, spark.createDataFrame([], StructType(odd.schema.fields)), SF)
    assert out.count() == 0
    if name != "bpe":
        assert out.columns == odd.columns


def posteriors_by_hand(rows, languages):
    """(language, rejected) by id, from rows with their text's trigrams and mean log-likelihoods."""
    count, buckets = len(languages), language_id.BUCKETS

    def own(r):
        best = max(r["means"])
        return r["means"].index(best) if r["grams"] > 0 and best > -math.log(buckets) else None

    def tally(by):
        out = {}
        for r in rows:
            if by(r) is not None and own(r) is not None:
                out.setdefault(by(r), [0] * count)[own(r)] += 1
        return out

    def parent(host):
        return None if host is None else ".".join(host.split(".")[-2:])

    hosts, parents = tally(lambda r: r["host"]), tally(lambda r: parent(r["host"]))
    everywhere = [sum(own(r) == k for r in rows) for k in range(count)]
    base = [(n + 1) / (sum(everywhere) + count) for n in everywhere]

    def smoothed(counts, prior, r):
        n = [x - (own(r) == k) for k, x in enumerate(counts)]
        return [(max(x, 0) + language_id.HOST_WEIGHT * p) / (sum(n) + language_id.HOST_WEIGHT) for x, p in zip(n, prior)]

    found = {}
    for r in rows:
        zero = [0] * count
        prior = smoothed(parents.get(parent(r["host"]), zero), base, r)
        prior = smoothed(hosts.get(r["host"], zero), prior, r)
        effective = r["grams"] / (1 + r["grams"] / language_id.EFFECTIVE)
        logs = [r["means"][k] * effective + math.log(prior[k]) + math.log(1 - language_id.NONE_PRIOR) for k in range(count)]
        none = -effective * math.log(buckets) + math.log(language_id.NONE_PRIOR)
        for said, right in ((r["declared"], language_id.DECLARED_RIGHT), (r["suffix"], language_id.SUFFIX_RIGHT)):
            if said in languages:
                logs = [x + math.log(right if k == said else (1 - right) / (count - 1)) for k, x in zip(languages, logs)]
                none -= math.log(count)
        names = [*languages, "none"]
        best = int(np.argmax([*logs, none]))
        found[r["id"]] = (names[best], best == count)
    return found


@pytest.mark.parametrize("name", ["op5_language_id", "page_language"])
def test_fusion_by_brute_force(spark, name):
    if name == "page_language":
        rows = language_id.page_rows(spark.read.parquet(f"{SF}/pages.parquet"))
    else:
        rows = language_id.document_rows(spark.read.parquet(f"{SF}/documents.parquet"))
    model = language_id.fit(rows, language_id.LANGUAGES)
    scored = [r.asDict() for r in language_id._scored(rows, model).collect()]
    expected = posteriors_by_hand(scored, language_id.LANGUAGES)
    key = "page_id" if name == "page_language" else "doc_id"
    got = {r[key]: (r["language"], r["rejected"]) for r in queries.QUERIES[name](spark, SF).collect()}
    assert got == expected and len(got) == len(scored)


def test_long_texts_score_as_in_one_piece(spark, monkeypatch):
    df = documents(spark, ["the cat and the dog " * 50, "", "le chat et le chien " * 30], lang=["en", "en", "fr"])
    rows = language_id.document_rows(df)
    model = language_id.fit(rows, language_id.LANGUAGES)
    whole = {r["id"]: (r["grams"], r["means"]) for r in language_id._scored(rows, model).collect()}
    monkeypatch.setattr(language_id, "CHUNK", 64)
    again = language_id.fit(rows, language_id.LANGUAGES)
    assert np.array_equal(model, again)
    for r in language_id._scored(rows, model).collect():
        assert r["grams"] == whole[r["id"]][0] and np.allclose(r["means"], whole[r["id"]][1], rtol=1e-9)
    assert rows.filter(F.col("body") == "").count() == 1
