import corpus_pipeline
import numpy as np
import pytest
from compare import compare
from support import base_by_hand, near_by_hand
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from tablewright.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, name):
    assert compare(spark, name, SF) is None


def test_registered():
    names = set(entry_points.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert {n.split("_")[0] for n in queries.QUERIES if n.startswith("op")} == {f"op{n}" for n in range(1, 14)}


def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def test_near_copies(spark):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, "op7_ngram_join")}
    assert got == near_by_hand(list(texts(spark).items()))


def test_personal_data(spark):
    bodies = texts(spark)
    rows = run(spark, "op3_personal_data")
    assert len(rows) == len(bodies)
    for r in rows:
        base = base_by_hand(bodies[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == x for k, _, _ in base) for x in ("email", "ip", "card", "phone")]


def test_tokens(spark):
    library = Tokenizer.from_file(queries.vocabulary_path())
    bodies = texts(spark)
    counted = {r["doc_id"]: r["n_tokens"] for r in run(spark, "op8_token_counts")}
    assert counted == {r["doc_id"]: r["n_tokens"] for r in run(spark, "op10_bpe_codec")}
    assert counted == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in bodies.items()}


def test_shards(spark):
    rows = run(spark, "op2_sharding")
    sums = {}
    for r in rows:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
    assert len(rows) == len(texts(spark)) and set(sums) <= set(range(40))
    mean = sum(sums.values()) / 40
    assert max(sums.values()) <= mean + 2 * max(r["size"] for r in rows)


def test_languages_and_mixture(spark):
    rows = run(spark, "op5_language_id")
    assert len(rows) == len(texts(spark)) and sum(r["rejected"] for r in rows) == 0
    assert {r["doc_id"] for r in run(spark, "op9_mixing")} == set(texts(spark))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "bpe":
            assert out.columns == docs.columns
        before[name], docs = {r["doc_id"] for r in docs.collect()}, out
    bodies = texts(spark)
    assert before["exact_dedup"] == set(bodies)
    last = {}
    for i, t in bodies.items():
        last[t] = max(i, last.get(t, i))
    assert before["ngram_jaccard"] == set(last.values())
    by_hand = near_by_hand([(i, bodies[i]) for i in before["ngram_jaccard"]])
    assert before["mixing"] == {c for _, c in by_hand.values()}
    library = Tokenizer.from_file(queries.vocabulary_path())
    for r in docs.collect():
        assert r["ids"] == library.encode(bodies[r["doc_id"]], add_special_tokens=False).ids
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
    assert np.all([r["doc_id"] in before["mixing"] for r in docs.collect()])
