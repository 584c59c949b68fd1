"""Spelling variants, importance resampling and top products on small tables, against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql.types import StructType
from support import LONG, documents

from tablewright.llm import importance, spelling, top_products

UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def empty_like(spark, df):
    return spark.createDataFrame([], StructType(df.schema.fields))


# 11


def forms_by_hand(pairs, shortest=7, factor=10, loses=31):
    counts = {}
    for number, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if number is None else number}:{run}".encode())
            if h % loses == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    around = {w: [v for v in counts if v != w and near(v, w)] for w in counts}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= factor * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), counts[w], len(around[w]), counts[form[w]] if form[w] else None) for w in counts}


def forms(df, **more):
    rows = spelling.spelling_forms(df, **more).collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def variants(rng, words, n):
    out = []
    for _ in range(n):
        w = rng.choice(words)
        at, c = rng.randrange(len(w) + 1), rng.choice("abnzéÿ")
        out.append(rng.choice([w, w, w, w[:at] + c + w[at:], w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :], w.upper()]))
    return out


def test_forms_follow_to_the_last(spark):
    texts = ["aaaaaaaa " * 400, "aaaaaaab " * 40, "aaaaaabb " * 4, "baaaaaaa " * 40, "zzzzzzz " * 2, "short", "lonelyword", *["aaaaaaa"] * 5]
    df = documents(spark, texts)
    expected = forms_by_hand(list(enumerate(texts)))
    assert forms(df) == expected
    assert expected["aaaaaabb"][:2] == ("aaaaaaab", "aaaaaaaa")
    assert expected["aaaaaaa"][:2] == ("aaaaaaaa", "aaaaaaaa")  # a letter of a run, counted once


def test_forms_by_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    words = ["bananas", "annanna", "nananana", "éclairée", "ÿÿÿÿÿÿÿÿ", "mississippi", "aaaaaaa", "abababab"]
    texts = [None, "", " ", "7 × ÷÷÷÷÷÷÷ ×××××××", "İstanbulu ŒUVRESS ſſſſſſſſ", LONG]
    texts += [rng.choice([" ", "-", "1", "\n"]).join(variants(rng, words, rng.randrange(1, 60))) for _ in range(60)]
    df = documents(spark, texts)
    expected = forms_by_hand(list(enumerate(texts)))
    assert sum(f is not None for f, *_ in expected.values()) > 20
    assert forms(df) == expected
    # Many ranges, small tasks: the trie's nodes go on across them.
    monkeypatch.setattr(spelling, "WORDS_PER_RANGE", 3)
    monkeypatch.setattr(spelling, "HELD", 5)
    assert forms(df) == expected
    assert forms(df.union(df)) == forms_by_hand(list(enumerate(texts)) * 2)
    assert forms(empty_like(spark, df)) == {}
    assert forms(documents(spark, [None, "", "a b"])) == {}
    # Every occurrence loses a letter; other factors.
    assert forms(df, loses=1, factor=2) == forms_by_hand(list(enumerate(texts)), loses=1, factor=2)
    with pytest.raises(ValueError):
        forms(df, factor=1)


def test_forms_of_null_ids(spark):
    df = spark.createDataFrame([(None, "bananas banana bananas"), (None, "bananas")], "doc_id bigint, text string")
    assert forms(df) == forms_by_hand([(None, "bananas banana bananas"), (None, "bananas")])


def test_trie_nodes_are_prefixes(spark, monkeypatch):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(300)})
    monkeypatch.setattr(spelling, "WORDS_PER_RANGE", 7)
    rows = spelling.vocabulary_tries(spark.createDataFrame([(w, 2) for w in words], "word string, n bigint")).collect()
    assert [r["word"] for r in sorted(rows, key=lambda r: r["id"])] == words
    for name, cut in (("prefixes", lambda w, i: w[:i]), ("suffixes", lambda w, i: w[len(w) - i :])):
        node_of, text_of = {}, {}
        for r in rows:
            assert len(r[name]) == len(r["word"]) + 1
            for i, node in enumerate(r[name]):
                text = cut(r["word"], i)
                assert node_of.setdefault(text, node) == node and text_of.setdefault(node, text) == text


# 12


def words_by_hand(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER))


def resampled_by_hand(docs, target, order=2, buckets=10_000, percent=25, least=20, seed=7):
    def features(text):
        w = words_by_hand(text)
        runs = [" ".join(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]
        return [zlib.crc32(r.encode()) % buckets for r in runs]

    s, t = np.zeros(buckets), np.zeros(buckets)
    for sums, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in features(text):
                sums[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    out = []
    for number, text in docs:
        f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{number}".encode()).hexdigest()[:8], 16)
        out.append((number, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_by_hand(text))))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0]))
    drawn = able[: percent * len(able) // 100]
    ranks = {}
    for i, r in enumerate(drawn):
        ranks.setdefault(r[:4], []).append(i + 1)
    rows = []
    for r in sorted(out):
        rows.append((*r[:4], ranks[r[:4]].pop(0) if ranks.get(r[:4]) else None))
    return sorted(rows, key=repr)


def drawn(df, target, **more):
    out = importance.resampled(df, target, **more)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("order", [1, 2, 3, 6])
def test_crcs_of_runs(order):
    rng = random.Random(order)
    texts = [b"", b"one", b"\xc3\xa9 \xff\xfe x", b"a" * 5000 + b" b " + b"c" * 130, b"x " * 300]
    texts += [" ".join("".join(rng.choice("ab é日") for _ in range(rng.randrange(9))) for _ in range(50)).encode() for _ in range(20)]
    words = [importance.words_of(t) for t in texts]
    crcs, owner = importance.ngram_crcs(words, order)
    expected = [(i, zlib.crc32(b" ".join(w[k : k + n]))) for i, w in enumerate(words) for n in range(1, order + 1) for k in range(len(w) - n + 1)]
    assert sorted(zip(owner.tolist(), crcs.tolist())) == sorted(expected)
    assert len(importance.ngram_crcs([[], []], order)[0]) == 0


@pytest.mark.parametrize("a, n", [(0, 0), (1, 1), (0xDEADBEEF, 63), (5, 64), (77, 4097), (123456789, 70_001)])
def test_shift_appends_zeros(a, n):
    # crc(AB) xor crc(B) = shift(crc(A)): B of zero bytes after any A.
    text = a.to_bytes(4, "big")
    shifted = importance.shifted(np.array([zlib.crc32(text)], dtype=np.uint32), np.array([n]))[0]
    assert shifted == zlib.crc32(text + bytes(n)) ^ zlib.crc32(bytes(n))


def test_draw_by_brute_force(spark):
    rng = random.Random(2)
    vocabulary = ["alpha", "Béta", "gamma", "12", "日本", "x", "delta,epsilon"]
    texts = [None, "", "\x00\x7f @[`{", "one", LONG] + [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 60))) for _ in range(120)]
    target = ["alpha béta alpha béta", None, "", "gamma 日本"]
    df = documents(spark, texts)
    goal = spark.createDataFrame([(i, t, "z") for i, t in enumerate(target)], "item_id int, text string, bucket string")
    docs = list(enumerate(texts))
    assert drawn(df, goal) == resampled_by_hand(docs, target)
    assert drawn(df, goal, order=3, percent=60, least_words=1, buckets=50) == resampled_by_hand(docs, target, 3, 50, 60, 1)
    # Repeated rows are drawn apart, in equal places.
    assert drawn(df.union(df), goal) == resampled_by_hand(docs * 2, target)
    assert drawn(df, empty_like(spark, goal)) == resampled_by_hand(docs, [])
    assert drawn(empty_like(spark, df), goal) == []
    assert [r[4] for r in drawn(documents(spark, ["a b"]), goal)] == [None]
    assert drawn(df, goal, percent=0) == resampled_by_hand(docs, target, percent=0)


def test_texts_longer_than_a_run(spark, monkeypatch):
    texts = ["a b c " * 30, "é" * 500, "x y " * 200, None] * 5
    target = spark.createDataFrame([("a b",)], "text string")
    monkeypatch.setattr(importance, "CHUNK", 100)
    assert drawn(documents(spark, texts), target) == resampled_by_hand(list(enumerate(texts)), ["a b"])


# 13


def top_by_hand(rows, every=50, k=5):
    def sound(v):
        return v is not None and all(c is not None and math.isfinite(c) for c in v)

    whole = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if sound(v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in whole if i is not None and i % every == 0}:
        scores = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q)]
        best = sorted(scores, key=lambda x: (x[0], x[1] is None, x[1]))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out, key=repr)


def top(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id bigint, embedding array<float>, key int, dim int, v string")
    out = top_products.top_products(df, **more)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_top_products_by_brute_force(spark):
    rng = np.random.default_rng(4)
    sizes = rng.lognormal(0, 1, 400)
    rows = [(i, (rng.normal(size=12) * sizes[i]).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[50][1]) for i in range(9)]  # ties
    rows += [(None, rows[100][1]), (450, None), (500, [1.0] * 11 + [None]), (550, [float("nan")] * 12), (600, [float("inf")] * 12)]
    rows += [(650, [0.0] * 12), (700, [1.0, 2.0]), (750, []), (751, []), (800, [3.0]), (7, rows[7][1])]
    expected = top_by_hand(rows)
    assert top(spark, rows) == expected
    # Many groups and tiles.
    assert top(spark, rows, group=20) == expected
    assert [r for r in expected if r[0] == 700] == [] and (750, 1, 751, 0) in expected
    assert top(spark, rows + rows[:1], group=50) == top_by_hand(rows + rows[:1])
    assert top(spark, [(0, [1.0, 2.0])]) == [] and top(spark, [(1, None)]) == []


def test_top_products_are_exact_beyond_doubles(spark):
    rows = [(i, [float(np.float32(1e6 + i)), float(np.float32(2e6 - 3 * i)), 1.0 + i / 256]) for i in range(60)]
    assert top(spark, rows, every=10) == top_by_hand(rows, every=10)


def test_too_long_vectors_take_no_part(spark):
    rows = [(0, [1.0, 1.0]), (1, [3e38, 0.0]), (2, [1.0, 0.0])]
    assert top(spark, rows) == [(0, 1, 2, 65536)]


def test_tiles_and_bounds(monkeypatch):
    rng = np.random.default_rng(1)
    v = rng.integers(-300, 300, size=(500, 16))
    v[:, 8:] //= 16
    length = np.sqrt((v**2).sum(axis=1))
    order = np.argsort(-length)
    v, length = v[order], length[order]
    axes = np.linalg.eigh(v.T @ v)[1][:, ::-1]
    monkeypatch.setattr(top_products, "TILE", 32)
    side = top_products.Side(np.arange(500), v, length, axes)
    q, ids, score = top_products.search(side, side[np.arange(0, 500, 7)], np.full(72, top_products.NO_BOUND), 5)
    for place, query in enumerate(range(0, 500, 7)):
        products = v @ v[query]
        expected = sorted((-products[j], j) for j in range(500) if j != query)[:5]
        assert list(zip(score[q == place].tolist(), ids[q == place].tolist())) == [(-s, j) for s, j in expected]
