import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyspark.sql.functions as F
import pytest
from pyspark.sql.types import StructType
from support import LONG, base_by_hand, documents, near_by_hand, smallest_reachable
from tokenizers import Tokenizer

from tablewright.llm import bpe_codec, language_id, metric_join, mixing, ngram_join, personal_data, sharding, url_filter
from tablewright.llm.components import components
from tablewright.llm.exact_dedup import exact_distinct, exact_groups
from tablewright.llm.token_counts import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\t", "a", "A a", "é" * 30, LONG, "one two three four", "one two three four five", "日本語 ١٢ ½"]


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def empty_like(spark, df):
    return spark.createDataFrame([], StructType(df.schema.fields))


# 1


def test_url_rules(spark):
    urls = [
        "http://a.NET/x", "https://net/", "http://example.net/en/1", "http://x.example.net/EN/1", "http://example.com/de/",
        "http://example.com/de", "http://b.org/fr/z?q#r", "http://net", "http://net?x", "nothing", None, "", "://", "a://b://net/c",
        "http://notnet/x", "http://www.cheap-pills.info/x", "http://a.info/Cheap-Pills?imprint", "http://a.info/cheap-pillsx",
        "http://a.net/x", "http://example.net.evil.info/en/", "http://a.info/#spam-farm", "http://a.info/?u=http://b.net/",
    ]
    df = spark.createDataFrame([(i, u, "p", "q") for i, u in enumerate(urls)], "page_id int, url string, path string, u string")
    got = by_id(url_filter.url_verdicts(df), "page_id")
    expected = {
        0: ("a.net", "/x", "net/", "block"), 1: ("net", "/", "net/", "block"), 2: ("example.net", "/en/1", "example.net/en/", "allow"),
        3: ("x.example.net", "/EN/1", "net/", "block"), 4: ("example.com", "/de/", "example.com/de/", "block"),
        5: ("example.com", "/de", None, "allow"), 6: ("b.org", "/fr/z", "org/fr/", "allow"), 7: ("net", "", None, "allow"),
        8: ("net", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("", "", None, "allow"),
        12: ("", "", None, "allow"), 13: ("b:", "//net/c", None, "allow"), 14: ("notnet", "/x", None, "allow"),
        15: ("www.cheap-pills.info", "/x", None, "block"), 16: ("a.info", "/Cheap-Pills", None, "allow"),
        17: ("a.info", "/cheap-pillsx", None, "allow"), 18: ("a.net", "/x", "net/", "block"),
        19: ("example.net.evil.info", "/en/", None, "allow"), 20: ("a.info", "/", None, "block"), 21: ("a.info", "/", None, "allow"),
    }
    assert {k: (r["host"], r["path"], r["rule"], r["verdict"]) for k, r in got.items()} == expected
    assert all(r["u"] == "q" for r in got.values())
    assert url_filter.url_verdicts(empty_like(spark, df)).count() == 0
    assert url_filter.url_verdicts(df.union(df)).count() == 2 * len(urls)


def test_url_patterns_without_words_run_everywhere(spark):
    df = spark.createDataFrame([(0, "http://a.info/abc"), (1, "http://b.info/x")], "page_id int, url string")
    rules = [url_filter.Pattern("block", "ab")]
    got = by_id(url_filter.url_verdicts(df, [], rules), "page_id")
    assert (got[0]["verdict"], got[1]["verdict"]) == ("block", "allow")


# 2


def check_shards(rows, shards):
    groups = {}
    for r in rows:
        groups.setdefault(r["shard"], []).append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    for members in groups.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    return {k: sum(r["size"] for r in v) for k, v in groups.items()}


def test_shards_are_even(spark):
    rng = random.Random(3)
    texts = ["x" * rng.randint(0, 400) for _ in range(3000)] + ["same text"] * 1500 + ODD[:-1]
    sources = ["hot" if i % 3 else f"s{i % 7}" for i in range(len(texts))]
    sources[5] = None
    df = documents(spark, texts, source=sources)
    rows = sharding.sharded(df, shards=7).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(got) == len(texts)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        assert (got[i]["size"], got[i]["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    sums = check_shards([r for r in rows], 7)
    largest = max(r["size"] for r in rows)
    small = [v for k, v in sums.items() if not any(r["size"] == largest and r["shard"] == k for r in rows)]
    assert max(small) - min(small) < 0.02 * min(small) + 1000 or largest > min(small)


def test_shards_of_equal_rows_and_none(spark):
    df = documents(spark, [f"text {i}" for i in range(400)], source=["one"] * 400)
    sums = check_shards(sharding.sharded(df, shards=8).collect(), 8)
    assert len(sums) == 8 and max(sums.values()) - min(sums.values()) <= 60
    assert sharding.sharded(empty_like(spark, df), shards=4).count() == 0
    few = sharding.sharded(df.limit(2), shards=5).collect()
    assert len(few) == 2
    check_shards(few, 5)
    assert sharding.sharded(df, target_bytes=10**9).select("shard").distinct().count() == 1
    twice = sharding.sharded(df.union(df), shards=3).collect()
    assert len(twice) == 800
    check_shards(twice, 3)


def test_equal_texts_stay_together(spark):
    rng = random.Random(6)
    texts = [f"copy {i} " + "y" * rng.randint(0, 300) for i in range(60) for _ in range(rng.randint(1, 12))]
    texts += ["a third of all rows"] * 400 + ["z" * 200] * 500 + [f"own text {i}" * 9 for i in range(600)]
    rng.shuffle(texts)
    df = documents(spark, texts, lang=[rng.choice(["en", "de", None]) for _ in texts], source=[rng.choice("abc") for _ in texts])
    rows = sharding.sharded(df, shards=9).collect()
    sums = check_shards(rows, 9)
    shards_of, bytes_of = {}, {}
    for r in rows:
        text = texts[r["doc_id"]]
        shards_of.setdefault(text, set()).add(r["shard"])
        bytes_of[text] = bytes_of.get(text, 0) + r["size"]
    share = sum(sums.values()) / 9
    parted = {t for t, found in shards_of.items() if len(found) > 1}
    assert parted == {"z" * 200} and bytes_of["z" * 200] > share
    assert len(sums) == 9 and max(sums.values()) - min(sums.values()) < 0.1 * share


def test_tree_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TOLERANCE", 0)
    rng = random.Random(9)
    texts = [f"text {i} " + "w" * rng.randint(0, 500) for i in range(300)] + [f"text {i} " for i in range(0, 300, 7)]
    df = documents(spark, texts, lang=[rng.choice(["en", "de"]) for _ in texts], source=[rng.choice("abcd") for _ in texts])
    points = sharding._texts(sharding._keyed(sharding._points(df, "doc_id", "text", "source", "lang")))
    shares = [1.0, 2.0, 1.0, 0.0, 3.0, 1.5, 1.0]
    placed, _, numbers = sharding.kd_tree(points, shares)
    got = {bytes(r["text_key"]): numbers[r["leaf"]] for r in placed.collect()}
    rows = [(bytes(r["text_key"]), r["size"], tuple(r[d] for d in sharding.DIMENSIONS)) for r in points.collect()]
    extent = [max(max(r[2][d] for r in rows) - min(r[2][d] for r in rows), 1) for d in range(4)]

    def cut(members, a, b):
        if b - a == 1 or not members:
            return {m[0]: a for m in members}
        middle, total = (a + b) // 2, sum(m[1] for m in members)
        both = sum(shares[a:b])
        need = total * (sum(shares[a:middle]) / both if both else (middle - a) / (b - a))
        axis = max(range(4), key=lambda d: (max(m[2][d] for m in members) - min(m[2][d] for m in members)) / extent[d])
        members = sorted(members, key=lambda m: m[2][axis])
        reached, left = 0, 0
        for m in members:
            reached += m[1]
            left += 1
            if reached >= need:
                left -= reached - need > need - (reached - m[1])
                break
        return cut(members[:left], a, middle) | cut(members[left:], middle, b)

    assert got == cut(rows, 0, len(shares))


# 3


def test_base_spans_against_plain_expressions(spark):
    rng = random.Random(5)
    parts = ["a@b.c", "@", ".", "+", "-", " ", "1", "22", "255", "256", "4111111111111111", "4111 1111 1111 1111", "(", ")", "é", "😀",
             "x_y", "1.2.3.4", "+1 (017) 555-7713", "\n", "a.b@c-d.e.f", "%", "007", "9" * 40]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(600)]
    texts += ["a@b.com_x@y.z a@b.c@d.e", "1.2.3.4.5.6.7.8 1.2.3", "+" * 50, "a" * 20_000 + "@", "a@b" + ".c" * 20_000, "1 " * 5000, *ODD]
    texts += ["x@y.de 10.0.0.1 " * 900]
    got = by_id(personal_data.personal_spans(documents(spark, texts)))
    for i, text in enumerate(texts):
        base = base_by_hand(text)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest(), text[:200]
        for kind in ("email", "ip", "card", "phone"):
            assert got[i][f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        assert set(f"{k}:{a}:{b}" for k, a, b in base) <= set(got[i]["spans"].split(",")) | {""}


def test_weak_supervision_adds_spans(spark):
    texts = [f"Call me, phone (212) 555-01{i:02d} or mail me: user{i}@mail.example.com now" for i in range(60)]
    texts += [f"IBAN DE89 3704 0044 0532 0130 {i:02d} please" for i in range(40)]
    texts += [f"version a123 456 78{i:02d}9z build" for i in range(40)] + ["clean words only"] * 20
    got = by_id(personal_data.personal_spans(documents(spark, texts)))
    found = sum("national_phone:" in got[i]["spans"] for i in range(60))
    assert found >= 50
    assert all(got[i]["n_more"] == 0 for i in range(100, len(texts)))
    assert personal_data.personal_spans(empty_like(spark, documents(spark, ["a"]))).count() == 0


def test_secrets_are_found_and_plain_words_left(spark):
    secrets = [f"see password=4c8f80{i:02d}a3af39d897 now" for i in range(30)] + [f'token = "97ffa88d7c5f{i:02d}655e3650"' for i in range(30)]
    secrets += [f"key AKIAMD62HKU6VBLCC{i:03d} there" for i in range(30)] + ["-----BEGIN RSA PRIVATE KEY----- xyz", "my api_key: ab12cd34ef"]
    plain = ["the password: required here", "a token = something plain", "AKIA is a name", "passwords2024 are long", "secretly 12345678"] * 6
    base = [f"password=41111111111111{i:02d} a@b.com" for i in range(100)]  # some are card numbers
    got = by_id(personal_data.personal_spans(documents(spark, secrets + plain + base)))
    n = len(secrets)
    assert all(got[i]["n_found"] == 1 for i in range(n)), [i for i in range(n) if got[i]["n_found"] != 1]
    assert all(got[n + i]["n_found"] == 0 for i in range(len(plain)))
    for i in range(n + len(plain), n + len(plain) + len(base)):
        spans = [tuple(map(int, s.split(":")[1:])) for s in got[i]["spans"].split(",")]
        assert all(a[1] <= b[0] or b[1] <= a[0] for k, a in enumerate(spans) for b in spans[k + 1 :])
        assert got[i]["n_found"] == got[i]["n_more"] + sum(got[i][f"n_{k}"] for k in ("email", "ip", "card", "phone"))


def test_reliabilities_find_the_bad_labeler():
    # Labelers 0 to 2 agree with the truth, 3 contradicts it at random, 4 never votes.
    patterns = [("k", "22221", 450), ("k", "22201", 450), ("k", "00001", 50), ("k", "00021", 50), ("k", "20221", 5)]
    sure = personal_data.reliabilities(patterns)
    assert sure["k", "22201"] > 0.95 and sure["k", "00021"] < 0.05


# 4


@pytest.mark.parametrize("digest", [None, lambda text: F.unhex(F.lpad(F.hex(F.length(text)), 8, "0"))])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups(spark, keep, digest):
    texts = ["b", "a", "b", None, "", "c", "b", "é", "é", "ab", "ba", "ab", LONG, LONG, "e"]
    df = documents(spark, texts)
    got = by_id(exact_groups(df, keep=keep, **({"digest": digest} if digest else {})))
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        group = [j for j, t in enumerate(texts) if (t or "") == (text or "")]
        stays = (min if keep == "smallest" else max)(group)
        assert got[i] == {
            "doc_id": i, "keep_id": stays, "group_size": len(group), "kept": i == stays,
            "text_sha256": hashlib.sha256((text or "").encode()).hexdigest(),
        }
    kept = sorted(r["doc_id"] for r in exact_distinct(df, keep=keep).collect())
    assert kept == sorted({got[i]["keep_id"] for i in got})


def test_exact_odd_rows(spark):
    df = documents(spark, ["a", "a", "a", "b", "b", "c"], ids=[1, 1, 0, None, None, None])
    rows = exact_groups(df).collect()
    assert len(rows) == 6 and sum(r["group_size"] == 3 for r in rows) == 3
    out = exact_distinct(df).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in out) == [("0", "a"), ("None", "b"), ("None", "c")]
    out = exact_distinct(df, keep="largest")
    assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == [("1", "a"), ("None", "b"), ("None", "c")]
    assert out.columns == df.columns
    assert exact_distinct(empty_like(spark, df)).count() == exact_groups(empty_like(spark, df)).count() == 0


# 5


def spoken(words, n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choices(words, k=n))


WORDS = {
    "en": "the and of that with from whether thing through would there when".split(),
    "de": "der und nicht auch schon zwischen wird über durch keit ung sich".split(),
    "fr": "le est une dans pour que avec sur où était être leur nous".split(),
    "es": "el una los para como está años también donde mañana según".split(),
}


def test_language_from_text_and_other_evidence(spark):
    langs = [k for k in WORDS for _ in range(60)]
    texts = [spoken(WORDS[k], 40, i) for i, k in enumerate(langs)]
    texts += [spoken(WORDS["de"], 40, 1), "", None, "\u4e2d\u6587\u5b57\u7b26\u4e32" * 40, "qzx" * 200, "die"]
    langs += ["fr", "es", None, None, None, None]
    hosts = ["h"] * len(texts)
    df = documents(spark, texts, lang=langs, source=hosts)
    rows = language_id.document_rows(df)
    got = by_id(language_id.language_posteriors(rows), "id")
    assert all(got[i]["language"] == langs[i] for i in range(240))
    assert got[240]["language"] == "de"  # the text outweighs the declaration
    assert got[241]["language"] == "es" and not got[241]["rejected"]  # no text: the declaration decides
    assert not got[242]["rejected"]
    assert got[243]["rejected"] and got[244]["rejected"]
    kept = language_id.in_known_language(df)
    assert kept.columns == df.columns and kept.count() == len(texts) - 2
    assert language_id.in_known_language(empty_like(spark, df)).count() == 0


def test_host_and_suffix_decide_short_texts(spark):
    texts = [spoken(WORDS["de"], 40, i) for i in range(50)] + [spoken(WORDS["en"], 40, i) for i in range(50)] + ["", "", ""]
    rows = [(i, ["de", "en"][i >= 50] if i < 100 else None, None, ["www.x.org", "y.org"][50 <= i < 100], t) for i, t in enumerate(texts)]
    rows[101] = (101, None, "en", "www.x.org", "")
    rows[102] = (102, None, None, "new.x.org", "")
    df = spark.createDataFrame(rows, "id bigint, declared string, suffix string, host string, body string")
    got = by_id(language_id.language_posteriors(df), "id")
    assert got[100]["language"] == "de" and got[102]["language"] == "de"
    assert got[101]["confidence"] < got[100]["confidence"]


def test_pages_as_evidence(spark):
    html = '<html lang="de"><script>var the="and";</script><body><p>der &amp; die</p><!-- the --></body></html>'
    df = spark.createDataFrame([(0, "http://www.a.fr/x", html), (1, None, None)], "page_id bigint, url string, html string")
    got = by_id(language_id.page_rows(df), "id")
    assert (got[0]["declared"], got[0]["suffix"], got[0]["host"]) == ("de", "fr", "www.a.fr")
    assert got[0]["body"].split() == ["der", "die"]
    assert got[1] == {"id": 1, "declared": None, "suffix": None, "host": None, "body": ""}


# 6


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, id string, node int")


def by_cosine(rows, least=0.93):
    sound = {}
    for i, v, label, *_ in rows:
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        sound[i] = (label, np.array(v, dtype=np.float32).astype(float))
    linked = []
    for a, (la, x) in sound.items():
        for b, (lb, y) in sound.items():
            if a < b and la == lb and len(x) == len(y):
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                    linked.append((a, b))
    component = smallest_reachable([r[0] for r in rows], linked)
    links = {r[0]: 0 for r in rows}
    for a, b in linked:
        links[a] += 1
        links[b] += 1
    return {i: (links[i], component[i], component[i] == i) for i in links}


@pytest.mark.parametrize("block, sample", [(2048, 64), (7, 6)])
def test_vector_groups(spark, monkeypatch, block, sample):
    monkeypatch.setattr(metric_join, "BLOCK", block)
    monkeypatch.setattr(metric_join, "SAMPLE", sample)
    rng = np.random.default_rng(1)
    rows = []
    for c in range(12):
        centre = rng.normal(size=6)
        for _ in range(25):
            rows.append([len(rows), (centre + rng.normal(size=6) * 0.25).tolist(), c % 2, "x", 1])
    same = rng.normal(size=6).tolist()
    rows += [[len(rows) + i, same, 0, "x", 1] for i in range(40)]
    odd = [None, [], [0.0] * 6, [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [float("inf")] * 6, same, [2 * x for x in same], same[:5], [1e-30] * 6]
    rows += [[len(rows) + i, v, 0, "x", 1] for i, v in enumerate(odd)]
    rows += [[len(rows), same, None, "x", 1]]
    df = vectors(spark, rows).repartition(5)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in metric_join.vector_groups(df).collect()}
    assert got == by_cosine(rows)


def test_clustered_vectors_are_cut(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "BLOCK", 16)
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=3).tolist(), 1, "1") for i in range(900)]
    classes = spark.createDataFrame(rows, "node bigint, vector array<float>, copies bigint, label string")
    cells = metric_join._partitioned(classes, metric_join.radius(0.998))
    work = metric_join._work(cells).collect()
    assert sum(r["residents"] for r in work) == 900
    assert sum(r["residents"] * r["members"] for r in work) < 0.15 * 900**2


def test_vector_odd_tables(spark):
    rows = [[3, [1.0, 0.0], 1, "x", 1], [3, [1.0, 0.0], 1, "x", 1], [None, [1.0, 0.01], 1, "x", 1]]
    got = sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in metric_join.vector_groups(vectors(spark, rows)).collect())
    assert got == [("3", 2, 3), ("3", 2, 3), ("None", 2, 3)]
    assert metric_join.vector_groups(vectors(spark, rows).limit(0)).count() == 0


# 7


def family(rng, size, copies, changes):
    words = [f"w{rng.randint(0, 5000)}" for _ in range(size)]
    out = []
    for _ in range(copies):
        text = list(words)
        for _ in range(rng.randint(0, changes)):
            text[rng.randrange(size)] = f"v{rng.randint(0, 10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("part, share", [(1024, 0.002), (4, 0.05)])
def test_near_groups(spark, monkeypatch, part, share):
    monkeypatch.setattr(ngram_join, "PART", part)
    monkeypatch.setattr(ngram_join, "HOT_SHARE", share)
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = list(ODD)
    for _ in range(40):
        texts += family(rng, rng.randint(5, 120), rng.randint(1, 6), 8)
    texts += family(rng, 150, 60, 9)
    texts += [f"{passage} " + " ".join(f"x{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 80))) for _ in range(60)]
    texts += ["one two  Three\tfour", "ONE two three four", "A b c d e f", "a B c d e f"]
    texts += [texts[30]] * 50
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_groups(documents(spark, texts).repartition(6)).collect()}
    assert got == near_by_hand(list(enumerate(texts)))


def test_near_odd_tables(spark):
    df = documents(spark, ["a b c d e f", "a b c d e f", "x", "a b c d e f"], ids=[5, 5, 4, None])
    rows = sorted((str(r["doc_id"]), r["component_id"]) for r in ngram_join.near_groups(df).collect())
    assert rows == [("4", 4), ("5", 5), ("5", 5), ("None", 5)]
    assert ngram_join.near_groups(empty_like(spark, df)).count() == 0
    assert ngram_join.near_groups(documents(spark, [None, "", " "])).count() == 3
    out = ngram_join.near_distinct(documents(spark, ["a b c d e f", "a b c d e f g", "z", None, ""]))
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 2, 3, 4] or sorted(r["doc_id"] for r in out.collect()) == [0, 1, 2, 3, 4]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 180)] + [(5, i) for i in range(200, 260)] + [(7, 7), (300, 301), (301, 300)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    expected = smallest_reachable({x for e in edges for x in e if e[0] != e[1]}, edges[:0] + [e for e in edges if e[0] != e[1]])
    assert got == expected


# 8 and 10


def byte_texts():
    rng = random.Random(6)
    texts = [x for x in ODD]
    texts += ["<|endoftext|>", "a<|endoftext|> <|endoftext|>b\n", "aaaa" * 300, "it's I'LL we've", " \u3000 z\x85c\x1cd"]
    return texts + ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0xD7FF)])) for _ in range(300)) for _ in range(30)]


def test_token_counts(spark):
    texts = byte_texts()
    library = Tokenizer.from_file(PATH)
    got = by_id(token_counts(documents(spark, texts), PATH))
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert got[i] == {"doc_id": i, "n_bytes": len((text or "").encode()), "n_tokens": n, "over_limit": n > 1024}
    assert token_counts(empty_like(spark, documents(spark, [""])), PATH).count() == 0


def test_codec(spark):
    texts = byte_texts()
    library = Tokenizer.from_file(PATH)
    df = documents(spark, texts)
    ids = by_id(bpe_codec.encoded(df, PATH))
    back = by_id(bpe_codec.decoded(bpe_codec.encoded(df, PATH), PATH))
    digests = by_id(bpe_codec.round_trip(df, PATH))
    for i, text in enumerate(texts):
        expected = library.encode(text or "", add_special_tokens=False).ids
        again = library.decode(expected, skip_special_tokens=False)
        assert ids[i]["ids"] == expected and back[i]["text"] == again
        raw = np.array(expected, dtype="<u4").tobytes()
        assert digests[i] == {
            "doc_id": i, "n_tokens": len(expected), "ids_sha256": hashlib.sha256(raw).hexdigest(),
            "decoded_sha256": hashlib.sha256(again.encode()).hexdigest(),
        }
    assert bpe_codec.round_trip(empty_like(spark, df), PATH).count() == 0


def test_ids_that_fill_a_frame_with_the_last_text(spark):
    # Nothing is left of the batch for a last frame then.
    texts = ["one", " a" * bpe_codec.IDS, "two", " a" * bpe_codec.IDS]
    out = bpe_codec.encoded(documents(spark, texts).coalesce(1), PATH).select("doc_id", F.size("ids").alias("n"), F.array_distinct("ids").alias("of"))
    library = Tokenizer.from_file(PATH)
    expected = [library.encode(t[:3], add_special_tokens=False).ids[:1] for t in texts]
    assert [(r["n"], r["of"]) for r in out.orderBy("doc_id").collect()] == [
        (n, ids) for n, ids in zip([1, bpe_codec.IDS, 1, bpe_codec.IDS], expected, strict=True)
    ]


def test_decoding_cut_characters():
    worker = bpe_codec.encoder(PATH)
    library = Tokenizer.from_file(PATH)
    ids = next(worker.encode(["日本語"]))
    some = np.frombuffer(ids, dtype="<u4").tolist()[:-1]
    assert worker.decode(ids[:-4]) == library.decode(some, skip_special_tokens=False)


def test_words_beyond_the_memory(spark, monkeypatch):
    monkeypatch.setattr(bpe_codec, "REMEMBERED", 5)
    monkeypatch.setattr("tablewright.llm.token_counts.REMEMBERED", 5)
    texts = [f"word{i} some other words{i}" for i in range(50)]
    library = Tokenizer.from_file(PATH)
    worker = bpe_codec.Encoder(bpe_codec.vocabulary(PATH))
    for _ in range(3):
        for text, ids in zip(texts, worker.encode(texts), strict=True):
            assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(text).ids


# 9


def test_mixture_against_brute_force(spark):
    rng = random.Random(12)
    texts = ["w " * rng.randrange(0, 40) for _ in range(900)]
    sources = [rng.choice(["hot"] * 12 + ["b", "c", "c", None]) for _ in texts]
    df = documents(spark, texts, source=sources).withColumn("mix_block", F.lit("clash"))
    seed, block_tokens, limit, target = 5, 60, 2.3, 0.9
    counts = {}
    for t, s in zip(texts, sources):
        counts[s] = counts.get(s, 0) + len(t.split())
    shares = {s: n / sum(counts.values()) for s, n in counts.items()}

    def weights(a):
        raised = {s: p**a for s, p in shares.items()}
        return {s: w / sum(raised.values()) for s, w in raised.items()}

    def entropy(a):
        return -sum(w * math.log(w) for w in weights(a).values())

    def repeats(a):
        return (max(shares.values()) / min(shares.values())) ** (1 - a)

    grid = [i / 200_000 for i in range(200_001)]
    a = max(x for x in grid if entropy(x) >= target * entropy(0.0)) if entropy(1.0) < target * entropy(0.0) else 1.0
    if repeats(a) > limit:
        a = min(x for x in grid if repeats(x) <= limit)
    out = mixing.mixed(df, seed=seed, block_tokens=block_tokens, max_repeats=limit, target_entropy=target)
    assert out.columns.count("mix_block") == 1
    plan = {r["source"]: r for r in out.groupBy("source").agg(F.first("mix_source_weight").alias("w")).collect()}
    for s, w in weights(a).items():
        assert abs(plan[s]["w"] - w) < 1e-4
    # The same blocks and places, taken one by one.
    blocks = F.create_map(*[x for s, n in counts.items() if s is not None for x in (F.lit(s), F.lit(-(-n // block_tokens)))])
    number = F.coalesce(blocks[F.col("source")], F.lit(-(-counts[None] // block_tokens)))
    key = mixing._key("doc_id", seed)
    exact = mixing.mixture_plan(
        df.select("source", key.alias("key"), mixing.n_words("text").alias("n_tokens")), target, limit, None, block_tokens, seed
    )
    plans = {r["source"]: (r["whole"], r["need"]) for r in exact.collect()}
    wholes = F.create_map(*[x for s, (w, _) in plans.items() if s is not None for x in (F.lit(s), F.lit(w))])
    whole = F.coalesce(wholes[F.col("source")], F.lit(plans[None][0]))
    block = mixing._block(key, number.cast("bigint"))
    rows = df.select("doc_id", "source", "text", key.alias("key"), block.alias("block"), mixing._place(F.col("source"), block, whole.cast("bigint"), seed).alias("place")).collect()
    expected = {}
    for s, (times, need) in plans.items():
        left = need
        mine = sorted((r for r in rows if r["source"] == s), key=lambda r: (r["place"], r["block"], r["key"]))
        stopped = need <= 0
        for at in sorted({(r["place"], r["block"]) for r in mine}):
            members = [r for r in mine if (r["place"], r["block"]) == at]
            tokens = sum(len(r["text"].split()) for r in members)
            for r in members:
                expected[r["doc_id"]] = times
            if stopped:
                continue
            if tokens > left:
                for r in members:
                    left -= len(r["text"].split())
                    if left < 0:
                        break
                    expected[r["doc_id"]] += 1
                stopped = True
            else:
                left -= tokens
                for r in members:
                    expected[r["doc_id"]] += 1
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in expected.items() if v}
    assert len(set(got.values())) > 1


def mix_table(spark):
    texts, sources = [], []
    for source, n in (("big", 900), ("middle", 300), ("small", 60), (None, 120)):
        texts += [f"{source} words and more {i}" + " x" * (i % 9) for i in range(n)]
        sources += [source] * n
    return documents(spark, [*texts, "", None], source=[*sources, "void", "void"])


def realised(df, source="source"):
    rows = df.withColumn("n", mixing.n_words("text")).groupBy(source).agg(F.sum("n").alias("t"), F.count("*").alias("c"))
    return {r[source]: (r["t"], r["c"]) for r in rows.collect()}


def test_repetition_limit(spark):
    df = mix_table(spark)
    before = realised(df)
    out = mixing.mixed(df, target_entropy=1.0, max_repeats=3.0, block_tokens=200)
    after = realised(out)
    assert out.columns[: len(df.columns)] == df.columns
    assert {k: after[k][0] for k in ("big", "void")} == {k: before[k][0] for k in ("big", "void")}
    least = min((t for t, _ in before.values() if t))
    most = max(t for t, _ in before.values())
    a = 1 - math.log(3) / math.log(most / least)
    for source, (tokens, _) in before.items():
        if tokens:
            aim = tokens * (tokens / most) ** (a - 1)
            assert aim - 15 <= after[source][0] <= aim + 1
    counts = out.groupBy("doc_id").count().agg(F.min("count"), F.max("count")).first()
    assert tuple(counts) == (1, 3)
    # Within an epoch every document occurs once.
    assert out.groupBy("doc_id", "mix_epoch").count().filter("count > 1").count() == 0


def test_entropy_target_and_budget(spark):
    df = mix_table(spark)
    slim = df.select("source", F.xxhash64("doc_id").alias("key"), mixing.n_words("text").alias("n_tokens"))
    plan = mixing.mixture_plan(slim, target_entropy=0.95, max_repeats=100.0)
    weights = [r["weight"] for r in plan.collect() if r["weight"]]
    assert abs(sum(weights) - 1) < 1e-9
    entropy = -sum(w * math.log(w) for w in weights) / math.log(len(weights))
    assert 0.95 <= entropy < 0.9501
    budget = 2000
    after = realised(mixing.mixed(df, target_entropy=0.0, max_repeats=100.0, budget=budget, block_tokens=100))
    total = sum(t for t, _ in after.values())
    assert budget - 15 * 4 <= total <= budget
    assert mixing.mixed(empty_like(spark, df)).count() == 0
    again = mixing.mixed(df.repartition(7), max_repeats=2.5).select("doc_id", "mix_epoch").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, mixing.mixed(df, max_repeats=2.5).select("doc_id", "mix_epoch").collect()))
