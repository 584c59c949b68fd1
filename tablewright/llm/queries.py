"""The dealt operators as queries over whole tables, with the parameters they would run with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.queries.registry import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the tables and, where there is one, the SQL that gives the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_HOST = """translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
_REST = "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*(.*)', 1), '')"


def _under(host: str) -> str:
    return f"(host = '{host}' or ends_with(host, '.{host}'))"


@query(
    "op1_url_filter",
    f"""
    with parts as (select page_id, {_HOST} as host, {_REST} as rest from pages),
    addresses as (select *, regexp_extract(rest, '(?s)^([^?#]*)', 1) as path from parts),
    ruled as (
        select *, case
            when {_under("example.net")} and starts_with(path, '/en/') then 'example.net/en/'
            when {_under("example.com")} and starts_with(path, '/de/') then 'example.com/de/'
            when {_under("org")} and starts_with(path, '/fr/') then 'org/fr/'
            when {_under("net")} and starts_with(path, '/') then 'net/' end as rule
        from addresses)
    select page_id, host, path, rule, case
        when rule in ('example.net/en/', 'org/fr/') then 'allow'
        when rule is not null then 'block'
        when regexp_matches(lower(host || rest), '(^|[^a-z0-9])imprint([^a-z0-9]|$)') then 'allow'
        when regexp_matches(lower(host || rest),
            '(^|[^a-z0-9])(cheap-pills|spam-farm|casino|adserver|free-money)([^a-z0-9]|$)') then 'block'
        else 'allow' end as verdict
    from ruled
    """,
)
def op1_url_filter(t: Tables) -> DataFrame:
    from tablewright.llm.url_filter import url_verdicts

    return url_verdicts(t.pages.select("page_id", "url")).drop("url")


@query(
    "op4_exact_dedup",
    """
    with d as (select doc_id, coalesce(text, '') as body from documents),
    g as (select body, max(doc_id) as keep_id, count(*) as group_size from d group by body)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
    from d join g using (body)
    """,
)
def op4_exact_dedup(t: Tables) -> DataFrame:
    from tablewright.llm.exact_dedup import exact_groups

    return exact_groups(t.documents, keep="largest")


@query("op8_token_counts")
def op8_token_counts(t: Tables) -> DataFrame:
    from tablewright.llm.token_counts import token_counts

    return token_counts(t.documents, vocabulary_path(), limit=1024)


@query("op10_bpe_codec")
def op10_bpe_codec(t: Tables) -> DataFrame:
    from tablewright.llm.bpe_codec import round_trip

    return round_trip(t.documents, vocabulary_path())


@query("op2_sharding")
def op2_sharding(t: Tables) -> DataFrame:
    from tablewright.llm.sharding import sharded

    return sharded(t.documents, shards=40)


@query("op3_personal_data")
def op3_personal_data(t: Tables) -> DataFrame:
    from tablewright.llm.personal_data import personal_spans

    return personal_spans(t.documents)


@query("op5_language_id")
def op5_language_id(t: Tables) -> DataFrame:
    from tablewright.llm.language_id import document_rows, language_posteriors

    out = language_posteriors(document_rows(t.documents)).withColumnRenamed("id", "doc_id")
    return out.withColumn("kept", ~F.col("rejected"))


@query("page_language")
def page_language(t: Tables) -> DataFrame:
    from tablewright.llm.language_id import language_posteriors, page_rows

    return language_posteriors(page_rows(t.pages)).withColumnRenamed("id", "page_id")


@query("op7_ngram_join")
def op7_ngram_join(t: Tables) -> DataFrame:
    from tablewright.llm.ngram_join import near_groups

    return near_groups(t.documents).drop("text_key")


@query("op9_mixing")
def op9_mixing(t: Tables) -> DataFrame:
    from tablewright.llm.mixing import mixed, n_words

    rows = t.documents.select("doc_id", "source", "text")
    return mixed(rows).withColumn("n_tokens", n_words("text")).drop("text")


@query(
    "op6_metric_join",
    """
    with recursive sound as (
        select vec_id, label, embedding::double[] as v from embeddings
        where label is not null and embedding is not null and len(embedding) > 0
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links as (
        select a.vec_id as a, b.vec_id as b from sound a join sound b
        on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
            and list_cosine_similarity(a.v, b.v) >= 0.93),
    reach(vec_id, other) as (
        select vec_id, vec_id from embeddings
        union
        select r.vec_id, l.b from reach r join links l on l.a = r.other),
    least as (select vec_id, min(other) as component_id from reach group by vec_id),
    counts as (select a, count(*) as n from links group by a)
    select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
    from least left join counts on a = vec_id
    """,
)
def op6_metric_join(t: Tables) -> DataFrame:
    from tablewright.llm.metric_join import vector_groups

    return vector_groups(t.embeddings, cosine=0.93)


# CRC-32 of the bytes of b, by the table of the CRC step of each byte.
_CRC_TABLE = """select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by i) as crcs
    from range(256) r(i)"""
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(range(octet_length(b)), lambda i: ('0x' || substr(hex(b), 2 * i + 1, 2))::bigint)),
    lambda c, x: xor(c >> 8, crcs[1 + (xor(c, x) & 255)])), 4294967295)"""


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op11_spelling",
    f"""
    with recursive crc_table as materialized ({_CRC_TABLE}),
    runs as (
        select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all({_lower("text")}, '[a-zÀ-ÿ]+')) as run
        from documents),
    counted as (select id, run, count(*) as n from runs where length(run) >= 7 group by all),
    drawn as materialized (
        select run, n, {_CRC} as h from (select *, encode(id || ':' || run) as b from counted), crc_table),
    lost as (
        select n, case when h % 31 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word
        from drawn),
    words as materialized (
        select word, sum(n)::bigint as n from lost where length(word) >= 7 group by word having sum(n) >= 2),
    skips as materialized (
        select word, n, i, word[:i] as head, word[i + 2:] as tail
        from (select word, n, unnest(range(length(word))) as i from words)),
    near as materialized (
        select a.word, b.word as other, b.n as other_n from skips a
        join skips b on a.i = b.i and a.head = b.head and a.tail = b.tail and a.word <> b.word
        union
        select s.word, w.word, w.n from skips s join words w on w.word = s.head || s.tail
        union
        select w.word, s.word, s.n from skips s join words w on w.word = s.head || s.tail),
    best as (
        select word, count(*) as n_near, max(other_n) as top_n from near group by word),
    formed as materialized (
        select w.word, w.n, coalesce(n_near, 0) as n_near,
            case when top_n >= 10 * w.n then top_n end as form_n,
            case when top_n >= 10 * w.n then
                (select min(other) from near x where x.word = w.word and x.other_n = top_n) end as form
        from words w left join best using (word)),
    steps(word, last) as (
        select word, word from formed
        union all
        select s.word, f.form from steps s join formed f on f.word = s.last where f.form is not null),
    roots as (select s.word, s.last as root from steps s join formed f on f.word = s.last where f.form is null)
    select word, form, root, n, n_near, form_n from formed join roots using (word)
    """,
)
def op11_spelling(t: Tables) -> DataFrame:
    from tablewright.llm.spelling import spelling_forms

    return spelling_forms(t.documents)


_WORDS = f"regexp_extract_all({_lower('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op12_importance",
    f"""
    with crc_table as materialized ({_CRC_TABLE}),
    worded as (
        select 's' as side, doc_id as id, {_WORDS} as w from documents
        union all select 't', item_id, {_WORDS} from benchmark),
    features as materialized (
        select side, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as f
        from worded),
    bucketed as materialized (
        select f, {_CRC} % 10000 as bucket
        from (select f, encode(f) as b from (select distinct f from features)), crc_table),
    placed as materialized (select side, id, bucket from features join bucketed using (f)),
    sums as (select bucket, count(*) filter (side = 's') as s, count(*) filter (side = 't') as t from placed group by bucket),
    gains as (
        select bucket, floor(1000 * ln(((t + 1)::double * ((select sum(s) from sums) + 10000)::double)
            / ((s + 1)::double * ((select sum(t) from sums) + 10000)::double)))::bigint as gain from sums),
    per_doc as (
        select id as doc_id, count(*) as n_features, sum(gain) as total
        from placed join gains using (bucket) where side = 's' group by id),
    weighed as (
        select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features,
            case when n_features > 0 then (total - ((total % n_features) + n_features) % n_features) // n_features else 0 end::bigint as weight,
            ('0x' || substr(sha256('7:' || doc_id), 1, 8))::bigint as h
        from (select id as doc_id, w from worded where side = 's') left join per_doc using (doc_id)),
    scored as (
        select *, weight + floor(-1000.0::double * ln(-ln((h + 0.5)::double / 4294967296.0::double)))::bigint as score from weighed),
    ranked as (
        select doc_id, row_number() over (order by score desc, doc_id) as place from scored where n_words >= 20)
    select s.doc_id, n_features, weight, score,
        case when place <= (select count(*) from ranked) * 25 // 100 then place end as rank
    from scored s left join ranked using (doc_id)
    """,
)
def op12_importance(t: Tables) -> DataFrame:
    from tablewright.llm.importance import resampled

    return resampled(t.documents, t.benchmark)


@query(
    "op13_top_products",
    """
    with sound as (
        select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (
        select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
        from sound q join sound c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0),
    ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
    select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
)
def op13_top_products(t: Tables) -> DataFrame:
    from tablewright.llm.top_products import top_products

    return top_products(t.embeddings)
