"""Personal data: exact base spans, and further spans found by weak supervision.

Base spans are the leftmost non-overlapping matches of one expression per kind that pass that kind's test; they always
stay. The expressions below give the same spans in time linear in the text: where a run of characters can only match
from its start, a look-behind says so, and loops never give back what they took. Offsets are running sums of the
lengths (in code points) of matches and of what lies between them.

Further spans are candidates of other shapes (account numbers, national phone numbers and ids, e-mail addresses spelt
out, access keys, passwords and tokens that are assigned in the text). On every candidate, base shapes included, labelers vote for, against or not at all: a strict expression, a
gazetteer of prefixes and endings, context words before it, its borders, and a check of digits. Expectation
maximisation over the counts of vote patterns estimates how reliable each labeler is, and a logistic regression on the
candidate's shape, fitted to the resulting soft labels, decides. Patterns are strings of a few fixed codes, so what
reaches the driver is bounded by their number, whatever the number of spans; all rows are counted.

A null text counts as empty and has no spans. Rows are judged one by one; repeated rows repeat. A further span that
overlaps a base span is left out; of candidates that overlap each other the leftmost counts, at one place the kind that
is listed first. Texts of any length are read whole. With an empty table no pattern is found and nothing is fitted. Only id
and text are read, so names of other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.shared import text_or_empty, written

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("account", "national_phone", "national_id", "spelt_email", "access_key", "secret")

_LOCAL = "[A-Za-z0-9._%+-]"
# How keys of well-known services begin and how long they are, and names that secrets are given to.
_KEYS = (
    "A(?:KIA|SIA|GPA|IDA|ROA|NPA|NVA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|AIza[A-Za-z0-9_-]{35}|"
    "xox[abprs]-[A-Za-z0-9-]{10,200}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,64}|glpat-[A-Za-z0-9_-]{20}|"
    "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
)
_SECRET_NAMES = (
    "[Pp]ass(?:word|wd|phrase|wort)|PASSWORD|[Pp]wd|[Ss]ecret(?:[_-]?[Kk]ey)?|SECRET|[Tt]oken|TOKEN|"
    "[Aa]pi[_-]?[Kk]ey|API[_-]?KEY|[Cc]ontraseña|[Mm]ot de passe"
)
EXPRESSIONS = {
    # From the start of a run of address characters, or where the match before ended inside one.
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A whole run of digits with single separators; other lengths fail the test anyway.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9](?:[ ().-]*+[0-9]){7,14}(?![ ().-]*+[0-9])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "national_phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "national_id": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "spelt_email": r"[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}"
    r"(?:(?: ?[\[(](?:dot|DOT)[\])] ?|\.)[A-Za-z0-9-]{1,63}){1,4}",
    "access_key": rf"(?<![A-Za-z0-9])(?:{_KEYS})(?![A-Za-z0-9])",
    # A value with a digit that is given to a name.
    "secret": rf"(?<![A-Za-z0-9])(?:{_SECRET_NAMES})[\"']?\s{{0,2}}[=:]\s{{0,2}}[\"']?"
    r"(?=[^\s\"']{0,200}[0-9])[A-Za-z0-9+/_=.!#$%&*-]{8,200}+",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Gazetteers and context words; fixed values.
# Any ending of two letters is a country's.
_ENDINGS = (
    r"(?i)[.](?:[a-z]{2}|com|org|net|edu|gov|mil|int|info|biz|name|pro|museum|coop|aero|jobs|mobi|travel|tel|cat|asia|post|"
    r"app|dev|blog|cloud|email|online|shop|site|store|tech|xyz|page|live|news|world|agency|company|group|network|systems)$"
)
_COUNTRY_CODES = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"
# Countries whose account numbers have this form.
_ACCOUNT_COUNTRIES = (
    "^(?:AD|AE|AL|AT|AZ|BA|BE|BG|BH|BR|BY|CH|CR|CY|CZ|DE|DK|DO|EE|EG|ES|FI|FO|FR|GB|GE|GI|GL|GR|GT|HR|HU|IE|IL|IQ|IS|IT|JO|"
    "KW|KZ|LB|LC|LI|LT|LU|LV|LY|MC|MD|ME|MK|MR|MT|MU|NL|NO|PK|PL|PS|PT|QA|RO|RS|SA|SC|SE|SI|SK|SM|ST|SV|TL|TN|TR|UA|VA|VG|XK)"
)
_FOR_WORDS = (
    r"(?i)\b(?:e-?mail|mail|contact|kontakt|contacto|tel|phone|telefon|t[ée]l[ée]phone|tel[ée]fono|call|fax|mobile|card|"
    r"karte|carte|tarjeta|visa|iban|konto|compte|cuenta|account|ssn|id|ip|host|address|adresse)\b[^A-Za-z]{0,6}$"
)
_AGAINST_WORDS = r"(?i)\b(?:version|v|isbn|page|seite|p|fig|order|no|nr|sku|build|release|sha|token|hash)\b[^A-Za-z]{0,6}$"
LABELERS = 5
LEFT, RIGHT = 32, 2
BLOCK = 512


def running_totals(lengths: Column) -> Column:
    """Sums up to and with each item. In blocks, since an array that grows item by item is copied each time."""

    def within(items: Column, start: Column) -> Column:
        state = F.struct(F.array().cast("array<bigint>").alias("out"), start.cast("bigint").alias("sum"))
        return F.aggregate(
            items,
            state,
            lambda a, x: F.struct(
                F.concat(a["out"], F.array(a["sum"] + x)).alias("out"), (a["sum"] + x).cast("bigint").alias("sum")
            ),
            lambda a: a["out"],
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / F.lit(BLOCK)).cast("int")),
        lambda b: within(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0)),
    )
    ends = within(F.transform(blocks, lambda b: F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0))), F.lit(0))
    shifted = F.zip_with(
        blocks,
        F.concat(F.array(F.lit(0).cast("bigint")), ends),
        lambda b, base: F.transform(F.coalesce(b, F.array().cast("array<bigint>")), lambda x: x + base),
    )
    return F.when(F.size(lengths) > 0, F.flatten(shifted)).otherwise(F.array().cast("array<bigint>"))


def _located(df: DataFrame, body: str, expression: str, name: str) -> DataFrame:
    """Add ``name``: an array of (start, end, hit, left, right) for all matches, in order."""
    hits, gaps, ends = f"{name}_hits", f"{name}_gaps", f"{name}_ends"
    df = df.withColumn(hits, F.regexp_extract_all(body, F.lit(expression), F.lit(0)))
    df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.split(body, expression, -1)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(
        ends,
        running_totals(
            F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: (F.length(g) + F.length(h)).cast("bigint"))
        ),
    )
    found = F.transform(
        hits,
        lambda h, i: F.struct(
            (F.get(ends, i) - F.length(h)).alias("start"),
            F.get(ends, i).alias("end"),
            h.alias("hit"),
            F.right(F.get(gaps, i), F.lit(LEFT)).alias("left"),
            F.left(F.get(gaps, i + 1), F.lit(RIGHT)).alias("right"),
        ),
    )
    return df.withColumn(name, found).drop(hits, gaps, ends)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _passes(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", _digits(hit))
    return F.lit(True)


def _test_of(kind: str) -> Callable[[Column], Column]:
    return lambda x: _passes(kind, x["hit"])


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


def _named(kind: str) -> Callable[[Column], Column]:
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))


def base_spans(df: DataFrame, body: str) -> DataFrame:
    """Add ``base``: an array of (kind, start, end) by kind, then start."""
    for kind in BASE_KINDS:
        df = _located(df, body, EXPRESSIONS[kind], f"__{kind}")
        df = df.withColumn(
            f"__{kind}",
            F.transform(
                F.filter(f"__{kind}", _test_of(kind)),
                _named(kind),
            ),
        )
    arrays = [f"__{kind}" for kind in BASE_KINDS]
    return df.withColumn("base", F.concat(*arrays)).drop(*arrays)


def _vote(positive: Column, negative: Column) -> Column:
    return F.when(positive, "2").when(negative, "0").otherwise("1")


def candidates(df: DataFrame, body: str) -> DataFrame:
    """Add ``candidates``: an array of (kind, start, end, votes, shape)."""
    kinds = [*BASE_KINDS, *MORE_KINDS]
    either = "|".join(f"(?:{EXPRESSIONS[k]})" for k in kinds)
    df = _located(df, body, either, "__all")

    def kind_of(hit: Column) -> Column:
        shape = F.lit(None).cast("string")
        tests = {
            "email": "@",
            "access_key": rf"^(?:{_KEYS})$",
            "secret": f"^(?:{_SECRET_NAMES})",
            "spelt_email": r"[\[(](?:at|AT)[\])]",
            "phone": r"^\+",
            "account": "^[A-Z]{2}[0-9]{2}",
            "ip": r"^[0-9]+(?:\.[0-9]+){3}$",
            "national_id": "^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
            "card": "^[0-9](?:[ -]?[0-9]){15,18}$",
        }
        for kind, test in reversed(tests.items()):
            shape = F.when(hit.rlike(test), kind).otherwise(shape)
        return F.coalesce(shape, F.lit("national_phone"))

    def judged(x: Column) -> Column:
        kind, hit, left, right = x["kind"], x["hit"], x["left"], x["right"]
        digits = _digits(hit)
        value = F.regexp_extract(hit, r"[=:]\s*[\"']?(.*)$", 1)
        coded = value.rlike("[A-Za-z]") & (F.length(F.regexp_replace(value, "[^0-9]", "")) >= 2)
        sure = kind.isin("email", "phone", "ip", "card", "spelt_email", "access_key")
        strict = _vote(sure | ((kind == "secret") & coded), (kind == "secret") & ~coded)
        known = (
            (kind.isin("email") & hit.rlike(_ENDINGS))
            | (kind.isin("phone") & hit.rlike(_COUNTRY_CODES))
            | (kind.isin("card") & hit.rlike(_ISSUERS))
            | (kind.isin("account") & hit.rlike(_ACCOUNT_COUNTRIES))
            | kind.isin("access_key", "secret")
        )
        gazetteer = _vote(known, kind.isin("account"))
        # The word that speaks for a secret is part of it.
        context = _vote(left.rlike(_FOR_WORDS) | kind.isin("secret"), left.rlike(_AGAINST_WORDS))
        glued = left.rlike("[A-Za-z0-9_=/-]$") | right.rlike("^[A-Za-z0-9_=/-]")
        borders = _vote(~glued, glued)
        valid = (
            F.when(kind == "card", F.call_function("luhn_check", digits))
            .when(kind == "ip", hit.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
            .when(kind == "national_phone", ~digits.rlike("^[01]"))
            .when(kind == "secret", F.length(value) >= 8)
            .when(kind == "national_id", ~digits.rlike("^(?:000|666|9)|^...00|0000$"))
        )
        check = F.when(valid, "2").when(~valid, "0").otherwise("1")
        size = F.least(F.floor(F.length(hit) / 8), F.lit(4)).cast("string")
        share = F.floor(F.length(digits) * 3 / F.length(hit)).cast("string")
        cuts = F.least(F.length(F.regexp_replace(hit, "[A-Za-z0-9]", "")), F.lit(4)).cast("string")
        before = F.when(left == "", "n").when(left.rlike(r"\s$"), "s").when(left.rlike("[A-Za-z0-9]$"), "a").otherwise("p")
        after = F.when(right == "", "n").when(right.rlike(r"^\s"), "s").when(right.rlike("^[A-Za-z0-9]"), "a").otherwise("p")
        return F.struct(
            kind.alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.concat(strict, gazetteer, context, borders, check).alias("votes"),
            F.concat_ws("|", kind, size, share, cuts, before, after).alias("shape"),
        )

    named = F.transform("__all", lambda x: x.withField("kind", kind_of(x["hit"])))
    df = df.withColumn("__named", named).drop("__all")
    return df.withColumn("candidates", F.transform("__named", judged)).drop("__named")


def reliabilities(patterns: list[tuple[str, str, int]], rounds: int = 60) -> dict[tuple[str, str], float]:
    """Expectation maximisation: probability that a span of (kind, votes) is personal, from counts of these.

    Each labeler has a table of how likely each vote is on true and on false spans. Pseudo-counts that make labelers
    better than chance settle which class is which.
    """
    kinds = sorted({k for k, _, _ in patterns})
    kind = np.array([kinds.index(k) for k, _, _ in patterns], dtype=int)
    votes = np.array([[int(c) for c in v] for _, v, _ in patterns], dtype=int).reshape(len(patterns), LABELERS)
    n = np.array([c for _, _, c in patterns], dtype=float)
    truth = 1 / (1 + np.exp(-(votes - 1).sum(axis=1, dtype=float)))
    for _ in range(rounds):
        prior = np.array([((n * truth)[kind == k].sum() + 1) / (n[kind == k].sum() + 2) for k in range(len(kinds))])
        tables = np.empty((LABELERS, 2, 3))
        for j in range(LABELERS):
            for y, weight in enumerate((1 - truth, truth)):
                pseudo = np.array([4.0, 3.0, 1.0]) if y == 0 else np.array([1.0, 3.0, 4.0])
                tables[j, y] = np.bincount(votes[:, j], n * weight, minlength=3) + pseudo
                tables[j, y] /= tables[j, y].sum()
        log = np.log(tables)
        odds = np.log(prior[kind] / (1 - prior[kind]))
        for j in range(LABELERS):
            odds += log[j, 1, votes[:, j]] - log[j, 0, votes[:, j]]
        truth = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return {(k, v): float(p) for (k, v, _), p in zip(patterns, truth, strict=True)}


def classifier(rows: list[tuple[str, float, float]], ridge: float = 1.0, rounds: int = 25) -> dict[str, float]:
    """Logistic regression by Newton's method on (shape, probability of being personal, count): a score per shape."""
    shapes = sorted({s for s, _, _ in rows})
    fields = sorted({(i, value) for s in shapes for i, value in enumerate(s.split("|"))})
    column = {f: k + 1 for k, f in enumerate(fields)}
    x = np.zeros((len(shapes), len(fields) + 1))
    x[:, 0] = 1
    for r, s in enumerate(shapes):
        for f in enumerate(s.split("|")):
            x[r, column[f]] = 1
    number = {s: r for r, s in enumerate(shapes)}
    n, yes = np.zeros(len(shapes)), np.zeros(len(shapes))
    for s, p, count in rows:
        n[number[s]] += count
        yes[number[s]] += p * count
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (yes - n * p) - ridge * beta
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        beta += np.clip(np.linalg.solve(curve, slope), -4, 4)
    score = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
    return dict(zip(shapes, score.tolist(), strict=True))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def personal_spans(df: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """Per row: id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base spans), ``base_sha256``, ``spans``,
    ``n_more`` (spans that the classifier added) and ``n_found`` (all spans)."""
    rows = df.select(F.col(id_column).alias("id"), text_or_empty(text).alias("body"))
    found = candidates(base_spans(rows, "body"), "body").drop("body")
    found = written(found, "personal-spans")
    each = found.select(F.explode("candidates").alias("c"))
    counts = each.groupBy("c.kind", "c.votes", "c.shape").agg(F.count(F.lit(1)).alias("n")).collect()
    by_votes: dict[tuple[str, str], int] = {}
    for r in counts:
        by_votes[r["kind"], r["votes"]] = by_votes.get((r["kind"], r["votes"]), 0) + r["n"]
    accepted: list[str] = []
    if counts:
        sure = reliabilities([(k, v, n) for (k, v), n in sorted(by_votes.items())])
        scores = classifier([(r["shape"], sure[r["kind"], r["votes"]], r["n"]) for r in sorted(counts)])
        accepted = [s for s, p in scores.items() if p >= least and s.split("|")[0] in MORE_KINDS]
    def stays(c: Column) -> Column:
        apart = ~F.exists("base", lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"]))
        return (c["shape"].isin(*accepted) & apart) if accepted else F.lit(False)

    more = F.filter("candidates", stays)
    ordered = F.concat(*[F.filter("__more", _is(kind)) for kind in MORE_KINDS])
    bare = F.transform(ordered, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    out = found.withColumn("__more", more).withColumn("__bare", bare)
    numbers = [
        F.size(F.filter("base", _is(kind))).cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS
    ]
    return out.select(
        F.col("id").alias(id_column),
        *numbers,
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "__bare")).alias("spans"),
        F.size("__bare").cast("bigint").alias("n_more"),
        (F.size("base") + F.size("__bare")).cast("bigint").alias("n_found"),
    )
