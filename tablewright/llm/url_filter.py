"""URL filter: address rules and patterns, each found by its rarest literal token.

Every rule becomes a regular expression with the words any matching address must hold as whole tokens. The rarest of
these over all addresses is the rule's key. An address's tokens fetch the rules with these keys, and only those rules'
expressions run. A rule without such a word runs on every address.

Addresses are judged once however often they occur: tokens, candidate rules and verdicts are made for distinct
addresses and joined back. Rules are a driver-side list; whether their table is broadcast is Spark's size check.

A null address, or one without ``://``, has an empty host and path, fits no rule and is allowed. Of rules that fit the
longest decides, of patterns an allowing one before a blocking one. Long addresses are judged whole, repeated rows alike.
An empty table gives no rows. Columns that have a result's name are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """``host`` and its subdomains, where the path starts with ``path``; the longest fitting rule decides."""

    verdict: str
    host: str
    path: str = "/"


class Pattern(NamedTuple):
    """Text anywhere in the lower-cased address; ``*`` is any run, ``^`` a character other than a letter or digit,
    or an end. Used where no rule fits: an allowing pattern wins over a blocking one."""

    verdict: str
    text: str


# Production parameters of the query.
RULES = [
    Rule("block", "net"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]
PATTERNS = [
    Pattern("block", "^cheap-pills^"),
    Pattern("block", "^spam-farm^"),
    Pattern("block", "^casino^"),
    Pattern("block", "^adserver^"),
    Pattern("block", "^free-money^"),
    Pattern("allow", "^imprint^"),
]


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def _compiled(rule: Rule | Pattern) -> tuple[str, bool, list[str]]:
    """Regular expression over what follows ``://``, whether it ignores case, and the words that must occur."""
    if isinstance(rule, Rule):
        if not rule.path.startswith("/") or re.search(r"[?#]", rule.path) or re.search(r"[/?#]", rule.host):
            raise ValueError(f"not a host and path: {rule}")
        words = re.findall("[a-z0-9]+", rule.host.lower())
        words += [w.lower() for w in re.findall("(?<=[^A-Za-z0-9])[A-Za-z0-9]+(?=[^A-Za-z0-9])", rule.path)]
        return "^(?:[^/?#]*\\.)?" + _quoted(rule.host.lower()) + _quoted(rule.path), False, words
    text = rule.text.lower()
    parts = {"*": ".*", "^": "(?:^|[^a-z0-9]|$)"}
    return "".join(parts.get(c) or _quoted(c) for c in text), True, re.findall("(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", text)


def host_of(url: Column) -> Column:
    after = F.substring_index(_after_scheme(url), "/", 1)
    host = F.substring_index(F.substring_index(after, "?", 1), "#", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(rest, F.lit(""))


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))


def url_verdicts(
    df: DataFrame,
    rules: Sequence[Rule] = RULES,
    patterns: Sequence[Pattern] = PATTERNS,
    url: str = "url",
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (the address rule that decided, else null) and ``verdict``.

    Columns of these names are replaced.
    """
    spark = df.sparkSession
    table = []
    for number, rule in enumerate([*rules, *patterns]):
        expression, any_case, words = _compiled(rule)
        address = isinstance(rule, Rule)
        name = rule.host + rule.path if address else rule.text
        table.append((number, address, rule.verdict, name, expression, any_case, sorted(set(words))))
    kinds = "number int, address boolean, verdict string, name string, expression string, any_case boolean, words array<string>"
    listed = spark.createDataFrame(table, kinds)

    urls = df.select(F.col(f"`{url}`").alias("u")).filter(F.instr("u", "://") > 0).distinct()
    subject = F.concat(host_of(F.col("u")), F.regexp_extract(_after_scheme(F.col("u")), "(?s)^[^/?#]*(.*)", 1))
    urls = urls.select("u", subject.alias("subject"), F.translate(subject, UPPER, LOWER).alias("lowered"))
    words = F.array_distinct(F.split("lowered", "[^a-z0-9]+"))
    tokens = urls.select("u", "subject", "lowered", F.explode(words).alias("token"))

    # The rarest of each rule's words over all addresses.
    needed = listed.select("number", F.explode("words").alias("token"))
    often = tokens.join(needed.select("token").distinct(), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = needed.join(often, "token", "left").groupBy("number")
    keys = rarest.agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    index = listed.join(keys, "number", "left").select("*").drop("words")

    shape = ["u", "subject", "lowered", "address", "verdict", "name", "expression", "any_case"]
    candidates = tokens.join(index, "token").select(shape)
    if any(not row[-1] for row in table):
        candidates = candidates.unionByName(urls.join(index.filter("token is null"), F.lit(True)).select(shape))
    fits = candidates.filter("case when any_case then lowered else subject end rlike expression")
    longest = F.struct(F.length("name"), F.length(F.substring_index("name", "/", 1)), "verdict")
    judged = fits.groupBy("u").agg(
        F.max_by(F.when(F.col("address"), F.col("name")), F.when(F.col("address"), longest)).alias("rule"),
        F.max_by(F.when(F.col("address"), F.col("verdict")), F.when(F.col("address"), longest)).alias("ruled"),
        F.min(F.when(~F.col("address"), F.col("verdict"))).alias("matched"),  # allow sorts before block
    )
    kept = [f"`{c}`" for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    rows = df.select(F.struct(*kept).alias("row"), F.col(f"`{url}`").alias("url")).join(judged, F.col("url") == F.col("u"), "left")
    return rows.select(
        "row.*",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        "rule",
        F.coalesce("ruled", "matched", F.lit("allow")).alias("verdict"),
    )
