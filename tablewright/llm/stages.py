"""The stages of the pipeline: each takes (spark, docs, sf_dir) and returns what stays of ``docs``.

All but the last return the columns of ``docs``, whatever further columns it has. Null texts count as empty ones; they say
nothing about language (other evidence decides), are equal to each other, are no near copies, have no tokens to mix by and
no ids. Ties go by id: exact copies leave the largest, near copies the smallest. Rows that repeat id and text are one
document from the second stage on. Texts of any length are worked on whole. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.bpe_codec import encoded
from tablewright.llm.exact_dedup import exact_distinct
from tablewright.llm.language_id import in_known_language
from tablewright.llm.mixing import mixed
from tablewright.llm.ngram_join import near_distinct
from tablewright.llm.queries import vocabulary_path
from tablewright.session import tuned


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus's languages; what is none of them goes."""
    tuned(spark)
    return in_known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    tuned(spark)
    return exact_distinct(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    tuned(spark)
    return near_distinct(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources repeated towards the target weights."""
    tuned(spark)
    return mixed(docs).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids."""
    tuned(spark)
    return encoded(docs, vocabulary_path())
