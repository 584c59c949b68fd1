"""A training corpus made from documents: language, exact copies, near copies, mixture, token ids.

Each stage takes what the one before kept, written as Parquet in the shared folder, so a lost executor costs no more
than the stage that runs. All but the last return the columns of ``documents``. What the stages do with null, empty and very
long texts, ties, repeated rows and empty tables is told in ``tablewright.llm.stages``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import stages
from tablewright.llm.shared import written
from tablewright.session import tuned

STAGES = [
    ("language_id", stages.language),
    ("exact_dedup", stages.exact),
    ("ngram_jaccard", stages.near),
    ("mixing", stages.mixture),
    ("bpe", stages.token_ids),
]

# Byte-pair encoding is not expressible in SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that every stage keeps, as token ids."""
    docs = tuned(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
