"""What several of these operators use: tables written between steps, and the numbers of equal parts."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.session import scratch_path

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written rows, so that lost executors cost no more than
    the step that runs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def workers_find_package(df: DataFrame) -> None:
    """Let Python workers find this package where the driver has it, whatever folder they start in."""
    environment = df.sparkSession.sparkContext.environment
    paths = [PACKAGE_ROOT, *environment.get("PYTHONPATH", "").split(os.pathsep)]
    environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(p for p in paths if p))


def in_pandas(rows: DataFrame, function: Callable, schema: str) -> DataFrame:
    workers_find_package(rows)
    return rows.mapInPandas(function, schema)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def same(left: list[Column], right: list[Column]) -> Column:
    """Equal column by column, where null equals null."""
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & a.eqNullSafe(b)
    return out


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``df`` in one, ``row``, beside others, so that their names cannot clash. ``row.*`` unpacks."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(k) for k, c in columns.items()])
