"""Conditions over many columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def any_of(conditions: Iterable[Column]) -> Column:
    """True where a condition holds, else false; nulls count as false.

    Written as one CASE, which Spark evaluates in methods small enough to be compiled however many
    conditions there are; a chain of ORs ends up in one large method.
    """
    result = None
    for condition in conditions:
        result = (F if result is None else result).when(condition, F.lit(True))
    return F.lit(False) if result is None else result.otherwise(F.lit(False))
