"""Extracts: per-request sums at a report grain, then complete cases.

The two aggregation stages of a report (extract, then re-sum after labelling)
must stay separate: rows with a NULL anywhere are dropped between them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adinsight.schemas import MEASURES


def measure_sums() -> list[Column]:
    """impressions, clicks, conversions (= pc + pv per row, NULL if either is)."""
    return [
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum(F.col("pcconversions") + F.col("pvconversions")).alias("conversions"),
    ]


def resum() -> list[Column]:
    """Re-aggregation of already-summed measures."""
    return [F.sum(m).alias(m) for m in MEASURES]


def aggregate(scoped: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Raw extract: sums per (request, keys).  ``carry`` are per-request
    columns (functionally dependent on ``request_id``) kept for later joins."""
    return scoped.groupBy("request_id", *carry, *keys).agg(*measure_sums())


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with NULL (or NaN) in any of ``columns``."""
    return df.na.drop(how="any", subset=list(columns))


def roll_up(raw: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """The raw extract at ``keys`` from the raw aggregate of a finer grain.

    Exact because it sums raw groups: rows with a NULL leave only afterwards,
    at each grain for itself.
    """
    return raw.groupBy("request_id", *carry, *keys).agg(*resum())
