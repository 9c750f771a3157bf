"""Lookup joins that label extracts (J1-J8).  Every lookup is a fixed
literal of a few rows, broadcast so the extract side is never shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adinsight.sources import dims


def label_days(df: DataFrame) -> DataFrame:
    """``dw`` -> ``day_name``, ``day_order``; unmapped rows dropped."""
    return df.join(dims.lookup(dims.days(df.sparkSession)), "dw", "inner")


def keep_days(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows whose ``day_name`` is in ``names`` (semi-join, J2/J3)."""
    return df.join(dims.lookup(dims.day_set(df.sparkSession, names)), "day_name", "left_semi")


def label_device_class(df: DataFrame) -> DataFrame:
    """Raw ``device_type`` -> ``device_types``; unmapped dropped."""
    return df.join(dims.lookup(dims.device_classes(df.sparkSession)), "device_type", "inner")


def lower_city(df: DataFrame) -> DataFrame:
    return df.withColumn("city", F.lower("city"))


def label_regions(df: DataFrame) -> DataFrame:
    """(``timezone``, ``region``) -> ``regions``, ``region_code``.

    Left join: unmapped regions keep NULL labels.  For time zones in
    ``LOWERCASE_REGION_ZONES`` the region is lower-cased before matching;
    otherwise the match is on the exact spelling.
    """
    key = F.when(F.col("timezone").isin(dims.LOWERCASE_REGION_ZONES), F.lower("region")) \
           .otherwise(F.col("region"))
    lk = dims.lookup(dims.region_codes(df.sparkSession))
    return (df.withColumn("region_key", key)
              .join(lk, ["timezone", "region_key"], "left")
              .drop("region_key"))
