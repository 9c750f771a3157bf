"""Distributed row numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from adinsight.operators.rownum import number_rows


def test_groups_spanning_partitions_get_consecutive_numbers(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # one hot group holding most rows, two small ones
        df = spark.range(3000).select(
            F.when(F.col("id") < 2500, F.lit("hot")).otherwise(
                F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.lit("b"))).alias("g"),
            (F.col("id") * 7 % 3001).alias("v"))
        out = number_rows(df, ["g"], [F.col("v").desc()])
        assert out.rdd.getNumPartitions() > 1
        rows = out.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by = {}
    for r in rows:
        by.setdefault(r["g"], []).append((r["row_id"], r["v"]))
    for g, items in by.items():
        items.sort()
        assert [i for i, _ in items] == list(range(1, len(items) + 1)), g
        vals = [v for _, v in items]
        assert vals == sorted(vals, reverse=True), g
    assert len(by["hot"]) == 2500
