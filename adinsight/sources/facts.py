"""Delivery fact tables, read with their explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adinsight import schemas

FACTS = ("placement_hour", "inventory", "system", "geo")

def read_fact(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A production fact table, read with its declared schema.

    ``path`` of the form ``table:<name>`` reads a catalog table instead (its
    columns are selected and cast to the declared schema).
    """
    schema = schemas.FACT_SCHEMAS[name]
    if path.startswith("table:"):
        t = spark.table(path[len("table:"):])
        return t.select(*[t[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.read.schema(schema).format(fmt).load(path)


def write_fact(df: DataFrame, name: str, path: str, mode: str = "overwrite") -> None:
    """Store a fact partitioned by ``dt`` (for teams that own their facts).

    The request date intervals of ``scope`` then prune whole partitions
    instead of row groups.
    """
    cols = schemas.FACT_SCHEMAS[name].fieldNames()
    df.select(*cols).write.mode(mode).partitionBy("dt").parquet(path)
