"""Daily aggregates of a fact, refreshed for changed days only (A1-A8 on repeated runs).

A fact stored by ``dt`` is summed once per day at the grain its extracts need
(and the id columns requests filter by).  The result has the schema of the fact
itself: a report reads it in the fact's place and finds the same sums, since
sums of sums with the same nulls are the same sums.  Post-click and post-view
conversions are stored as their row-wise sum, null where no row has both.

::

    <path>/day/<refresh id>/dt=.../...parquet   the days a refresh has summed
    <path>/state/<number>                       a table: day, fingerprint, refresh id

A day's fingerprint is made of the names, sizes and times of its files.  A refresh
lists them, sums the days whose fingerprint is new and drops those that are gone;
nothing is overwritten, so a reader keeps the state it began with.
"""

from __future__ import annotations

import hashlib
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adinsight import schemas
from adinsight.plans.report import RAW_GRAINS
from adinsight.sources.facts import read_fact

STATE = "dt date, fingerprint string, refresh string"

# Columns of the raw grains that the fact derives or names differently.
_FACT_COLUMNS = {"dw": [], "city": ["de_city"], "region": ["de_region_name"]}
_ALSO = {"placement_hour": ["time_zone_name"], "geo": ["de_country_name"]}


def grain_columns(name: str) -> list[str]:
    """The columns of the fact that a report on it groups or filters by."""
    grain = [c for g in RAW_GRAINS[name] for c in _FACT_COLUMNS.get(g, [g])]
    return ["dt", "advertiser_id", "insertion_order_id", "pixel_id", *grain, *_ALSO.get(name, [])]


def daily_sums(fact: DataFrame, name: str) -> DataFrame:
    """The fact with one row per day and combination of ``grain_columns``."""
    both = F.sum(F.col("pcconversions") + F.col("pvconversions"))
    sums = fact.groupBy(*grain_columns(name)).agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"), both.alias("pcconversions"))
    return sums.withColumn("pvconversions", F.lit(0).cast("bigint")).select(*schemas.FACT_SCHEMAS[name].fieldNames())


class DailyFact:
    """The daily aggregate of fact ``name``, kept under ``path``, of the files in ``source``."""

    def __init__(self, spark: SparkSession, name: str, source: str, path: str):
        self.spark, self.name, self.source, self.path = spark, name, source.rstrip("/"), path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _list(self, path: str):
        folder = self._hadoop.Path(path)
        fs = folder.getFileSystem(self._conf)
        return fs.listStatus(folder) if fs.exists(folder) else []

    def fingerprints(self) -> dict[date, str]:
        """What each day of the source is made of."""
        out = {}
        for folder in self._list(self.source):
            name = folder.getPath().getName()
            if name.startswith("dt="):
                files = sorted(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}"
                               for f in self._list(folder.getPath().toString()))
                out[date.fromisoformat(name[3:])] = hashlib.sha256("\n".join(files).encode()).hexdigest()
        return out

    def _state(self) -> tuple[int, dict[date, tuple[str, str]]]:
        """Number and content of the latest complete state: a row per stored day."""
        found = [int(s.getPath().getName()) for s in self._list(f"{self.path}/state")
                 if any(f.getPath().getName() == "_SUCCESS" for f in self._list(s.getPath().toString()))]
        if not found:
            return 0, {}
        rows = self.spark.read.schema(STATE).parquet(f"{self.path}/state/{max(found)}").collect()
        return max(found), {r["dt"]: (r["fingerprint"], r["refresh"]) for r in rows}

    def refresh(self) -> list[date]:
        """Bring the aggregate up to date; returns the days that were summed."""
        (number, have), now, name = self._state(), self.fingerprints(), uuid.uuid4().hex
        changed = sorted(d for d, f in now.items() if have.get(d, ("", ""))[0] != f)
        if not changed and set(have) == set(now):
            return []
        if changed:
            # Only the changed folders are listed and read.
            fact = (self.spark.read.schema(schemas.FACT_SCHEMAS[self.name]).option("basePath", self.source)
                    .parquet(*[f"{self.source}/dt={d}" for d in changed]))
            # A day is one file unless it is large enough to be split.
            daily_sums(fact, self.name).hint("rebalance", "dt").write.partitionBy("dt").parquet(f"{self.path}/day/{name}")
        rows = [(d, f, name if d in set(changed) else have[d][1]) for d, f in sorted(now.items())]
        (self.spark.createDataFrame(rows, STATE).coalesce(1)
             .write.mode("errorifexists").parquet(f"{self.path}/state/{number + 1}"))
        return changed

    def read(self) -> DataFrame:
        """The aggregate as a fact table, partitioned by ``dt``."""
        _, have = self._state()
        schema = schemas.FACT_SCHEMAS[self.name]
        out = None
        for refresh in sorted({r for _, r in have.values()}):
            days = [d for d, (_, r) in have.items() if r == refresh]
            stored = {s.getPath().getName() for s in self._list(f"{self.path}/day/{refresh}")}
            paths = [f"{self.path}/day/{refresh}/dt={d}" for d in sorted(days) if f"dt={d}" in stored]
            if paths:
                part = (self.spark.read.schema(schema).option("basePath", f"{self.path}/day/{refresh}").parquet(*paths)
                        .select(*schema.fieldNames()))
                out = part if out is None else out.unionAll(part)
        return out if out is not None else self.spark.createDataFrame([], schema)


def refreshed_facts(spark: SparkSession, sources: dict[str, str], path: str) -> dict[str, DataFrame]:
    """All facts as daily aggregates under ``path``, brought up to date from their ``sources``."""
    out = {}
    for name, source in sources.items():
        if source.startswith("table:"):  # a catalog table has no files to tell changed days by
            out[name] = read_fact(spark, name, source)
            continue
        daily = DailyFact(spark, name, source, f"{path.rstrip('/')}/{name}")
        daily.refresh()
        out[name] = daily.read()
    return out
