from __future__ import annotations

import os
import sys
from datetime import date

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from adinsight.schemas import FACT_SCHEMAS  # noqa: E402
from adinsight.session import get_spark  # noqa: E402
from adinsight.sources.local import local_table  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    return get_spark(master="local[*]", conf={
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR"})


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def duck_small():
    return duck(SF_SMALL)


BASE_ROW = dict(dt=date(2024, 1, 1), advertiser_id=1, insertion_order_id=1, pixel_id=0,
                impressions=0, clicks=0, pcconversions=0, pvconversions=0,
                day_hour=12, time_zone_name="AEST", site_domain="s.example",
                device_type="pc", os_name="linux", browser_name="chrome", width=300,
                height=250, de_city="city", de_region_name="victoria",
                de_country_name="australia", postal_code="3000")


def fact(spark, name: str, rows: list[dict]):
    """A fact table from a few hand-written rows (defaults from BASE_ROW)."""
    schema = FACT_SCHEMAS[name]
    tuples = [tuple({**BASE_ROW, **r}[f.name] for f in schema.fields) for r in rows]
    return local_table(spark, tuples, schema)


def facts(spark, **rows):
    return {name: fact(spark, name, rows.get(name, [])) for name in FACT_SCHEMAS}


def request(advertiser="1", io="NA", pixel="NA", tz="AEST", flag="Yes", row=1,
            start="2024-01-01", end="2024-01-31", seg="NA"):
    return (row, advertiser, io, pixel, seg, start, end, tz, flag, f"r{row}@example.com")


def sorted_rows(df, cols=None):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
