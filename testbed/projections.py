"""The driver's test tables mapped onto the four fact schemas.

Plain SQL expressions; the same text defines the oracle's inputs, so both
engines see identical facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adinsight.sources.facts import FACTS

# Columns shared by the three lineitem-based projections.
_LINEITEM_COMMON = [
    "CAST(l_shipdate AS DATE) AS dt",
    "CAST(l_suppkey % 10 AS BIGINT) AS advertiser_id",
    "CAST(l_suppkey % 25 AS BIGINT) AS insertion_order_id",
    "CAST(l_orderkey % 4 AS BIGINT) AS pixel_id",
    "CAST(l_quantity AS BIGINT) AS impressions",
    "CAST(CASE WHEN l_returnflag='R' THEN l_linenumber ELSE 0 END AS BIGINT) AS clicks",
    "CAST(CASE WHEN l_linenumber=7 THEN NULL WHEN l_returnflag='A' THEN 1 ELSE 0 END AS BIGINT) AS pcconversions",
    "CAST(CASE WHEN l_linestatus='F' AND l_returnflag='N' THEN 1 ELSE 0 END AS BIGINT) AS pvconversions",
]

# fact name -> (test table, SQL projection list).  Valid in Spark SQL and DuckDB.
TESTDATA_PROJECTIONS: dict[str, tuple[str, list[str]]] = {
    "placement_hour": ("events", [
        "CAST(ts AS DATE) AS dt",
        "CAST(hour(ts) AS INT) AS day_hour",
        "CAST(user_id % 10 AS BIGINT) AS advertiser_id",
        "CAST(user_id % 25 AS BIGINT) AS insertion_order_id",
        "CAST(event_id % 4 AS BIGINT) AS pixel_id",
        "split_part('AEST|NZST|UTC','|',CAST(event_id % 3 AS INT)+1) AS time_zone_name",
        "CAST(CASE WHEN event_type='view' THEN 1 ELSE 0 END AS BIGINT) AS impressions",
        "CAST(CASE WHEN event_type='click' THEN 1 ELSE 0 END AS BIGINT) AS clicks",
        "CAST(CASE WHEN event_type='purchase' THEN 1 WHEN event_type='error' THEN NULL ELSE 0 END AS BIGINT) AS pcconversions",
        "CAST(CASE WHEN event_type='signup' THEN 1 ELSE 0 END AS BIGINT) AS pvconversions",
    ]),
    "inventory": ("lineitem", _LINEITEM_COMMON + [
        "CASE WHEN l_orderkey % 4 = 0 THEN concat('tail',l_orderkey,'.example.com') "
        "ELSE concat('site',l_partkey % 50,'.example.com') END AS site_domain",
    ]),
    "system": ("lineitem", _LINEITEM_COMMON + [
        "nullif(split_part('pc & other devices|pc or unknown|pc|mobile|phone|Phone|tablet|Tablet|tv|PC',"
        "'|',CAST(l_partkey % 11 AS INT)+1),'') AS device_type",
        "split_part('windows|macos|android|ios|linux','|',CAST(l_orderkey % 5 AS INT)+1) AS os_name",
        "split_part('chrome|safari|firefox|edge|opera|other','|',"
        "CAST((l_orderkey+l_linenumber) % 6 AS INT)+1) AS browser_name",
        "CAST(split_part('300|728|160|320|970','|',CAST(l_linenumber % 5 AS INT)+1) AS INT) AS width",
        "CAST(split_part('250|90|600|50|250','|',CAST(l_linenumber % 5 AS INT)+1) AS INT) AS height",
    ]),
    "geo": ("lineitem", _LINEITEM_COMMON + [
        "split_part('australia|AU|Australia|new zealand|NZ|New Zealand|fiji','|',"
        "CAST(l_orderkey % 7 AS INT)+1) AS de_country_name",
        "CASE WHEN l_orderkey % 7 < 3 THEN split_part('australian capital territory|new south wales|"
        "northern territory|queensland|south australia|tasmania|victoria|western australia|"
        "Australian Capital Territory|New South Wales|Northern Territory|Queensland|South Australia|"
        "Tasmania|Victoria|Western Australia|NEW SOUTH WALES','|',CAST(l_partkey % 17 AS INT)+1) "
        "WHEN l_orderkey % 7 < 6 THEN split_part('Northland|auckland|WAIKATO|bay of plenty|gisborne|"
        "hawkes bay|Hawke''s Bay|taranaki|manawatu-wanganui|wellington|tasman|nelson|marlborough|"
        "west coast|canterbury|otago|southland|chatham islands','|',CAST(l_partkey % 18 AS INT)+1) "
        "ELSE 'central' END AS de_region_name",
        "concat(CASE WHEN l_linenumber % 2 = 0 THEN 'City' ELSE 'city' END, l_partkey % 40) AS de_city",
        "nullif(CAST(2000 + l_partkey % 60 AS VARCHAR(10)),'2000') AS postal_code",
    ]),
}


def fact_from_testdata(spark: SparkSession, name: str, sf_dir: str,
                       source: DataFrame | None = None) -> DataFrame:
    """Fact ``name`` projected from the driver's test tables in ``sf_dir``.

    Only the referenced source columns are read (the projection prunes the
    parquet scan).  ``source`` may pass the already opened source table.
    """
    table, exprs = TESTDATA_PROJECTIONS[name]
    src = source if source is not None else spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return src.selectExpr(*exprs)


def facts_from_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four facts; each source table is opened once."""
    sources: dict[str, DataFrame] = {}
    for table, _ in TESTDATA_PROJECTIONS.values():
        if table not in sources:
            sources[table] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return {name: fact_from_testdata(spark, name, sf_dir, sources[TESTDATA_PROJECTIONS[name][0]])
            for name in FACTS}
