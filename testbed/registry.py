"""Registered queries: one per operator of the inventory.

Each callable takes ``(spark, sf_dir)``, reads the test tables in ``sf_dir``
through the fact projections, serves the request fixture and returns a lazy
DataFrame.  Column names equal those of the matching oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adinsight.operators.labels import keep_days, label_days, label_device_class, label_regions
from adinsight.operators.metrics import with_metrics
from adinsight.operators.scope import scan_bounds, scope
from adinsight.plans.report import EXTRACT_GRAINS, ReportJob
from adinsight.sources import dims
from testbed.projections import facts_from_testdata
from testbed.fixtures import request_table

Query = Callable[[SparkSession, str], DataFrame]


def job_for(spark: SparkSession, sf_dir: str, **kw) -> ReportJob:
    return ReportJob(spark, facts_from_testdata(spark, sf_dir), request_table(spark), **kw)


def _sheet(name: str) -> Query:
    return lambda spark, sf: job_for(spark, sf).sheet(name)


def _raw_extract(name: str) -> Query:
    return lambda spark, sf: job_for(spark, sf).raw_extract(name)


def _scope_only(fact: str, **flags) -> Query:
    def q(spark, sf):
        job = job_for(spark, sf)
        off = dict(apply_io=False, apply_pixel=False, apply_dates=False)
        off.update(flags)
        return scope(job.facts[fact], job.requests, **off)
    return q


def _scope_all(spark, sf):
    job = job_for(spark, sf)
    return scope(job.facts["placement_hour"], job.requests, match_timezone=True)


def _labelled_tod(spark, sf):
    return label_days(job_for(spark, sf).extract("tod"))


def _region_join(tz: str) -> Query:
    def q(spark, sf):
        city = job_for(spark, sf).extract("city")
        return label_regions(city.filter(F.col("timezone") == tz))
    return q


def _share_global(spark, sf):
    return with_metrics(job_for(spark, sf).extract("device"), ["device_type"])


def _share_within_group(spark, sf):
    return with_metrics(job_for(spark, sf).extract("os"), ["device_type", "os_name"],
                        share_by=("request_id", "device_type"))


def _sorted_ids(c: str):
    return F.array_join(F.array_sort(F.col(c)), ",").alias(c)


def requests_overview(job: ReportJob, pending_only: bool) -> DataFrame:
    """Parsed requests with the number of fact rows each one scopes.

    Scoping runs for every parsed request (pending or not), so the counts
    preview what a request would select before it is served.
    """
    parsed = job.parsed
    out = parsed.filter(F.col("pending")) if pending_only else parsed
    bounds = scan_bounds(parsed)
    for fact, kw in (("placement_hour", {"match_timezone": True}), ("inventory", {}),
                     ("system", {}), ("geo", {"match_country": True})):
        scoped = scope(job.facts[fact], parsed, bounds=bounds, **kw)
        counts = scoped.groupBy("request_id").agg(F.count(F.lit(1)).alias(f"rows_{fact}"))
        out = out.join(counts, "request_id", "left")
    return out.select(
        "request_id", "sheet_row", _sorted_ids("advertiser_ids"), _sorted_ids("io_ids"),
        _sorted_ids("conv_pixel_ids"), _sorted_ids("seg_pixel_ids"), "from_dt", "to_dt",
        "timezone", "flag", "pending", "to_email", "status",
        *[F.coalesce(F.col(f"rows_{f}"), F.lit(0)).cast("bigint").alias(f"rows_{f}")
          for f in ("placement_hour", "inventory", "system", "geo")])


def _requests_claimed(spark, sf):
    job = job_for(spark, sf)
    manifest = job.delivery_manifest().select(
        F.col("request_id").alias("_rid"), "report_rows")
    claimed = job.claimed()
    return (claimed.join(manifest, claimed["sheet_row"].cast("bigint") == manifest["_rid"], "left")
                   .drop("_rid"))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for key, sheet in {
        "sheet_tod_weekday": "TOD_Weekday", "sheet_tod_weekend": "TOD_Weekend",
        "sheet_dow": "DOW", "sheet_site_domains": "Site_Domains",
        "sheet_device_type": "Device_type", "sheet_device_os": "Device_Os",
        "sheet_browser": "Browser", "sheet_creative_size": "Creative_Size",
        "sheet_city_region": "City_Region", "sheet_regions": "Regions",
        "sheet_city_postcode": "City_postal_code",
    }.items():
        q[key] = _sheet(sheet)
    for x in EXTRACT_GRAINS:
        q[f"extract_{x}"] = _raw_extract(x)
    q["complete_cases"] = lambda spark, sf: job_for(spark, sf).extract("postcode")
    q["scope_advertiser"] = _scope_only("system")
    q["scope_insertion_order"] = _scope_only("system", apply_io=True)
    q["scope_dates"] = _scope_only("system", apply_dates=True)
    q["scope_pixel"] = _scope_only("system", apply_pixel=True)
    q["scope_timezone"] = _scope_only("placement_hour", match_timezone=True)
    q["scope_country"] = _scope_only("geo", match_country=True)
    q["scope_all"] = _scope_all
    q["join_day_name"] = _labelled_tod
    q["join_weekday_semi"] = lambda spark, sf: keep_days(_labelled_tod(spark, sf), dims.WEEKDAYS)
    q["join_weekend_semi"] = lambda spark, sf: keep_days(_labelled_tod(spark, sf), dims.WEEKEND)
    q["join_device_class"] = lambda spark, sf: label_device_class(job_for(spark, sf).extract("device"))
    q["join_region_au"] = _region_join("AEST")
    q["join_region_nz"] = _region_join("NZST")
    q["share_global"] = _share_global
    q["share_within_group"] = _share_within_group
    q["requests_parsed"] = lambda spark, sf: requests_overview(job_for(spark, sf), False)
    q["requests_pending"] = lambda spark, sf: requests_overview(job_for(spark, sf), True)
    q["requests_first"] = lambda spark, sf: job_for(spark, sf, first_only=True).report_long()
    q["requests_claimed"] = _requests_claimed
    q["report_long"] = lambda spark, sf: job_for(spark, sf).report_long()
    q["report_row_ids"] = lambda spark, sf: job_for(spark, sf).report_long(row_ids=True)
    q["delivery_manifest"] = lambda spark, sf: job_for(spark, sf).delivery_manifest()
    return q


__all__ = ["queries", "job_for", "requests_overview"]
