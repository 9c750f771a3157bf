"""The batch report job: every pending request, all eleven sheets.

Flow per fact (see the sheet module for the sheets themselves)::

    control table --snapshot--> requests --> bounds, calendar, request keys
    fact --pushed bounds, calendar, id filter--> sums per segment --join keys--> sums per request
    sums at the finest grain --roll up--> extracts --complete cases--> sheets

The control table is written once per job (``snapshot``): scan bounds, extracts,
manifest and claim all see the same requests.  Each fact is scanned and summed
once, however many requests cover a row (``operators.scope.request_sums``): the
system fact's raw aggregate (device, OS, browser, size) rolls up to four
extracts and the geo fact's (city, region, postcode) to two.  For a whole report
these raw aggregates are snapshots, too, because the sheets push different
filters into them; a single sheet is one lazy plan.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adinsight.functions.columns import day_of_week
from adinsight.operators.extract import complete_cases, roll_up
from adinsight.operators.rownum import number_rows
from adinsight.operators.scope import ScanBounds, request_sums, scan_bounds, scope
from adinsight.operators.snapshot import Scratch, snapshot
from adinsight.plans import sheets as S
from adinsight.schemas import MEASURES
from adinsight.sources import requests as R
from adinsight.sources.control import ControlTable

# The delivery mail (subject, body labels in body order) and
# the report name suffix.
MAIL_SUBJECT = "Automation of Standard Insights"
MAIL_GREETING = "Hey,\nAttached is the data for your advertiser: "
MAIL_IO = ", insertion_order_id: "
MAIL_FROM = ", From Date: "
MAIL_TO = ", To Date: "
MAIL_CONV_PIXEL = ",conversion pixel_id: "
MAIL_SEG_PIXEL = ",segment pixel_id: "
REPORT_SUFFIX = "_Report.xlsx"

# extract name -> (fact, grain keys)
EXTRACT_GRAINS = {
    "tod": ("placement_hour", ["day_hour", "dw"]),
    "site": ("inventory", ["site_domain"]),
    "device": ("system", ["device_type"]),
    "os": ("system", ["device_type", "os_name"]),
    "browser": ("system", ["device_type", "browser_name"]),
    "size": ("system", ["width", "height"]),
    "city": ("geo", ["city", "region"]),
    "postcode": ("geo", ["city", "region", "postal_code"]),
}

# fact -> its finest grain, from which all its extracts roll up
RAW_GRAINS = {
    "placement_hour": ["day_hour", "dw"],
    "inventory": ["site_domain"],
    "system": ["device_type", "os_name", "browser_name", "width", "height"],
    "geo": ["city", "region", "postal_code"],
}

# sheet name -> (builder, extract name)
SHEET_BUILDERS = {
    "TOD_Weekday": (S.tod_weekday, "tod"),
    "TOD_Weekend": (S.tod_weekend, "tod"),
    "DOW": (S.dow, "tod"),
    "Site_Domains": (S.site_domains, "site"),
    "Device_type": (S.device_type, "device"),
    "Device_Os": (S.device_os, "os"),
    "Browser": (S.browser, "browser"),
    "Creative_Size": (S.creative_size, "size"),
    "City_Region": (S.city_region, "city"),
    "Regions": (S.regions, "city"),
    "City_postal_code": (S.city_postcode, "postcode"),
}

# fact -> how its rows meet a request's time zone
ZONE_MATCH = {"placement_hour": {"match_timezone": True}, "geo": {"match_country": True}}

REPORT_DIMS = ["day_hour", "day_name", "site_domain", "device_types", "os_name",
               "browser_name", "size", "city", "regions", "region_code", "postal_code"]


class ReportJob:
    """Reports for a batch of requests over a set of fact tables.

    ``facts`` maps ``placement_hour, inventory, system, geo`` to DataFrames.
    ``first_only`` serves only the earliest pending request (one per run),
    otherwise every pending request is served.
    """

    def __init__(self, spark: SparkSession, facts: dict[str, DataFrame],
                 requests_raw: DataFrame, *, first_only: bool = False):
        self.spark = spark
        self.facts = facts
        self._given = requests_raw
        self._first_only = first_only

    @cached_property
    def scratch(self) -> Scratch:
        """Where the job keeps what it writes on the way; ``write`` clears it."""
        return Scratch(self.spark)

    # -- requests -----------------------------------------------------------
    @cached_property
    def requests_raw(self) -> DataFrame:
        """The control table as it stood when the job first read it."""
        raw = snapshot(self._given, self.scratch)
        R.check_identity(raw)
        return raw

    @cached_property
    def parsed(self) -> DataFrame:
        return R.parse_requests(self.requests_raw)

    @cached_property
    def requests(self) -> DataFrame:
        """The requests this job serves, parsed once and written."""
        served = R.pending(self.parsed)
        return snapshot(R.first_only(served) if self._first_only else served, self.scratch)

    @cached_property
    def bounds(self) -> ScanBounds:
        """Scan bounds of the requests, shared by every fact."""
        return scan_bounds(self.requests, self.scratch)

    # -- extracts -----------------------------------------------------------
    @staticmethod
    def _carry(fact: str) -> list[str]:
        return ["timezone"] if fact == "geo" else []

    def labelled(self, fact: str) -> DataFrame:
        """The fact with the columns its extracts are grouped by."""
        df = self.facts[fact]
        if fact == "placement_hour":
            df = df.withColumn("dw", day_of_week("dt"))
        if fact == "geo":
            df = df.withColumnRenamed("de_city", "city").withColumnRenamed("de_region_name", "region")
        return df

    def scoped(self, fact: str) -> DataFrame:
        """The fact rows of each request, as they are: for looking at what a report is made of."""
        return scope(self.labelled(fact), self.requests, bounds=self.bounds, **ZONE_MATCH.get(fact, {}))

    def sums(self, fact: str, grain: list[str]) -> DataFrame:
        """Measure sums per request at ``grain``, from one scan of the fact."""
        return request_sums(self.labelled(fact), self.requests, grain, bounds=self.bounds, **ZONE_MATCH.get(fact, {}))

    def raw_extract(self, name: str, raw: DataFrame | None = None) -> DataFrame:
        """One extract before complete cases: from ``raw``, or from its own scan."""
        fact, keys = EXTRACT_GRAINS[name]
        if raw is None:
            return self.sums(fact, keys)
        if keys == RAW_GRAINS[fact]:
            return raw
        return roll_up(raw, keys, self._carry(fact))

    def extract(self, name: str, raw: DataFrame | None = None) -> DataFrame:
        return complete_cases(self.raw_extract(name, raw), [*EXTRACT_GRAINS[name][1], *MEASURES])

    @cached_property
    def shared_extracts(self) -> dict[str, DataFrame]:
        """All eight extracts from one scan and one raw aggregate per fact."""
        self.bounds, self.scratch  # made once, before they are shared
        with ThreadPoolExecutor(len(RAW_GRAINS)) as pool:  # a fact's last tasks leave room for another's first
            written = {fact: pool.submit(lambda f=fact, g=grain: snapshot(self.sums(f, g), self.scratch))
                       for fact, grain in RAW_GRAINS.items()}
            raw = {fact: w.result() for fact, w in written.items()}
        return {name: self.extract(name, raw[fact]) for name, (fact, _) in EXTRACT_GRAINS.items()}

    # -- sheets -------------------------------------------------------------
    def sheet(self, name: str, *, order: bool = True) -> DataFrame:
        """One sheet for every served request, as one lazy plan."""
        builder, ext = SHEET_BUILDERS[name]
        return S.finish(builder(self.extract(ext)), name, order=order)

    def report_long(self, row_ids: bool = False) -> DataFrame:
        """All sheets of all requests as one long table with a ``sheet`` column.

        Each sheet is padded to the common column list (NULL for dimensions it
        does not have) and the sheets are appended positionally.  With
        ``row_ids`` every row gets its 1-based position in its request's sheet
        (one distributed sort for the whole report).
        """
        metrics = [c for c in S.sheet_columns("DOW") if c not in ("request_id", "day_name")]
        types = {"day_hour": "int"}
        out = None
        for name in S.SHEET_NAMES:
            builder, ext = SHEET_BUILDERS[name]
            df = builder(self.shared_extracts[ext])
            have = set(S.SHEET_DIMS[name])
            cols = ["request_id", f"'{name}' AS sheet"] + [
                c if c in have else f"CAST(NULL AS {types.get(c, 'string')}) AS {c}"
                for c in REPORT_DIMS] + metrics
            if row_ids:
                cols += S.sort_keys(name)
            df = df.selectExpr(*cols)
            out = df if out is None else out.unionAll(df)
        if row_ids:
            out = number_rows(out, ["request_id", "sheet"], [F.col(c) for c in S.SORT_COLUMNS],
                              scratch=self.scratch)
            out = out.drop(*S.SORT_COLUMNS)
        return out

    # -- delivery -----------------------------------------------------------
    def delivery_manifest(self, report: DataFrame | None = None,
                          report_dir: str | None = None) -> DataFrame:
        """One row per served request: mail fields, report name, row count.

        The mail lists the ids as the request gives them, repeats included.

        With ``report_dir`` (the written report) a ``report_path`` column
        points at the request's folder in it.
        """
        report = report if report is not None else self.report_long()
        counts = report.groupBy("request_id").agg(F.count(F.lit(1)).alias("report_rows"))
        r = self.requests
        ids = lambda c: F.array_join(F.col(c), ",")
        given = lambda label, c: F.when(F.col(c).isNull(), F.lit("")).otherwise(
            F.concat(F.lit(label), ids(c)))
        body = F.concat(
            F.lit(MAIL_GREETING), F.coalesce(ids("advertiser_list"), F.lit("")),
            given(MAIL_IO, "io_list"),
            F.lit(MAIL_FROM), F.coalesce(F.col("from_dt").cast("string"), F.lit("NA")),
            F.lit(MAIL_TO), F.coalesce(F.col("to_dt").cast("string"), F.lit("NA")),
            given(MAIL_CONV_PIXEL, "conv_pixel_list"), given(MAIL_SEG_PIXEL, "seg_pixel_list"))
        path = [] if report_dir is None else [
            F.concat(F.lit(report_dir.rstrip("/") + "/request_id="),
                     F.col("request_id").cast("string")).alias("report_path")]
        return (r.join(counts, "request_id", "left")
                 .select(
                     "request_id",
                     F.col("to_email").alias("to"),
                     F.lit(MAIL_SUBJECT).alias("subject"),
                     body.alias("body"),
                     F.concat(F.coalesce(ids("advertiser_list"), F.lit("")),
                              F.lit(REPORT_SUFFIX)).alias("report_name"),
                     "status",
                     F.coalesce(F.col("report_rows"), F.lit(0)).cast("bigint").alias("report_rows"),
                     *path,
                 ))

    def claimed(self, served: DataFrame | None = None) -> DataFrame:
        """Next version of the control table: served requests flagged done."""
        return R.claim(self.requests_raw, served if served is not None else self.requests)

    def write(self, out_dir: str, csv_sheets: bool = False, run_id: str | None = None) -> dict[str, str]:
        """Write report and manifest; what the job has written on the way is removed.

        Every run writes folders of its own (``run=<id>``) and overwrites nothing.
        The rows are rebalanced by request and sheet: a sheet is one file unless
        it is large enough for adaptive execution to split it, and small sheets
        share a task.  With ``csv_sheets`` every sheet is also written as CSV
        with a header (one folder per sheet, partitioned by request; the sheet's
        own columns with ``row_id`` first), the tab-per-sheet form of a workbook.
        """
        out, run = out_dir.rstrip("/"), run_id or new_run()
        paths = {"report": f"{out}/report/run={run}", "manifest": f"{out}/manifest/run={run}"}
        try:
            report = self.report_long(row_ids=True)
            (report.hint("rebalance", "request_id", "sheet").sortWithinPartitions("request_id", "sheet", "row_id")
                   .write.partitionBy("request_id", "sheet").parquet(paths["report"]))
            # Explicit schema: an empty report writes no data files to infer from.
            written = self.spark.read.schema(report.schema).parquet(paths["report"])
            if csv_sheets:
                for name in S.SHEET_NAMES:
                    path = f"{out}/sheets/run={run}/{name}"
                    cols = ["row_id", *S.SHEET_DIMS[name], *S.METRIC_COLUMNS, "request_id"]
                    (written.filter(F.col("sheet") == name).select(*cols)
                            .hint("rebalance", "request_id").sortWithinPartitions("request_id", "row_id")
                            .write.partitionBy("request_id").option("header", True).csv(path))
                    paths[f"sheet:{name}"] = path
            self.delivery_manifest(written, paths["report"]).write.parquet(paths["manifest"])
        finally:
            self.scratch.clear()
        return paths


def new_run() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def serve(spark: SparkSession, facts: dict[str, DataFrame], control: ControlTable, out_dir: str, *,
          first_only: bool = False, csv_sheets: bool = False, run_id: str | None = None) -> dict[str, str]:
    """Claim the pending requests of a control table, report on them and settle the claim.

    Jobs may run side by side on one control table: none serves what another has
    claimed.  If the report fails its requests are pending again.
    """
    run = run_id or new_run()
    claimed = control.claim(run, first_only)
    try:
        paths = ReportJob(spark, facts, claimed).write(out_dir, csv_sheets, run)
    except BaseException:
        control.release(run)
        raise
    paths["requests"] = control.data_path(control.finish(run))
    return paths
