"""Report write, delivery manifest and the next control-table version."""

from __future__ import annotations

import csv
import os
import tempfile
from collections import Counter

import pytest

from adinsight.plans.report import ReportJob, serve
from adinsight.schemas import REQUEST_RAW
from adinsight.sources.control import ControlTable
from testbed.fixtures import REQUEST_ROWS, request_table
from testbed.projections import facts_from_testdata
from tests.conftest import SF_SMALL, facts, request


def control_of(spark, path, rows) -> ControlTable:
    control = ControlTable(spark, str(path))
    control.add(request_table(spark, rows))
    return control


def test_write_report_manifest_and_claim(spark):
    out = tempfile.mkdtemp(prefix="adinsight-test-out-")
    paths = serve(spark, facts_from_testdata(spark, SF_SMALL), control_of(spark, f"{out}/requests", REQUEST_ROWS), out)
    report = spark.read.parquet(paths["report"])
    assert set(r["sheet"] for r in report.select("sheet").distinct().collect()) == {
        "TOD_Weekday", "TOD_Weekend", "DOW", "Site_Domains", "Device_type", "Device_Os",
        "Browser", "Creative_Size", "City_Region", "Regions", "City_postal_code"}
    manifest = {r["request_id"]: r for r in spark.read.parquet(paths["manifest"]).collect()}
    assert sorted(manifest) == [0, 1, 2, 3, 4, 5, 6, 7, 11, 12]
    assert manifest[7]["status"] == "invalid" and manifest[7]["report_rows"] == 0
    assert manifest[1]["report_name"] == "1,2_Report.xlsx"
    assert manifest[6]["report_name"] == "1,1_Report.xlsx"  # a repeated id stays in the name
    assert manifest[1]["subject"] == "Automation of Standard Insights"
    assert ", From Date: 2024-01-03, To Date: 2024-01-25" in manifest[1]["body"]
    assert manifest[1]["report_rows"] == report.filter("request_id = 1").count()
    assert spark.read.parquet(manifest[1]["report_path"]).count() == manifest[1]["report_rows"]
    flags = {r["sheet_row"]: r["Insight_Flag"] for r in spark.read.parquet(paths["requests"]).collect()}
    assert [flags[i] for i in (0, 1, 2, 3, 4, 5, 6, 7, 11, 12)] == ["No"] * 10
    assert flags[9] == "yes"


@pytest.fixture(scope="module")
def fact_paths(spark, tmp_path_factory):
    from adinsight.sources.facts import write_fact
    base = tmp_path_factory.mktemp("facts")
    out = []
    for name, df in facts_from_testdata(spark, SF_SMALL).items():
        write_fact(df.coalesce(1), name, str(base / name))
        out += [f"--{name.replace('_', '-')}", str(base / name)]
    return out


def _requests_csv(path, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(REQUEST_RAW.fieldNames())
        w.writerows(["" if v is None else v for v in r] for r in rows)
    return str(path)


def test_runs_follow_each_other_without_loss(spark, tmp_path, fact_paths):
    """Each run serves the next request of the control table; nothing written is lost."""
    from adinsight.__main__ import main
    out = str(tmp_path / "out")
    source = _requests_csv(tmp_path / "requests.csv", REQUEST_ROWS[1:4])
    # The sheet may be given again: rows the control table has are not added twice.
    runs = [main([*given, "--out", out, "--first-only", *fact_paths])
            for given in (["--requests", source], [], ["--requests", source])]
    served = [[r["request_id"] for r in spark.read.parquet(p["manifest"]).collect()] for p in runs]
    assert served == [[1], [2], [3]]
    for p, (rid,) in zip(runs, served):  # the earlier reports and tables are all there
        assert {r["request_id"] for r in spark.read.parquet(p["report"]).select("request_id").distinct().collect()} == {rid}
        assert spark.read.parquet(p["requests"]).count() == 3
    assert spark.read.parquet(f"{out}/manifest").count() == 3
    flags = [{r["sheet_row"]: r["Insight_Flag"] for r in spark.read.parquet(p["requests"]).collect()} for p in runs]
    assert flags == [{1: "No", 2: "Yes", 3: "Yes"}, {1: "No", 2: "No", 3: "Yes"}, {1: "No", 2: "No", 3: "No"}]
    last = main(["--out", out, *fact_paths])  # nothing left to serve
    assert spark.read.parquet(last["manifest"]).count() == 0


def test_claims_of_a_run_that_died_are_released(spark, tmp_path):
    from adinsight.__main__ import main
    control = control_of(spark, tmp_path / "out" / "requests", [request(row=1), request(row=2, flag="Yes, urgent")])
    control.claim("dead")
    assert control.claim("next").count() == 0 and control.claims().count() == 2
    main(["--out", str(tmp_path / "out"), "--release", "dead"])
    assert {r["sheet_row"]: r["Insight_Flag"] for r in control.requests().collect()} == {1: "Yes", 2: "Yes, urgent"}
    assert control.claims().count() == 0


def test_csv_sheets(spark, tmp_path, fact_paths):
    from adinsight.__main__ import main
    paths = main(["--requests", _requests_csv(tmp_path / "requests.csv", REQUEST_ROWS[1:4]), "--out",
                  str(tmp_path / "out"), "--first-only", "--csv-sheets", *fact_paths])
    dow = spark.read.option("header", True).csv(paths["sheet:DOW"])
    assert dow.columns[:2] == ["row_id", "day_name"] and "request_id" in dow.columns
    assert sorted(int(r["row_id"]) for r in dow.collect()) == list(range(1, dow.count() + 1))


def test_a_request_flagged_while_a_job_runs_stays_pending(spark, tmp_path):
    control = control_of(spark, tmp_path / "requests", [request(row=1, advertiser="1"), request(row=2, advertiser="2", flag="No")])
    facts = facts_from_testdata(spark, SF_SMALL)
    served = control.claim("a")
    job = ReportJob(spark, facts, served)
    # Meanwhile one request is flagged and another is added.
    control.put(request_table(spark, [request(row=2, advertiser="2"), request(row=3, advertiser="3")]))
    paths = job.write(str(tmp_path / "out"), run_id="a")
    control.finish("a")
    assert [r["request_id"] for r in spark.read.parquet(paths["manifest"]).collect()] == [1]
    flags = {r["sheet_row"]: r["Insight_Flag"] for r in control.requests().collect()}
    assert flags == {1: "No", 2: "Yes", 3: "Yes"}
    nxt = serve(spark, facts, control, str(tmp_path / "out"))
    assert sorted(r["request_id"] for r in spark.read.parquet(nxt["manifest"]).collect()) == [2, 3]


def test_a_failed_write_gives_its_requests_back(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    facts = facts_from_testdata(spark, SF_SMALL)
    control = control_of(spark, f"{out}/requests", REQUEST_ROWS[1:4])
    serve(spark, facts, control, out, first_only=True, run_id="a")
    before = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*") if p.is_file()}

    def fail(*_):
        raise RuntimeError("mail table")

    monkeypatch.setattr(ReportJob, "delivery_manifest", fail)
    with pytest.raises(RuntimeError):
        serve(spark, facts, control, out, first_only=True, run_id="b")
    assert all(os.stat(p).st_mtime_ns == t for p, t in before.items())
    flags = {r["sheet_row"]: r["Insight_Flag"] for r in control.requests().collect()}
    assert flags == {1: "No", 2: "Yes", 3: "Yes"} and control.claims().count() == 0
    # A run never writes over another.
    monkeypatch.undo()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        serve(spark, facts, control, out, first_only=True, run_id="a")
    assert {r["sheet_row"] for r in control.requests().filter("Insight_Flag = 'Yes'").collect()} == {2, 3}


def test_the_mail_lists_ids_as_given(spark):
    rows = [request(advertiser="1|1", io="3|3|1", pixel="2|2", seg="7|7|7")]
    job = ReportJob(spark, facts_from_testdata(spark, SF_SMALL), request_table(spark, rows))
    (mail,) = job.delivery_manifest().collect()
    assert "advertiser: 1,1, insertion_order_id: 3,3,1," in mail["body"]
    assert ",conversion pixel_id: 2,2" in mail["body"] and mail["body"].endswith(",segment pixel_id: 7,7,7")


def files_by_folder(path):
    return Counter(str(p.parent) for p in path.rglob("*.parquet"))


def test_small_sheets_are_one_file_and_a_large_one_is_split(spark, tmp_path):
    system = spark.range(40_000).selectExpr(
        "date'2024-01-05' AS dt", "1L AS advertiser_id", "1L AS insertion_order_id", "0L AS pixel_id",
        "'pc' AS device_type", "concat('os', id) AS os_name", "'b' AS browser_name", "1 AS width", "1 AS height",
        "id + 1 AS impressions", "0L AS clicks", "1L AS pcconversions", "0L AS pvconversions")
    small = spark.range(2, 102).selectExpr(
        "date'2024-01-05' AS dt", "id AS advertiser_id", "1L AS insertion_order_id", "0L AS pixel_id",
        "'pc' AS device_type", "'linux' AS os_name", "'b' AS browser_name", "1 AS width", "1 AS height",
        "1L AS impressions", "0L AS clicks", "1L AS pcconversions", "0L AS pvconversions")
    tables = facts(spark)
    tables["system"] = system.unionAll(small)
    rows = [request(row=i, advertiser=str(i)) for i in range(1, 102)]
    # Sizes of a cluster, divided by about two thousand.
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8k"}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        job = ReportJob(spark, tables, request_table(spark, rows))
        scratch = job.scratch.path
        job.write(str(tmp_path / "out"), run_id="r")
    finally:
        for k in sizes:
            spark.conf.unset(k)
    found = files_by_folder(tmp_path / "out" / "report")
    large = found.pop(str(tmp_path / "out" / "report" / "run=r" / "request_id=1" / "sheet=Device_Os"))
    assert large > 1 and set(found.values()) == {1} and len(found) == 101 * 4 - 1
    assert not os.path.exists(scratch.removeprefix("file:"))  # nothing of the job's own tables is left


def test_read_fact_from_catalog_table(spark):
    from adinsight.schemas import FACT_SCHEMAS
    from adinsight.sources.facts import read_fact
    from testbed.projections import fact_from_testdata
    fact_from_testdata(spark, "inventory", SF_SMALL).createOrReplaceTempView("inv_fact")
    df = read_fact(spark, "inventory", "table:inv_fact")
    assert df.schema.fieldNames() == FACT_SCHEMAS["inventory"].fieldNames()
    assert df.count() > 0


def test_no_pending_requests_gives_empty_outputs(spark, tmp_path):
    idle = [r for r in REQUEST_ROWS if r[8] is None or "Yes" not in r[8]]
    job = ReportJob(spark, facts_from_testdata(spark, SF_SMALL), request_table(spark, idle))
    assert job.report_long().count() == 0
    assert job.sheet("City_Region").count() == 0
    control = control_of(spark, tmp_path / "out" / "requests", idle)
    paths = serve(spark, facts_from_testdata(spark, SF_SMALL), control, str(tmp_path / "out"))
    assert spark.read.parquet(paths["manifest"]).count() == 0
    flags = {r["sheet_row"]: r["Insight_Flag"] for r in spark.read.parquet(paths["requests"]).collect()}
    assert flags == {r[0]: r[8] for r in idle}
