"""Daily aggregates in place of the facts."""

from __future__ import annotations

import shutil

import pytest

from adinsight.plans.report import EXTRACT_GRAINS, ReportJob
from adinsight.sources.daily import DailyFact, refreshed_facts
from adinsight.sources.facts import read_fact, write_fact
from testbed.fixtures import REQUEST_ROWS, request_table
from testbed.projections import facts_from_testdata
from tests.conftest import SF_SMALL, fact, request, sorted_rows


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stored")
    for name, df in facts_from_testdata(spark, SF_SMALL).items():
        few = df.filter("dt BETWEEN '1996-01-01' AND '1996-01-20' OR dt BETWEEN '2024-01-01' AND '2024-01-20'")
        write_fact(few.coalesce(1), name, str(base / name))
    return {name: str(base / name) for name in ("placement_hour", "inventory", "system", "geo")}


def test_extracts_are_those_of_the_facts(spark, stored, tmp_path):
    daily = refreshed_facts(spark, stored, str(tmp_path / "daily"))
    direct = {n: read_fact(spark, n, p) for n, p in stored.items()}
    assert all(0 < daily[n].count() <= direct[n].count() for n in stored)
    a, b = (ReportJob(spark, f, request_table(spark, REQUEST_ROWS)) for f in (direct, daily))
    for name in EXTRACT_GRAINS:
        assert sorted_rows(a.raw_extract(name)) == sorted_rows(b.raw_extract(name)), name


def test_groups_of_nulls_only_stay_null(spark, tmp_path):
    rows = [{"pcconversions": None, "impressions": 3}, {"pcconversions": None, "pvconversions": 5},
            {"os_name": "x", "pcconversions": 2, "pvconversions": 1}, {"os_name": "x", "clicks": None},
            {"os_name": None, "clicks": None, "pcconversions": 1}]
    write_fact(fact(spark, "system", rows), "system", str(tmp_path / "system"))
    daily = refreshed_facts(spark, {"system": str(tmp_path / "system")}, str(tmp_path / "daily"))
    reqs = request_table(spark, [request()])
    got, want = (ReportJob(spark, f, reqs).raw_extract("os") for f in (daily, {"system": fact(spark, "system", rows)}))
    assert sorted_rows(got) == sorted_rows(want)
    assert (1, "pc", "linux", 3, 0, None) in [tuple(r) for r in got.collect()]


def test_only_changed_days_are_summed_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "system")
    rows = [{"dt": d, "impressions": n} for n, d in enumerate(_days(4), 1)]
    write_fact(fact(spark, "system", rows), "system", path)
    daily = DailyFact(spark, "system", path, str(tmp_path / "daily"))
    assert daily.refresh() == _days(4) and daily.refresh() == []
    before = daily.read()
    # One day is rewritten, one goes, one comes.
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_fact(fact(spark, "system", [{"dt": _days(5)[1], "impressions": 70}, {"dt": _days(5)[4], "impressions": 9}]), "system", path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    shutil.rmtree(f"{path}/dt={_days(4)[0]}")
    assert daily.refresh() == [_days(5)[1], _days(5)[4]]
    got = {(r["dt"], r["impressions"]) for r in daily.read().collect()}
    assert got == {(_days(5)[1], 70), (_days(5)[2], 3), (_days(5)[3], 4), (_days(5)[4], 9)}
    # A reader that began before sees the state it began with.
    assert {r["impressions"] for r in before.collect()} == {1, 2, 3, 4}
    # The second run reads the aggregate only.
    job = ReportJob(spark, {"system": daily.read()}, request_table(spark, [request()]))
    files = job.sums("system", ["os_name"]).inputFiles()
    assert files and not any(f.startswith(f"file://{path}/") for f in files)


def test_the_command_line_keeps_daily_aggregates(spark, stored, tmp_path):
    from adinsight.__main__ import main
    args = [x for n, p in stored.items() for x in (f"--{n.replace('_', '-')}", p)]
    request_table(spark, REQUEST_ROWS[1:3]).write.parquet(str(tmp_path / "requests"))
    paths = main(["--requests", str(tmp_path / "requests"), "--requests-format", "parquet", "--out", str(tmp_path / "out"),
                  "--daily", str(tmp_path / "daily"), *args])
    direct = {n: read_fact(spark, n, p) for n, p in stored.items()}
    want = ReportJob(spark, direct, request_table(spark, REQUEST_ROWS[1:3])).report_long()
    assert spark.read.parquet(paths["report"]).count() == want.count() > 0


def _days(n):
    from datetime import date, timedelta
    return [date(2024, 1, 1) + timedelta(days=i) for i in range(n)]
