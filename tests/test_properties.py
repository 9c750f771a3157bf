"""Properties of the report at test-data scale, plus batch equivalence."""

from __future__ import annotations

from collections import defaultdict

import pytest

from testbed.registry import job_for
from adinsight.plans.report import ReportJob
from adinsight.plans.sheets import SHEET_NAMES
from testbed.projections import facts_from_testdata
from testbed.fixtures import REQUEST_ROWS, request_table
from tests.conftest import SF_SMALL

SHARES = ["Percentage_Impression_share", "Percentage_Click_share", "Percentage_Conversion_share"]


@pytest.fixture(scope="module")
def report(spark):
    return [r.asDict() for r in job_for(spark, SF_SMALL).report_long().collect()]


def _sums(report, by):
    out = defaultdict(lambda: [0.0, 0.0, 0.0])
    for r in report:
        k = by(r)
        for i, s in enumerate(SHARES):
            out[k][i] += r[s]
    return out


def test_shares_sum_to_100_or_0(report):
    full = {"TOD_Weekday", "TOD_Weekend", "DOW", "Device_type", "Creative_Size", "Regions"}
    sums = _sums([r for r in report if r["sheet"] in full], lambda r: (r["request_id"], r["sheet"]))
    assert sums
    for v in sums.values():
        for s in v:
            assert s == pytest.approx(100) or s == 0


def test_within_class_shares_sum_to_100(report):
    sums = _sums([r for r in report if r["sheet"] in ("Device_Os", "Browser")],
                 lambda r: (r["request_id"], r["sheet"], r["device_types"]))
    assert sums
    for v in sums.values():
        for s in v:
            assert s == pytest.approx(100) or s == 0


def test_filtered_sheets_sum_at_most_100(report):
    sums = _sums([r for r in report if r["sheet"] in ("Site_Domains", "City_Region", "City_postal_code")],
                 lambda r: (r["request_id"], r["sheet"]))
    assert sums
    for v in sums.values():
        for s in v:
            assert s <= 100 + 1e-9


def test_site_threshold_holds(report):
    assert all(r["Percentage_Impression_share"] > 0.01 for r in report if r["sheet"] == "Site_Domains")


def test_no_geo_sheets_without_country(report):
    geo = {"City_Region", "Regions", "City_postal_code"}
    assert not [r for r in report if r["request_id"] == 5 and r["sheet"] in geo]   # UTC
    assert not [r for r in report if r["request_id"] == 7]                          # no advertiser


def test_repeated_id_equals_single_id(report):
    def rows(rid):
        return sorted((r["sheet"], r["impressions"], r["clicks"], r["conversions"])
                      for r in report if r["request_id"] == rid and r["sheet"] != "City_Region"
                      and r["sheet"] not in ("Regions", "City_postal_code"))
    assert rows(5) == rows(6)   # "1" (UTC) and "1|1" (AEST) agree on non-geo sheets


def test_batch_equals_single_request_jobs(spark, report):
    facts = facts_from_testdata(spark, SF_SMALL)
    single = []
    for row in REQUEST_ROWS:
        job = ReportJob(spark, facts, request_table(spark, [row]))
        single += [r.asDict() for r in job.report_long().collect()]
    key = lambda r: tuple(sorted((k, repr(v)) for k, v in r.items()))
    assert sorted(map(key, single)) == sorted(map(key, report))


def test_shared_grains_equal_separate_extracts(spark):
    job = job_for(spark, SF_SMALL)
    for name in ("device", "os", "browser", "size", "city", "postcode"):
        shared = job.shared_extracts[name]
        alone = job.extract(name)
        cols = sorted(alone.columns)
        assert sorted(shared.select(*cols).collect()) == sorted(alone.select(*cols).collect()), name


def test_first_only_is_the_first_of_the_batch(spark, report):
    first = [r.asDict() for r in job_for(spark, SF_SMALL, first_only=True).report_long().collect()]
    key = lambda r: tuple(sorted((k, repr(v)) for k, v in r.items()))
    assert sorted(map(key, first)) == sorted(map(key, [r for r in report if r["request_id"] == 0]))
    assert {r["sheet"] for r in first} == set(SHEET_NAMES)  # it meets all four facts


def test_row_ids_are_consecutive_and_follow_sheet_order(spark):
    rows = [r.asDict() for r in job_for(spark, SF_SMALL).report_long(row_ids=True).collect()]
    groups = defaultdict(list)
    for r in rows:
        groups[(r["request_id"], r["sheet"])].append(r)
    assert groups
    for (rid, sheet), items in groups.items():
        items.sort(key=lambda r: r["row_id"])
        assert [r["row_id"] for r in items] == list(range(1, len(items) + 1)), (rid, sheet)
        if sheet in ("Site_Domains", "City_Region", "City_postal_code"):
            shares = [r["Percentage_Impression_share"] for r in items]
            assert shares == sorted(shares, reverse=True)
        if sheet in ("TOD_Weekday", "TOD_Weekend"):
            hours = [r["day_hour"] for r in items]
            assert hours == sorted(hours)


def test_sheets_have_no_more_rows_than_their_extracts(spark, report):
    from adinsight.plans.report import SHEET_BUILDERS
    job = job_for(spark, SF_SMALL)
    extract_rows = {}
    for name, df in job.shared_extracts.items():
        for r in df.groupBy("request_id").count().collect():
            extract_rows[(name, r["request_id"])] = r["count"]
    sheet_rows = defaultdict(int)
    for r in report:
        sheet_rows[(r["sheet"], r["request_id"])] += 1
    assert sheet_rows
    for (sheet, rid), n in sheet_rows.items():
        ext = SHEET_BUILDERS[sheet][1]
        assert n <= extract_rows.get((ext, rid), 0), (sheet, rid)


def test_every_fact_row_is_scoped(spark):
    """The whole-table requests of the fixture reach every row of every fact, by zone and country."""
    job = job_for(spark, SF_SMALL)
    whole = {0: "AEST", 11: "NZST", 12: "UTC"}
    tod = {(r["request_id"], r["time_zone_name"]): r["count"] for r in
           job.scoped("placement_hour").groupBy("request_id", "time_zone_name").count().collect()}
    for r in job.facts["placement_hour"].groupBy("time_zone_name").count().collect():
        assert tod[next(k for k, z in whole.items() if z == r["time_zone_name"]), r["time_zone_name"]] == r["count"]
    for fact in ("inventory", "system"):
        n = {r["request_id"]: r["count"] for r in job.scoped(fact).groupBy("request_id").count().collect()}
        assert all(n[k] == job.facts[fact].count() for k in whole)
    geo = {(r["request_id"], r["de_country_name"]): r["count"] for r in
           job.scoped("geo").groupBy("request_id", "de_country_name").count().collect()}
    zones = {"australia": 0, "AU": 0, "Australia": 0, "new zealand": 11, "NZ": 11, "New Zealand": 11}
    for r in job.facts["geo"].groupBy("de_country_name").count().collect():
        if r["de_country_name"] in zones:
            assert geo[zones[r["de_country_name"]], r["de_country_name"]] == r["count"]


@pytest.mark.parametrize("name", SHEET_NAMES)
def test_every_sheet_is_in_its_order(spark, name):
    """``sheet`` (one order per sheet) agrees with the row numbers (one shared sort)."""
    job = job_for(spark, SF_SMALL)
    rows = [r.asDict() for r in job.sheet(name).collect()]
    numbered = [r.asDict() for r in _numbered(spark) if r["sheet"] == name]
    numbered.sort(key=lambda r: (r["request_id"], r["row_id"]))
    assert rows and [{k: r[k] for k in rows[0]} for r in numbered] == rows


_ROWS = []


def _numbered(spark):
    if not _ROWS:
        _ROWS.extend(job_for(spark, SF_SMALL).report_long(row_ids=True).collect())
    return _ROWS
