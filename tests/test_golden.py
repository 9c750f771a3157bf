"""Hand-made micro fixtures for the semantic traps of the reports."""

from __future__ import annotations

from datetime import date

import pytest

from adinsight.plans.report import ReportJob
from testbed.fixtures import request_table
from tests.conftest import facts, request


def job(spark, req=None, **rows):
    return ReportJob(spark, facts(spark, **rows), request_table(spark, [req or request()]))


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_g1_null_conversions_group_dropped(spark):
    j = job(spark, system=[
        dict(device_type="mobile", impressions=100, clicks=5, pcconversions=None, pvconversions=1),
        dict(device_type="phone", impressions=50, clicks=5, pcconversions=1, pvconversions=0)])
    (r,) = rows_of(j.sheet("Device_type"))
    assert (r["device_types"], r["impressions"], r["clicks"], r["conversions"]) == ("phone", 50, 5, 1)
    assert r["Percentage_CTR"] == 10 and r["Percentage_CVR"] == 2
    assert r["Percentage_Impression_share"] == 100 and r["Percentage_Click_share"] == 100
    assert r["Percentage_Conversion_share"] == 100


def test_g2_os_shares_within_device_class(spark):
    j = job(spark, system=[
        dict(device_type="pc", os_name="linux", impressions=300, clicks=3),
        dict(device_type="pc", os_name="macos", impressions=100, clicks=1),
        dict(device_type="Phone", os_name="ios", impressions=50, clicks=0)])
    got = {(r["device_types"], r["os_name"]): r for r in rows_of(j.sheet("Device_Os"))}
    assert got[("pc", "linux")]["Percentage_Impression_share"] == 75
    assert got[("pc", "macos")]["Percentage_Impression_share"] == 25
    assert got[("phone", "ios")]["Percentage_Impression_share"] == 100
    assert got[("pc", "linux")]["Percentage_Click_share"] == 75
    assert got[("phone", "ios")]["Percentage_Click_share"] == 0
    assert all(r["Percentage_Conversion_share"] == 0 for r in got.values())


def test_g3_null_os_leaves_fine_sheet_only(spark):
    j = job(spark, system=[
        dict(device_type="tablet", os_name=None, impressions=10, clicks=1, pcconversions=1),
        dict(device_type="Tablet", os_name="ios", impressions=30, clicks=1)])
    (d,) = rows_of(j.sheet("Device_type"))
    assert (d["device_types"], d["impressions"], d["clicks"], d["conversions"]) == ("tablet", 40, 2, 1)
    (o,) = rows_of(j.sheet("Device_Os"))
    assert (o["device_types"], o["os_name"], o["impressions"], o["clicks"], o["conversions"]) == \
        ("tablet", "ios", 30, 1, 0)


def test_g4_city_region_vs_regions(spark):
    j = job(spark, geo=[
        dict(de_city="Sydney", de_region_name="new south wales", impressions=60),
        dict(de_city="sydney", de_region_name="New South Wales", impressions=20),
        dict(de_city="Sydney", de_region_name="NEW SOUTH WALES", impressions=20)])
    (c,) = rows_of(j.sheet("City_Region"))
    assert (c["city"], c["regions"], c["region_code"], c["impressions"]) == ("sydney", "NSW", "02", 80)
    assert c["Percentage_Impression_share"] == 80
    (g,) = rows_of(j.sheet("Regions"))
    assert (g["regions"], g["region_code"], g["impressions"]) == ("NSW", "02", 80)
    assert g["Percentage_Impression_share"] == 100


def test_g5_hour_filter_not_on_day_of_week(spark):
    monday = date(2024, 1, 1)
    j = job(spark, placement_hour=[
        dict(dt=monday, day_hour=6, impressions=10, clicks=1),
        dict(dt=monday, day_hour=7, impressions=30)])
    (t,) = rows_of(j.sheet("TOD_Weekday"))
    assert (t["day_hour"], t["impressions"], t["Percentage_Impression_share"]) == (7, 30, 100)
    assert rows_of(j.sheet("TOD_Weekend")) == []
    (d,) = rows_of(j.sheet("DOW"))
    assert (d["day_name"], d["impressions"], d["clicks"], d["Percentage_CTR"]) == ("Monday", 40, 1, 2.5)


def test_g6_site_threshold_is_strict(spark):
    j = job(spark, inventory=[dict(site_domain="a", impressions=9999),
                              dict(site_domain="b", impressions=1)])
    (a,) = rows_of(j.sheet("Site_Domains"))
    assert a["site_domain"] == "a" and a["Percentage_Impression_share"] == pytest.approx(99.99)


def test_g7_zero_impressions(spark):
    j = job(spark, system=[dict(device_type="pc", impressions=0, clicks=4, pcconversions=1)])
    (r,) = rows_of(j.sheet("Device_type"))
    assert r["Percentage_CTR"] == 0 and r["Percentage_CVR"] == 0
    assert r["Percentage_Impression_share"] == 0
    assert r["Percentage_Click_share"] == 100 and r["Percentage_Conversion_share"] == 100


def test_g8_nz_region_spellings_merge(spark):
    j = job(spark, req=request(tz="NZST"), geo=[
        dict(de_country_name="NZ", de_region_name="hawkes bay", impressions=10),
        dict(de_country_name="New Zealand", de_region_name="Hawke's Bay", impressions=5)])
    (g,) = rows_of(j.sheet("Regions"))
    assert (g["regions"], g["region_code"], g["impressions"]) == ("Hawke's Bay", "06", 15)


@pytest.mark.parametrize("pixel,expected", [("7", 8), ("NA", 10), ("7|8", 10)])
def test_g9_pixel_zero_always_kept(spark, pixel, expected):
    j = job(spark, req=request(pixel=pixel), system=[
        dict(pixel_id=0, impressions=5), dict(pixel_id=7, impressions=3),
        dict(pixel_id=8, impressions=2)])
    (r,) = rows_of(j.sheet("Device_type"))
    assert r["impressions"] == expected


def test_country_gate_and_timezone_scope(spark):
    rows = dict(
        placement_hour=[dict(time_zone_name="AEST", impressions=3, day_hour=9),
                        dict(time_zone_name="UTC", impressions=5, day_hour=9)],
        geo=[dict(de_country_name="australia", impressions=4),
             dict(de_country_name="fiji", impressions=6)])
    au = job(spark, **rows)
    assert [r["impressions"] for r in rows_of(au.sheet("TOD_Weekday"))] == [3]
    assert [r["impressions"] for r in rows_of(au.sheet("Regions"))] == [4]
    other = job(spark, req=request(tz="UTC"), **rows)
    assert [r["impressions"] for r in rows_of(other.sheet("TOD_Weekday"))] == [5]
    assert rows_of(other.sheet("Regions")) == []


def test_insertion_orders_and_dates_inclusive(spark):
    j = job(spark, req=request(io="2|3", start="2024-01-02", end="2024-01-03"), system=[
        dict(insertion_order_id=2, dt=date(2024, 1, 2), impressions=1),
        dict(insertion_order_id=3, dt=date(2024, 1, 3), impressions=2),
        dict(insertion_order_id=3, dt=date(2024, 1, 4), impressions=4),
        dict(insertion_order_id=4, dt=date(2024, 1, 2), impressions=8)])
    (r,) = rows_of(j.sheet("Device_type"))
    assert r["impressions"] == 3


def test_repeated_advertiser_id_counts_once(spark):
    j = job(spark, req=request(advertiser="1|1"), system=[dict(impressions=7)])
    (r,) = rows_of(j.sheet("Device_type"))
    assert r["impressions"] == 7


def test_unmapped_regions_count_in_city_shares(spark):
    j = job(spark, geo=[dict(de_city="A", de_region_name="victoria", impressions=30),
                        dict(de_city="B", de_region_name="nowhere", impressions=70)])
    (c,) = rows_of(j.sheet("City_Region"))
    assert c["city"] == "a" and c["Percentage_Impression_share"] == 30
    (g,) = rows_of(j.sheet("Regions"))
    assert g["Percentage_Impression_share"] == 100


def test_creative_size_label_and_order(spark):
    j = job(spark, system=[dict(width=728, height=90, impressions=1),
                           dict(width=160, height=600, impressions=3)])
    assert [r["size"] for r in rows_of(j.sheet("Creative_Size"))] == ["160x600", "728x90"]


def test_day_of_week_order(spark):
    rows = [dict(dt=date(2024, 1, d), impressions=1) for d in range(1, 8)]  # Mon..Sun
    j = job(spark, placement_hour=rows)
    assert [r["day_name"] for r in rows_of(j.sheet("DOW"))] == [
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def test_unmapped_and_null_device_types_leave_device_sheets(spark):
    j = job(spark, system=[
        dict(device_type="PC", impressions=1), dict(device_type="Mobile", impressions=2),
        dict(device_type="tv", impressions=4), dict(device_type=None, impressions=8),
        dict(device_type="pc or unknown", impressions=16)])
    (r,) = rows_of(j.sheet("Device_type"))
    assert (r["device_types"], r["impressions"], r["Percentage_Impression_share"]) == ("pc", 16, 100)
    assert [x["impressions"] for x in rows_of(j.sheet("Creative_Size"))] == [31]
