"""Request control table: parsing, pending, first-only, claim."""

from __future__ import annotations

from datetime import date

from adinsight.sources import requests as R
from testbed.fixtures import REQUEST_ROWS, request_table
from tests.conftest import request


def parsed(spark, rows):
    return {r["request_id"]: r.asDict() for r in R.parse_requests(request_table(spark, rows)).collect()}


def test_id_lists(spark):
    p = parsed(spark, [request(advertiser="1|2", io=" 3 , x|4 ", pixel="NA", seg=""),
                       request(row=2, advertiser="NA", io="abc"),
                       request(row=3, advertiser="5|5|6")])
    assert p[1]["advertiser_ids"] == [1, 2]
    assert p[1]["io_ids"] == [3, 4]          # bad token dropped, blanks trimmed
    assert p[1]["conv_pixel_ids"] is None    # NA: no filter
    assert p[1]["seg_pixel_ids"] is None     # empty cell: no filter
    assert p[2]["advertiser_ids"] is None and p[2]["status"] == "invalid"
    assert p[2]["io_ids"] == []              # only bad tokens: matches nothing
    assert p[3]["advertiser_ids"] == [5, 6]
    assert p[1]["from_dt"] == date(2024, 1, 1) and p[1]["to_dt"] == date(2024, 1, 31)


def test_pending_is_case_sensitive_substring(spark):
    p = parsed(spark, REQUEST_ROWS)
    assert sorted(k for k, v in p.items() if v["pending"]) == [0, 1, 2, 3, 4, 5, 6, 7, 11, 12]


def test_first_only(spark):
    pend = R.pending(R.parse_requests(request_table(spark)))
    assert [r["request_id"] for r in R.first_only(pend).collect()] == [0]


def test_claim_flips_only_served_rows(spark):
    raw = request_table(spark)
    served = R.pending(R.parse_requests(raw)).filter("request_id IN (1, 4)")
    out = {r["sheet_row"]: r["Insight_Flag"] for r in R.claim(raw, served).collect()}
    assert out[1] == "No" and out[4] == "No"
    assert out[2] == "Yes" and out[8] == "No" and out[9] == "yes" and out[10] is None
    assert out[11] == "Yes"
    assert R.claim(raw, served).columns == raw.columns


def test_bad_dates_make_request_invalid(spark):
    p = parsed(spark, [request(start="2024-13-01")])
    assert p[1]["from_dt"] is None and p[1]["status"] == "invalid"


def test_read_requests_csv(spark, tmp_path):
    import csv
    from adinsight.schemas import REQUEST_RAW
    path = tmp_path / "requests.csv"
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(REQUEST_RAW.fieldNames())
        for r in REQUEST_ROWS:
            w.writerow(["" if v is None else v for v in r])
    raw = R.read_requests(spark, str(path))
    assert raw.schema == REQUEST_RAW
    got = {r["request_id"]: r for r in R.parse_requests(raw).collect()}
    want = {r["request_id"]: r for r in R.parse_requests(request_table(spark)).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert got[k]["advertiser_ids"] == want[k]["advertiser_ids"]
        assert got[k]["pending"] == want[k]["pending"]


def _csv(path, header, rows):
    import csv
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(["" if v is None else v for v in r] for r in rows)
    return str(path)


def test_exported_sheet_without_row_numbers(spark, tmp_path):
    from adinsight.schemas import REQUEST_RAW
    names = REQUEST_RAW.fieldNames()
    path = _csv(tmp_path / "nine.csv", names[1:], [r[1:] for r in REQUEST_ROWS])
    raw = R.read_requests(spark, path).collect()
    assert [r["sheet_row"] for r in raw] == list(range(1, len(REQUEST_ROWS) + 1))
    assert [r["Timezone"] for r in raw] == [r[7] for r in REQUEST_ROWS]
    assert [r["To_email_address"] for r in raw] == [r[9] for r in REQUEST_ROWS]


def test_columns_are_found_by_name(spark, tmp_path):
    from adinsight.schemas import REQUEST_RAW
    names = REQUEST_RAW.fieldNames()[::-1]
    raw = R.read_requests(spark, _csv(tmp_path / "turned.csv", names, [r[::-1] for r in REQUEST_ROWS]))
    assert raw.schema == REQUEST_RAW and [tuple(r) for r in raw.collect()] == [tuple(r) for r in request_table(spark).collect()]


def test_unknown_or_missing_columns_fail(spark, tmp_path):
    import pytest
    from adinsight.schemas import REQUEST_RAW
    names = REQUEST_RAW.fieldNames()
    with pytest.raises(ValueError, match="unknown columns .'Flag'"):
        R.read_requests(spark, _csv(tmp_path / "a.csv", [*names, "Flag"], [(*r, "x") for r in REQUEST_ROWS]))
    with pytest.raises(ValueError, match="missing columns .'To_email_address'"):
        R.read_requests(spark, _csv(tmp_path / "b.csv", names[:-1], [r[:-1] for r in REQUEST_ROWS]))


def test_rows_that_share_a_number_are_refused(spark, tmp_path):
    import pytest
    from adinsight.plans.report import ReportJob
    from adinsight.schemas import REQUEST_RAW
    folder = tmp_path / "two"
    folder.mkdir()
    for name in ("a", "b"):  # two files that number their rows alike
        _csv(folder / f"{name}.csv", REQUEST_RAW.fieldNames(), [request(advertiser="1" if name == "a" else "2")])
    job = ReportJob(spark, {}, R.read_requests(spark, str(folder)))
    with pytest.raises(ValueError, match="without a number of their own"):
        job.requests
    with pytest.raises(ValueError):
        R.check_identity(request_table(spark, [request(row=None)]))
