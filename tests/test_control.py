"""The control table: compare-and-set versions and claims."""

from __future__ import annotations

import threading

from adinsight.sources.control import ControlTable
from testbed.fixtures import request_table
from tests.conftest import request


def flags(control):
    return {r["sheet_row"]: r["Insight_Flag"] for r in control.requests().collect()}


def table(spark, path, rows):
    control = ControlTable(spark, str(path))
    control.add(request_table(spark, rows))
    return control


def test_two_jobs_from_one_version_do_not_serve_the_same_request(spark, tmp_path, monkeypatch):
    one = table(spark, tmp_path, [request(row=1), request(row=2)])
    two = ControlTable(spark, str(tmp_path))
    theirs = []
    create = ControlTable._created

    def late(self, version, text):
        if self is one and not theirs:  # the other job commits between our read and our commit
            theirs.append({r["sheet_row"] for r in two.claim("two", first_only=True).collect()})
        return create(self, version, text)

    monkeypatch.setattr(ControlTable, "_created", late)
    ours = {r["sheet_row"] for r in one.claim("one").collect()}
    assert theirs == [{1}] and ours == {2}
    assert {(r["sheet_row"], r["claim_run"]) for r in one.claims().collect()} == {(1, "two"), (2, "one")}
    assert [one.commit(v)["parent"] for v in (1, 2, 3)] == [0, 1, 2] and one.version() == 3


def test_rows_added_meanwhile_survive(spark, tmp_path, monkeypatch):
    one = table(spark, tmp_path, [request(row=1)])
    two = ControlTable(spark, str(tmp_path))
    create, done = ControlTable._created, []

    def late(self, version, text):
        if self is one and not done:
            done.append(two.add(request_table(spark, [request(row=7, flag="no")])))
        return create(self, version, text)

    monkeypatch.setattr(ControlTable, "_created", late)
    assert [r["sheet_row"] for r in one.claim("a").collect()] == [1]
    assert flags(one) == {1: "No", 7: "no"}
    # The abandoned table of the first attempt is gone; one folder per version is left.
    assert len([p for p in (tmp_path / "data").iterdir()]) == one.version() == 3


def test_many_claimers_share_the_requests_out(spark, tmp_path):
    control = table(spark, tmp_path, [request(row=i) for i in range(1, 6)])
    got = {}

    def work(run):
        rows = ControlTable(spark, str(tmp_path)).claim(run, first_only=True).collect()
        got[run] = [r["sheet_row"] for r in rows]

    threads = [threading.Thread(target=work, args=(f"run{i}",)) for i in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(x for v in got.values() for x in v) == [1, 2, 3, 4, 5]
    assert all(len(v) == 1 for v in got.values()) and control.version() == 6


def test_finish_keeps_a_flag_set_anew_and_release_brings_flags_back(spark, tmp_path):
    control = table(spark, tmp_path, [request(row=1), request(row=2, flag="Yes!"), request(row=3, flag="No")])
    assert sorted(r["Insight_Flag"] for r in control.claim("a").collect()) == ["Yes", "Yes!"]
    assert flags(control) == {1: "No", 2: "No", 3: "No"}
    control.put(request_table(spark, [request(row=1, advertiser="9")]))
    control.finish("a")
    assert flags(control) == {1: "Yes", 2: "No", 3: "No"}
    control.claim("b")
    control.release("b")
    control.release("unknown")
    assert flags(control) == {1: "Yes", 2: "No", 3: "No"}
    (row,) = control.requests().filter("sheet_row = 1").collect()
    assert row["Advertiser_ID"] == "9"


def test_add_keeps_the_rows_it_has(spark, tmp_path):
    control = table(spark, tmp_path, [request(row=1, flag="No")])
    control.add(request_table(spark, [request(row=1), request(row=2)]))
    assert flags(control) == {1: "No", 2: "Yes"}
    assert ControlTable(spark, str(tmp_path / "none")).read().count() == 0
