"""Benchmark: report queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line.  ``value`` is the wall time of the headline query: the
full report (all eleven sheets) for every pending request in one batch, from
reading the request table to the last sheet row (median of five runs after
one untimed warm-up run on the same data).  Every query is forced to
completion through the ``noop`` sink (no collect).  The ``serial`` figure
runs the same requests one job per request, the way the reference serves
them, for comparison with the batch job.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from testbed.registry import job_for  # noqa: E402
from adinsight.plans.report import ReportJob  # noqa: E402
from adinsight.plans.sheets import SHEET_NAMES  # noqa: E402
from adinsight.session import get_spark  # noqa: E402
from testbed.projections import facts_from_testdata  # noqa: E402
from testbed.fixtures import REQUEST_ROWS, request_table  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return round(time.perf_counter() - t, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", conf={
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR"})
    # Warm-up (JVM start, class loading, code generation), not timed.
    _run(job_for(spark, sf_dir).report_long())

    times: dict[str, float] = {}
    runs = sorted(_timed(lambda: _run(job_for(spark, sf_dir).report_long())) for _ in range(5))
    times["report_all"] = runs[len(runs) // 2]
    # Phases of one more run of the headline query.
    t0 = time.perf_counter()
    job = job_for(spark, sf_dir)
    job.bounds
    t1 = time.perf_counter()
    job.shared_extracts
    t2 = time.perf_counter()
    rl = job.report_long()
    t3 = time.perf_counter()
    _run(rl)
    t4 = time.perf_counter()
    times["phase_request_check"] = round(t1 - t0, 3)
    times["phase_fact_extracts"] = round(t2 - t1, 3)
    times["phase_plan_sheets"] = round(t3 - t2, 3)
    times["phase_run_sheets"] = round(t4 - t3, 3)
    times["report_first"] = _timed(
        lambda: _run(job_for(spark, sf_dir, first_only=True).report_long()))
    times["manifest"] = _timed(lambda: _run(job_for(spark, sf_dir).delivery_manifest()))
    for name in SHEET_NAMES:
        times[f"sheet_{name}"] = _timed(lambda n=name: _run(job_for(spark, sf_dir).sheet(n)))

    # The same pending requests served one job each (the reference's mode).
    facts = facts_from_testdata(spark, sf_dir)

    def serial():
        for row in (r for r in REQUEST_ROWS if "Yes" in (r[8] or "")):
            job = ReportJob(spark, facts, request_table(spark, [row]))
            _run(job.report_long())
    times["serial_one_job_per_request"] = _timed(serial)

    # Requests for the same rows: a fact is read and summed once for all of them.
    whole = next(r for r in REQUEST_ROWS if r[0] == 0)
    for n in (1, 10, 100):
        rows = [(i, *whole[1:]) for i in range(n)]
        times[f"equal_requests_{n}"] = _timed(
            lambda rows=rows: _run(ReportJob(spark, facts, request_table(spark, rows)).sums("system", ["device_type", "os_name"])))

    n_rows = job_for(spark, sf_dir).report_long().agg(F.count(F.lit(1))).first()[0]
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "report_all_requests_all_sheets",
        "value": times["report_all"],
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "report_all_runs": runs,
        "report_rows": n_rows,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
