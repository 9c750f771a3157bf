"""Command line: serve the pending requests of a control table.

    spark-submit ... -m adinsight --requests requests.csv --out OUT \\
        --placement-hour P --inventory P --system P --geo P

Writes ``OUT/report/run=<id>`` (partitioned by request and sheet) and
``OUT/manifest/run=<id>``.  The control table lies in ``OUT/requests``: rows of
``--requests`` that it does not have yet are added, and a later run may leave
``--requests`` out.  Several runs may share a control table.  ``--release RUN``
gives back what a run that died had claimed, and serves nothing.  With ``--daily``
the facts are read as daily aggregates kept in that folder, of which only the days
that changed since the last run are summed anew.
"""

from __future__ import annotations

import argparse
import json
import sys

from adinsight.plans.report import serve
from adinsight.session import get_spark
from adinsight.sources.control import ControlTable
from adinsight.sources.daily import refreshed_facts
from adinsight.sources.facts import FACTS, read_fact
from adinsight.sources.requests import read_requests


def main(argv: list[str] | None = None) -> dict[str, str]:
    ap = argparse.ArgumentParser(prog="adinsight", description=__doc__.split("\n")[0])
    ap.add_argument("--requests", help="table of requests to add to the control table")
    ap.add_argument("--requests-format", default="csv")
    ap.add_argument("--out", required=True)
    ap.add_argument("--fact-format", default="parquet")
    for name in FACTS:
        ap.add_argument(f"--{name.replace('_', '-')}", dest=name,
                        help=f"{name} fact: path, or table:<catalog name>")
    ap.add_argument("--first-only", action="store_true", help="serve only the first pending request")
    ap.add_argument("--csv-sheets", action="store_true", help="also write each sheet as CSV")
    ap.add_argument("--daily", metavar="FOLDER", help="keep and read daily aggregates of the facts here")
    ap.add_argument("--release", metavar="RUN", help="give back the requests claimed by a run that died")
    args = ap.parse_args(argv)

    spark = get_spark()
    control = ControlTable(spark, f"{args.out.rstrip('/')}/requests")
    if args.release:
        paths = {"requests": control.data_path(control.release(args.release))}
        print(json.dumps(paths))
        return paths
    missing = [n for n in FACTS if not getattr(args, n)]
    if missing:
        ap.error(f"facts not given: {', '.join(missing)}")
    if args.requests:
        control.add(read_requests(spark, args.requests, args.requests_format))
    if args.daily:
        facts = refreshed_facts(spark, {n: getattr(args, n) for n in FACTS}, args.daily)
    else:
        facts = {n: read_fact(spark, n, getattr(args, n), args.fact_format) for n in FACTS}
    paths = serve(spark, facts, control, args.out, first_only=args.first_only, csv_sheets=args.csv_sheets)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main(sys.argv[1:])
