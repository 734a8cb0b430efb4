"""Runs a named report over stored probes and prints it or writes it as JSON.

    spark-submit -m netvitals.plans.report_job --input <folder> --query latency_trend --country US
"""

from __future__ import annotations

import argparse

from netvitals.plans.session import build_session
from netvitals.plans.sql_views import REPORTS, run_report
from netvitals.plans.store import write_view
from netvitals.sources.ndjson import read_history, read_probes


def main() -> None:
    parser = argparse.ArgumentParser(description="Named reports over the probe history")
    parser.add_argument("--input", required=True, help="NDJSON folder, or history with --parquet")
    parser.add_argument("--parquet", action="store_true", help="input is compacted history")
    parser.add_argument("--query", required=True, choices=sorted(REPORTS))
    parser.add_argument("--country", help="country code of latency_trend")
    parser.add_argument("--as-of", type=int, help="epoch second; default is the newest record")
    parser.add_argument("--out", help="folder for the rows as JSON; printed when left out")
    args = parser.parse_args()
    spark = build_session("netvitals-report")
    probes = (read_history if args.parquet else read_probes)(spark, args.input)
    params = {"country": args.country} if args.country else {}
    rows = run_report(spark, args.query, probes, args.as_of, **params)
    if args.out:
        write_view(rows, args.out, "json")
    else:
        # every row, a partition at a time through the driver
        for line in rows.toJSON().toLocalIterator():
            print(line)
    spark.stop()


if __name__ == "__main__":
    main()
