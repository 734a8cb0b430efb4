"""The hourly batch job: all history views from two passes over the history.

    spark-submit -m netvitals.plans.batch_job --input <ndjson folder> --output <root>
"""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvitals.functions.rounding import shown
from netvitals.operators import history
from netvitals.operators.alerts import last_episodes
from netvitals.operators.episodes import outage_episodes
from netvitals.plans.session import build_session
from netvitals.plans.shared import discard, settle, together
from netvitals.plans.sql_views import batch_summary
from netvitals.plans.store import write_view
from netvitals.sources.ndjson import read_history, read_probes


def batch_views(probes: DataFrame) -> dict[str, DataFrame]:
    """The batch views. Pass one makes the hourly cube, pass two the quantiles; most else is
    taken from those two small tables. Country rollup, summary and outage episodes read the
    history themselves."""
    return _views(probes, *_tables(probes))


def _tables(probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    made: dict[str, DataFrame] = {}

    def cube() -> None:
        made["cube"] = settle(history.hourly_cube(probes), "cube")

    def latency() -> None:
        made["latency"] = settle(history.latency_by_region(probes, ordered=False), "latency")

    together(probes.sparkSession, cube, latency)
    return made["cube"], made["latency"]


def _views(probes: DataFrame, cube: DataFrame, latency: DataFrame) -> dict[str, DataFrame]:
    outages = history.outage_frequency(cube)
    return {
        "latency_by_region": latency.orderBy(F.desc("avg_latency_ms"), "region_id"),
        "outage_frequency": outages,
        "hourly_health_trend": history.hourly_health_trend(cube),
        "top_affected": history.top_affected(latency, outages),
        "global_summary": history.global_summary(cube),
        "country_rollup": history.country_rollup(probes),
        "batch_summary": batch_summary(probes.sparkSession, probes),
        "last_episodes": last_episodes(outage_episodes(probes)),
    }


def run_batch(probes: DataFrame, root: str, fmt: str = "parquet") -> None:
    cube, latency = _tables(probes)

    def write(name: str, view: DataFrame) -> None:
        stamped = shown(view, name)
        if name == "global_summary":
            stamped = stamped.withColumn("computed_at", F.current_timestamp())
        write_view(stamped, f"{root}/batch/{name}", fmt)

    # the views are independent of each other
    views = _views(probes, cube, latency)
    together(probes.sparkSession, *[partial(write, name, view) for name, view in views.items()])
    discard(cube, latency)


def main() -> None:
    parser = argparse.ArgumentParser(description="Batch views over the probe history")
    parser.add_argument("--input", required=True, help="NDJSON folder, or history with --parquet")
    parser.add_argument("--output", required=True, help="root folder of the views")
    parser.add_argument("--format", default="parquet", choices=["parquet", "json"])
    parser.add_argument("--parquet", action="store_true", help="input is compacted history")
    args = parser.parse_args()
    spark = build_session("netvitals-batch")
    read = read_history if args.parquet else read_probes
    run_batch(read(spark, args.input), args.output, args.format)
    spark.stop()


if __name__ == "__main__":
    main()
