"""Runs the speed layer over a folder of arriving NDJSON files, the merge every few seconds and
the incremental batch job every hour beside it.

    spark-submit -m netvitals.streaming.run --input <ndjson folder> --output <root>

One query parses the files for the archive, the rejects, and the kept alerts and metrics; all are
written by batch id, so a batch may run again. The archive takes every record; only the live views
drop repeats. Alerts and metrics take late and repeated records too: read them with `kept_alerts`
and `kept_metrics`, which drop repeats. Windows are appended as the watermark closes them and made
whole from the archive every hour: read them with `kept_windows`.
"""

from __future__ import annotations

import argparse
import logging
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from netvitals.operators import feed, speed, storage
from netvitals.plans import archive, incremental, snapshots
from netvitals.plans.serve import run_merge
from netvitals.plans.session import build_session
from netvitals.plans.shared import together
from netvitals.sources.ndjson import dedup_events, line_stream, parsed_lines, probe_stream, split_parsed
from netvitals.sources.views import read_view
from netvitals.streaming.jobs import paced, sliding_window_table, speed_layer

MERGE_EVERY_S = 15
BATCH_EVERY_S = 3600
log = logging.getLogger(__name__)


ALERTS_DDL = (
    "region STRING, country STRING, flag STRING, severity STRING, latency DOUBLE, loss DOUBLE, "
    "health DOUBLE, ts TIMESTAMP, event_id STRING"
)
METRICS_DDL = (
    "event_id STRING, ts TIMESTAMP, region STRING, country STRING, metric STRING, value DOUBLE, unit STRING"
)


def ingest_batch(lines: DataFrame, batch_id: int, root: str) -> None:
    """One micro-batch of lines into the archive, the rejects and the kept tables, parsed once."""
    rows = parsed_lines(lines, extra=True).persist()
    try:
        records, broken = split_parsed(rows)

        def kept(table: str, made: DataFrame) -> None:
            hourly = storage.with_hour(made).hint("rebalance", "hour")
            snapshots.append(hourly, f"{root}/streams/{table}", f"b{batch_id}", ("stream", batch_id))

        def reject() -> None:
            if not broken.isEmpty():
                stamped = broken.withColumn("received_at", F.current_timestamp())
                stamped.write.mode("overwrite").parquet(f"{root}/rejects/batch={batch_id}")

        together(
            lines.sparkSession,
            lambda: archive.append_batch(records, batch_id, f"{root}/history"),
            reject,
            lambda: kept("outage_alerts", feed.outage_alert_stream(records, "event_id")),
            lambda: kept("metrics_long", storage.metrics_long(records)),
        )
    finally:
        rows.unpersist()


def ingest(lines: DataFrame, root: str) -> DataStreamWriter:
    """Every line of a `line_stream`, however late."""
    return lines.writeStream.foreachBatch(lambda batch, i: ingest_batch(batch, i, root))


def kept_alerts(spark: SparkSession, root: str) -> DataFrame:
    """The kept alerts, each event once; those without an id are all there."""
    return dedup_events(snapshots.read(spark, f"{root}/streams/outage_alerts", ALERTS_DDL).drop("hour"))


def kept_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The kept metrics, each metric of an event once; those without an id are all there."""
    rows = snapshots.read(spark, f"{root}/streams/metrics_long", METRICS_DDL).drop("hour")
    return dedup_events(rows, keys=("event_id", "metric"))


def kept_windows(spark: SparkSession, root: str) -> DataFrame:
    """The closed windows: those made from the archive, and the stream's own after them."""
    whole = incremental.stored_windows(spark, root)
    streamed = read_view(spark, f"{root}/streams/sliding_windows", incremental.WINDOWS_DDL)
    reached = F.coalesce(whole.agg(F.max("window_start")).scalar(), F.lit(0).cast("timestamp"))
    return whole.unionByName(streamed.select(*whole.columns).filter(F.col("window_start") > reached))


def kept_kpis(spark: SparkSession, root: str) -> DataFrame:
    """Global KPIs of each closed window."""
    return speed.speed_global(kept_windows(spark, root))


def start_all(spark: SparkSession, source: str, root: str, window_s: int, every: str | None) -> list:
    """Starts the queries of the speed layer over ``source``; each has its own checkpoint."""
    unique = dedup_events(probe_stream(spark, source))
    writers = {
        "ingest": ingest(line_stream(spark, source), root),
        "speed": speed_layer(unique, root, window_s),
        "windows": sliding_window_table(probe_stream(spark, source), f"{root}/streams/sliding_windows"),
    }
    return [paced(w, f"{root}/_progress/{n}", every).queryName(n).start() for n, w in writers.items()]


def run_hourly(spark: SparkSession, root: str, now: int, days: int = 30) -> dict[str, list[str]]:
    """The batch views from what the archive has new, then retention and compaction."""
    done = incremental.run_incremental(spark, f"{root}/history", root)
    archive.maintain(spark, f"{root}/history", now, days)
    tables = {"outage_alerts": (ALERTS_DDL, ("event_id",)), "metrics_long": (METRICS_DDL, ("event_id", "metric"))}
    for name, (ddl, keys) in tables.items():
        table = f"{root}/streams/{name}"
        archive.expire_archive(spark, table, now, days)
        archive.compact_table(spark, table, ddl, keys)
        snapshots.vacuum(spark, table)
    return done


def hourly_safely(spark: SparkSession, root: str) -> None:
    """One hourly run; a failure is logged and the next one makes up for it."""
    try:
        run_hourly(spark, root, int(time.time()))
    except Exception:
        log.exception("batch run failed; the next one reads what it has missed")


def merge_safely(spark: SparkSession, root: str) -> bool:
    """One merge; a failure is logged and the next round tries again."""
    try:
        run_merge(spark, root)
        return True
    except Exception:
        log.exception("merge failed; it is tried again in %s s", MERGE_EVERY_S)
        return False


def main() -> None:
    parser = argparse.ArgumentParser(description="Speed layer over arriving NDJSON files")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True, help="root folder of views and checkpoints")
    parser.add_argument("--window", type=int, default=300, help="trailing window in seconds")
    parser.add_argument("--every", default="60 seconds", help="trigger interval")
    parser.add_argument("--batch-every", type=float, default=BATCH_EVERY_S, help="seconds between batch runs")
    args = parser.parse_args()
    spark = build_session("netvitals-speed")
    start_all(spark, args.input, args.output, args.window, args.every)
    batch, due = None, time.monotonic()
    # ends, with its error, as soon as any of the queries does
    while not spark.streams.awaitAnyTermination(MERGE_EVERY_S):
        merge_safely(spark, args.output)
        if time.monotonic() >= due and not (batch and batch.is_alive()):
            due = time.monotonic() + args.batch_every
            batch = threading.Thread(target=hourly_safely, args=(spark, args.output), daemon=True)
            batch.start()


if __name__ == "__main__":
    main()
