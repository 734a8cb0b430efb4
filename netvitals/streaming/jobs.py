"""Streaming queries over a probe stream.

``raw_history`` appends every record, late and repeated ones too (compaction removes
repeats), ``raw_rejects`` the lines that are none, ``sliding_window_table`` appends closed windows, and
``speed_layer`` keeps the small live views current after each micro-batch. Start each with
its own checkpoint folder, which belongs to its output root; ``every=None`` processes what
is there and stops.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from netvitals import schema
from netvitals.functions.rounding import shown
from netvitals.operators import feed, latest, speed
from netvitals.operators.storage import with_hour
from netvitals.plans.shared import together
from netvitals.plans.store import read_version, write_version
from netvitals.plans.timeframe import between
from netvitals.sources.ndjson import parse_lines
from netvitals.sources.views import empty

EVERY = "60 seconds"
#: Versions of the per-batch aggregates that stay: a day of minutes.
AGGREGATES_KEPT = 1440
#: How far a record's stamp may lie ahead of the trigger's clock.
CLOCK_SLACK_S = 60
VIEWS = {
    "current_state": schema.STATE_DDL,
    "live_events": schema.FEED_DDL,
    "window_aggregates": schema.WINDOW_DDL,
    "speed_global": schema.SPEED_GLOBAL_DDL,
    "history": schema.HISTORY_DDL,
}


def paced(writer: DataStreamWriter, checkpoint: str, every: str | None = EVERY):
    """Sets checkpoint and trigger."""
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def as_probe_rows(rows: DataFrame) -> DataFrame:
    """Any probe-like rows in the full probe layout; absent columns are null."""
    names = dict(field.split() for field in schema.PROBE_DDL.split(","))
    columns = [
        (F.col(n) if n in rows.columns else F.lit(None)).cast(t).alias(n) for n, t in names.items()
    ]
    return rows.select(*columns, "ts")


def raw_history(stream: DataFrame, path: str) -> DataStreamWriter:
    """Appends records to the hourly history; the file sink commits each batch once."""
    rows = with_hour(stream).select(*schema.PROBE_COLUMNS, "ts", "hour")
    return (
        rows.writeStream.format("parquet").option("path", path).partitionBy("hour")
    ).outputMode("append")


def raw_rejects(lines: DataFrame, path: str) -> DataStreamWriter:
    """Appends the lines of a `line_stream` that are no JSON objects."""
    rows = parse_lines(lines)[1].withColumn("received_at", F.current_timestamp())
    return rows.writeStream.format("parquet").option("path", path).outputMode("append")


def sliding_window_table(stream: DataFrame, path: str, **window) -> DataStreamWriter:
    """Appends each region window once it is closed by the watermark."""
    rows = speed.stream_sliding_windows(stream, **window).drop("w")
    return rows.writeStream.format("parquet").option("path", path).outputMode("append")


def kpi_table(stream: DataFrame, path: str, **window) -> DataStreamWriter:
    """Appends the global KPIs of each closed window: an aggregation over the windows."""
    rows = speed.stream_speed_global(speed.stream_sliding_windows(stream, **window))
    return rows.writeStream.format("parquet").option("path", path).outputMode("append")


def flush_speed(probes: DataFrame, root: str, batch_id: int, as_of: int, window_s: int) -> None:
    """Window, KPI and KPI-history views as of a moment, from rows that cover the window."""
    spark = probes.sparkSession
    # the rows of one window, read several times below
    recent = between(probes, as_of, window_s).persist()
    window = shown(
        speed.trailing_window(recent, as_of, window_s, settled=False, ordered=False),
        "window_aggregates",
    ).persist()
    try:
        kpis = shown(speed.speed_global(window), "speed_global")
        ring_path = f"{root}/speed/history"
        older = read_version(spark, ring_path, schema.HISTORY_DDL, before=batch_id)
        # the same moment flushed again replaces its row
        older = older.filter(F.col("ts") != F.timestamp_seconds(F.lit(as_of)))
        ring = older.unionByName(speed.kpi_history(kpis, 1))
        newest = ring.orderBy(F.desc("ts")).limit(speed.HISTORY_LEN)
        together(
            spark,
            lambda: write_version(window, f"{root}/speed/window_aggregates", batch_id),
            lambda: write_version(kpis, f"{root}/speed/speed_global", batch_id),
            lambda: write_version(newest, ring_path, batch_id),
        )
    finally:
        window.unpersist()
        recent.unpersist()


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    window_s: int = speed.WINDOW_S,
    now: Callable[[DataFrame], int | None] | None = None,
) -> None:
    """Everything the live views need from one micro-batch.

    All writes are by batch id, so running a batch again gives the same files. Views hold
    one row per region or a ring of fixed length; records are only appended.

    The views' moment is the newest record's time, unless ``now`` gives another. It never
    moves back (a batch of late records is added at the moment already reached) and never
    passes the time of the trigger: records stamped further ahead stay in the raw copy and
    are left out of live views.
    """
    spark = batch.sparkSession
    paths = {name: f"{root}/speed/{name}" for name in VIEWS}
    stored = {name: read_version(spark, paths[name], ddl, before=batch_id) for name, ddl in VIEWS.items()}
    whole = batch.persist()
    try:
        limit = int(time.time()) + CLOCK_SLACK_S
        batch = whole.filter(F.coalesce(F.col("unix_ts") <= limit, F.lit(False)))
        # a few values; the event clock unless the caller sets another
        sound = F.col("unix_ts") <= limit
        newest_ts, records = whole.agg(F.max(F.when(sound, F.col("unix_ts"))), F.count(F.lit(1))).first()
        if newest_ts is None:
            if records:
                append_batch(whole, root, batch_id)
            # versions must not skip a batch id: carry all views over
            for name, view in stored.items():
                write_version(view, paths[name], batch_id)
            return
        reached = stored["history"].agg(F.max(F.unix_seconds("ts"))).first()[0]
        as_of = now(batch) if now else max(newest_ts, reached or newest_ts)

        def window_views() -> None:
            append_batch(whole, root, batch_id)
            recent = recent_batches(spark, root, as_of, window_s)
            flush_speed(recent, root, batch_id, as_of, window_s)

        def batch_view() -> None:
            rows = shown(speed.microbatch_aggregates(batch, settled=False), "batch_aggregates")
            rows.write.mode("overwrite").parquet(f"{root}/speed/batch_aggregates/batch={batch_id}")

        def state_view() -> None:
            state = latest.upsert_state(stored["current_state"], batch, as_of, window_s, settled=False)
            write_version(state, paths["current_state"], batch_id)

        def feed_view() -> None:
            newest = feed.live_events(feed.feed_event(batch))
            rows = feed.live_events(stored["live_events"].unionByName(newest))
            write_version(rows, paths["live_events"], batch_id)

        together(spark, window_views, batch_view, state_view, feed_view)
        forget_batches(spark, root, as_of - window_s - 3600, batch_id)
    finally:
        whole.unpersist()


def append_batch(batch: DataFrame, root: str, batch_id: int) -> None:
    """Raw copy of a batch under hour=/batch=; a rerun replaces its own folders only. AQE
    sizes the files: a small batch leaves one per hour, a large hour is split."""
    rows = with_hour(batch).withColumn("batch", F.lit(batch_id).cast("bigint"))
    rows = rows.select(*schema.PROBE_COLUMNS, "ts", "hour", "batch").hint("rebalance", "hour")
    (
        rows.sortWithinPartitions("hour", "unix_ts")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("hour", "batch")
        .parquet(f"{root}/raw_batches")
    )


def forget_batches(spark: SparkSession, root: str, before: int, batch_id: int) -> None:
    """Removes raw copies of hours that no window will read again (all records are in the archive)
    and batch aggregates older than the last day's. Only folder names are listed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    limit = dt.datetime.fromtimestamp(before, dt.timezone.utc).strftime("%Y%m%d_%H")
    oldest = batch_id - AGGREGATES_KEPT
    for pattern, prefix, gone in (
        (f"{root}/raw_batches/hour=*", "hour=", lambda name: name[:1].isdigit() and name < limit),
        (f"{root}/speed/batch_aggregates/batch=*", "batch=", lambda name: int(name) <= oldest),
    ):
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        files = path.getFileSystem(conf)
        for status in files.globStatus(path) or []:
            if gone(status.getPath().getName().removeprefix(prefix)):
                files.delete(status.getPath(), True)


def recent_batches(spark: SparkSession, root: str, as_of: int, seconds: int) -> DataFrame:
    """Raw copies of the hours that [as_of - seconds, as_of] touches. Only those folders are
    listed, so the cost does not grow with the age of the table."""
    end = dt.datetime.fromtimestamp(as_of, dt.timezone.utc)
    start = end - dt.timedelta(seconds=seconds)
    hour, names = start.replace(minute=0, second=0, microsecond=0), []
    while hour <= end:
        names.append(hour.strftime("%Y%m%d_%H"))
        hour += dt.timedelta(hours=1)
    base = f"{root}/raw_batches"
    ddl = f"{schema.PROBE_DDL}, ts TIMESTAMP, hour STRING, batch BIGINT"
    known = [f"{base}/hour={name}" for name in names]
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    known = [k for k in known if files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(k))]
    if not known:
        return empty(spark, ddl).drop("batch")
    reader = spark.read.schema(ddl).option("basePath", base)
    return reader.parquet(*known).drop("batch")


def speed_layer(stream: DataFrame, root: str, window_s: int = speed.WINDOW_S, now=None):
    """Live views from a probe stream: state, feed, batch aggregates, window, KPIs."""
    return stream.writeStream.foreachBatch(
        lambda batch, batch_id: apply_batch(batch, batch_id, root, window_s, now)
    )
