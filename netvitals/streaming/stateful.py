"""Stateful streams that keep their state inside the engine: outage sessions, alerts joined with
the window they fall in, and the latest record per region as a log of changes.

State is bounded by a watermark in each. Use the RocksDB provider (`use_rocksdb`) where state is
larger than an executor's memory; a checkpoint keeps the provider it was begun with.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from netvitals import schema
from netvitals.operators import latest, speed
from netvitals.plans import snapshots
from netvitals.plans.timeframe import hour_of

#: Silence after which an outage is over, after a critical record and another one.
CRITICAL_GAP, OTHER_GAP = "30 minutes", "10 minutes"
LATENESS = "10 minutes"


def use_rocksdb(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB."""
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)


def outage_sessions(
    probes: DataFrame,
    critical_gap: str = CRITICAL_GAP,
    other_gap: str = OTHER_GAP,
    lateness: str = LATENESS,
) -> DataFrame:
    """Outages per region by silence: records in outage belong together while the next one comes
    within the gap of one before it, a longer gap after critical records. Batch or stream; a
    stream appends a session once the watermark has passed its end, and joins two sessions when a
    late record closes the gap between them."""
    gap = F.when(F.col("state") == "critical", critical_gap).otherwise(other_gap)
    rows = probes.filter("outage_detected").withColumn("region_id", F.coalesce("region_id", F.lit("unknown")))
    if rows.isStreaming:
        rows = rows.withWatermark("ts", lateness)
    return (
        rows.groupBy(F.session_window("ts", gap).alias("s"), "region_id")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min("ts").alias("start_ts"),
            F.max("ts").alias("end_ts"),
            F.max("packet_loss_pct").alias("worst_loss_pct"),
        )
        .select(
            "region_id",
            "start_ts",
            "end_ts",
            F.col("s.end").alias("closed_at"),
            ((F.unix_micros("end_ts") - F.unix_micros("start_ts")) / 1e6).alias("duration_s"),
            "records",
            "worst_loss_pct",
        )
    )


def _tumbling(probes: DataFrame, width_s: int, lateness: str) -> DataFrame:
    """Closed windows of a region, one after another, with a time that joins can hold against."""
    rows = probes.withColumn("region_id", F.coalesce("region_id", F.lit("unknown")))
    if rows.isStreaming:
        rows = rows.withWatermark("ts", lateness)
    made = rows.groupBy(F.window("ts", f"{width_s} seconds").alias("w"), "region_id").agg(*speed.partial_sums())
    measures = speed.window_measures()
    picked = ("sample_count", "avg_health_score", "outage_count", "is_outage")
    return made.select(
        F.col("region_id").alias("window_region"),
        F.window_time("w").alias("window_at"),
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *[measures[name].alias(name) for name in picked],
    )


def alerts_with_window(
    probes: DataFrame, windows_of: DataFrame, width_s: int = speed.WINDOW_S, lateness: str = LATENESS
) -> DataFrame:
    """Critical records with the outage window of their region that they fall in, if it is one:
    an interval join of two streams (or batches) of probe rows. On streams both sides have a
    watermark, an alert waits for its window to close, and it is emitted without one when none
    can come any more."""
    alerts = probes.filter("state = 'critical'").select(
        "event_id",
        F.coalesce("region_id", F.lit("unknown")).alias("region_id"),
        F.col("ts").alias("alert_ts"),
        "avg_rtt_ms",
        "packet_loss_pct",
    )
    if alerts.isStreaming:
        alerts = alerts.withWatermark("alert_ts", lateness)
    windows = _tumbling(windows_of, width_s, lateness).filter("is_outage")
    width = F.expr(f"INTERVAL {int(width_s)} SECONDS")  # a literal, from which state bounds are derived
    # the window's time is its last instant
    within = (F.col("window_at") >= F.col("alert_ts")) & (F.col("window_at") < F.col("alert_ts") + width)
    joined = alerts.join(windows, (F.col("region_id") == F.col("window_region")) & within, "left_outer")
    return joined.drop("window_region", "window_at")


def appended(rows: DataFrame, path: str) -> DataStreamWriter:
    return rows.writeStream.format("parquet").option("path", path).outputMode("append")


# --- latest state ------------------------------------------------------------------------------

CHANGES_DDL = schema.STATE_DDL


#: Rows a task collects before it keeps the newest of each region and pane.
COLLECTED = 65_536


def _newest_of_task(pane_s: int, collected: int = COLLECTED):
    """The newest row per region and pane among the rows of a task, as far as those of a few times
    ``collected`` rows are kept: an aggregation of whole records would sort the task's input."""
    width = pane_s * 1_000_000

    def reduced(parts):
        rows = pa.Table.from_batches(parts)
        rows = rows.take(pc.sort_indices(rows, [("ts", "ascending"), ("event_id", "ascending")], null_placement="at_start"))
        at = rows.column("ts").cast(pa.int64()).to_numpy()
        groups = pa.table({"r": rows.column("region_id"), "p": at // width, "i": np.arange(len(at))})
        last = groups.group_by(["r", "p"], use_threads=False).aggregate([("i", "max")]).column("i_max")
        return rows.take(last).combine_chunks().to_batches()

    def run(batches):
        parts, size, limit = [], 0, collected
        for batch in batches:
            parts.append(batch)
            size += batch.num_rows
            if size >= limit:
                parts = reduced(parts)
                size = sum(p.num_rows for p in parts)
                if size > 4 * collected:
                    yield from parts
                    parts, size = [], 0
                limit = max(collected, 2 * size)
        if size:
            yield from reduced(parts)

    return run


def state_changes(probes: DataFrame, window_s: int = speed.WINDOW_S, lateness: str = LATENESS) -> DataFrame:
    """The newest record per region and pane of twice the window, as a streaming aggregation: the
    state holds a row per region and open pane, gets the newest rows of each task, and goes with
    the watermark. In update mode a batch yields the regions it has changed, nothing else."""
    rows = latest.state_rows(probes).filter("ts IS NOT NULL")
    rows = rows.mapInArrow(_newest_of_task(2 * window_s), rows.schema)
    if rows.isStreaming:
        rows = rows.withWatermark("ts", lateness)
    payload = F.struct(*[c for c in latest.STATE_COLUMNS if c not in ("region_id", "ts")], F.col("ts").alias("at"))
    newest = F.max_by(payload, F.struct("ts", "event_id")).alias("r")
    panes = rows.groupBy(F.window("ts", f"{2 * window_s} seconds").alias("pane"), "region_id").agg(newest)
    changed = panes.select("region_id", "r.*").withColumnRenamed("at", "ts")
    expires: Column = (F.col("unix_ts") + F.lit(2 * window_s)).cast("bigint")
    return changed.withColumn("expires_at", expires)


def state_log(probes: DataFrame, root: str, window_s: int = speed.WINDOW_S) -> DataStreamWriter:
    """Writes each batch's changes as a commit of the hourly table ``root``: the cost follows the
    changed regions, stored state is neither read nor rewritten."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # dealt by hour, not coalesced: that would put all partitions of the state into one task
        hourly = batch.withColumn("hour", hour_of(F.col("ts"))).repartition("hour")
        snapshots.append(hourly, root, f"b{batch_id}", ("stream", batch_id))

    return state_changes(probes, window_s).writeStream.outputMode("update").foreachBatch(write)


def logged_state(spark: SparkSession, root: str, now: int, window_s: int = speed.WINDOW_S) -> DataFrame:
    """The newest entry per region that has not expired at ``now``, from the hours in which such
    an entry can lie; older ones can be
    dropped (`snapshots.drop_hours`)."""
    moments = F.sequence(
        F.date_trunc("hour", F.timestamp_seconds(F.lit(now - 2 * window_s))),
        F.date_trunc("hour", F.timestamp_seconds(F.lit(now))),
        F.expr("INTERVAL 1 HOUR"),
    )
    young = spark.range(1).select(F.explode(F.transform(moments, hour_of))).collect()  # a few names
    known = snapshots.newest(spark, root)
    hours = [h for (h,) in young if h in known.hours]
    hours += [h for h in known.hours if h > max((y for (y,) in young)) and h[:1].isdigit()]
    rows = snapshots.read(spark, root, CHANGES_DDL, hours, known).drop("hour")
    payload = F.struct(*[c for c in rows.columns if c != "region_id"])
    newest = rows.groupBy("region_id").agg(F.max_by(payload, F.struct("ts", "event_id")).alias("r"))
    return newest.select("region_id", "r.*").filter(F.col("expires_at") > now)
