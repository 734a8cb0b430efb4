"""Shapes that go to storage and monitoring: hourly buckets, retention, long metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvitals.plans.timeframe import as_column, hour_of, hour_pruned

# Metric name, probe column, unit, value of an absent field.
METRICS = (
    ("HealthScore", "health_score", "None", 100.0),
    ("AvgLatencyMs", "avg_rtt_ms", "Milliseconds", 0.0),
    ("PacketLossPct", "packet_loss_pct", "Percent", 0.0),
)


def with_hour(rows: DataFrame, moment: str = "ts") -> DataFrame:
    return rows.withColumn("hour", hour_of(F.col(moment)))


def time_ordered(rows: DataFrame) -> DataFrame:
    """Rows with an ``hour`` column, laid out for writing hourly folders.

    Rebalancing by hour lets AQE decide the number of tasks from the rows' real size: small
    hours share a task, a busy hour is split into several, so nobody has to give a count.
    Files are sorted by time, and their statistics let later scans skip parts of an hour.
    """
    return rows.hint("rebalance", "hour").sortWithinPartitions("hour", "unix_ts")


def hourly_raw(rows: DataFrame) -> DataFrame:
    """Records per hourly bucket, i.e. per partition of the stored history."""
    return with_hour(rows).groupBy("hour").agg(F.count(F.lit(1)).alias("records"))


def metrics_long(probes: DataFrame) -> DataFrame:
    """Three metric rows per probe row, with its region and country as dimensions."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                F.coalesce(column, F.lit(absent)).alias("value"),
                F.lit(unit).alias("unit"),
            )
            for name, column, unit, absent in METRICS
        ]
    )
    return probes.select(
        "event_id",
        "ts",
        F.coalesce("region_id", F.lit("unknown")).alias("region"),
        F.coalesce("country_code", F.lit("XX")).alias("country"),
        F.inline(entries),
    )


def retained(rows: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Rows young enough to keep; old hour partitions are not even listed."""
    start = as_column(as_of) - days * 86_400
    return hour_pruned(rows.filter(F.col("unix_ts") >= start), start, None)
