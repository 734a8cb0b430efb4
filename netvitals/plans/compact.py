"""NDJSON history to Parquet, partitioned by hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvitals.operators.storage import retained, time_ordered, with_hour
from netvitals.plans.shared import discard, settle
from netvitals.plans.timeframe import hour_of
from netvitals.schema import PROBE_COLUMNS, PROBE_DDL
from netvitals.sources.ndjson import dedup_events, lenient_ndjson
from netvitals.sources.views import read_view


def _refuse_stream_target(spark: SparkSession, path: str) -> None:
    """A folder of the file sink has a list of its files that an overwrite or a removal would
    break; `netvitals.plans.archive` is the history that streams and batch jobs can share."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_spark_metadata")
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        raise ValueError(f"{path} belongs to a stream")


def write_history(rows: DataFrame, path: str, records_per_file: int = 5_000_000) -> None:
    """Replaces the hours that occur in ``rows``."""
    _refuse_stream_target(rows.sparkSession, path)
    hourly = with_hour(rows).select(*PROBE_COLUMNS, "ts", "hour")
    (
        time_ordered(hourly)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", records_per_file)
        .partitionBy("hour")
        .parquet(path)
    )


def merged_hours(rows: DataFrame, path: str, dedup: bool = True) -> DataFrame:
    """``rows`` together with what the history at ``path`` holds of the hours they touch."""
    spark = rows.sparkSession
    hourly = with_hour(rows).select(*PROBE_COLUMNS, "ts", "hour")
    # a value per hour of the delivery: the folders to list
    hours = [r[0] for r in hourly.select("hour").distinct().collect()]
    stored = read_view(spark, path, f"{PROBE_DDL}, ts TIMESTAMP, hour STRING")
    stored = stored.filter(F.coalesce(F.col("hour"), F.lit("")).isin([h or "" for h in hours]))
    both = stored.select(*hourly.columns).unionByName(hourly)
    return dedup_events(both) if dedup else both


def compact_history(
    spark: SparkSession,
    source: str,
    target: str,
    dedup: bool = True,
    as_of=None,
    days: int = 30,
    rejects: str | None = None,
) -> dict[str, int]:
    """Compacts a delivery of NDJSON files into the hourly history.

    Touched hours are read, joined with the delivery, deduplicated and replaced, so that a
    late delivery adds to an hour. ``as_of`` leaves out what is past its retention. Lines that
    are no JSON objects are appended to the table ``rejects`` if given. Returns the counts of
    both, {"records": ..., "rejects": ...}. The merged hours are written to the shared folder
    first: Spark's overwrite is not atomic, and after a crash they are still there.
    """
    rows, broken = lenient_ndjson(spark, source)
    if as_of is not None:
        rows = retained(rows, as_of, days)
    rows = settle(rows, "compact_delivery")
    merged = settle(merged_hours(rows, target, dedup), "compact_hours")
    write_history(merged.drop("hour"), target)
    broken = settle(broken, "compact_rejects")
    if rejects is not None:
        broken.withColumn("source", F.lit(source)).write.mode("append").parquet(rejects)
    counts = {"records": rows.count(), "rejects": broken.count()}
    discard(rows, merged, broken)
    return counts


def drop_expired(spark: SparkSession, path: str, as_of: int, days: int = 30) -> list[str]:
    """Removes the hour folders of ``path`` that lie wholly before the retention; returns their
    hours. Only folder names are read."""
    _refuse_stream_target(spark, path)
    limit = spark.range(1).select(hour_of(F.timestamp_seconds(F.lit(as_of - days * 86_400)))).first()[0]
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "hour=*")) or []
    gone = []
    for status in found:
        hour = status.getPath().getName().removeprefix("hour=")
        if hour < limit and hour[:1].isdigit():
            files.delete(status.getPath(), True)
            gone.append(hour)
    return sorted(gone)
