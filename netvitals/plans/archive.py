"""The record archive: one hourly history that the stream, deliveries, compaction and retention
share through its snapshots (`netvitals.plans.snapshots`).

    <root>/data/commit=<name>/hour=<hour>   records
    <root>/_commits/<version>.json          the snapshots
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from netvitals.operators.storage import retained, time_ordered, with_hour
from netvitals.plans import snapshots
from netvitals.plans.shared import discard, settle
from netvitals.plans.timeframe import hour_of
from netvitals.schema import PROBE_COLUMNS, PROBE_DDL
from netvitals.sources.ndjson import dedup_events, parsed_lines, split_parsed

#: ``extra`` is JSON text of the fields a record has beyond the declared ones.
ARCHIVE_DDL = f"{PROBE_DDL}, ts TIMESTAMP, extra STRING"


def _hourly(rows: DataFrame) -> DataFrame:
    if "extra" not in rows.columns:
        rows = rows.withColumn("extra", F.lit(None).cast("string"))
    return time_ordered(with_hour(rows).select(*PROBE_COLUMNS, "ts", "extra", "hour"))


def append_batch(batch: DataFrame, batch_id: int, root: str, writer: str = "stream") -> snapshots.Snapshot:
    """Adds a micro-batch once, however often it is run. Late and repeated records go in too."""
    return snapshots.append(_hourly(batch), root, f"{writer}-{batch_id}", (writer, batch_id))


def archive_stream(stream: DataFrame, root: str, writer: str = "stream") -> DataStreamWriter:
    """Adds every record of a probe stream. A checkpoint belongs to its ``writer`` name."""
    return stream.writeStream.foreachBatch(lambda batch, i: append_batch(batch, i, root, writer))


def append_delivery(
    spark: SparkSession, source: str, root: str, as_of=None, days: int = 30, rejects: str | None = None
) -> dict[str, int]:
    """Adds NDJSON files, without what is past its retention at ``as_of``; lines that are no JSON
    objects go to the table ``rejects`` if given. Returns the counts of both."""
    rows, broken = split_parsed(parsed_lines(spark.read.text(source), extra=True))
    rows = settle(rows if as_of is None else retained(rows, as_of, days), "archive_delivery")
    broken = settle(broken, "archive_rejects")
    if rejects is not None:
        broken.withColumn("source", F.lit(source)).write.mode("append").parquet(rejects)
    snapshots.append(_hourly(rows), root)
    counts = {"records": rows.count(), "rejects": broken.count()}
    discard(rows, broken)
    return counts


def read_archive(spark: SparkSession, root: str, hours=None, snapshot=None) -> DataFrame:
    """Records as they were archived, repeats included, with their ``hour``."""
    return snapshots.read(spark, root, ARCHIVE_DDL, hours, snapshot)


def compact_table(
    spark: SparkSession, root: str, ddl: str, keys: tuple[str, ...] = ("event_id",), least: int = 2, hours=None
) -> list[str]:
    """Rewrites hours of ``least`` folders and more (or ``hours``) of an hourly table with ``ts``
    and ``event_id`` as one folder each, without repeats of ``keys``. Readers see the old folders
    until the commit and the new one from then on."""
    base = snapshots.newest(spark, root)
    picked = [h for h in (base.hours if hours is None else hours) if len(base.folders(h)) >= least]
    if picked:
        rows = dedup_events(snapshots.read(spark, root, ddl, picked, base), keys=keys)
        ordered = rows.hint("rebalance", "hour").sortWithinPartitions("hour", "ts")
        snapshots.replace(ordered, root, base, picked, same_records=True)
    return sorted(picked)


def compact_archive(spark: SparkSession, root: str, least: int = 2, hours=None) -> list[str]:
    """`compact_table` of the archive."""
    return compact_table(spark, root, ARCHIVE_DDL, least=least, hours=hours)


def expire_archive(spark: SparkSession, root: str, as_of: int, days: int = 30) -> list[str]:
    """Drops the hours that lie wholly before the retention; records without a time stay."""
    moment = F.timestamp_seconds(F.lit(as_of - days * 86_400))
    limit = spark.range(1).select(hour_of(moment)).first()[0]
    return snapshots.drop_hours(spark, root, lambda h: h[:1].isdigit() and h < limit)


def maintain(spark: SparkSession, root: str, as_of: int | None = None, days: int = 30) -> dict[str, int]:
    """Retention, compaction and removal of what no snapshot lists, in this order."""
    gone = expire_archive(spark, root, as_of, days) if as_of is not None else []
    merged = compact_archive(spark, root)
    return {"expired": len(gone), "compacted": len(merged), "removed": snapshots.vacuum(spark, root)}
