"""The hourly batch job as incremental maintenance.

Two hourly tables are kept beside the archive: a cube of sums and sketches, and the pieces of
outage episodes. Their commits note which snapshot of the archive they were made from, so a run
reads the records of those hours alone that have changed since, replaces them in both tables,
drops the hours that have expired, and makes the views from the tables. A run that is broken off
between the two commits is made up for by the next one; compaction of the archive changes no
records and so causes no work.

Quantiles come from KLL sketches: the rank of a value given as p50 or p95 is off by about 1.3 % of
the records at most (k = 200) with a probability of 99 %; `history.latency_by_region` has the exact
ones. Distinct counts of regions over any hours come from theta sketches, exact below their size.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvitals.functions.measures import mean, merge_sums, partial_sums
from netvitals.functions.rounding import shown
from netvitals.operators import history
from netvitals.operators.alerts import last_episodes
from netvitals.operators.episodes import episode_pieces, joined_episodes
from netvitals.operators.speed import SLIDE_S, WINDOW_S, sliding_windows
from netvitals.plans import snapshots
from netvitals.plans.archive import read_archive
from netvitals.plans.shared import discard, settle, together
from netvitals.plans.store import write_view
from netvitals.plans.timeframe import HOUR_FORMAT, hour_of
from netvitals.schema import REGION_COLUMNS, REGION_DDL
from netvitals.sources.ndjson import dedup_events

KLL_K = 200
#: Theta sketches are exact up to 2 ** this many distinct regions.
THETA_BITS = 12
#: Name of the archive's progress in the tables' marks.
SOURCE = "archive"

CUBE_DDL = f"""{REGION_DDL}, outage_detected BOOLEAN, n BIGINT, outages BIGINT,
    rtt_sum DOUBLE, rtt_n BIGINT, loss_sum DOUBLE, loss_n BIGINT, health_sum DOUBLE, health_n BIGINT,
    rtt_min DOUBLE, rtt_max DOUBLE, rtt_sketch BINARY, region_sketch BINARY"""
PIECES_DDL = """region_id STRING, chunk BIGINT, country_code STRING, country_name STRING,
    good_here BIGINT, records BIGINT, start_ts TIMESTAMP, end_ts TIMESTAMP, good BIGINT"""


def cube_rows(records: DataFrame) -> DataFrame:
    """Sums and sketches per hour, region and outage flag of records with their ``hour``."""
    return records.groupBy("hour", *REGION_COLUMNS, "outage_detected").agg(
        *partial_sums(),
        F.kll_sketch_agg_double("avg_rtt_ms", F.lit(KLL_K)).alias("rtt_sketch"),
        # one region a row: the sketches are united over rows and hours
        F.theta_sketch_agg("region_id", F.lit(THETA_BITS)).alias("region_sketch"),
    )


def piece_rows(records: DataFrame) -> DataFrame:
    """The outage pieces and totals of each hour as rows of one table; totals have a ``good``."""
    pieces, totals = episode_pieces(records)
    rows = pieces.unionByName(totals, allowMissingColumns=True)
    return rows.withColumn("hour", hour_of(F.timestamp_seconds(F.col("chunk") * 3600)))


def changed_hours(spark: SparkSession, source: snapshots.Snapshot, table: str) -> tuple[snapshots.Snapshot, list[str]]:
    """The table's snapshot, and the hours whose records it does not have as they are now."""
    have = snapshots.newest(spark, table)
    return have, source.changed_since(have.marks.get(SOURCE, -1))


def refresh(spark: SparkSession, archive: str, root: str) -> dict[str, list[str]]:
    """Brings the cube and the episode pieces up to the archive's newest snapshot; returns the
    hours that were read, by table."""
    source = snapshots.newest(spark, archive)
    done: dict[str, list[str]] = {}

    def bring(name: str, build) -> None:
        table = f"{root}/tables/{name}"
        have, hours = changed_hours(spark, source, table)
        done[name] = hours
        if have.marks.get(SOURCE, -1) == source.version:
            return
        records = dedup_events(read_archive(spark, archive, hours, source))
        # hours that have expired are replaced by nothing
        gone = [h for h in have.hours if h not in source.hours]
        rows = build(records).hint("rebalance", "hour")
        snapshots.replace(rows, table, have, [*hours, *gone], marks={SOURCE: source.version})

    together(spark, lambda: bring("cube", cube_rows), lambda: bring("pieces", piece_rows))
    return done


def stored_cube(spark: SparkSession, root: str, hours=None) -> DataFrame:
    """The cube with ``hour`` as a time, of all hours or those given."""
    rows = snapshots.read(spark, f"{root}/tables/cube", CUBE_DDL, hours)
    return rows.withColumn("hour", F.try_to_timestamp("hour", F.lit(HOUR_FORMAT)))


def stored_episodes(spark: SparkSession, root: str) -> DataFrame:
    rows = snapshots.read(spark, f"{root}/tables/pieces", PIECES_DDL).drop("hour")
    return joined_episodes(rows.filter("good IS NULL"), rows.filter("good IS NOT NULL"))


WINDOWS_DDL = """window_start TIMESTAMP, window_end TIMESTAMP, region_id STRING, sample_count BIGINT,
    avg_health_score DOUBLE, avg_latency_ms DOUBLE, avg_packet_loss DOUBLE, outage_count BIGINT,
    is_outage BOOLEAN"""


def _shifted(hours: list[str], by: int) -> set[str]:
    moved = (dt.datetime.strptime(h, "%Y%m%d_%H") + dt.timedelta(hours=by) for h in hours if h[:1].isdigit())
    return {m.strftime("%Y%m%d_%H") for m in moved}


def repair_windows(
    spark: SparkSession, archive: str, root: str, width_s: int = WINDOW_S, slide_s: int = SLIDE_S
) -> list[str]:
    """Brings the table of sliding windows up to the archive; returns the hours of window starts
    that were made anew. A stream's windows lack the records that came after its watermark; here
    an hour's windows are redone from the archive whenever one of its records, or of the hour
    after it, has changed."""
    source = snapshots.newest(spark, archive)
    have, hours = changed_hours(spark, source, f"{root}/tables/windows")
    if have.marks.get(SOURCE, -1) == source.version:
        return []
    before = -(-width_s // 3600)  # hours that a record's windows may begin before it
    targets = set().union(*(_shifted(hours, -k) for k in range(before + 1)))
    read = set().union(*(_shifted(list(targets), k) for k in range(before + 1))) & set(source.hours)
    # windows go with the hour they begin in; those before the first record's hour stay with it
    first = min((h for h in source.hours if h[:1].isdigit()), default="")
    gone = [h for h in have.hours if h not in targets and h < first and h not in _shifted([first], -before)]
    records = dedup_events(read_archive(spark, archive, sorted(read), source))
    windows = sliding_windows(records, width_s, slide_s).withColumn("hour", hour_of(F.col("window_start")))
    windows = windows.filter(F.col("hour").isin(sorted(targets))).hint("rebalance", "hour")
    replaced = [*sorted(targets), *gone]
    snapshots.replace(windows, f"{root}/tables/windows", have, replaced, marks={SOURCE: source.version})
    return sorted(targets)


def stored_windows(spark: SparkSession, root: str) -> DataFrame:
    return snapshots.read(spark, f"{root}/tables/windows", WINDOWS_DDL).drop("hour")


def late_records(streamed: DataFrame, repaired: DataFrame) -> DataFrame:
    """Per region and window what a stream's windows lack: the number of late records."""
    keys = ["window_start", "region_id"]
    seen = streamed.select(*keys, F.col("sample_count").alias("in_stream"))
    both = repaired.select(*keys, "sample_count").join(seen, keys, "left")
    missing = F.col("sample_count") - F.coalesce("in_stream", F.lit(0))
    return both.select(*keys, missing.alias("late")).filter("late > 0")


def latency_range(cube: DataFrame) -> DataFrame:
    """Latency statistics per region over a cube of any hours, quantiles from its sketches."""
    merged = cube.groupBy(*REGION_COLUMNS).agg(*merge_sums(), F.kll_merge_agg_double("rtt_sketch").alias("sketch"))
    some = F.col("rtt_n") > 0

    def quantile(p: float):
        return F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(p)))

    return merged.select(
        *REGION_COLUMNS,
        F.col("n").alias("probe_count"),
        mean("rtt").alias("avg_latency_ms"),
        F.col("rtt_min").alias("min_latency_ms"),
        F.col("rtt_max").alias("max_latency_ms"),
        quantile(0.5).alias("p50_latency_ms"),
        quantile(0.95).alias("p95_latency_ms"),
        mean("loss").alias("avg_packet_loss_pct"),
        mean("health").alias("avg_health_score"),
    )


def outage_regions(cube: DataFrame, name: str = "sketch") -> DataFrame:
    """One row with the theta sketch of the regions that had an outage in a cube's hours."""
    return cube.filter("outage_detected").agg(F.theta_union_agg("region_sketch").alias(name))


def regions_in_outage(first: DataFrame, second: DataFrame) -> DataFrame:
    """How many regions had an outage in the hours of one cube, of another, and of both."""
    both = outage_regions(first).unionByName(outage_regions(second))
    either = outage_regions(first.unionByName(second), "either")
    common = both.agg(F.theta_intersection_agg("sketch").alias("common"))

    def number(frame: DataFrame, sketch: str):
        return F.coalesce(frame.select(F.theta_sketch_estimate(sketch)).scalar(), F.lit(0))

    counts = {
        "in_first": number(outage_regions(first), "sketch"),
        "in_second": number(outage_regions(second), "sketch"),
        "in_either": number(either, "either"),
        "in_both": number(common, "common"),
    }
    return first.sparkSession.range(1).select(*[c.cast("bigint").alias(n) for n, c in counts.items()])


def cube_summary(cube: DataFrame) -> DataFrame:
    """The per-region summary view from a cube."""
    keys = ["country_code", "country_name", "region_id", "region_name", "continent"]
    flagged = F.when(F.col("outage_detected"), F.col("n")).when(~F.col("outage_detected"), 0)
    return (
        cube.withColumn("flagged", flagged)
        .groupBy(*keys)
        .agg(*merge_sums(), F.sum("flagged").alias("total_outages"))
        .select(
            *keys,
            F.col("n").alias("total_probes"),
            mean("rtt").alias("avg_latency_ms"),
            F.col("rtt_min").alias("min_latency_ms"),
            F.col("rtt_max").alias("max_latency_ms"),
            mean("loss").alias("avg_packet_loss_pct"),
            mean("health").alias("avg_health_score"),
            "total_outages",
        )
        .orderBy("avg_health_score", "region_id")
    )


def views(cube: DataFrame, episodes: DataFrame) -> dict[str, DataFrame]:
    """The batch views, as `batch_job.batch_views` makes them from all records."""
    latency, outages = latency_range(cube), history.outage_frequency(cube)
    return {
        "latency_by_region": latency.orderBy(F.desc("avg_latency_ms"), "region_id"),
        "outage_frequency": outages,
        "hourly_health_trend": history.hourly_health_trend(cube),
        "top_affected": history.top_affected(latency, outages),
        "global_summary": history.global_summary(cube),
        "country_rollup": history.country_rollup(cube),
        "batch_summary": cube_summary(cube),
        "last_episodes": last_episodes(episodes),
    }


def run_incremental(spark: SparkSession, archive: str, root: str, fmt: str = "parquet") -> dict[str, list[str]]:
    """Refreshes the tables and writes all batch views; returns the hours that were read."""
    done = refresh(spark, archive, root)
    cube = settle(stored_cube(spark, root), "cube")

    def write(name: str, view: DataFrame) -> None:
        stamped = shown(view, name)
        if name == "global_summary":
            stamped = stamped.withColumn("computed_at", F.current_timestamp())
        write_view(stamped, f"{root}/batch/{name}", fmt)

    made = views(cube, stored_episodes(spark, root))
    together(spark, *[partial(write, name, view) for name, view in made.items()])
    discard(cube)
    repair_windows(spark, archive, root)
    for table in ("cube", "pieces", "windows"):
        snapshots.vacuum(spark, f"{root}/tables/{table}")
    return done
