"""Outage episodes and rate drops over the whole history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def outage_episodes(probes: DataFrame, chunk_s: int = 3600) -> DataFrame:
    """Runs of consecutive outage records per region: start, end, duration, record count.

    A run is named by the number of good records before it. That number is a count within
    the record's (region, time chunk) plus the good records of the region's earlier
    chunks, so only chunk totals are ever brought together per region; the records of a
    hot region stay spread over its chunks. ``chunk_s`` is a tuning value: runs that
    cross chunks get the same name in each and are joined by it.
    """
    return joined_episodes(*episode_pieces(probes, chunk_s))


def episode_pieces(probes: DataFrame, chunk_s: int = 3600) -> tuple[DataFrame, DataFrame]:
    """(pieces, totals): the outage runs within each (region, time chunk), named by the good
    records of the chunk before them, and the chunk's number of good records. Both depend on the
    records of their chunk alone, so chunks can be stored and redone one by one."""
    outage = F.coalesce("outage_detected", F.lit(False))
    rows = probes.select(
        # never null, so that the join of pieces and totals is a plain one
        F.coalesce("region_id", F.lit("unknown")).alias("region_id"),
        "country_code",
        "country_name",
        "ts",
        F.floor(F.unix_seconds("ts") / chunk_s).alias("chunk"),
        outage.alias("outage"),
        F.col("event_id"),
    )
    in_chunk = W.partitionBy("region_id", "chunk").orderBy("ts", "event_id")
    counted = rows.withColumn(
        "good_here",
        F.count_if(~F.col("outage")).over(
            in_chunk.rowsBetween(W.unboundedPreceding, W.currentRow)
        ),
    )
    pieces = (
        counted.groupBy("region_id", "chunk", "country_code", "country_name", "good_here")
        .agg(
            F.count_if("outage").alias("records"),
            F.min(F.when(F.col("outage"), F.col("ts"))).alias("start_ts"),
            F.max(F.when(F.col("outage"), F.col("ts"))).alias("end_ts"),
        )
        .filter("records > 0")
    )
    # a pass of its own over two columns, counted map-side: cheaper than the ordered rows
    totals = rows.groupBy("region_id", "chunk").agg(F.count_if(~F.col("outage")).alias("good"))
    return pieces, totals


def joined_episodes(pieces: DataFrame, totals: DataFrame) -> DataFrame:
    """Episodes from the pieces and totals of all chunks."""
    earlier = W.partitionBy("region_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("region_id").alias("_region"),
        F.col("chunk").alias("_chunk"),
        F.coalesce(F.sum("good").over(earlier), F.lit(0)).alias("good_before"),
    )
    named = (
        pieces.join(
            offsets,
            (F.col("region_id") == F.col("_region")) & (F.col("chunk") == F.col("_chunk")),
        )
        .withColumn("run", F.col("good_before") + F.col("good_here"))
    )
    return (
        named.groupBy("region_id", "country_code", "country_name", "run")
        .agg(
            F.min("start_ts").alias("start_ts"),
            F.max("end_ts").alias("end_ts"),
            F.sum("records").alias("records"),
        )
        .select(
            "region_id",
            "country_code",
            "country_name",
            "start_ts",
            "end_ts",
            ((F.unix_micros("end_ts") - F.unix_micros("start_ts")) / 1e6).alias("duration_s"),
            "records",
        )
    )


def outage_duration(episodes: DataFrame) -> DataFrame:
    """Outage time per country, longest first."""
    return (
        episodes.groupBy("country_code", "country_name")
        .agg(
            F.count(F.lit(1)).alias("episodes"),
            F.sum("records").alias("outage_records"),
            F.sum("duration_s").alias("total_duration_s"),
            F.max("duration_s").alias("longest_s"),
        )
        .orderBy(F.desc("total_duration_s"), "country_code")
    )


def rate_drop(events: DataFrame, ratio: float = 0.5) -> DataFrame:
    """Hours in which a region's event rate fell below ``ratio`` of its own mean hourly rate.

    Hours without any event inside the region's first-to-last range count as rate 0 and are
    reported too. Everything after the first aggregation works on hourly counts.
    """
    hourly = events.groupBy("region_id", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("events")
    )
    spans = hourly.groupBy("region_id").agg(
        F.min("hour").alias("first"), F.max("hour").alias("last"), F.sum("events").alias("total")
    )
    hours = F.sequence("first", "last", F.expr("INTERVAL 1 HOUR"))
    grid = spans.select(
        "region_id",
        F.explode(hours).alias("hour"),
        (F.col("total") / F.size(hours)).alias("mean_per_hour"),
    )
    filled = grid.join(hourly, ["region_id", "hour"], "left").fillna(0, subset=["events"])
    return filled.filter(F.col("events") < F.col("mean_per_hour") * F.lit(ratio)).select(
        "region_id", "hour", "events", "mean_per_hour"
    )


def seasonal_drop(
    events: DataFrame, ratio: float = 0.5, season_h: int = 168, seasons: int = 8, least: int = 2, spread: float = 3.0
) -> DataFrame:
    """Hours in which a region's event count fell out of its own season: below ``ratio`` of the
    median of the same hour in up to ``seasons`` earlier weeks (``season_h`` hours each), and by
    more than ``spread`` median absolute deviations. At least ``least`` earlier hours are needed.

    Only earlier hours are read for an hour's verdict, so later records change none. Hours without
    an event count as 0 from a region's first hour on; the hours looked at are those in which any
    region has an event, so a stray stamp adds one hour and no range. Counts per region and hour
    are all that is ordered, spread over (region, hour of the season).
    """
    hourly = events.groupBy("region_id", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("events")
    )
    hourly = hourly.filter("hour IS NOT NULL")
    first = hourly.groupBy("region_id").agg(F.min("hour").alias("first"))
    hours = hourly.select("hour").distinct()
    # regions by hours, as rate_drop's grid, without the hours nobody has
    grid = first.join(hours, F.col("hour") >= F.col("first")).select("region_id", "hour")
    filled = grid.join(hourly, ["region_id", "hour"], "left").fillna(0, subset=["events"])
    place = F.floor(F.unix_seconds("hour") / 3600)
    slots = filled.withColumns({"slot": place % season_h, "season": F.floor(place / season_h)})
    before = W.partitionBy("region_id", "slot").orderBy("season").rangeBetween(-seasons, -1)
    past = slots.withColumn("past", F.sort_array(F.collect_list("events").over(before)))

    def median(values):
        n = F.size(values)
        low, high = F.get(values, F.floor((n - 1) / 2).cast("int")), F.get(values, F.floor(n / 2).cast("int"))
        return (low + high) / F.lit(2.0)

    judged = past.filter(F.size("past") >= least).withColumn("median", median(F.col("past")))
    off = F.sort_array(F.transform("past", lambda x: F.abs(x - F.col("median"))))
    judged = judged.withColumn("mad", median(off))
    low = (F.col("events") < F.col("median") * ratio) & (F.col("median") - F.col("events") > spread * F.col("mad"))
    return judged.filter(low).select("region_id", "hour", "events", "median", "mad")
