"""Serving views: speed and batch results merged per region and overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvitals.functions import rules

# What a region shows when neither side knows the field.
METADATA_DEFAULTS = {
    "country_code": "XX",
    "country_name": "Unknown",
    "continent": "",
    "lat": 0.0,
    "lon": 0.0,
    "flag": "",
    "provider": "",
}
DEFAULT_HEALTH, DEFAULT_LATENCY_MS, DEFAULT_LOSS = 100.0, 50.0, 0.0


def _prefer(first: Column, second: Column, default) -> Column:
    return F.coalesce(first, second, F.lit(default) if not isinstance(default, Column) else default)


def merge_regions(speed: DataFrame, batch: DataFrame, ordered: bool = True) -> DataFrame:
    """Every region of either side once: current figures from the speed side, history from
    the batch side, each filled from the other where it is absent; worst impact first. The
    history's probe count is 0 and its p95 null for a region that only the speed side knows.

    The speed side holds one row per region. A region whose metadata changed has several
    rows in the batch view, which lists slowest first; the last of them counts.
    ``ordered=False`` saves the sort when the rows are only aggregated or ranked further.
    """
    s, b = speed.alias("s"), one_per_region(batch).alias("b")
    both = s.join(b, F.col("s.region_id") == F.col("b.region_id"), "full_outer")
    region = F.coalesce("s.region_id", "b.region_id")
    metadata = {
        name: _prefer(F.col(f"s.{name}"), F.col(f"b.{name}"), default)
        for name, default in METADATA_DEFAULTS.items()
    }
    metadata["region_name"] = _prefer(F.col("s.region_name"), F.col("b.region_name"), region)
    health = _prefer(F.col("s.avg_health_score"), F.col("b.avg_health_score"), DEFAULT_HEALTH)
    latency = _prefer(F.col("s.avg_latency_ms"), F.col("b.avg_latency_ms"), DEFAULT_LATENCY_MS)
    loss = _prefer(F.col("s.avg_packet_loss"), F.col("b.avg_packet_loss_pct"), DEFAULT_LOSS)
    is_outage = F.coalesce("s.is_outage", F.lit(False))
    view = both.select(
        region.alias("region_id"),
        *[
            metadata[c].alias(c)
            for c in (
                "region_name", "country_code", "country_name", "continent", "lat", "lon",
                "flag", "provider",
            )
        ],
        health.alias("current_health_score"),
        latency.alias("current_latency_ms"),
        loss.alias("current_packet_loss"),
        is_outage.alias("is_outage"),
        F.coalesce("s.current_state", F.lit("healthy")).alias("state"),
        rules.status_band(health).alias("status"),
        F.coalesce("b.avg_health_score", health).alias("hist_health_score"),
        F.coalesce("b.avg_latency_ms", latency).alias("hist_latency_ms"),
        F.coalesce("b.avg_packet_loss_pct", loss).alias("hist_packet_loss"),
        F.coalesce("b.probe_count", F.lit(0).cast("bigint")).alias("hist_probe_count"),
        F.col("b.p95_latency_ms").alias("hist_p95_latency_ms"),
        rules.merged_impact(health, loss, is_outage).alias("impact_score"),
        F.struct(
            F.col("s.region_id").isNotNull().alias("speed_layer"),
            F.col("b.region_id").isNotNull().alias("batch_layer"),
        ).alias("data_sources"),
    )
    return view.orderBy(F.desc("impact_score"), "region_id") if ordered else view


def one_per_region(batch: DataFrame) -> DataFrame:
    payload = F.struct(*[c for c in batch.columns if c != "region_id"])
    order = F.struct("avg_latency_ms", "provider", "country_code")
    return (
        batch.filter(F.col("region_id").isNotNull())
        .groupBy("region_id")
        .agg(F.min_by(payload, order).alias("r"))
        .select("region_id", "r.*")
    )


def merge_global(regions: DataFrame, batch_global: DataFrame, speed_global: DataFrame) -> DataFrame:
    """Overall KPIs: unweighted means over merged regions, totals from the batch side.

    The batch and speed rows are read as scalar subqueries, so an absent row simply gives
    the fallback. No row when there are no regions.
    """

    def scalar(frame: DataFrame, column: str) -> Column:
        return frame.agg(F.max(column)).scalar()

    overall = regions.agg(
        F.avg("current_health_score").alias("global_health_score"),
        F.avg("current_latency_ms").alias("global_avg_latency"),
        F.avg("current_packet_loss").alias("global_avg_loss"),
        F.count_if("is_outage").alias("active_outages"),
        F.count(F.lit(1)).alias("regions_monitored"),
    ).filter("regions_monitored > 0")
    health = F.col("global_health_score")
    zero = F.lit(0).cast("bigint")
    return overall.select(
        "*",
        F.coalesce(scalar(batch_global, "total_records"), zero).alias("total_records_batch"),
        F.coalesce(scalar(batch_global, "total_outage_events"), zero).alias("total_outage_events"),
        F.coalesce(scalar(batch_global, "global_health_score"), health).alias("batch_health"),
        F.coalesce(scalar(speed_global, "global_health_score"), health).alias("speed_health"),
        F.lit("merged").alias("layer"),
    )


def top_affected_regions(regions: DataFrame, n: int = 10) -> DataFrame:
    return regions.orderBy(F.desc("impact_score"), "region_id").limit(n)


def normalized_regions(state: DataFrame) -> DataFrame:
    """Latest probe per region in merged-region shape, for use before any merge ran."""
    health = F.coalesce("health_score", F.lit(DEFAULT_HEALTH))
    latency = F.coalesce("avg_rtt_ms", F.lit(DEFAULT_LATENCY_MS))
    loss = F.coalesce("packet_loss_pct", F.lit(DEFAULT_LOSS))
    filled = {name: F.coalesce(name, F.lit(v)) for name, v in METADATA_DEFAULTS.items()}
    return state.select(
        F.coalesce("region_id", F.lit("")).alias("region_id"),
        F.coalesce("region_name", F.lit("")).alias("region_name"),
        *[c.alias(name) for name, c in filled.items()],
        health.alias("current_health_score"),
        latency.alias("current_latency_ms"),
        loss.alias("current_packet_loss"),
        F.coalesce("outage_detected", F.lit(False)).alias("is_outage"),
        F.coalesce("state", F.lit("healthy")).alias("state"),
        rules.status_band(health).alias("status"),
        health.alias("hist_health_score"),
        latency.alias("hist_latency_ms"),
        rules.live_impact(health).alias("impact_score"),
    ).orderBy(F.desc("impact_score"), "region_id")
