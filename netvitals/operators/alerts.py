"""Observability summary, incidents and alerts derived from the merged regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from netvitals.functions.rules import DEGRADED_FROM, HEALTHY_FROM, half_up
from netvitals.plans.timeframe import as_column

INCIDENT_REGIONS, ALERT_REGIONS, LIVE_ALERTS = 8, 6, 12
# Limits of incidents, alerts and metric tones.
INCIDENT_BELOW, INCIDENT_WARNING_FROM = 90.0, 70.0
SLOW_MS, LOSSY_PCT = 80.0, 1.0


def observability_summary(regions: DataFrame) -> DataFrame:
    """One row of dashboard figures; a quiet default row when there are no regions.

    Overall figures are rounded before the derived ones are taken from them, as shown.
    """
    score = F.coalesce("current_health_score", F.lit(100.0))
    outage = F.coalesce("is_outage", F.lit(False))
    raw = regions.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.coalesce("current_latency_ms", F.lit(0.0))).alias("latency"),
        F.avg(F.coalesce("current_packet_loss", F.lit(0.0))).alias("loss"),
        F.avg(score).alias("overall"),
        F.count_if(score >= HEALTHY_FROM).alias("healthy_regions"),
        F.count_if(score < DEGRADED_FROM).alias("failed_regions"),
        F.count_if(outage | (score < DEGRADED_FROM)).alias("active_incidents"),
    )
    empty = F.col("n") == 0
    shown = raw.select(
        "n",
        F.coalesce(half_up(F.col("latency"), 1), F.lit(0.0)).alias("latency"),
        F.coalesce(half_up(F.col("loss"), 2), F.lit(0.0)).alias("packet_loss"),
        F.coalesce(half_up(F.col("overall"), 1), F.lit(100.0)).alias("overall"),
        "healthy_regions",
        "failed_regions",
        "active_incidents",
    )
    load = F.floor(F.lit(400.0) + (F.lit(100.0) - F.col("overall")) * F.lit(2.0)).cast("int")
    return shown.select(
        "overall",
        F.floor("overall").cast("int").alias("availability"),
        "packet_loss",
        "latency",
        "active_incidents",
        "healthy_regions",
        "failed_regions",
        F.when(empty, 0).otherwise(load).alias("requests_per_sec"),
        F.when(F.col("latency") > SLOW_MS, "warning").otherwise("healthy").alias("latency_tone"),
        F.when(F.col("packet_loss") > LOSSY_PCT, "warning").otherwise("healthy").alias("loss_tone"),
        F.when(F.col("overall") >= HEALTHY_FROM, "healthy")
        .otherwise("critical")
        .alias("availability_tone"),
    )


def _ranked(regions: DataFrame, n: int) -> DataFrame:
    """The ``n`` worst regions with their rank; the limit comes first, so the unpartitioned
    window sees ``n`` rows."""
    top = regions.orderBy(F.desc("impact_score"), "region_id").limit(n)
    score = F.coalesce("current_health_score", F.lit(100.0))
    order = W.orderBy(F.desc("impact_score"), "region_id")
    return top.withColumn("score", score).withColumn("rank", F.row_number().over(order))


def _title(suffix: str):
    return F.concat(F.coalesce("region_name", F.lit("Region")), F.lit(suffix))


def incidents(regions: DataFrame) -> DataFrame:
    """Degraded regions among the eight worst; the id keeps the rank among those eight."""
    return (
        _ranked(regions, INCIDENT_REGIONS)
        .filter(F.col("score") < INCIDENT_BELOW)
        .select(
            F.concat(F.lit("inc-"), F.col("rank").cast("string")).alias("id"),
            _title(" degradation").alias("title"),
            F.when(F.col("score") >= INCIDENT_WARNING_FROM, "warning")
            .otherwise("critical")
            .alias("severity"),
            F.coalesce("region_name", F.lit("Unknown")).alias("region"),
            "region_id",
            "score",
        )
    )


def last_episodes(episodes: DataFrame) -> DataFrame:
    """The last outage episode of each region."""
    last = episodes.groupBy("region_id").agg(
        F.max_by(F.struct("start_ts", "end_ts", "duration_s"), F.col("start_ts")).alias("e")
    )
    return last.select("region_id", "e.start_ts", "e.end_ts", "e.duration_s")


def incident_timeline(incident_rows: DataFrame, episodes: DataFrame) -> DataFrame:
    """Incidents with the start, end and duration of their region's last outage episode.
    ``episodes`` may hold all episodes or only the last ones."""
    return incident_rows.join(last_episodes(episodes), "region_id", "left").select(
        *incident_rows.columns,
        F.col("start_ts").alias("start"),
        F.col("end_ts").alias("end"),
        "duration_s",
    )


def alerts(regions: DataFrame, as_of=None) -> DataFrame:
    """Alerts for unhealthy regions among the six worst, numbered in that order; one
    all-clear row when there is none."""
    unhealthy = _ranked(regions, ALERT_REGIONS).filter(F.col("score") < HEALTHY_FROM)
    number = F.row_number().over(W.orderBy("rank"))
    raised = unhealthy.select(
        F.concat(F.lit("alert-"), number.cast("string")).alias("id"),
        _title(" traffic anomaly").alias("title"),
        F.when(F.col("score") < DEGRADED_FROM, "critical").otherwise("warning").alias("severity"),
        F.format_string(
            "Latency %.1fms and loss %.2f%%",
            F.coalesce(half_up(F.col("current_latency_ms"), 1), F.lit(0.0)),
            F.coalesce(half_up(F.col("current_packet_loss"), 2), F.lit(0.0)),
        ).alias("message"),
    )
    # aggregating to one row makes "there is no alert" a value to filter on
    all_clear = raised.agg(F.count(F.lit(1)).alias("raised")).filter("raised = 0").select(
        F.lit("alert-0").alias("id"),
        F.lit("All services nominal").alias("title"),
        F.lit("information").alias("severity"),
        F.lit("No critical issues detected across monitored regions.").alias("message"),
    )
    rows = raised.unionByName(all_clear)
    return rows if as_of is None else rows.withColumn("ts", F.timestamp_seconds(as_column(as_of)))


def live_alerts(feed: DataFrame, n: int | None = LIVE_ALERTS) -> DataFrame:
    """Alerts straight from feed events that are not mere information, newest first;
    ``n=None`` keeps them all. Events of one millisecond share an id."""
    level = F.lower(F.coalesce("severity", F.lit("warning")))
    rows = feed.filter(F.lower(F.coalesce("severity", F.lit(""))) != "information").select(
        F.concat(F.lit("live-"), F.unix_millis("ts").cast("string")).alias("id"),
        F.concat(F.coalesce("region_name", F.lit("Global")), F.lit(" traffic event")).alias("title"),
        level.alias("severity"),
        F.coalesce("event_type", F.lit("Live outage signal detected")).alias("message"),
        # position in the combined list: newest first
        (-F.unix_micros("ts")).alias("position"),
        "event_id",
    )
    return rows if n is None else rows.orderBy("position", F.desc("event_id")).limit(n)


def alert_dedupe(live: DataFrame, derived: DataFrame) -> DataFrame:
    """Live alerts before derived ones, the first of each id, rows without id dropped.

    ``min_by`` merges map-side, so many copies of one id cost one row per task.
    """
    columns = ["id", "title", "severity", "message"]
    first = F.struct(F.lit(0).alias("list"), F.col("position"), F.col("event_id"))
    second = F.struct(
        F.lit(1).alias("list"),
        F.coalesce(F.expr("try_cast(substring_index(id, '-', -1) AS BIGINT)"), F.lit(0)).alias(
            "position"
        ),
        F.lit("").alias("event_id"),
    )
    both = live.select(*columns, first.alias("o")).unionByName(
        derived.select(*columns, second.alias("o"))
    )
    kept = both.filter(F.col("id").isNotNull()).groupBy("id")
    return kept.agg(F.min_by(F.struct(*columns[1:]), "o").alias("r")).select("id", "r.*")
