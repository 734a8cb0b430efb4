"""Merging the stored speed and batch views, and serving them by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvitals import schema
from netvitals.functions.rounding import shown
from netvitals.operators import alerts, feed, serving, speed
from netvitals.plans.store import publish, read_version
from netvitals.sources.views import first_non_empty, read_view, stored_format


def _batch(spark: SparkSession, root: str, name: str, ddl: str) -> DataFrame:
    path = f"{root}/batch/{name}"
    return read_view(spark, path, ddl, stored_format(spark, path))


def _speed(spark: SparkSession, root: str, name: str, ddl: str) -> DataFrame:
    return read_version(spark, f"{root}/speed/{name}", ddl)


def run_merge(spark: SparkSession, root: str) -> None:
    """Reads both layers' views (absent ones as empty) and writes the merged views."""
    window = _speed(spark, root, "window_aggregates", schema.WINDOW_DDL)
    latency = _batch(spark, root, "latency_by_region", schema.LATENCY_DDL)
    merged = serving.merge_regions(window, latency, ordered=False)
    # a row per region, read by three views
    regions = shown(merged, "merged_regions").persist()
    overall = serving.merge_global(
        regions,
        _batch(spark, root, "global_summary", schema.BATCH_GLOBAL_DDL),
        _speed(spark, root, "speed_global", schema.SPEED_GLOBAL_DDL),
    )
    at = {"merged_at": F.current_timestamp()}
    ordered = regions.orderBy(F.desc("impact_score"), "region_id")
    publish(ordered.withColumns(at), f"{root}/merged/merged_regions")
    publish(shown(overall, "merged_global").withColumns(at), f"{root}/merged/merged_global")
    top = serving.top_affected_regions(regions)
    publish(top.withColumns(at), f"{root}/merged/top_affected")
    regions.unpersist()


def live_state(spark: SparkSession, root: str, now: int | None = None) -> DataFrame:
    """The latest-state table, without entries past their time when ``now`` is given."""
    rows = _speed(spark, root, "current_state", schema.STATE_DDL)
    return rows if now is None else rows.filter(F.col("expires_at") > now)


def serve_view(
    spark: SparkSession, root: str, name: str, now: int | None = None, prefer_live: bool = False
) -> DataFrame:
    """A view by its public name, from the best source that has rows.

    Regions come from the merged view, else the window view, else the latest state; with
    ``prefer_live`` the latest state is asked first. Ranked views are ordered here, since
    stored files have no order.
    """
    state = live_state(spark, root, now)

    def merged(view: str, ddl: str) -> DataFrame:
        return read_version(spark, f"{root}/merged/{view}", ddl)

    def best(fallback: DataFrame, *stored: DataFrame) -> DataFrame:
        if prefer_live:
            return first_non_empty(fallback, *stored, fallback)
        return first_non_empty(*stored, fallback)

    def live_regions() -> DataFrame:
        # the same places as the stored views it stands in for
        return shown(serving.normalized_regions(state), "merged_regions")

    if name == "map-data":
        window = _speed(spark, root, "window_aggregates", schema.WINDOW_DDL)
        found = best(live_regions(), merged("merged_regions", schema.MERGED_DDL), window)
        return found.orderBy(F.desc("impact_score"), "region_id")
    if name == "global":
        kpis = _speed(spark, root, "speed_global", schema.SPEED_GLOBAL_DDL)
        stored = merged("merged_global", schema.MERGED_GLOBAL_DDL)
        return best(shown(speed.live_global(state), "merged_global"), stored, kpis)
    if name == "top-affected":
        top = serving.top_affected_regions(live_regions())
        return serving.top_affected_regions(best(top, merged("top_affected", schema.MERGED_DDL)))
    if name == "history":
        return _speed(spark, root, "history", schema.HISTORY_DDL).orderBy(F.desc("ts"))
    if name == "live-events":
        return feed.live_events(_speed(spark, root, "live_events", schema.FEED_DDL))
    if name == "batch-summary":
        return _batch(spark, root, "global_summary", schema.BATCH_GLOBAL_DDL)
    if name == "window-aggregates":
        window = _speed(spark, root, "window_aggregates", schema.WINDOW_DDL)
        return window.orderBy("avg_health_score", "region_id")
    if name == "observability":
        return alerts.observability_summary(live_regions())
    if name == "incidents":
        episodes = _batch(spark, root, "last_episodes", schema.EPISODE_DDL)
        return alerts.incident_timeline(alerts.incidents(live_regions()), episodes)
    if name == "alerts":
        return alerts.alerts(live_regions(), now)
    raise KeyError(name)
