"""Recent-window views: trailing window, sliding windows, per-batch aggregates, KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from netvitals.functions import rules
from netvitals.functions.measures import merge_sums, partial_sums, zero_filled_mean
from netvitals.operators.latest import newest_rows, pick_one
from netvitals.plans.shared import settle
from netvitals.plans.timeframe import as_column, between

WINDOW_S = 300
SLIDE_S = 60
HISTORY_LEN = 120
METADATA = [
    "region_name", "country_code", "country_name", "continent", "lat", "lon", "flag", "provider",
]


def _keyed(probes: DataFrame) -> DataFrame:
    return probes.withColumn("region_id", F.coalesce("region_id", F.lit("unknown")))


def _with_latest_metadata(rows: DataFrame, unknown_state: str, settled: bool) -> DataFrame:
    """Per region: sums over the rows plus the metadata and state of the newest row."""
    sums = rows.groupBy("region_id").agg(*partial_sums(), F.max("ts").alias("last_ts"))
    if settled:
        sums = settle(sums, "window")
    carried = rows.select("region_id", "ts", "event_id", "state", *METADATA)
    newest = pick_one(newest_rows(carried, "region_id", sums), "region_id")
    return (
        sums.join(newest.drop("ts", "event_id"), "region_id")
        .withColumn("flag", F.coalesce("flag", F.lit("")))
        .withColumn("provider", F.coalesce("provider", F.lit("")))
        .withColumn("current_state", F.coalesce("state", F.lit(unknown_state)))
        .drop("state")
    )


def window_measures() -> dict[str, Column]:
    """Columns every windowed view shares, from the blocks of ``partial_sums``."""
    return {
        "sample_count": F.col("n"),
        "avg_health_score": zero_filled_mean("health"),
        "avg_latency_ms": zero_filled_mean("rtt"),
        "avg_packet_loss": zero_filled_mean("loss"),
        "outage_count": F.col("outages"),
        "is_outage": rules.outage_share_exceeded(F.col("outages"), F.col("n")),
    }


def trailing_window(
    probes: DataFrame,
    as_of,
    window_s: int = WINDOW_S,
    settled: bool = True,
    ordered: bool = True,
) -> DataFrame:
    """Per-region aggregates over the closed range [as_of - window_s, as_of], worst first.

    A missing measure counts as 0 here, unlike in the history views. ``settled=False``
    keeps the plan free of intermediate tables, for inputs the size of a micro-batch.
    ``ordered=False`` saves the sort when the rows are only joined or aggregated further.
    """
    end = as_column(as_of)
    rows = _keyed(between(probes, end, window_s)).withColumns(
        # min and max see the zero of a missing latency too
        {"avg_rtt_ms": F.coalesce("avg_rtt_ms", F.lit(0.0))}
    )
    base = _with_latest_metadata(rows, "unknown", settled)
    measures = window_measures()
    health, latency, loss = (
        measures[c] for c in ("avg_health_score", "avg_latency_ms", "avg_packet_loss")
    )
    view = base.select(
        "region_id",
        *METADATA,
        F.timestamp_seconds(end - window_s).alias("window_start"),
        F.timestamp_seconds(end).alias("window_end"),
        F.lit(window_s).alias("window_size_s"),
        *[c.alias(name) for name, c in measures.items()],
        # the names the merged shape uses for the same figures
        health.alias("current_health_score"),
        latency.alias("current_latency_ms"),
        loss.alias("current_packet_loss"),
        health.alias("hist_health_score"),
        latency.alias("hist_latency_ms"),
        rules.status_band(health).alias("status"),
        rules.live_impact(health).alias("impact_score"),
        F.col("rtt_min").alias("min_latency_ms"),
        F.col("rtt_max").alias("max_latency_ms"),
        "current_state",
    )
    return view.orderBy("avg_health_score", "region_id") if ordered else view


def microbatch_aggregates(batch: DataFrame, settled: bool = True) -> DataFrame:
    """The same figures over one delivered batch, whatever time its records carry."""
    base = _with_latest_metadata(_keyed(batch), "healthy", settled)
    return base.select(
        "region_id",
        "region_name",
        "country_code",
        "country_name",
        "lat",
        "lon",
        "flag",
        *[c.alias(name) for name, c in window_measures().items()],
        "current_state",
        F.col("last_ts").alias("updated_at"),
    )


def sliding_windows(
    probes: DataFrame, width_s: int = WINDOW_S, slide_s: int = SLIDE_S
) -> DataFrame:
    """One row per region and window; windows are [start, start + width), every slide.

    Rows are first reduced to one row per region and slide-long pane, and the panes, not
    the rows, are copied into the windows that contain them.
    """
    if width_s % slide_s:
        raise ValueError("width_s must be a multiple of slide_s")
    second = F.unix_seconds("ts")
    pane = F.timestamp_seconds(second - F.pmod(second, F.lit(slide_s)))
    panes = _keyed(probes).groupBy("region_id", pane.alias("pane")).agg(*partial_sums())
    starts = F.sequence(
        F.col("pane") - F.make_dt_interval(secs=F.lit(width_s - slide_s)),
        F.col("pane"),
        F.make_dt_interval(secs=F.lit(slide_s)),
    )
    spread = panes.withColumn("window_start", F.explode(starts))
    return (
        spread.groupBy("window_start", "region_id")
        .agg(*merge_sums())
        .select(
            "window_start",
            (F.col("window_start") + F.make_dt_interval(secs=F.lit(width_s))).alias("window_end"),
            "region_id",
            *[c.alias(name) for name, c in window_measures().items()],
        )
    )


def stream_sliding_windows(
    probes: DataFrame, width_s: int = WINDOW_S, slide_s: int = SLIDE_S, lateness: str = "10 minutes"
) -> DataFrame:
    """Streaming form of :func:`sliding_windows` (``probes`` from ``readStream``).

    State per region and window is the sums, never rows. Records later than ``lateness``
    are left out, which bounds the state.
    """
    window = F.window("ts", f"{width_s} seconds", f"{slide_s} seconds")
    return (
        _keyed(probes)
        .withWatermark("ts", lateness)
        .groupBy(window.alias("w"), "region_id")
        .agg(*partial_sums())
        .select(
            "w",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "region_id",
            *[c.alias(name) for name, c in window_measures().items()],
        )
    )


def kpi_measures() -> list[Column]:
    """Global figures over region aggregates: regions count equally, not by samples."""
    return [
        F.avg("avg_health_score").alias("global_health_score"),
        F.avg("avg_latency_ms").alias("global_avg_latency"),
        F.avg("avg_packet_loss").alias("global_avg_loss"),
        F.count_if("is_outage").alias("active_outages"),
        F.count(F.lit(1)).alias("regions_monitored"),
    ]


def speed_global(windows: DataFrame) -> DataFrame:
    """KPI row per window end, from trailing or sliding region windows; none when empty."""
    return (
        windows.groupBy(F.col("window_end").alias("computed_at"))
        .agg(*kpi_measures())
        .withColumn("layer", F.lit("speed"))
    )


def stream_speed_global(windows: DataFrame) -> DataFrame:
    """Streaming KPIs chained onto :func:`stream_sliding_windows`. Windows of one slide
    share their end, so each is keyed by its own time window."""
    return (
        windows.groupBy(F.col("w"))
        .agg(*kpi_measures())
        .select(
            F.col("w.end").alias("computed_at"),
            "global_health_score",
            "global_avg_latency",
            "global_avg_loss",
            "active_outages",
            "regions_monitored",
            F.lit("speed").alias("layer"),
        )
    )


def kpi_history(kpis: DataFrame, n: int = HISTORY_LEN) -> DataFrame:
    """The newest ``n`` KPI rows, oldest first. The limit leaves one partition of ``n`` rows,
    so they are put in time order there, without another shuffle."""
    return (
        kpis.orderBy(F.desc("computed_at"))
        .limit(n)
        .select(
            F.col("computed_at").alias("ts"),
            F.col("global_health_score").alias("health_score"),
            F.col("global_avg_latency").alias("latency_ms"),
            F.col("global_avg_loss").alias("loss_pct"),
        )
        .coalesce(1)
        .sortWithinPartitions("ts")
    )


def window_update(kpis: DataFrame) -> DataFrame:
    """The record pushed to subscribers after each window."""
    return kpis.select(
        F.col("global_health_score").alias("global_health"),
        "active_outages",
        F.col("global_avg_latency").alias("global_latency"),
        F.col("regions_monitored").alias("regions"),
        F.col("computed_at").alias("ts"),
    )


def live_global(state: DataFrame) -> DataFrame:
    """KPIs straight from the latest record per region; no row when there is none."""
    return (
        state.agg(
            F.avg(F.coalesce("health_score", F.lit(100.0))).alias("global_health_score"),
            F.avg(F.coalesce("avg_rtt_ms", F.lit(50.0))).alias("global_avg_latency"),
            F.avg(F.coalesce("packet_loss_pct", F.lit(0.0))).alias("global_avg_loss"),
            F.count_if("outage_detected").alias("active_outages"),
            F.count(F.lit(1)).alias("regions_monitored"),
        )
        .filter("regions_monitored > 0")
        .withColumn("layer", F.lit("live"))
    )


def trending_issues(
    probes: DataFrame, as_of, window_s: int = WINDOW_S, n: int = 5
) -> DataFrame:
    """The ``n`` most frequent (region, bad state) pairs of the trailing window."""
    return (
        between(probes, as_of, window_s)
        .filter(F.col("state") != "healthy")
        .groupBy("region_id", "region_name", "state")
        .agg(*partial_sums())
        .select(
            "region_id",
            "region_name",
            "state",
            F.col("n").alias("occurrences"),
            zero_filled_mean("health").alias("avg_health_score"),
        )
        .orderBy(F.desc("occurrences"), "region_id", "state")
        .limit(n)
    )


#: Keys a heavy-hitter sketch follows: counts are exact while no more occur, beyond that a count
#: is too high by the share of the rows that the sketch had to merge.
TOP_KEYS = 1000


def issue_panes(probes: DataFrame, pane_s: int = 3600, keys: int = TOP_KEYS) -> DataFrame:
    """A heavy-hitter sketch of (region, bad state) pairs per pane: mergeable, of bounded size."""
    second = F.unix_seconds("ts")
    pane = F.timestamp_seconds(second - F.pmod(second, F.lit(pane_s)))
    # one text, as the sketch takes plain values
    pair = F.concat_ws("|", F.coalesce("region_id", F.lit("unknown")), F.col("state"))
    rows = probes.filter("state != 'healthy'").select(pane.alias("pane"), pair.alias("issue"))
    return rows.groupBy("pane").agg(F.expr(f"approx_top_k_accumulate(issue, {int(keys)})").alias("sketch"))


def window_issues(
    panes: DataFrame, width_s: int, pane_s: int = 3600, n: int = 5, keys: int = TOP_KEYS
) -> DataFrame:
    """The ``n`` most frequent issues of every window of ``width_s`` that begins at a pane, from
    the panes' sketches: sketches are copied into windows, never records."""
    if width_s % pane_s:
        raise ValueError("width_s must be a multiple of pane_s")
    starts = F.sequence(
        F.col("pane") - F.make_dt_interval(secs=F.lit(width_s - pane_s)),
        F.col("pane"),
        F.make_dt_interval(secs=F.lit(pane_s)),
    )
    spread = panes.withColumn("window_start", F.explode(starts))
    merged = spread.groupBy("window_start").agg(F.expr(f"approx_top_k_combine(sketch, {int(keys)})").alias("sketch"))
    # a few more than wanted, so that equal counts can be put in order
    found = merged.select("window_start", F.expr(f"inline(approx_top_k_estimate(sketch, {int(keys)}))"))
    rank = F.row_number().over(W.partitionBy("window_start").orderBy(F.desc("count"), "item"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= n).select(
        "window_start",
        "rank",
        F.substring_index("item", "|", -1).alias("state"),
        F.regexp_replace("item", r"\|[^|]*$", "").alias("region_id"),
        F.col("count").alias("occurrences"),
    )
