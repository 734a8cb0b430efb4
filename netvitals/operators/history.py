"""Full-history views per region, country and hour.

``outage_frequency``, ``hourly_health_trend``, ``global_summary`` and ``country_rollup`` take probe
rows or an :func:`hourly_cube` made from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvitals.functions import rules
from netvitals.functions.measures import mean, merge_sums, partial_sums
from netvitals.operators.ranks import values_at
from netvitals.schema import REGION_COLUMNS

COUNTRY = ["country_code", "country_name"]
CUBE_KEYS = ["hour", "region_id", "region_name", *COUNTRY, "outage_detected"]


def hourly_cube(probes: DataFrame) -> DataFrame:
    """Sums per hour, region and outage flag: one pass over the history, from which every
    view here except the quantiles can be taken. Hours can be added or redone one by one."""
    rows = probes.withColumn("hour", F.date_trunc("hour", "ts"))
    return rows.groupBy(*CUBE_KEYS).agg(*partial_sums())


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    """Sums per key group of probe rows or of a cube."""
    blocks = merge_sums() if "rtt_sum" in rows.columns else partial_sums()
    return rows.groupBy(*keys).agg(*blocks)


def _latency_view(rows: DataFrame, p50: Column, p95: Column, ordered: bool) -> DataFrame:
    view = rows.select(
        *REGION_COLUMNS,
        F.col("n").alias("probe_count"),
        mean("rtt").alias("avg_latency_ms"),
        F.col("rtt_min").alias("min_latency_ms"),
        F.col("rtt_max").alias("max_latency_ms"),
        p50.alias("p50_latency_ms"),
        p95.alias("p95_latency_ms"),
        mean("loss").alias("avg_packet_loss_pct"),
        mean("health").alias("avg_health_score"),
    )
    return view.orderBy(F.desc("avg_latency_ms"), "region_id") if ordered else view


def latency_by_region(probes: DataFrame, ordered: bool = True) -> DataFrame:
    """Latency statistics per region over everything given, slowest region first.

    p50 and p95 are exact discrete quantiles (the value at position ceil(p * n)) at any size:
    one pass makes the sums and counts values per bin, a second opens the bins that hold the
    positions (`ranks.values_at`). ``ordered=False`` saves the sort.
    """

    def positions(n: Column) -> dict[str, Column]:
        # whole numbers, so that no product is off by a rounding
        at = {f"q{p}": F.floor((F.lit(p) * n + 99) / 100) - 1 for p in (50, 95)}
        return {name: F.greatest(position, F.lit(0)) for name, position in at.items()}

    found = values_at(
        probes, list(REGION_COLUMNS), "avg_rtt_ms", positions, partial_sums(), merge_sums()
    )
    return _latency_view(found, F.col("q50"), F.col("q95"), ordered)


def latency_sketch(probes: DataFrame, accuracy: int = 10_000, ordered: bool = True) -> DataFrame:
    """`latency_by_region` in one pass, with quantiles of a sketch per region: their rank is
    off by at most n / ``accuracy``."""
    quantiles = F.percentile_approx("avg_rtt_ms", [0.5, 0.95], accuracy)
    rows = probes.groupBy(*REGION_COLUMNS).agg(*partial_sums(), quantiles.alias("quantiles"))
    p50, p95 = (F.get("quantiles", F.lit(i)) for i in (0, 1))
    return _latency_view(rows, p50, p95, ordered)


def region_means(probes: DataFrame) -> DataFrame:
    """The means of `latency_by_region` alone, in one pass without quantiles."""
    rows = _summed(probes, *REGION_COLUMNS)
    return rows.select(
        *REGION_COLUMNS,
        F.col("n").alias("probe_count"),
        mean("rtt").alias("avg_latency_ms"),
        mean("loss").alias("avg_packet_loss_pct"),
        mean("health").alias("avg_health_score"),
    )


def outage_frequency(probes: DataFrame) -> DataFrame:
    """Outage events per country, most affected first.

    Grouping by (country, region) first makes the distinct-region count a plain count
    over a few rows, instead of an expansion of every outage row.
    """
    per_region = _summed(probes.filter("outage_detected"), *COUNTRY, "region_id")
    return (
        per_region.groupBy(*COUNTRY)
        .agg(*merge_sums(), F.count("region_id").alias("affected_regions"))
        .select(
            *COUNTRY,
            F.col("n").alias("outage_events"),
            "affected_regions",
            mean("loss").alias("avg_packet_loss_during_outage"),
            mean("rtt").alias("avg_latency_during_outage"),
        )
        .orderBy(F.desc("outage_events"), "country_code")
    )


def hourly_health_trend(probes: DataFrame) -> DataFrame:
    """Averages per region and hour, in region and time order."""
    keys = ["hour", "region_id", "region_name", "country_code"]
    is_cube = "rtt_sum" in probes.columns
    rows = probes if is_cube else probes.withColumn("hour", F.date_trunc("hour", "ts"))
    return (
        _summed(rows, *keys)
        .select(
            *keys,
            mean("health").alias("avg_health_score"),
            mean("rtt").alias("avg_latency_ms"),
            mean("loss").alias("avg_packet_loss_pct"),
            F.col("n").alias("sample_count"),
        )
        .orderBy("region_id", "hour")
    )


def global_summary(probes: DataFrame) -> DataFrame:
    """One row of totals. Both distinct counts are taken over (country, region) groups, so
    the raw rows are aggregated once; nulls on empty input become 0."""
    pairs = _summed(probes, "country_code", "region_id")
    totals = pairs.agg(
        *merge_sums(),
        F.count_distinct("country_code").alias("countries_monitored"),
        F.count_distinct("region_id").alias("regions_monitored"),
    )
    zero = F.lit(0.0)
    return totals.select(
        F.coalesce(mean("health"), zero).alias("global_health_score"),
        F.coalesce(mean("rtt"), zero).alias("global_avg_latency"),
        F.coalesce(mean("loss"), zero).alias("global_avg_loss"),
        F.coalesce("n", F.lit(0)).alias("total_records"),
        F.coalesce("outages", F.lit(0)).alias("total_outage_events"),
        "countries_monitored",
        "regions_monitored",
    )


def country_rollup(probes: DataFrame, wire_digits: tuple[int, int, int] | None = None) -> DataFrame:
    """Means, outage total and region list per country, in country order.

    Absent fields count with defaults (country XX, region unknown, rtt and loss 0, health
    100). ``wire_digits=(3, 3, 2)`` rounds rtt, loss and health per record before they are
    summed, as a text exchange between map and reduce steps would.
    """
    if "rtt_sum" in probes.columns:
        return _country_view(_filled_cube(probes))
    filled = probes.select(
        F.coalesce("country_code", F.lit("XX")).alias("country_code"),
        F.coalesce("region_id", F.lit("unknown")).alias("region_id"),
        F.coalesce("avg_rtt_ms", F.lit(0.0)).alias("avg_rtt_ms"),
        F.coalesce("packet_loss_pct", F.lit(0.0)).alias("packet_loss_pct"),
        F.coalesce("health_score", F.lit(100.0)).alias("health_score"),
        "outage_detected",
    )
    if wire_digits is not None:
        columns = ["avg_rtt_ms", "packet_loss_pct", "health_score"]
        filled = filled.withColumns({c: F.round(c, d) for c, d in zip(columns, wire_digits)})
    return _country_view(filled.groupBy("country_code", "region_id").agg(*partial_sums()))


def _filled_cube(cube: DataFrame) -> DataFrame:
    """Sums per country and region of a cube, absent fields counted with their defaults."""

    def filled(name: str, default: float) -> Column:
        return F.coalesce(f"{name}_sum", F.lit(0.0)) + default * (F.col("n") - F.col(f"{name}_n"))

    defaults = {"rtt": 0.0, "loss": 0.0, "health": 100.0}
    rows = cube.withColumns(
        {
            "country_code": F.coalesce("country_code", F.lit("XX")),
            "region_id": F.coalesce("region_id", F.lit("unknown")),
            **{f"{name}_sum": filled(name, default) for name, default in defaults.items()},
            **{f"{name}_n": F.col("n") for name in defaults},
        }
    )
    return rows.groupBy("country_code", "region_id").agg(*merge_sums())


def _country_view(per_region: DataFrame) -> DataFrame:
    # region names are collected from (country, region) rows, never from probe rows
    return (
        per_region.groupBy("country_code")
        .agg(*merge_sums(), F.sort_array(F.collect_set("region_id")).alias("affected_regions"))
        .select(
            "country_code",
            F.col("n").alias("probe_count"),
            mean("rtt").alias("avg_latency_ms"),
            mean("loss").alias("avg_packet_loss_pct"),
            F.col("outages").alias("total_outage_events"),
            mean("health").alias("avg_health_score"),
            "affected_regions",
        )
        .orderBy("country_code")
    )


def region_rollup(probes: DataFrame, tasks: int | None = None) -> DataFrame:
    """Four measures per region. ``tasks`` limits the scan to that many tasks, which is how
    the benchmark compares degrees of parallelism; leave it out otherwise."""
    rows = probes if tasks is None else probes.coalesce(tasks)
    return (
        rows.groupBy("region_id")
        .agg(*partial_sums())
        .select(
            "region_id",
            mean("rtt").alias("avg_latency"),
            mean("loss").alias("avg_loss"),
            mean("health").alias("avg_health"),
            "outages",
        )
    )


def top_affected(latency: DataFrame, outages: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` regions with the highest combined health and outage-count impact.

    Takes :func:`latency_by_region` or :func:`region_means`, and :func:`outage_frequency`; the outage count is the
    country's, so regions of one country share it.
    """
    counts = outages.select("country_code", "outage_events", "affected_regions")
    return (
        latency.join(counts, "country_code", "left")
        .fillna(0, subset=["outage_events", "affected_regions"])
        .withColumn(
            "impact_score", rules.batch_impact(F.col("avg_health_score"), F.col("outage_events"))
        )
        .orderBy(F.desc("impact_score"), "region_id")
        .limit(n)
        .select(
            *COUNTRY,
            "avg_latency_ms",
            "avg_packet_loss_pct",
            "avg_health_score",
            "outage_events",
            "affected_regions",
            "impact_score",
        )
    )
