"""The named SQL reports over a probe table, with bound parameters.

Each report takes ``as_of`` (epoch second; None means the newest record of the table) and
reads ``{probes}``, which is a DataFrame, a view or a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DAY, WEEK = 86_400, 604_800
_START = "coalesce(:as_of, {newest}) - :lookback_s"
_SINCE = f"unix_ts >= {_START}{{pruned}}"
# Over a history partitioned by hour, the newest record is looked up in the newest folder and
# the folders before the first hour are not listed.
_NEWEST = "(SELECT max(unix_ts) FROM {probes})"
_NEWEST_BY_HOUR = (
    "(SELECT max(unix_ts) FROM {probes} WHERE hour = (SELECT max(hour) FROM {probes}))"
)
_BY_HOUR = f" AND hour >= date_format(timestamp_seconds({_START}), 'yyyyMMdd_HH')"
_HOUR = "date_trunc('hour', timestamp_seconds(unix_ts))"

REPORTS = {
    # worst countries of the last day
    "top_affected": (
        f"""
        SELECT country_code, country_name,
               avg(health_score) AS avg_health, avg(avg_rtt_ms) AS avg_latency,
               avg(packet_loss_pct) AS avg_loss,
               count_if(outage_detected) AS outage_events, count(*) AS probe_count
        FROM {{probes}} WHERE {_SINCE}
        GROUP BY ALL ORDER BY avg_health, country_code LIMIT 10
        """,
        {"lookback_s": DAY},
    ),
    # one country by hour
    "latency_trend": (
        f"""
        SELECT {_HOUR} AS hour_bucket, country_code,
               avg(avg_rtt_ms) AS avg_latency_ms, avg(packet_loss_pct) AS avg_loss_pct,
               avg(health_score) AS avg_health
        FROM {{probes}} WHERE {_SINCE} AND country_code = :country
        GROUP BY ALL ORDER BY hour_bucket
        """,
        {"lookback_s": DAY, "country": "US"},
    ),
    # everything by hour
    "global_trend": (
        f"""
        SELECT {_HOUR} AS hour_bucket,
               avg(health_score) AS global_health, avg(avg_rtt_ms) AS global_latency,
               avg(packet_loss_pct) AS global_loss, count_if(outage_detected) AS outage_events
        FROM {{probes}} WHERE {_SINCE}
        GROUP BY ALL ORDER BY hour_bucket
        """,
        {"lookback_s": WEEK},
    ),
    # regions with most outage records
    "outage_hotspots": (
        f"""
        SELECT region_id, region_name, country_code, country_name,
               count(*) AS outage_count, avg(avg_rtt_ms) AS avg_latency_during_outage,
               avg(packet_loss_pct) AS avg_loss
        FROM {{probes}} WHERE outage_detected AND {_SINCE}
        GROUP BY ALL ORDER BY outage_count DESC, region_id LIMIT 10
        """,
        {"lookback_s": DAY},
    ),
    # what the table covers; regions are counted over pre-grouped rows
    "dataset_span": (
        """
        SELECT sum(n) AS total_records, count(region_id) AS regions,
               min(lo) AS first_ts, max(hi) AS last_ts
        FROM (SELECT region_id, count(*) AS n, min(unix_ts) AS lo, max(unix_ts) AS hi
              FROM {probes} GROUP BY region_id)
        """,
        {},
    ),
}

_BATCH_SUMMARY = """
    SELECT country_code, country_name, region_id, region_name, continent,
           count(*) AS total_probes, avg(avg_rtt_ms) AS avg_latency_ms,
           min(avg_rtt_ms) AS min_latency_ms, max(avg_rtt_ms) AS max_latency_ms,
           avg(packet_loss_pct) AS avg_packet_loss_pct, avg(health_score) AS avg_health_score,
           sum(CAST(outage_detected AS INT)) AS total_outages
    FROM {probes} GROUP BY ALL ORDER BY avg_health_score, region_id
"""


def run_report(
    spark: SparkSession, name: str, probes: DataFrame | str, as_of: int | None = None, **params
) -> DataFrame:
    """A named report as a typed DataFrame. Parameters are bound, never put into the text."""
    text, defaults = REPORTS[name]
    source = spark.table(probes) if isinstance(probes, str) else probes
    args = {**defaults, **params}
    unknown = set(params) - set(defaults)
    if unknown:
        raise ValueError(f"{name} takes no parameter {sorted(unknown)}")
    if ":as_of" in text:
        args["as_of"] = as_of
    by_hour = "hour" in source.columns
    text = text.replace("{pruned}", _BY_HOUR if by_hour else "")
    text = text.replace("{newest}", _NEWEST_BY_HOUR if by_hour else _NEWEST)
    return spark.sql(text, args=args or None, probes=source)


def batch_summary(spark: SparkSession, probes: DataFrame | str) -> DataFrame:
    """Per-region summary over the whole table."""
    source = spark.table(probes) if isinstance(probes, str) else probes
    return spark.sql(_BATCH_SUMMARY, probes=source)


def create_batch_view(spark: SparkSession, table: str, view: str = "v_batch_summary") -> None:
    """The summary as a view over a registered table."""
    source = ".".join(f"`{part}`" for part in table.split("."))
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS " + _BATCH_SUMMARY.format(probes=source))
