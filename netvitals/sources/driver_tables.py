"""The probe history and the raw connector inputs, derived from the star-schema tables.

Every column is a deterministic expression over ``events``, ``nation`` and ``region``,
so the same view can be written in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netvitals.functions import rules
from netvitals.plans.session import tune
from netvitals.plans.shared import settle
from netvitals.schema import PROBE_COLUMNS


# Given, not inferred: inference would run a job per table just to read a footer.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _text(column: Column) -> Column:
    return column.cast("string")


def _region_columns() -> list[Column]:
    key = F.col("n_nationkey")
    return [
        F.col("n_name").alias("region_id"),
        _cat("Region ", F.col("n_name")).alias("region_name"),
        _cat("C", _text(key % 10)).alias("country_code"),
        _cat("Country ", _text(key % 10)).alias("country_name"),
        F.col("r_name").alias("continent"),
        (key * 5 - 60).cast("double").alias("lat"),
        (key * 14 - 170).cast("double").alias("lon"),
        F.lit("").alias("flag"),
        _cat("ISP", _text(key % 7)).alias("provider"),
    ]


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region dimension: one row per nation, as a stored table of known size."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("n_nationkey").alias("region_key")
    return settle(joined.select(key, *_region_columns()), "region_dim")


def raw_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Events with an instant instead of a zone-less time, and the property ``k``."""
    if stream:
        tune(spark)
        # written as a pattern: the stream source wants a folder or a pattern, not one file
        pattern = f"{sf_dir}/events.parque[t]"
        events = spark.readStream.schema(SCHEMAS["events"]).parquet(pattern)
    else:
        events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def probes(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Probe rows: events (table or stream) with their nation and region.

    The two dimensions are joined one after the other as plain file scans. Joined with each
    other first, their estimated size is a product, and Spark would shuffle the events by
    nation instead of broadcasting a few rows.
    """
    k = F.col("k")
    state = (
        F.when(F.col("event_type") != "error", "healthy")
        .when(k % 4 == 0, "critical")
        .when(k % 4 == 1, "warning")
        .otherwise("degraded")
    )
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = (
        raw_events(spark, sf_dir, stream)
        .withColumn("state", state)
        .join(nation, F.col("user_id") % 25 == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    user = _text(F.col("user_id") % 5 + 1)
    measured = joined.select(
        "event_id",
        "ts",
        F.unix_seconds("ts").alias("unix_ts"),
        _cat("probe-", F.col("n_name"), "-", user).alias("probe_id"),
        *_region_columns(),
        (F.col("value") * 4).alias("avg_rtt_ms"),
        (F.col("value") * 3).alias("min_rtt_ms"),
        (F.col("value") * 6).alias("max_rtt_ms"),
        (k * rules.lit_double(0.4)).alias("packet_loss_pct"),
        (k % 15 + 6).alias("hop_count"),
        (~((F.col("state") == "critical") & (k % 5 < 2))).alias("is_reachable"),
        "state",
        F.lit("ping").alias("measurement_type"),
    )
    return measured.withColumns(
        {
            "outage_detected": rules.outage_flag(F.col("state"), F.col("packet_loss_pct")),
            "health_score": rules.health_score(
                F.col("avg_rtt_ms"), F.col("packet_loss_pct"), F.col("is_reachable")
            ),
        }
    )


def newest_event(spark: SparkSession, sf_dir: str) -> Column:
    """Epoch second of the newest event, as a scalar subquery over one column."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").agg(F.unix_seconds(F.max(ts))).scalar()


def edit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit-feed lines as JSON text: the event type plays the language edition."""
    e = raw_events(spark, sf_dir)
    domain = _cat(F.col("event_type"), ".example.org")
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.struct(
        F.struct(domain.alias("domain"), when.alias("dt")).alias("meta"),
        F.unix_seconds("ts").alias("timestamp"),
        F.when(F.col("k") % 2 == 0, "edit").otherwise("categorize").alias("type"),
        F.when(F.col("k") % 3 == 0, F.lit(True))
        .when(F.col("k") % 3 == 1, F.lit(False))
        .alias("bot"),
    )
    return e.select("event_id", F.to_json(body).alias("data"))


def language_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language -> region: four event types map to the four nations named here."""
    language = F.lit(None).cast("string")
    for lang, key in (("click", 1), ("view", 2), ("signup", 3), ("purchase", 4)):
        language = F.when(F.col("region_key") == key, lang).otherwise(language)
    mapped = regions(spark, sf_dir).select(language.alias("language"), "region_id")
    mapped = mapped.filter("language IS NOT NULL")
    return settle(mapped, "language_dim")


def atlas_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ping results with missing and zero round-trip times and missing loss."""
    k = F.col("k")
    return raw_events(spark, sf_dir).select(
        "event_id",
        "ts",
        F.col("user_id").alias("prb_id"),
        F.when(k % 10 == 0, F.lit(None).cast("double"))
        .when(k % 10 == 1, F.lit(0.0))
        .otherwise(F.col("value") * 10)
        .alias("avg"),
        F.when(k % 7 != 0, k.cast("double")).alias("loss"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery envelopes: base64 payload, queue body, or neither, by event id."""
    body = F.to_json(F.struct("event_id", "user_id", "value"))
    kind = F.col("event_id") % 3
    payload = F.when(kind == 0, F.struct(F.base64(F.encode(body, "UTF-8")).alias("data")))
    return raw_events(spark, sf_dir).select(
        payload.alias("kinesis"),
        F.when(kind == 1, "aws:sqs").alias("eventSource"),
        F.when(kind == 1, body).alias("body"),
    )


def ndjson_copy(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The probe rows as NDJSON files, with ISO times and text ids."""
    rows = probes(spark, sf_dir)
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    known = [c for c in PROBE_COLUMNS if c in rows.columns and c != "event_id"]
    lines = rows.select(F.col("event_id").cast("string"), iso.alias("timestamp"), *known)
    lines.write.json(path)
