"""Event feed: per-record projections, search, ring buffer, counters, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvitals.functions import rules
from netvitals.plans.shared import settle

RING_SIZE = 50
# Event labels by how the record was measured.
EDIT_MEASUREMENT, EDIT_LABEL, PROBE_LABEL = (
    "wikimedia-edit-proxy", "Wikimedia activity", "Network telemetry",
)


def feed_event(probes: DataFrame) -> DataFrame:
    """Probe rows in feed shape."""
    is_edit = F.col("measurement_type") == EDIT_MEASUREMENT
    return probes.select(
        "ts",
        F.col("event_id").cast("string").alias("event_id"),
        F.coalesce("region_id", F.lit("unknown")).alias("region_id"),
        "region_name",
        F.col("country_name").alias("country"),
        F.coalesce("flag", F.lit("")).alias("flag"),
        F.coalesce("state", F.lit("unknown")).alias("severity"),
        F.col("avg_rtt_ms").alias("latency_ms"),
        F.col("packet_loss_pct").alias("packet_loss"),
        F.col("health_score").alias("health"),
        F.when(is_edit, EDIT_LABEL).otherwise(PROBE_LABEL).alias("event_type"),
    )


def outage_alert_stream(probes: DataFrame, *keep: str) -> DataFrame:
    """Records worth pushing: flagged as outage or in a bad state, with the columns ``keep``
    beside the alert's own. Works on streams."""
    bad = F.coalesce("outage_detected", F.lit(False)) | F.coalesce(
        F.col("state").isin(*rules.OUTAGE_STATES), F.lit(False)
    )
    return probes.filter(bad).select(
        F.col("region_name").alias("region"),
        F.col("country_name").alias("country"),
        F.coalesce("flag", F.lit("")).alias("flag"),
        F.coalesce("state", F.lit("unknown")).alias("severity"),
        F.col("avg_rtt_ms").alias("latency"),
        F.col("packet_loss_pct").alias("loss"),
        F.col("health_score").alias("health"),
        "ts",
        *keep,
    )


def feed_search(feed: DataFrame, term: str) -> DataFrame:
    """Feed rows whose region and country text contains ``term``, ignoring case."""
    text = F.concat(
        F.coalesce("region_name", F.lit("")), F.lit(" "), F.coalesce("country", F.lit(""))
    )
    return feed.filter(F.contains(F.lower(text), F.lower(F.lit(term))))


GRAM = 3


def _search_text() -> Column:
    text = F.concat(F.coalesce("region_name", F.lit("")), F.lit(" "), F.coalesce("country", F.lit("")))
    return F.lower(text)


def _grams(text: Column) -> Column:
    """The distinct runs of three characters of a text; none of a shorter one."""
    n = F.length(text) - (GRAM - 1)
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))


def search_index(feed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, texts, postings) of a feed, stored for `indexed_search`. Rows share few texts, so
    texts get numbers and rows hold theirs, sorted by it; a posting is a trigram and a number,
    sorted by trigram. The order lets a scan skip the row groups of other numbers and trigrams."""
    named = feed.withColumn("_text", _search_text())
    texts = settle(
        named.groupBy("_text").agg(F.count(F.lit(1)).alias("rows")).withColumn("number", F.xxhash64("_text")),
        "search_texts",
    )
    rows = named.withColumn("number", F.xxhash64("_text")).drop("_text")
    stored = settle(rows.repartitionByRange("number").sortWithinPartitions("number"), "search_rows")
    grams = texts.select("number", F.explode(_grams(F.col("_text"))).alias("gram"))
    postings = grams.repartitionByRange("gram").sortWithinPartitions("gram", "number")
    return stored, texts, settle(postings, "search_postings")


def indexed_search(index: tuple[DataFrame, DataFrame, DataFrame], term: str) -> DataFrame:
    """The rows of `feed_search` from an index: texts that hold all trigrams of the term, then
    those that contain it, then their rows. A term of fewer characters is looked for in the texts
    themselves. The term is a literal, so its trigrams are filters of the scan."""
    rows, texts, postings = index
    wanted = term.lower()
    grams = sorted({wanted[i : i + GRAM] for i in range(len(wanted) - GRAM + 1)})
    if grams:
        listed = postings.filter(F.col("gram").isin(grams)).groupBy("number").agg(F.count(F.lit(1)).alias("n"))
        texts = texts.join(listed.filter(F.col("n") == len(grams)).select("number"), "number", "left_semi")
    met = texts.filter(F.contains("_text", F.lit(wanted))).select("number")
    return rows.join(met, "number", "left_semi").drop("number")


def live_events(feed: DataFrame, n: int = RING_SIZE) -> DataFrame:
    """The newest ``n`` feed rows, newest first."""
    return feed.orderBy(F.desc("ts"), F.desc("event_id")).limit(n)


def feed_counters(feed: DataFrame, regions: DataFrame) -> DataFrame:
    """Dashboard counters: warning events, regions in outage, events in total."""
    counts = feed.agg(
        F.count_if(F.lower("severity") == "warning").alias("warning_events"),
        F.count(F.lit(1)).alias("total_events"),
    )
    in_outage = regions.agg(F.count_if("is_outage")).scalar()
    return counts.withColumn("outage_regions", in_outage)


def event_region_context(feed: DataFrame, regions: DataFrame) -> DataFrame:
    """Each feed row with the region it belongs to: by id, else by name; unmatched rows
    keep what the event itself says.

    The first region in serving order wins when a name occurs twice. The region table is
    settled first, so its size decides between broadcast and shuffle join; a shuffle join
    on a hot region is split by AQE because only the feed side is large.
    """
    picked = [
        "region_id", "region_name", "provider", "is_outage", "status",
        "current_health_score", "current_latency_ms", "current_packet_loss", "impact_score",
    ]
    known = settle(regions.select(*picked), "regions")
    by_id = known.select(F.struct(*picked).alias("by_id"))
    by_name = (
        known.filter(F.col("region_name").isNotNull())
        .groupBy("region_name")
        .agg(F.min_by(F.struct(*picked), F.struct(-F.col("impact_score"), "region_id")).alias("r"))
        .select(F.col("r").alias("by_name"))
    )
    joined = feed.join(by_id, F.col("region_id") == F.col("by_id.region_id"), "left").join(
        by_name, F.col("region_name") == F.col("by_name.region_name"), "left"
    )
    match = F.coalesce("by_id", "by_name")
    critical = F.coalesce(F.lower("severity") == "critical", F.lit(False))
    return joined.withColumn("m", match).select(
        "event_id",
        "ts",
        "severity",
        F.col("m.region_id").alias("matched_region_id"),
        F.coalesce("m.region_name", "region_name").alias("region_name"),
        F.col("m.provider").alias("provider"),
        F.coalesce("m.is_outage", critical).alias("is_outage"),
        F.coalesce("m.current_health_score", "health").alias("current_health_score"),
        F.coalesce("m.current_latency_ms", "latency_ms").alias("current_latency_ms"),
        F.coalesce("m.current_packet_loss", "packet_loss").alias("current_packet_loss"),
    )
