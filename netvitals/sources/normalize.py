"""Connector records to probe rows: edit feed, atlas pings, delivery envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvitals.functions import rules
from netvitals.schema import EDIT_EVENT_DDL, REGION_COLUMNS


def language_of(domain: Column) -> Column:
    return F.substring_index(domain, ".", 1)


def domain_region(events: DataFrame, languages: DataFrame, regions: DataFrame) -> DataFrame:
    """Adds the region row of ``domain``'s language edition; unmapped domains drop out.

    Both dimensions are stored tables, so Spark broadcasts them by their known size.
    """
    return (
        events.withColumn("language", language_of(F.col("domain")))
        .join(languages, "language")
        .join(regions.select(*REGION_COLUMNS), "region_id")
    )


def edit_activity(
    lines: DataFrame, languages: DataFrame, regions: DataFrame, received_at: Column | None = None
) -> DataFrame:
    """Edit-feed JSON (column ``data``) to activity rows.

    An edit proves that its region is connected. It carries no latency or loss, so none is
    made up: those columns stay absent. ``received_at`` fills a missing time.
    """
    now = F.current_timestamp() if received_at is None else received_at
    parsed = lines.withColumn("e", F.from_json("data", EDIT_EVENT_DDL)).withColumn(
        "domain", F.coalesce("e.meta.domain", F.lit(""))
    )
    said = F.try_to_timestamp(F.nullif(F.col("e.meta.dt"), F.lit("")))
    return domain_region(parsed, languages, regions).select(
        "event_id",
        F.coalesce(said, now).alias("ts"),
        # 0 is treated like a missing time
        F.coalesce(F.nullif(F.col("e.timestamp"), F.lit(0)), F.unix_seconds(now)).alias("unix_ts"),
        F.concat(F.lit("wiki-"), F.col("domain")).alias("probe_id"),
        *REGION_COLUMNS,
        F.lit("wikimedia.org").alias("target_ip"),
        F.concat(F.lit("Wikipedia ("), F.col("domain"), F.lit(")")).alias("target_name"),
        F.lit(True).alias("is_reachable"),
        F.lit(False).alias("outage_detected"),
        F.lit("healthy").alias("state"),
        F.lit("wikimedia-edit-proxy").alias("measurement_type"),
        F.col("domain").alias("wiki_domain"),
        F.coalesce("e.type", F.lit("")).alias("wiki_type"),
        F.coalesce("e.bot", F.lit(False)).alias("is_bot"),
    )


def atlas_probes(results: DataFrame) -> DataFrame:
    """Atlas ping results to probe rows. A null or zero round-trip time means no reply."""
    rtt = F.coalesce(
        F.nullif(F.col("avg"), F.lit(0.0)), rules.lit_double(rules.NO_REPLY_RTT_MS)
    )
    loss = F.coalesce("loss", F.lit(0.0))
    reachable = rtt < rules.NO_REPLY_RTT_MS
    extra = [c for c in ("event_id", "ts", "unix_ts", "timestamp") if c in results.columns]
    return results.select(
        *extra,
        F.concat(F.lit("ripe-"), F.coalesce("prb_id", F.lit(0)).cast("string")).alias("probe_id"),
        F.lit("ripe-atlas").alias("region_id"),
        F.lit("RIPE Atlas").alias("region_name"),
        F.lit("XX").alias("country_code"),
        F.lit("Unknown").alias("country_name"),
        rtt.alias("avg_rtt_ms"),
        loss.alias("packet_loss_pct"),
        reachable.alias("is_reachable"),
        ((rtt > rules.SLOW_REPLY_RTT_MS) | (loss > rules.OUTAGE_LOSS_PCT)).alias(
            "outage_detected"
        ),
        rules.health_score(rtt, loss, reachable).alias("health_score"),
        F.lit("ping").alias("measurement_type"),
        F.lit("ripe-atlas").alias("source"),
    )


def decode_envelopes(envelopes: DataFrame, payload_ddl: str) -> tuple[DataFrame, DataFrame]:
    """(decoded payload rows, envelopes that could not be decoded).

    A payload is either base64 JSON in ``kinesis.data`` or JSON text in ``body`` of a queue
    message. Unknown envelopes and broken payloads go to the second frame.
    """
    queue = F.col("eventSource") == "aws:sqs"
    # decoding garbage bytes must give a reject, not stop the job
    binary = F.try_to_binary(F.col("kinesis.data"), F.lit("base64"))
    text = F.when(F.col("kinesis").isNotNull(), F.try_validate_utf8(binary.cast("string"))).when(
        queue, F.col("body")
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    parsed = F.from_json(text, f"{payload_ddl}, _broken STRING", options)
    opened = envelopes.withColumn("_p", parsed)
    good = F.col("_p").isNotNull() & F.col("_p._broken").isNull() & text.isNotNull()
    decoded = opened.filter(good).select("_p.*").drop("_broken")
    return decoded, opened.filter(~good).select(*envelopes.columns)
