"""Newest record per key: the state table, the window metadata and the expiring store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvitals.plans.shared import settle


def newest_rows(rows: DataFrame, key: str, newest: DataFrame) -> DataFrame:
    """The rows of ``rows`` whose ``ts`` is their key's newest (``newest``: key, last_ts).

    The lower bound reaches the Parquet scan, so old row groups are skipped whenever all
    keys are still reporting. The join is on (key, ts): if ``newest`` is too big to be
    broadcast, the rows spread by time and not by key.
    """
    bound = newest.agg(F.min("last_ts")).scalar()
    marks = newest.select(F.col(key).alias("_key"), "last_ts")
    return (
        rows.filter(F.col("ts") >= bound)
        .join(marks, F.col(key).eqNullSafe(F.col("_key")) & (F.col("ts") == F.col("last_ts")))
        .drop("_key", "last_ts")
    )


def pick_one(candidates: DataFrame, key: str) -> DataFrame:
    """Among rows with one timestamp per key the greatest event_id wins. The id is wrapped
    because ``max_by`` skips rows whose order value is null."""
    payload = F.struct(*[c for c in candidates.columns if c != key])
    chosen = candidates.groupBy(key).agg(F.max_by(payload, F.struct("event_id")).alias("r"))
    return chosen.select(key, "r.*")


def latest_per_key(rows: DataFrame, key: str = "region_id", settled: bool = True) -> DataFrame:
    """One whole record per key: greatest (ts, event_id).

    Pass one reads two columns and hash-aggregates the newest ``ts`` per key; pass two
    fetches just those rows. ``max_by`` over whole records would sort the full history.
    ``settled=False`` keeps the plan free of intermediate tables, for micro-batches.
    """
    newest = rows.groupBy(key).agg(F.max("ts").alias("last_ts"))
    if settled:
        newest = settle(newest, "newest")
    return pick_one(newest_rows(rows, key, newest), key)


STATE_DEFAULTS = {
    "country_code": "XX",
    "country_name": "Unknown",
    "continent": "",
    "provider": "",
    "avg_rtt_ms": 0.0,
    "packet_loss_pct": 0.0,
    "health_score": 100.0,
    "is_reachable": True,
    "outage_detected": False,
    "state": "healthy",
    "lat": 0.0,
    "lon": 0.0,
    "flag": "",
}
STATE_COLUMNS = [
    "region_id", "event_id", "ts", "unix_ts", "country_code", "country_name", "region_name",
    "continent", "provider", "avg_rtt_ms", "packet_loss_pct", "health_score", "is_reachable",
    "outage_detected", "state", "lat", "lon", "flag",
]


def state_rows(probes: DataFrame) -> DataFrame:
    """Probe rows in state-table shape, absent fields filled."""
    region = F.coalesce("region_id", F.lit("unknown"))
    filled = {name: F.coalesce(name, F.lit(value)) for name, value in STATE_DEFAULTS.items()}
    filled["region_name"] = F.coalesce("region_name", region)
    filled["region_id"] = region
    filled["event_id"] = F.col("event_id").cast("string")
    return probes.withColumns(filled).select(*STATE_COLUMNS)


def upsert_state(
    stored: DataFrame | None,
    batch: DataFrame,
    now,
    window_s: int = 300,
    processed_at=None,
    settled: bool = True,
) -> DataFrame:
    """Stored state with a batch applied: newest record per region, expired entries gone.

    An entry lives twice the window. Its clock starts at ``processed_at`` when given, and
    at the record's own time otherwise, which keeps replays repeatable. Applying a batch
    twice changes nothing.
    """
    start = F.col("unix_ts") if processed_at is None else F.lit(processed_at)
    fresh = latest_per_key(state_rows(batch), settled=settled).withColumn(
        "expires_at", (start + F.lit(2 * window_s)).cast("bigint")
    )
    entries = fresh if stored is None else stored.unionByName(fresh)
    payload = F.struct(*[c for c in fresh.columns if c != "region_id"])
    # both inputs hold one row per region
    merged = entries.groupBy("region_id").agg(
        F.max_by(payload, F.struct("ts", "event_id", "expires_at")).alias("r")
    )
    return merged.select("region_id", "r.*").filter(F.col("expires_at") > now)
