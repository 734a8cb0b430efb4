"""Decimal places of the published views. Operators return full precision; writers round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Digits per column and view.
_SPEED = {
    "avg_health_score": 1, "current_health_score": 1, "hist_health_score": 1,
    "avg_latency_ms": 2, "current_latency_ms": 2, "hist_latency_ms": 2,
    "avg_packet_loss": 2, "current_packet_loss": 2,
    "min_latency_ms": 2, "max_latency_ms": 2, "impact_score": 2,
}
_REGIONS = {
    "current_health_score": 1, "current_latency_ms": 1, "current_packet_loss": 2,
    "hist_health_score": 1, "hist_latency_ms": 1, "hist_p95_latency_ms": 1, "hist_packet_loss": 2, "impact_score": 2,
}
_GLOBAL = {
    "global_health_score": 1, "global_avg_latency": 1, "global_avg_loss": 2,
    "batch_health": 1, "speed_health": 1,
}
DIGITS = {
    "window_aggregates": _SPEED,
    "batch_aggregates": _SPEED,
    "merged_regions": _REGIONS,
    "speed_global": _GLOBAL,
    "merged_global": _GLOBAL,
    "global_summary": _GLOBAL,
    "history": {"health_score": 1, "latency_ms": 1, "loss_pct": 2},
    "country_rollup": {"avg_latency_ms": 2, "avg_packet_loss_pct": 2, "avg_health_score": 1},
}


def shown(frame: DataFrame, view: str) -> DataFrame:
    digits = {c: d for c, d in DIGITS.get(view, {}).items() if c in frame.columns}
    return frame.withColumns({c: F.round(c, d) for c, d in digits.items()})
