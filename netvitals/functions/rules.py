"""Scoring and classification rules as Column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The thresholds and weights below define the published scores.
HEALTHY_FROM, DEGRADED_FROM, WARNING_FROM = 80.0, 60.0, 40.0
FREE_LATENCY_MS, MS_PER_POINT, MAX_PENALTY, POINTS_PER_LOSS_PCT = 30.0, 12.0, 40.0, 0.8
OUTAGE_LOSS_PCT = 30.0
OUTAGE_STATES = ("warning", "critical")
OUTAGE_SHARE = 0.3
NO_REPLY_RTT_MS, SLOW_REPLY_RTT_MS = 999.0, 500.0
HEALTH_WEIGHT, OUTAGE_COUNT_WEIGHT, OUTAGE_BONUS = 0.6, 0.4, 20.0


def lit_double(value: float) -> Column:
    return F.lit(float(value))


def health_score(rtt: Column, loss: Column, reachable: Column) -> Column:
    """0..100: both latency and loss cost up to 40 points; unreachable is 0."""
    full = lit_double(MAX_PENALTY)
    slow = F.greatest(lit_double(0), (rtt - lit_double(FREE_LATENCY_MS)) / lit_double(MS_PER_POINT))
    lossy = loss * lit_double(POINTS_PER_LOSS_PCT)
    points = lit_double(100) - F.least(full, slow) - F.least(full, lossy)
    return (
        F.when(~reachable, lit_double(0))
        # least/greatest skip nulls, which would turn an unknown into a perfect score
        .when(rtt.isNull() | loss.isNull(), F.lit(None).cast("double"))
        .otherwise(F.greatest(lit_double(0), points))
    )


def outage_flag(state: Column, loss: Column) -> Column:
    """True for the two bad states or heavy loss; a null on one side does not hide the other."""
    return F.coalesce(state.isin(*OUTAGE_STATES), F.lit(False)) | F.coalesce(
        loss > lit_double(OUTAGE_LOSS_PCT), F.lit(False)
    )


def status_band(score: Column) -> Column:
    return (
        F.when(score >= HEALTHY_FROM, "healthy")
        .when(score >= DEGRADED_FROM, "degraded")
        .when(score >= WARNING_FROM, "warning")
        .otherwise("critical")
    )


def outage_share_exceeded(outages: Column, samples: Column) -> Column:
    """Strict: exactly 30 % outage samples is not an outage."""
    return outages > samples * lit_double(OUTAGE_SHARE)


def batch_impact(avg_health: Column, outage_events: Column) -> Column:
    return (lit_double(100) - avg_health) * lit_double(HEALTH_WEIGHT) + outage_events * lit_double(
        OUTAGE_COUNT_WEIGHT
    )


def live_impact(health: Column) -> Column:
    return lit_double(100) - health


def merged_impact(health: Column, loss: Column, is_outage: Column) -> Column:
    bonus = F.when(is_outage, lit_double(OUTAGE_BONUS)).otherwise(lit_double(0))
    return (lit_double(100) - health) * lit_double(HEALTH_WEIGHT) + loss + bonus


def half_up(value: Column, digits: int) -> Column:
    """Round half up with plain arithmetic, so other SQL engines give the same figure."""
    scale = lit_double(10**digits)
    return F.floor(value * scale + lit_double(0.5)) / scale
