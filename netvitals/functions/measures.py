"""Mergeable aggregates: sums and counts first, ratios last.

Every mean in this package is carried as (sum, count) until the last step. Sums,
counts, min and max of numbers stay in hash aggregation with map-side combine, so
a region holding a third of all rows reaches the shuffle as one row per task.
Aggregates with string or struct buffers would make Spark sort the whole input
first; they are only used on frames that are already one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# measure name -> probe column
MEASURES = {"rtt": "avg_rtt_ms", "loss": "packet_loss_pct", "health": "health_score"}


def partial_sums() -> list[Column]:
    """Per-group building blocks over probe rows. SQL null handling: nulls do not count."""
    outage = F.coalesce(F.col("outage_detected"), F.lit(False))
    blocks = [F.count(F.lit(1)).alias("n"), F.count_if(outage).alias("outages")]
    for name, column in MEASURES.items():
        blocks += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
    blocks += [F.min("avg_rtt_ms").alias("rtt_min"), F.max("avg_rtt_ms").alias("rtt_max")]
    return blocks


def merge_sums() -> list[Column]:
    """Combine rows made by :func:`partial_sums` into coarser groups."""
    blocks = [F.sum("n").alias("n"), F.sum("outages").alias("outages")]
    for name in MEASURES:
        blocks += [F.sum(f"{name}_sum").alias(f"{name}_sum"), F.sum(f"{name}_n").alias(f"{name}_n")]
    blocks += [F.min("rtt_min").alias("rtt_min"), F.max("rtt_max").alias("rtt_max")]
    return blocks


def mean(name: str) -> Column:
    """Mean of a measure from its blocks; null when the group had no value."""
    return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n"))


def zero_filled_mean(name: str) -> Column:
    """Mean over all rows of the group, a missing value counting as 0 (speed-layer rule)."""
    return F.coalesce(F.col(f"{name}_sum"), F.lit(0.0)) / F.col("n")
