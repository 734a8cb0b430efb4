"""Exact order statistics per group without putting a group into one task."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from netvitals.plans.shared import settle


def same(keys: list[str], suffix: str) -> Column:
    """Equality of ``keys`` with their suffixed copies; a null key is a group of its own."""
    return reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}{suffix}")) for k in keys]
    )


def values_at(
    rows: DataFrame,
    keys: list[str],
    value: str,
    positions: Callable[[Column], dict[str, Column]],
    blocks: list[Column],
    merges: list[Column],
    bin_width: float = 1.0,
) -> DataFrame:
    """Per group: merged ``blocks``, and the value at each 0-based position of the sorted
    non-null values. ``positions`` maps the number of values to named positions.

    1. one pass aggregates rows per (keys, bin of the value); the blocks are merged from
       these bins, and prefix sums over a group's bins tell which bin holds each position;
    2. a second pass reads the values of just those bins, merges equal ones map-side and
       ranks each bin on its own.

    Both passes are hash aggregations that shuffle counts, not rows, spread by (keys, bin).
    ``bin_width`` is a tuning value and does not change the result. ``keys[0]`` should be
    the selective one; the second pass filters by it and the bin.
    """
    bin_of = F.floor(F.col(value) / F.lit(float(bin_width)))
    binned = settle(
        rows.groupBy(*keys, bin_of.alias("bin")).agg(*blocks, F.count(value).alias("bin_n")),
        "bins",
    )
    group = W.partitionBy(*keys)
    through = group.orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    ordered = binned.filter(F.col("bin").isNotNull()).select(
        *keys,
        "bin",
        "bin_n",
        (F.sum("bin_n").over(through) - F.col("bin_n")).alias("before"),
        F.sum("bin_n").over(group).alias("valued"),
    )
    named = positions(F.col("valued"))
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), position.cast("bigint").alias("at"))
            for name, position in named.items()
        ]
    )
    targets = settle(
        ordered.select("*", F.explode(wanted).alias("w"))
        .filter("w.at >= before AND w.at < before + bin_n")
        .select(
            *[F.col(k).alias(f"{k}_t") for k in keys],
            F.col("bin").alias("bin_t"),
            "w.name",
            (F.col("w.at") - F.col("before")).alias("offset"),
        ),
        "rank_targets",
    )
    near = [keys[0], "bin"]
    opened_bins = targets.select(*[f"{c}_t" for c in near]).distinct()
    in_bin = W.partitionBy(*keys, "bin").orderBy("v").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    opened = (
        rows.filter(F.col(value).isNotNull())
        .select(*keys, bin_of.alias("bin"), F.col(value).alias("v"))
        .join(opened_bins, same(near, "_t"), "left_semi")
        .groupBy(*keys, "bin", "v")
        .agg(F.count(F.lit(1)).alias("c"))
        .select(*keys, "bin", "v", "c", F.sum("c").over(in_bin).alias("upto"))
    )
    hit = (F.col("offset") < F.col("upto")) & (F.col("offset") >= F.col("upto") - F.col("c"))
    picked = (
        opened.join(targets, same([*keys, "bin"], "_t") & hit)
        .groupBy(*[F.col(k).alias(f"{k}_p") for k in keys])
        .agg(*[F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in named])
    )
    merged = binned.groupBy(*keys).agg(*merges, F.sum("bin_n").alias("valued"))
    return merged.join(picked, same(keys, "_p"), "left").drop(*[f"{k}_p" for k in keys])


def rank_percentiles(
    rows: DataFrame,
    key: str,
    value: str,
    percents: tuple[int, ...] = (50, 95, 99),
    bin_width: float = 1.0,
) -> DataFrame:
    """Nearest-rank percentiles (0-based position ``int(p * n)``), median and mean per key."""

    def positions(n: Column) -> dict[str, Column]:
        ranks = {f"p{p}": F.least(F.floor(F.lit(p / 100.0) * n), n - 1) for p in percents}
        # the median is the mean of the two middle positions, which coincide for odd n
        middle = {"lower": F.floor((n - 1) / 2), "upper": F.floor(n / 2)}
        return {**ranks, **middle}

    found = values_at(
        rows.filter(F.col(value).isNotNull()),
        [key],
        value,
        positions,
        [F.sum(value).alias("value_sum")],
        [F.sum("value_sum").alias("value_sum")],
        bin_width,
    )
    return found.select(
        key,
        F.col("valued").alias("n"),
        *[f"p{p}" for p in percents],
        ((F.col("lower") + F.col("upper")) / 2).alias("median"),
        (F.col("value_sum") / F.col("valued")).alias("mean"),
    )
