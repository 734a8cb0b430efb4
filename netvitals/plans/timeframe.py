"""Reference times and time filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR_FORMAT = "yyyyMMdd_HH"  # fixed value: name of an hourly raw bucket


def hour_of(moment: Column) -> Column:
    """Partition value of a timestamp; text that sorts in time order."""
    return F.date_format(moment, HOUR_FORMAT)


def as_column(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(int(as_of)).cast("bigint")


def between(rows: DataFrame, as_of, seconds: int) -> DataFrame:
    """Rows of the closed range [as_of - seconds, as_of].

    History tables are partitioned by ``hour``; when that column is present the range is
    also put on it, so only the matching folders are listed and read.
    """
    end = as_column(as_of)
    kept = rows.filter((F.col("unix_ts") >= end - seconds) & (F.col("unix_ts") <= end))
    return hour_pruned(kept, end - seconds, end)


def hour_pruned(rows: DataFrame, start: Column, end: Column | None) -> DataFrame:
    if "hour" not in rows.columns:
        return rows
    rows = rows.filter(F.col("hour") >= hour_of(F.timestamp_seconds(start)))
    if end is not None:
        rows = rows.filter(F.col("hour") <= hour_of(F.timestamp_seconds(end)))
    return rows
