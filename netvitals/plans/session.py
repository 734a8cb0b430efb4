"""Session settings for standalone runs; jobs never depend on who built the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "netvitals", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    tune(spark)
    return spark


def tune(spark: SparkSession) -> None:
    """Runtime settings the jobs rely on. Partition counts are left to the deployment:
    AQE coalesces small shuffles and splits skewed ones."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Quantile sketches use object hash aggregation. Its default limit of 128 groups per
    # task is below a few hundred regions, and beyond it Spark sorts the whole input.
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
