"""Reading result views, with an empty frame of the right shape when one is missing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def read_view(spark: SparkSession, path: str, ddl: str, fmt: str = "parquet") -> DataFrame:
    """A stored view, or no rows when it was never written."""
    try:
        return spark.read.schema(ddl).format(fmt).load(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return empty(spark, ddl)
        raise


def stored_format(spark: SparkSession, path: str) -> str:
    """"json" where the folder holds JSON files, else "parquet"."""
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return "json" if files.globStatus(jvm.org.apache.hadoop.fs.Path(path, "*.json*")) else "parquet"


def first_non_empty(*candidates: DataFrame) -> DataFrame:
    """The first frame with a row, else the last. ``isEmpty`` reads at most one row."""
    for frame in candidates[:-1]:
        if not frame.isEmpty():
            return frame
    return candidates[-1]
