"""Stored result views.

Batch views are overwritten folders. Views that are rewritten while others read them are kept
as immutable versions: version n is the folder ``batch=n``, complete once Spark has put its
success mark there. Readers take the greatest complete one, a batch that is run again reads
the one before its own id, and the last few are kept for readers that began earlier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from netvitals.sources.views import empty, read_view

VERSIONS_KEPT = 4


def write_view(frame: DataFrame, path: str, fmt: str = "parquet") -> None:
    frame.write.mode("overwrite").format(fmt).save(path)


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Ids of the complete versions, in order."""
    folder, files = _folder(spark, path)
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "batch=*/_SUCCESS")
    found = files.globStatus(mark) or []
    return sorted(int(s.getPath().getParent().getName().removeprefix("batch=")) for s in found)


def write_version(frame: DataFrame, path: str, batch_id: int, keep: int = VERSIONS_KEPT) -> None:
    """Stores ``frame`` as version ``batch_id`` and removes versions older than the last
    ``keep`` before it."""
    spark = frame.sparkSession
    frame.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    old = [v for v in versions(spark, path) if v < batch_id][: -keep or None]
    folder, files = _folder(spark, path)
    for v in old:
        files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"batch={v}"), True)


def read_version(spark: SparkSession, path: str, ddl: str, before: int | None = None) -> DataFrame:
    """The newest complete version, or the newest one before batch ``before``; no rows without."""
    known = [v for v in versions(spark, path) if before is None or v < before]
    return read_view(spark, f"{path}/batch={known[-1]}", ddl) if known else empty(spark, ddl)


def publish(frame: DataFrame, path: str) -> None:
    """Stores ``frame`` as the version after the newest one."""
    known = versions(frame.sparkSession, path)
    write_version(frame, path, known[-1] + 1 if known else 0)
