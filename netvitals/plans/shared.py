"""Shared-folder handling and small derived tables that are used more than once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without the setting (tests) gets a folder of its own;
    on a cluster the missing setting is an error rather than a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_fallback:
        _local_fallback[app] = tempfile.mkdtemp(prefix="netvitals-")
    return _local_fallback[app]


def fresh_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def settle(frame: DataFrame, purpose: str = "settled") -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    The result is computed once, survives executor loss, and has a size Spark knows:
    a join with it becomes a broadcast join only when the written files are below
    ``spark.sql.autoBroadcastJoinThreshold``, and a shuffle join otherwise. Meant for
    aggregated frames that a second pass over the raw rows needs.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, purpose)
    frame.write.parquet(path)
    stored = spark.read.schema(frame.schema).parquet(path)
    stored.settled_path = path
    return stored


def discard(*frames: DataFrame) -> None:
    """Removes the files of settled tables that nothing will read again. Jobs call it when
    their outputs are written; a query's tables live as long as its lazy result may be read,
    so give the folder an expiry rule for those."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.settled_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def together(spark: SparkSession, *actions: Callable[[], None]) -> None:
    """Runs independent Spark actions at the same time; the first failure is raised."""
    with ThreadPoolExecutor(len(actions)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
        for action in running:
            action.result()
