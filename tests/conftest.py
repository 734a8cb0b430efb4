import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from netvitals.plans.session import tune

    session = (
        SparkSession.builder.master("local[4]")
        .appName("netvitals-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    tune(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def probes(spark):
    """Builds probe rows from dicts; anything not given is absent."""
    from netvitals.schema import PROBE_COLUMNS, PROBE_DDL
    from netvitals.sources.ndjson import with_time

    def build(*rows, **common):
        filled = [{**common, **r} for r in rows]
        values = [tuple(r.get(c) for c in PROBE_COLUMNS) for r in filled]
        return with_time(spark.createDataFrame(values, PROBE_DDL))

    return build
