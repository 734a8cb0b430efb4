import pytest
from pyspark.sql import functions as F

from netvitals.functions import rules


def evaluate(spark, column, ddl, *rows):
    frame = spark.createDataFrame(list(rows), ddl)
    return [r[0] for r in frame.select(column).collect()]


def test_health_score(spark):
    got = evaluate(
        spark,
        rules.health_score(F.col("rtt"), F.col("loss"), F.col("up")),
        "rtt double, loss double, up boolean",
        (30.0, 0.0, True),  # free latency
        (10.0, 0.0, True),  # below it costs nothing
        (42.0, 10.0, True),  # one point latency, eight loss
        (1e6, 100.0, True),  # both penalties at their cap
        (10.0, 0.0, False),
        (None, 0.0, True),
        (None, None, False),
    )
    assert got == [100.0, 100.0, 91.0, 20.0, 0.0, None, 0.0]


def test_bands_at_their_edges(spark):
    got = evaluate(
        spark, rules.status_band(F.col("s")), "s double",
        (80.0,), (79.99,), (60.0,), (59.99,), (40.0,), (39.99,), (0.0,),
    )
    assert got == ["healthy", "degraded", "degraded", "warning", "warning", "critical", "critical"]


def test_outage_flag(spark):
    got = evaluate(
        spark, rules.outage_flag(F.col("s"), F.col("l")), "s string, l double",
        ("healthy", 30.0), ("healthy", 30.1), ("warning", 0.0), ("critical", None),
        (None, 31.0), (None, None), ("degraded", 1.0),
    )
    assert got == [False, True, True, True, True, False, False]


def test_outage_share_is_strict(spark):
    got = evaluate(
        spark, rules.outage_share_exceeded(F.col("o"), F.col("n")), "o bigint, n bigint",
        (3, 10), (4, 10), (0, 5),
    )
    assert got == [False, True, False]


def test_merged_impact_hand_check(spark):
    (got,) = evaluate(
        spark, rules.merged_impact(F.col("h"), F.col("l"), F.col("o")),
        "h double, l double, o boolean", (44.3, 38.06, True),
    )
    assert got == pytest.approx(91.48)
