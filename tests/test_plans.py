"""Physical plans: what is pruned, pushed down and never used."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from netvitals.operators import history, latest, speed
from netvitals.plans.compact import write_history
from netvitals.plans.timeframe import between
from netvitals.sources.ndjson import read_history

T0 = 1_700_000_000
SF = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, probes, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "history")
    rows = [{"unix_ts": T0 - h * 3600, "region_id": "ab"[h % 2]} for h in range(48)]
    write_history(probes(*rows, avg_rtt_ms=1.0, health_score=50.0), path)
    return read_history(spark, path)


def test_recent_rows_prune_hours_and_push_the_time_filter(stored):
    plan = plan_of(between(stored, T0, 300).select("region_id"))
    assert "PartitionFilters: [isnotnull(hour" in plan
    assert "GreaterThanOrEqual(unix_ts" in plan
    kept = between(stored, T0, 3600)
    assert kept.count() == 2 and len(kept.inputFiles()) <= 48


def test_only_used_columns_are_read(stored):
    plan = plan_of(history.region_rollup(stored))
    (schema,) = [part for part in plan.split("ReadSchema: ")[1:]]
    assert "provider" not in schema and "event_id" not in schema


def test_newest_rows_push_their_bound(stored):
    newest = stored.groupBy("region_id").agg(F.max("ts").alias("last_ts"))
    plan = plan_of(latest.newest_rows(stored, "region_id", newest))
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in plan


@pytest.mark.parametrize(
    "view",
    [
        history.outage_frequency, history.hourly_health_trend, history.global_summary,
        history.region_rollup, history.hourly_cube, speed.sliding_windows,
    ],
)
def test_sums_stay_in_hash_aggregation(stored, view):
    plan = plan_of(view(stored))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


# plans that do not start jobs of their own
CHEAP = [
    "health_score", "domain_region", "edit_activity", "envelope_decode", "latency_by_region",
    "country_rollup", "top_affected", "rank_percentiles", "outage_episodes", "rate_drop",
    "merge_global", "event_region_context", "feed_counters", "alerts", "q_global_trend",
]


@pytest.mark.parametrize("name", CHEAP)
def test_no_python_and_no_all_pairs(spark, name):
    plan = plan_of(entry_point.queries()[name](spark, SF))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
