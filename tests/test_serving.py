"""Merging, incidents, alerts and event context on hand-built rows."""

import pytest

from netvitals import schema
from netvitals.operators import alerts, feed, history, serving, speed
from netvitals.sources.views import empty

T0 = 1_700_000_000


def dicts(frame, *order):
    rows = [r.asDict(recursive=True) for r in frame.collect()]
    return sorted(rows, key=lambda r: tuple(r[c] for c in order)) if order else rows


@pytest.fixture(scope="module")
def sides(probes):
    p = probes(
        {"region_id": "both", "health_score": 40.0, "avg_rtt_ms": 10.0, "provider": "P",
         "outage_detected": True, "state": "critical"},
        {"region_id": "fresh", "health_score": 90.0, "avg_rtt_ms": 20.0},
        {"region_id": "quiet", "health_score": 70.0, "avg_rtt_ms": 30.0, "unix_ts": T0 - 9999,
         "region_name": "Quiet", "outage_detected": True},
        {"region_id": "both", "health_score": 80.0, "avg_rtt_ms": 30.0, "unix_ts": T0 - 9999,
         "provider": "P"},
        unix_ts=T0, packet_loss_pct=2.0,
    )
    window = speed.trailing_window(p, T0)
    batch = history.latency_by_region(p.filter("region_id != 'fresh'"))
    return p, window, batch


def test_merge_covers_all_three_cases(sides):
    _, window, batch = sides
    rows = {r["region_id"]: r for r in dicts(serving.merge_regions(window, batch))}
    assert set(rows) == {"both", "fresh", "quiet"}
    both, fresh, quiet = rows["both"], rows["fresh"], rows["quiet"]
    assert (both["current_health_score"], both["hist_health_score"]) == (40.0, 60.0)
    assert both["impact_score"] == pytest.approx(0.6 * 60 + 2 + 20)
    assert (both["status"], both["state"]) == ("warning", "critical")
    assert fresh["hist_health_score"] == 90.0 and fresh["region_name"] == "fresh"
    assert fresh["data_sources"] == {"speed_layer": True, "batch_layer": False}
    # only history: no outage flag, state as if healthy, history as current figures
    assert (quiet["is_outage"], quiet["state"]) == (False, "healthy")
    assert quiet["current_latency_ms"] == quiet["hist_latency_ms"] == 30.0
    assert quiet["data_sources"] == {"speed_layer": False, "batch_layer": True}
    assert quiet["country_code"] == "XX" and quiet["lat"] == 0.0
    assert [(r["hist_probe_count"], r["hist_p95_latency_ms"]) for r in (both, fresh, quiet)] == [
        (2, 30.0), (0, None), (1, 30.0),
    ]


def test_merge_keys_are_the_union_of_both_sides(spark, sides):
    _, window, batch = sides
    no_window, no_batch = empty(spark, schema.WINDOW_DDL), empty(spark, schema.LATENCY_DDL)
    assert {r["region_id"] for r in dicts(serving.merge_regions(no_window, batch))} == {
        "both", "quiet",
    }
    assert serving.merge_regions(window, no_batch).count() == 2
    assert serving.merge_regions(no_window, no_batch).count() == 0


def test_merge_takes_last_listed_row_of_a_region(spark, probes, sides):
    p = probes(
        {"region_id": "r", "provider": "slow", "avg_rtt_ms": 9.0},
        {"region_id": "r", "provider": "fast", "avg_rtt_ms": 1.0}, health_score=50.0,
    )
    no_window = empty(spark, schema.WINDOW_DDL)
    (row,) = dicts(serving.merge_regions(no_window, history.latency_by_region(p)))
    assert row["provider"] == "fast"


def test_merge_global_falls_back_and_vanishes_when_empty(spark, sides):
    p, window, batch = sides
    regions = serving.merge_regions(window, batch)
    no_batch = empty(spark, schema.BATCH_GLOBAL_DDL)
    no_speed = empty(spark, schema.SPEED_GLOBAL_DDL)
    (row,) = dicts(serving.merge_global(regions, no_batch, no_speed))
    mean = (40.0 + 90.0 + 70.0) / 3
    assert row["global_health_score"] == pytest.approx(mean)
    assert row["batch_health"] == row["speed_health"] == pytest.approx(mean)
    assert (row["total_records_batch"], row["active_outages"]) == (0, 1)
    (row,) = dicts(
        serving.merge_global(regions, history.global_summary(p), speed.speed_global(window))
    )
    assert (row["total_records_batch"], row["total_outage_events"]) == (4, 2)
    assert row["speed_health"] == pytest.approx(65.0) and row["batch_health"] == 70.0
    assert serving.merge_global(regions.limit(0), no_batch, no_speed).count() == 0


def region_rows(spark, *scores):
    rows = [
        (f"r{i}", f"Region {i}", s, 10.0 + i, 1.234, s < 50, 100.0 - s) for i, s in enumerate(scores)
    ]
    return spark.createDataFrame(
        rows,
        "region_id string, region_name string, current_health_score double, "
        "current_latency_ms double, current_packet_loss double, is_outage boolean, "
        "impact_score double",
    )


def test_incidents_look_at_eight_regions_only(spark):
    regions = region_rows(spark, 95.0, *[60.0 + i for i in range(9)], 91.0)
    rows = dicts(alerts.incidents(regions), "id")
    assert [r["id"] for r in rows] == [f"inc-{i}" for i in range(1, 9)]
    few = region_rows(spark, 90.0, 89.9, 70.0, 69.9)
    got = {r["region_id"]: (r["id"], r["severity"]) for r in dicts(alerts.incidents(few))}
    assert got == {
        "r3": ("inc-1", "critical"), "r2": ("inc-2", "warning"), "r1": ("inc-3", "warning"),
    }


def test_alerts_and_all_clear(spark):
    rows = dicts(alerts.alerts(region_rows(spark, 59.9, 60.0, 79.9, 80.0, 99.0)), "id")
    assert [(r["id"], r["severity"]) for r in rows] == [
        ("alert-1", "critical"), ("alert-2", "warning"), ("alert-3", "warning"),
    ]
    assert rows[0]["message"] == "Latency 10.0ms and loss 1.23%"
    for regions in (region_rows(spark, 80.0, 99.0), region_rows(spark, 1.0).limit(0)):
        (row,) = dicts(alerts.alerts(regions, T0))
        assert (row["id"], row["severity"]) == ("alert-0", "information")


def test_zero_health_is_not_healthy(spark):
    (row,) = dicts(alerts.observability_summary(region_rows(spark, 0.0, 80.0, 100.0)))
    assert (row["healthy_regions"], row["failed_regions"], row["active_incidents"]) == (2, 1, 1)
    assert (row["overall"], row["availability"], row["requests_per_sec"]) == (60.0, 60, 480)
    assert (row["latency_tone"], row["loss_tone"]) == ("healthy", "warning")


def test_summary_of_nothing(spark):
    (row,) = dicts(alerts.observability_summary(region_rows(spark, 1.0).limit(0)))
    assert (row["overall"], row["availability"], row["requests_per_sec"]) == (100.0, 100, 0)
    assert row["active_incidents"] == 0 and row["latency_tone"] == "healthy"


def test_alert_dedupe_keeps_first_and_drops_null_ids(spark, probes):
    p = probes(
        {"unix_ts": T0, "event_id": "1", "region_name": "A", "state": "Warning"},
        {"unix_ts": T0, "event_id": "2", "region_name": "B"},  # same millisecond, same id
        {"unix_ts": T0 + 1, "event_id": "3", "state": "information"},
    )
    live = alerts.live_alerts(feed.feed_event(p))
    derived = alerts.alerts(region_rows(spark, 10.0, 20.0))
    clash = derived.selectExpr("id", "'late' AS title", "severity", "message")
    no_id = derived.selectExpr("cast(null as string) AS id", "title", "severity", "message")
    got = dicts(alerts.alert_dedupe(live, derived.unionByName(no_id)), "id")
    assert [r["id"] for r in got] == ["alert-1", "alert-2", f"live-{T0}000"]
    assert got[2]["title"] == "A traffic event" and got[2]["severity"] == "warning"
    assert alerts.alert_dedupe(live, derived.unionByName(clash)).count() == 3


def test_event_context_by_id_then_name(spark, probes):
    known = region_rows(spark, 50.0, 60.0).selectExpr(
        "*", "'isp' AS provider", "'warning' AS status"
    )
    p = probes(
        {"event_id": "id", "region_id": "r0", "region_name": "Region 1"},
        {"event_id": "name", "region_id": "zz", "region_name": "Region 1"},
        {"event_id": "none", "region_id": "zz", "region_name": "?", "state": "critical"},
        unix_ts=T0, health_score=5.0,
    )
    got = {r["event_id"]: r for r in dicts(feed.event_region_context(feed.feed_event(p), known))}
    assert got["id"]["matched_region_id"] == "r0"
    assert got["name"]["matched_region_id"] == "r1"
    assert got["none"]["matched_region_id"] is None
    assert got["none"]["is_outage"] is True and got["none"]["current_health_score"] == 5.0


def test_counters(spark, probes):
    p = probes({"state": "warning"}, {"state": "WARNING"}, {"state": "healthy"}, unix_ts=T0)
    (row,) = dicts(feed.feed_counters(feed.feed_event(p), region_rows(spark, 1.0)))
    assert (row["warning_events"], row["total_events"], row["outage_regions"]) == (2, 3, 1)
