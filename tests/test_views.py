"""History views, windows, state and ranks on hand-built rows."""

import random

import pytest
from pyspark.sql import functions as F

from netvitals.operators import episodes, feed, history, latest, ranks, speed, storage
from netvitals.plans import sql_views

T0 = 1_700_000_000


def dicts(frame, *order):
    rows = [r.asDict(recursive=True) for r in frame.collect()]
    return sorted(rows, key=lambda r: tuple(r[c] for c in order)) if order else rows


def test_means_skip_nulls_in_history_and_zero_them_in_windows(probes):
    p = probes(
        {"avg_rtt_ms": 10.0, "health_score": 90.0, "packet_loss_pct": 1.0},
        {"avg_rtt_ms": None, "health_score": None, "packet_loss_pct": None},
        region_id="a", unix_ts=T0,
    )
    (batch,) = dicts(history.latency_by_region(p))
    assert (batch["avg_latency_ms"], batch["min_latency_ms"], batch["probe_count"]) == (10, 10, 2)
    (window,) = dicts(speed.trailing_window(p, T0))
    assert window["avg_latency_ms"] == 5.0
    assert window["min_latency_ms"] == 0.0
    assert window["avg_health_score"] == 45.0
    assert window["avg_packet_loss"] == 0.5


def test_null_keys_stay_a_group(probes):
    p = probes({"region_id": None, "avg_rtt_ms": 1.0}, {"region_id": "a", "avg_rtt_ms": 2.0})
    assert {r["region_id"] for r in dicts(history.latency_by_region(p))} == {None, "a"}


def test_country_rollup_defaults_and_wire_rounding(probes):
    p = probes(
        {"avg_rtt_ms": 1.00049, "region_id": "b"},
        {"avg_rtt_ms": 2.0, "region_id": "a", "outage_detected": True},
        {},
    )
    (row,) = dicts(history.country_rollup(p))
    assert row["country_code"] == "XX" and row["probe_count"] == 3
    assert row["affected_regions"] == ["a", "b", "unknown"]
    assert row["avg_health_score"] == 100.0 and row["total_outage_events"] == 1
    assert row["avg_latency_ms"] == pytest.approx(3.00049 / 3)
    (rounded,) = dicts(history.country_rollup(p, wire_digits=(3, 3, 2)))
    assert rounded["avg_latency_ms"] == pytest.approx(1.0)


def test_top_affected_shares_the_country_count_and_fans_out_on_two_names(probes):
    p = probes(
        {"region_id": "r1", "country_code": "A", "country_name": "One", "outage_detected": True},
        {"region_id": "r2", "country_code": "A", "country_name": "One"},
        {"region_id": "r3", "country_code": "B", "country_name": "Bee"},
        {"region_id": "r4", "country_code": "A", "country_name": "Uno", "outage_detected": True},
        health_score=50.0, avg_rtt_ms=1.0,
    )
    top = dicts(history.top_affected(history.latency_by_region(p), history.outage_frequency(p)))
    assert [r["outage_events"] for r in top] == [1] * 6 + [0]
    assert top[0]["impact_score"] == pytest.approx(30.4)
    assert top[-1]["country_code"] == "B" and top[-1]["affected_regions"] == 0


def test_views_from_cube_equal_views_from_rows(spark, probes):
    rng = random.Random(1)
    rows = [
        {
            "region_id": rng.choice("abc"), "country_code": rng.choice("XY"),
            "unix_ts": T0 + rng.randrange(20_000), "avg_rtt_ms": float(rng.randrange(100)),
            "health_score": rng.choice([None, 10.0, 90.0]), "packet_loss_pct": 1.0,
            "outage_detected": rng.choice([True, False, None]),
        }
        for _ in range(300)
    ]
    p = probes(*rows)
    cube = history.hourly_cube(p)
    for view in (history.outage_frequency, history.hourly_health_trend, history.global_summary):
        a, b = view(p), view(cube)
        assert a.columns == b.columns
        for x, y in zip(sorted(map(repr, dicts(a))), sorted(map(repr, dicts(b)))):
            assert x == y


def test_empty_input(probes, spark):
    none = probes().limit(0)
    (summary,) = dicts(history.global_summary(none))
    assert summary["total_records"] == 0 and summary["global_health_score"] == 0.0
    for frame in (
        history.latency_by_region(none), history.outage_frequency(none),
        speed.trailing_window(none, T0), speed.sliding_windows(none),
        speed.speed_global(speed.sliding_windows(none)), speed.live_global(none),
        latest.latest_per_key(none), episodes.outage_episodes(none), episodes.rate_drop(none),
        ranks.rank_percentiles(none, "region_id", "avg_rtt_ms"),
    ):
        assert frame.count() == 0


def test_trailing_window_bounds_are_closed(probes):
    p = probes(
        {"unix_ts": T0 - 301}, {"unix_ts": T0 - 300}, {"unix_ts": T0}, {"unix_ts": T0 + 1},
        region_id="a",
    )
    (row,) = dicts(speed.trailing_window(p, T0))
    assert row["sample_count"] == 2
    assert (row["window_end"] - row["window_start"]).total_seconds() == 300


def test_trailing_window_outage_share_and_metadata_of_latest(probes):
    rows = [{"unix_ts": T0 - i, "outage_detected": i < 3, "state": "healthy"} for i in range(10)]
    rows[0].update(event_id="1", state="warning", region_name="old")
    rows.append({"unix_ts": T0, "event_id": "2", "region_name": "new", "outage_detected": False})
    p = probes(*rows, region_id="a", health_score=80.0)
    (row,) = dicts(speed.trailing_window(p, T0))
    assert (row["sample_count"], row["outage_count"], row["is_outage"]) == (11, 3, False)
    # two records share the newest time: the greater event id is the latest
    assert row["region_name"] == "new" and row["current_state"] == "unknown"
    assert row["status"] == "healthy" and row["impact_score"] == 20.0
    lazily = dicts(speed.trailing_window(p, T0, settled=False))
    assert lazily == [row]
    more = probes(*[{"outage_detected": i < 4} for i in range(10)], region_id="a", unix_ts=T0)
    assert dicts(speed.trailing_window(more, T0))[0]["is_outage"] is True


def test_microbatch_defaults(probes):
    (row,) = dicts(speed.microbatch_aggregates(probes({"unix_ts": T0, "avg_rtt_ms": 4.0})))
    assert row["region_id"] == "unknown" and row["current_state"] == "healthy"
    assert row["avg_latency_ms"] == 4.0 and row["avg_health_score"] == 0.0


def test_sliding_windows_place_each_row_in_five(probes):
    p = probes({"unix_ts": T0 + 7}, {"unix_ts": T0 + 8}, {"unix_ts": T0 + 61}, region_id="a")
    rows = dicts(speed.sliding_windows(p), "window_start")
    assert sum(r["sample_count"] for r in rows) == 5 * 3
    naive = p.groupBy(F.window("ts", "5 minutes", "1 minute").start.alias("s")).count()
    assert [r["sample_count"] for r in rows] == [r["count"] for r in dicts(naive, "s")]
    with pytest.raises(ValueError):
        speed.sliding_windows(p, 300, 70)


def test_kpi_history_keeps_newest_in_time_order(spark):
    kpis = spark.range(200).select(
        F.timestamp_seconds(F.col("id") * 60).alias("computed_at"),
        F.col("id").cast("double").alias("global_health_score"),
        F.lit(1.0).alias("global_avg_latency"),
        F.lit(0.0).alias("global_avg_loss"),
    )
    assert [r["health_score"] for r in dicts(speed.kpi_history(kpis))] == [
        float(i) for i in range(80, 200)
    ]


def test_latest_keeps_one_whole_row(probes):
    p = probes(
        {"region_id": "a", "unix_ts": T0, "event_id": "1", "state": "warning"},
        {"region_id": "a", "unix_ts": T0, "event_id": "2", "state": "healthy"},
        {"region_id": "a", "unix_ts": T0 - 5, "event_id": "9"},
        {"region_id": "b", "unix_ts": T0 - 900_000, "event_id": "3"},
        {"region_id": None, "unix_ts": T0, "event_id": "4"},
    )
    got = {r["region_id"]: r["event_id"] for r in dicts(latest.latest_per_key(p))}
    assert got == {"a": "2", "b": "3", None: "4"}


def test_upsert_is_idempotent_and_expires(probes):
    first = probes({"region_id": "a", "unix_ts": T0}, {"region_id": "b", "unix_ts": T0 - 500})
    stored = latest.upsert_state(None, first, T0)
    assert {r["region_id"] for r in dicts(stored)} == {"a", "b"}
    batch = probes({"region_id": "a", "unix_ts": T0 + 100, "event_id": "n"})
    once = latest.upsert_state(stored, batch, T0 + 100)
    twice = latest.upsert_state(once, batch, T0 + 100)
    assert dicts(once, "region_id") == dicts(twice, "region_id")
    (row,) = dicts(once)  # b ended at T0 + 100, which is not later than now
    assert (row["region_id"], row["event_id"], row["expires_at"]) == ("a", "n", T0 + 700)
    assert (row["country_code"], row["health_score"], row["is_reachable"]) == ("XX", 100.0, True)
    older = latest.upsert_state(once, first.filter("region_id = 'a'"), T0 + 100)
    assert dicts(older)[0]["event_id"] == "n"
    late = latest.upsert_state(None, first, T0, processed_at=T0 + 1000)
    assert {r["expires_at"] for r in dicts(late)} == {T0 + 1600}


def brute_ranks(values):
    values, n = sorted(values), len(values)
    at = lambda p: values[min(int(p * n), n - 1)]
    median = (values[(n - 1) // 2] + values[n // 2]) / 2
    return at(0.5), at(0.95), at(0.99), median


@pytest.mark.parametrize("width", [0.01, 1.0, 1000.0])
def test_rank_percentiles_against_brute_force(spark, width):
    rng = random.Random(7)
    data = {
        "hot": [rng.choice([1.5, 2.5, rng.uniform(-50, 500)]) for _ in range(1500)],
        "one": [3.0],
        "even": [1.0, 2.0, 3.0, 4.0],
        "same": [7.0] * 40,
    }
    frame = spark.createDataFrame(
        [(k, v) for k, vs in data.items() for v in vs] + [("one", None)], "k string, v double"
    )
    for r in dicts(ranks.rank_percentiles(frame, "k", "v", bin_width=width)):
        values = data[r["k"]]
        assert (r["p50"], r["p95"], r["p99"], r["median"]) == brute_ranks(values)
        assert r["n"] == len(values) and r["mean"] == pytest.approx(sum(values) / len(values))


@pytest.mark.parametrize("chunk", [1, 60, 3600, 10**9])
def test_episodes_against_a_plain_scan(spark, probes, chunk):
    rng = random.Random(3)
    rows = [
        {"region_id": rng.choice("ab"), "unix_ts": T0 + rng.randrange(9000), "event_id": f"{i:04d}",
         "outage_detected": rng.random() < 0.6}
        for i in range(400)
    ]
    want = []
    for region in "ab":
        run = None
        for r in sorted(
            (r for r in rows if r["region_id"] == region),
            key=lambda r: (r["unix_ts"], r["event_id"]),
        ):
            if not r["outage_detected"]:
                run = None
            elif run is None:
                run = [region, r["unix_ts"], r["unix_ts"], 1]
                want.append(run)
            else:
                run[2], run[3] = r["unix_ts"], run[3] + 1
    found = episodes.outage_episodes(probes(*rows), chunk_s=chunk).select(
        "region_id", F.unix_seconds("start_ts"), F.unix_seconds("end_ts"), "records"
    )
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want))


def test_rate_drop_reports_silent_hours(probes):
    rows = [{"unix_ts": T0 + h * 3600} for h in range(6) if h != 3 for _ in range(4)]
    got = dicts(episodes.rate_drop(probes(*rows, region_id="a"), ratio=0.5))
    assert [(r["events"], round(r["mean_per_hour"], 3)) for r in got] == [(0, round(20 / 6, 3))]


def test_trending_issues_ignore_healthy(probes):
    p = probes(
        {"state": "healthy"}, {"state": "warning"}, {"state": "warning"}, {"state": "critical"},
        {"state": "warning", "unix_ts": T0 - 900}, region_id="a", unix_ts=T0,
    )
    got = [(r["state"], r["occurrences"]) for r in dicts(speed.trending_issues(p, T0))]
    assert got == [("warning", 2), ("critical", 1)]


def test_reports_take_as_of_and_bound_parameters(spark, probes):
    p = probes(
        {"unix_ts": T0, "country_code": "A"}, {"unix_ts": T0 - 86_401, "country_code": "A"},
        {"unix_ts": T0 - 10, "country_code": "B' OR '1'='1"}, health_score=50.0,
        outage_detected=True, region_id="r",
    )
    run = lambda name, **k: dicts(sql_views.run_report(spark, name, p, **k))
    assert sum(r["probe_count"] for r in run("top_affected")) == 2
    assert sum(r["probe_count"] for r in run("top_affected", as_of=T0 - 1)) == 3
    assert len(run("latency_trend", country="A")) == 1
    assert len(run("latency_trend", country="B' OR '1'='1")) == 1
    assert run("latency_trend", country="' OR '1'='1") == []
    assert sum(r["outage_events"] for r in run("global_trend")) == 3
    (span,) = run("dataset_span")
    assert (span["total_records"], span["regions"], span["last_ts"]) == (3, 1, T0)
    with pytest.raises(ValueError):
        run("dataset_span", country="A")


def test_retention_and_hours(probes):
    p = probes({"unix_ts": T0}, {"unix_ts": T0 - 30 * 86_400}, {"unix_ts": T0 - 30 * 86_400 - 1})
    assert storage.retained(p, T0).count() == 2
    hours = dicts(storage.hourly_raw(p), "hour")
    assert [(r["hour"], r["records"]) for r in hours] == [("20231015_22", 2), ("20231114_22", 1)]


def test_feed_rules(probes):
    p = probes(
        {"state": "warning", "country_name": "Peru", "region_name": "Lima", "unix_ts": T0,
         "event_id": "1"},
        {"measurement_type": "wikimedia-edit-proxy", "outage_detected": True, "unix_ts": T0,
         "event_id": "2"},
        {"state": "degraded", "unix_ts": T0 - 1, "event_id": "3"},
    )
    rows = dicts(feed.feed_event(p), "event_id")
    assert [r["event_type"] for r in rows] == [
        "Network telemetry", "Wikimedia activity", "Network telemetry",
    ]
    assert rows[1]["severity"] == "unknown" and rows[1]["region_id"] == "unknown"
    assert {r["severity"] for r in dicts(feed.outage_alert_stream(p))} == {"warning", "unknown"}
    found = feed.feed_search(feed.feed_event(p), "LIMA per")
    assert [r["event_id"] for r in dicts(found)] == ["1"]
    assert feed.feed_search(feed.feed_event(p), "").count() == 3
    newest = dicts(feed.live_events(feed.feed_event(p), 2))
    assert [r["event_id"] for r in newest] == ["2", "1"]


def test_metrics_fill_defaults(probes):
    rows = {r["metric"]: r for r in dicts(storage.metrics_long(probes({"avg_rtt_ms": 3.0})))}
    assert (rows["HealthScore"]["value"], rows["PacketLossPct"]["value"]) == (100.0, 0.0)
    assert rows["AvgLatencyMs"]["value"] == 3.0 and rows["AvgLatencyMs"]["unit"] == "Milliseconds"
    assert rows["HealthScore"]["region"] == "unknown" and rows["HealthScore"]["country"] == "XX"
