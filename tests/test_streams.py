"""Streams against their batch twins, and the live views after replayed micro-batches."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from netvitals import schema
from netvitals.operators import feed, latest, speed
from netvitals.plans import serve
from netvitals.plans.store import read_version
from netvitals.sources import ndjson
from netvitals.streaming import jobs

T0 = 1_700_000_000 - 1_700_000_000 % 3600


def make_rows(n, span, seed=5):
    rng = random.Random(seed)
    times = sorted(rng.sample(range(span), n))
    return [
        {
            "event_id": f"e{i:05d}", "unix_ts": T0 + t, "region_id": rng.choice("abc"),
            "region_name": "R", "country_code": "C", "country_name": "Country",
            "avg_rtt_ms": float(rng.randrange(1, 400)), "packet_loss_pct": float(rng.randrange(40)),
            "health_score": float(rng.randrange(101)), "outage_detected": rng.random() < 0.4,
            "state": rng.choice(["healthy", "warning", "critical"]),
        }
        for i, t in enumerate(times)
    ]


def write_file(folder, name, rows, order):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n{broken\n")
    # the file source takes files by modification time
    os.utime(path, (T0 + order, T0 + order))


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("in") / "raw"
    rows = make_rows(300, 7200)
    for i in range(3):
        write_file(folder, f"{i}.ndjson", rows[i * 100 : (i + 1) * 100], i)
    return str(folder)


def run(writer, checkpoint):
    query = jobs.paced(writer, checkpoint, every=None).start()
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def rows_of(frame):
    return sorted(map(repr, (r.asDict(recursive=True) for r in frame.collect())))


def rounded(frame):
    doubles = [c for c, t in frame.dtypes if t == "double"]
    return frame.withColumns({c: F.round(c, 6) for c in doubles})


def closed(batch, column, lateness_s=600):
    """Windows the watermark has passed once all records are seen."""
    return batch.filter(F.unix_seconds(column) <= T0 + last_offset() - lateness_s)


def last_offset():
    return make_rows(300, 7200)[-1]["unix_ts"] - T0


def test_sliding_windows_stream_equals_batch(spark, landed, tmp_path):
    out = str(tmp_path / "windows")
    stream = ndjson.probe_stream(spark, landed, 1)
    run(jobs.sliding_window_table(stream, out), str(tmp_path / "ck"))
    batch = closed(speed.sliding_windows(ndjson.read_probes(spark, landed)), "window_end")
    got = spark.read.parquet(out)
    assert got.count() > 100
    assert rows_of(rounded(got.select(*batch.columns))) == rows_of(rounded(batch))


def test_kpi_stream_equals_batch(spark, landed, tmp_path):
    out = str(tmp_path / "kpis")
    stream = ndjson.probe_stream(spark, landed, None)
    run(jobs.kpi_table(stream, out), str(tmp_path / "ck"))
    windows = speed.sliding_windows(ndjson.read_probes(spark, landed))
    batch = {r["computed_at"]: r for r in rounded(speed.speed_global(windows)).collect()}
    got = rounded(spark.read.parquet(out)).collect()
    # a chained aggregation closes a window one watermark later; what is out must be equal
    assert len(got) >= 90 and all(batch[r["computed_at"]].asDict() == r.asDict() for r in got)


def test_raw_history_and_dedup(spark, tmp_path):
    rows = make_rows(60, 7200, seed=9)
    folder = tmp_path / "raw"
    write_file(folder, "0.ndjson", rows[:40], 0)
    write_file(folder, "1.ndjson", rows[30:], 1)  # ten records delivered again
    out, check = str(tmp_path / "history"), str(tmp_path / "ck")
    unique = ndjson.dedup_events(ndjson.probe_stream(spark, str(folder), 1), "3 hours")
    run(jobs.raw_history(unique, out), check)
    assert ndjson.read_history(spark, out).count() == 60
    assert ndjson.dedup_events(ndjson.read_probes(spark, str(folder))).count() == 60
    run(jobs.raw_history(unique, out), check)  # nothing new arrived
    assert ndjson.read_history(spark, out).count() == 60


def test_the_archive_takes_late_and_nameless_records(spark, tmp_path):
    rows = make_rows(60, 7200, seed=9)
    folder = tmp_path / "raw"
    nameless = [{"unix_ts": T0 + i, "region_id": "a"} for i in range(3)]
    write_file(folder, "0.ndjson", rows[30:], 0)
    write_file(folder, "1.ndjson", rows[:30] + nameless, 1)  # all late by more than ten minutes
    out, bad = str(tmp_path / "history"), str(tmp_path / "rejects")
    run(jobs.raw_history(ndjson.probe_stream(spark, str(folder), 1), out), str(tmp_path / "ck"))
    run(jobs.raw_rejects(ndjson.line_stream(spark, str(folder), 1), bad), str(tmp_path / "ck2"))
    assert ndjson.read_history(spark, out).count() == 63
    assert [r["line"] for r in spark.read.parquet(bad).collect()] == ["{broken"] * 2
    unique = ndjson.dedup_events(ndjson.probe_stream(spark, str(folder), 1), "3 hours")
    live = str(tmp_path / "unique")
    run(jobs.raw_history(unique, live), str(tmp_path / "ck3"))
    assert ndjson.read_history(spark, live).count() == 63


def test_future_and_late_records_do_not_move_the_clock(spark, probes, tmp_path):
    root = str(tmp_path / "root")
    row = {"region_name": "R", "country_code": "C", "avg_rtt_ms": 5.0, "health_score": 90.0, "state": "healthy"}
    jobs.apply_batch(probes(*[{"event_id": r, "region_id": r, "unix_ts": T0 + 1000, **row} for r in "abcd"]), 0, root)
    ahead = {"event_id": "f", "region_id": "e", "unix_ts": 9_000_000_000, **row}
    jobs.apply_batch(probes(ahead, {"event_id": "g", "region_id": "a", "unix_ts": T0 + 1001, **row}), 1, root)
    assert {r["region_id"] for r in serve.live_state(spark, root).collect()} == set("abcd")
    jobs.apply_batch(probes({"event_id": "h", "region_id": "a", "unix_ts": T0, **row}), 2, root)
    assert serve.serve_view(spark, root, "window-aggregates").count() == 4
    assert serve.serve_view(spark, root, "history").agg(F.max(F.unix_seconds("ts"))).first()[0] == T0 + 1001
    jobs.apply_batch(probes(ahead), 3, root)
    assert serve.live_state(spark, root).count() == 4
    assert spark.read.parquet(f"{root}/raw_batches").count() == 8


def test_alert_stream_is_the_batch_filter(spark, landed, tmp_path):
    out = str(tmp_path / "alerts")
    stream = feed.outage_alert_stream(ndjson.probe_stream(spark, landed))
    run(stream.writeStream.format("parquet").option("path", out), str(tmp_path / "ck"))
    want = feed.outage_alert_stream(ndjson.read_probes(spark, landed))
    assert rows_of(spark.read.parquet(out)) == rows_of(want)


def test_speed_layer_views(spark, landed, tmp_path):
    root = str(tmp_path / "root")
    run(jobs.speed_layer(ndjson.probe_stream(spark, landed, 1), root), str(tmp_path / "ck"))
    p = ndjson.read_probes(spark, landed)
    as_of = T0 + last_offset()

    state = serve.live_state(spark, root)
    want = latest.latest_per_key(latest.state_rows(p)).filter(F.col("unix_ts") + 600 > as_of)
    assert rows_of(state.drop("expires_at").select(*want.columns)) == rows_of(want)

    ring = serve.serve_view(spark, root, "live-events")
    want = feed.live_events(feed.feed_event(p))
    assert rows_of(ring) == rows_of(want.select(*ring.columns))

    window = serve.serve_view(spark, root, "window-aggregates")
    want = speed.trailing_window(p, as_of).select("region_id", "sample_count", "outage_count")
    assert rows_of(window.select(*want.columns)) == rows_of(want)

    assert serve.serve_view(spark, root, "history").count() == 3
    assert serve.serve_view(spark, root, "global").count() == 1
    assert serve.serve_view(spark, root, "map-data").count() == window.count()
    for name in ("top-affected", "observability", "incidents", "alerts"):
        assert serve.serve_view(spark, root, name, now=as_of).count() >= 0
    aggregates = spark.read.parquet(f"{root}/speed/batch_aggregates")
    assert aggregates.agg(F.sum("sample_count")).first()[0] == 300
    serve.run_merge(spark, root)
    merged = serve.serve_view(spark, root, "map-data")
    assert merged.first()["data_sources"]["speed_layer"] is True


def test_replayed_and_empty_batches_change_nothing(spark, probes, tmp_path):
    root = str(tmp_path / "root")
    rows = make_rows(90, 3000, seed=2)
    batches = [probes(*rows[i * 30 : (i + 1) * 30]) for i in range(3)]
    for i, batch in enumerate(batches):
        jobs.apply_batch(batch, i, root)
    views = {
        "current_state": schema.STATE_DDL, "live_events": schema.FEED_DDL,
        "window_aggregates": schema.WINDOW_DDL, "history": schema.HISTORY_DDL,
        "speed_global": schema.SPEED_GLOBAL_DDL,
    }

    def snapshot():
        return {
            v: rows_of(read_version(spark, f"{root}/speed/{v}", ddl)) for v, ddl in views.items()
        }

    before = snapshot()
    assert len(before["history"]) == 3 and before["current_state"]
    jobs.apply_batch(batches[2], 2, root)
    assert snapshot() == before
    jobs.apply_batch(probes().limit(0), 3, root)
    assert snapshot() == before
    assert spark.read.parquet(f"{root}/raw_batches").count() == 90


def test_kept_alerts_and_metrics_take_late_records_once(spark, tmp_path):
    from netvitals.streaming import run as live

    rows = [{**r, "outage_detected": True} for r in make_rows(60, 7200, seed=9)]
    folder, root = tmp_path / "raw", str(tmp_path / "root")
    write_file(folder, "0.ndjson", rows[30:], 0)
    write_file(folder, "1.ndjson", [{"unix_ts": T0 + 9000, "region_id": "a"}], 1)
    write_file(folder, "2.ndjson", rows[:35], 2)  # an hour late, five of them delivered again
    run(live.ingest(ndjson.line_stream(spark, str(folder), 1), root), str(tmp_path / "ck"))
    assert spark.read.parquet(f"{root}/rejects").count() == 3
    ids = {r["event_id"] for r in rows}
    alerts, metrics = live.kept_alerts(spark, root).collect(), live.kept_metrics(spark, root).collect()
    assert len(alerts) == 60 and {r["event_id"] for r in alerts} == ids
    assert len(metrics) == 3 * 61 and {r["event_id"] for r in metrics} == ids | {None}


def test_live_system_with_hourly_runs(spark, tmp_path):
    """Files in, hourly run, late files in, hourly run: views and windows equal those of all
    records, and only what changed is read."""
    from netvitals.plans import archive, incremental, snapshots
    from netvitals.streaming import run as live

    rows = make_rows(300, 4 * 3600, seed=4)
    late = [r for r in rows if r["unix_ts"] < T0 + 3600][::3]
    soon = [r for r in rows if r not in late]
    folder, root = tmp_path / "raw", str(tmp_path / "root")
    write_file(folder, "0.ndjson", soon[:150], 0)
    write_file(folder, "1.ndjson", soon[150:], 1)

    def arrive():
        for query in live.start_all(spark, str(folder), root, 300, None):
            query.awaitTermination(120)
            assert query.exception() is None

    now = T0 + 5 * 3600
    arrive()
    first = live.run_hourly(spark, root, now)
    assert len(first["cube"]) == 4
    write_file(folder, "2.ndjson", late + soon[-3:], 2)
    arrive()
    second = live.run_hourly(spark, root, now)
    assert 1 <= len(second["cube"]) <= 2
    assert live.run_hourly(spark, root, now)["cube"] == []
    p = ndjson.dedup_events(ndjson.read_probes(spark, str(folder)))
    want = rounded(speed.sliding_windows(p))
    got = live.kept_windows(spark, root)
    assert rows_of(rounded(got.select(*want.columns))) == rows_of(want)
    streamed = spark.read.parquet(f"{root}/streams/sliding_windows")
    missing = incremental.late_records(streamed, incremental.stored_windows(spark, root))
    lost = missing.join(streamed, ["window_start", "region_id"], "left_semi").agg(F.sum("late")).first()[0]
    assert lost and lost >= len(late)
    serve.run_merge(spark, root)
    assert serve.serve_view(spark, root, "batch-summary").first()["total_records"] == 300
    assert live.kept_kpis(spark, root).count() > 100
    assert live.kept_metrics(spark, root).count() == 900
    assert {len(e["folders"]) for e in snapshots.newest(spark, f"{root}/streams/metrics_long").hours.values()} == {1}
    # retention takes the oldest hours out of archive, cube and windows
    live.run_hourly(spark, root, T0 + 2 * 3600 + 30 * 86_400)
    live.run_hourly(spark, root, T0 + 2 * 3600 + 30 * 86_400)
    assert archive.read_archive(spark, f"{root}/history").agg(F.min("unix_ts")).first()[0] >= T0 + 2 * 3600
    assert serve.serve_view(spark, root, "batch-summary").first()["total_records"] < 300


def test_raw_copies_and_aggregates_are_forgotten(spark, probes, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "AGGREGATES_KEPT", 2)
    root = str(tmp_path / "root")
    for i in range(4):
        at = T0 + i * 3600
        row = {"event_id": f"e{i}", "region_id": "a", "unix_ts": at, "health_score": 90.0, "state": "healthy"}
        jobs.apply_batch(probes(row), i, root)
    hours = {p.name for p in (tmp_path / "root/raw_batches").glob("hour=*")}
    assert len(hours) == 3
    assert {p.name for p in (tmp_path / "root/speed/batch_aggregates").glob("batch=*")} == {"batch=2", "batch=3"}
