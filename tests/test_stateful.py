"""Streams that keep state in the engine against their batch twins, late rows included."""

import pytest
from pyspark.sql import functions as F
from test_streams import T0, make_rows, rounded, rows_of, run, write_file

from netvitals.operators import latest
from netvitals.plans import snapshots
from netvitals.sources import ndjson
from netvitals.streaming import stateful


@pytest.fixture(scope="module")
def arrivals(tmp_path_factory):
    """Three files; the second holds records up to ten minutes older than the newest of the first."""
    folder = tmp_path_factory.mktemp("stateful") / "raw"
    rows = make_rows(300, 4 * 3600, seed=11)
    first = [r for i, r in enumerate(rows) if r["unix_ts"] < T0 + 7200 and not (r["unix_ts"] > T0 + 6700 and i % 2)]
    second = [r for r in rows if r not in first and r["unix_ts"] < T0 + 9000]
    third = [r for r in rows if r["unix_ts"] >= T0 + 9000]
    for i, part in enumerate((first, second, third)):
        write_file(folder, f"{i}.ndjson", part, i)
    assert any(r["unix_ts"] < max(x["unix_ts"] for x in first) for r in second)
    return str(folder)


def test_sessions_stream_equals_batch(spark, arrivals, tmp_path):
    out = str(tmp_path / "sessions")
    gaps = ("6 minutes", "3 minutes", "11 minutes")
    run(stateful.appended(stateful.outage_sessions(ndjson.probe_stream(spark, arrivals, 1), *gaps), out), str(tmp_path / "ck"))
    batch = stateful.outage_sessions(ndjson.read_probes(spark, arrivals), *gaps)
    newest = ndjson.read_probes(spark, arrivals).filter("outage_detected").agg(F.max("unix_ts")).first()[0]
    closed = batch.filter(F.unix_seconds("closed_at") + 660 <= newest)
    got = spark.read.parquet(out)
    assert 20 < got.count() < 120 and rows_of(got.select(*closed.columns)) == rows_of(closed)


def test_a_late_record_joins_two_sessions(spark, probes):
    def row(i, at, state):
        return {"event_id": str(i), "region_id": "a", "unix_ts": T0 + at, "state": state, "outage_detected": True}

    apart = probes(row(1, 0, "warning"), row(2, 900, "warning"), row(3, 4000, "critical"), row(4, 5700, "warning"))
    assert sorted(r.records for r in stateful.outage_sessions(apart).collect()) == [1, 1, 2]
    joined = apart.unionByName(probes(row(5, 450, "warning")))
    assert sorted(r.records for r in stateful.outage_sessions(joined).collect()) == [2, 3]
    none = probes({"region_id": None, "unix_ts": T0, "outage_detected": True}, {"region_id": "b", "unix_ts": T0})
    assert [r.region_id for r in stateful.outage_sessions(none).collect()] == ["unknown"]


def test_alert_join_stream_equals_batch(spark, arrivals, tmp_path):
    out = str(tmp_path / "joined")
    two = [ndjson.probe_stream(spark, arrivals, 1) for _ in range(2)]
    run(stateful.appended(stateful.alerts_with_window(*two, 300), out), str(tmp_path / "ck"))
    p = ndjson.read_probes(spark, arrivals)
    batch = stateful.alerts_with_window(p, p, 300)
    newest = p.agg(F.max("unix_ts")).first()[0]
    want = batch.filter(F.unix_seconds("alert_ts") < newest - 1800)
    got = spark.read.parquet(out).filter(F.unix_seconds("alert_ts") < newest - 1800)
    assert rows_of(rounded(got.select(*want.columns))) == rows_of(rounded(want))
    assert got.filter("window_start IS NULL").count() > 5 and got.filter("is_outage").count() > 5


def test_state_log_equals_the_latest_records(spark, arrivals, tmp_path):
    root, window = str(tmp_path / "log"), 1800
    query = run(stateful.state_log(ndjson.probe_stream(spark, arrivals, 1), root, window), str(tmp_path / "ck"))
    assert all(p["stateOperators"][0]["numRowsTotal"] <= 12 for p in query.recentProgress if p["stateOperators"])
    p = ndjson.read_probes(spark, arrivals)
    newest = p.agg(F.max("unix_ts")).first()[0]
    for now in (newest, newest + 600, newest + 7200):
        want = latest.upsert_state(None, p, now, window)
        got = stateful.logged_state(spark, root, now, window)
        assert rows_of(got.select(*want.columns)) == rows_of(want)
    changed = snapshots.newest(spark, root)
    assert changed.marks == {"stream": 3} or changed.marks == {"stream": 2}


def test_rocksdb_state(spark, arrivals, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    stateful.use_rocksdb(spark)
    try:
        root = str(tmp_path / "log")
        run(stateful.state_log(ndjson.probe_stream(spark, arrivals, 1), root), str(tmp_path / "ck"))
        assert snapshots.read(spark, root, stateful.CHANGES_DDL).count() > 3
    finally:
        spark.conf.set(key, before)


def test_a_task_passes_on_its_newest_rows_only(spark, probes):
    rows = probes(*[
        {"event_id": str(i % 7) if i % 5 else None, "region_id": "ab"[i % 2], "unix_ts": T0 - 7200 + 600 * (i // 40)} for i in range(800)
    ], {"event_id": "x", "region_id": None, "unix_ts": -1}, {"event_id": "y", "region_id": None, "unix_ts": 1})
    whole = latest.state_rows(rows).coalesce(1)
    for collected in (1, 50, 10_000):
        kept = whole.mapInArrow(stateful._newest_of_task(3600, collected), whole.schema)
        want = whole.groupBy("region_id", F.window("ts", "3600 seconds")).agg(F.max(F.struct("ts", "event_id")).alias("m"))
        got = kept.groupBy("region_id", F.window("ts", "3600 seconds")).agg(F.max(F.struct("ts", "event_id")).alias("m"))
        assert rows_of(got.select("region_id", "m.*")) == rows_of(want.select("region_id", "m.*"))
        if collected > 800:
            assert kept.count() == want.count()


def test_the_state_is_not_written_by_one_task(spark, arrivals, tmp_path):
    stages = []
    append = snapshots.append
    snapshots.append = lambda rows, *more: (stages.append(rows._jdf.queryExecution().toString()), append(rows, *more))[1]
    try:
        run(stateful.state_log(ndjson.probe_stream(spark, arrivals, 1), str(tmp_path / "log")), str(tmp_path / "ck"))
    finally:
        snapshots.append = append
    assert stages and not any("Coalesce 1" in s or "Repartition 1, false" in s for s in stages)
