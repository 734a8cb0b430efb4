"""Snapshots of the archive through crashes and maintenance, and the incremental batch job."""

import random

import pytest
from pyspark.sql import functions as F

from netvitals.plans import archive, incremental, snapshots
from netvitals.plans.batch_job import batch_views
from netvitals.plans.snapshots import Snapshot
from netvitals.sources.ndjson import dedup_events

T0 = 1_700_000_000 - 1_700_000_000 % 3600


def records(n, first=0, hours=6, seed=3):
    rng = random.Random(seed + first)
    return [
        {
            "event_id": f"e{i:05d}", "unix_ts": T0 + rng.randrange(hours * 3600), "region_id": rng.choice("abcde"),
            "region_name": "R", "country_code": rng.choice("XY"), "country_name": "C", "lat": 1.0, "lon": 2.0,
            "avg_rtt_ms": float(rng.randrange(400)), "packet_loss_pct": float(rng.randrange(40)),
            "health_score": float(rng.randrange(101)), "outage_detected": rng.random() < 0.4, "state": "warning",
        }
        for i in range(first, first + n)
    ]


def ids(frame):
    return sorted(r["event_id"] or "" for r in frame.select("event_id").collect())


def names(rows):
    return sorted(r["event_id"] or "" for r in rows)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "archive")


def test_batches_are_added_once(spark, probes, root):
    rows = records(60)
    first, second = probes(*rows[:40]), probes(*rows[35:])
    archive.append_batch(first, 0, root)
    archive.append_batch(second, 1, root)
    archive.append_batch(first, 0, root)
    assert ids(archive.read_archive(spark, root)) == names(rows[:40] + rows[35:])
    archive.compact_archive(spark, root)
    # repeats of one hour are gone, and a batch that is run again is still known
    assert ids(archive.read_archive(spark, root)) == names(rows)
    archive.append_batch(second, 1, root)
    assert ids(archive.read_archive(spark, root)) == names(rows)
    archive.append_batch(probes(), 2, root)
    assert snapshots.newest(spark, root).marks == {"stream": 2}


def test_readers_of_an_older_snapshot_keep_it(spark, probes, root):
    archive.append_batch(probes(*records(50)), 0, root)
    archive.append_batch(probes(*records(20, 50)), 1, root)
    older = snapshots.newest(spark, root)
    reader = archive.read_archive(spark, root, snapshot=older)
    archive.compact_archive(spark, root)
    archive.expire_archive(spark, root, T0 + 2 * 3600 + 30 * 86_400)
    snapshots.vacuum(spark, root, grace_s=0)
    assert reader.count() == 70
    assert archive.read_archive(spark, root).filter(F.col("unix_ts") < T0 + 2 * 3600).count() == 0
    assert snapshots.vacuum(spark, root, keep=1, grace_s=0) > 0
    kept = [r for r in records(50) + records(20, 50) if r["unix_ts"] >= T0 + 2 * 3600]
    assert ids(archive.read_archive(spark, root)) == names(kept)
    assert snapshots.vacuum(spark, root, keep=1, grace_s=0) == 0


def test_records_without_id_or_time_survive(spark, probes, root):
    rows = [{"region_id": "a"}, {"event_id": "x", "region_id": "b"}, {"unix_ts": T0, "region_id": "c"}] * 2
    archive.append_batch(probes(*rows), 0, root)
    archive.append_batch(probes(*rows), 1, root)
    archive.compact_archive(spark, root)
    archive.expire_archive(spark, root, T0 + 90 * 86_400)
    assert ids(archive.read_archive(spark, root)) == ["", "", "", "", "x"]


@pytest.mark.parametrize("step", ["write", "rename"])
@pytest.mark.parametrize("work", ["append", "compact", "expire", "refresh"])
def test_a_crash_before_any_step_loses_nothing(spark, probes, root, monkeypatch, step, work):
    rows = records(40)
    archive.append_batch(probes(*rows[:30]), 0, root)
    archive.append_batch(probes(*rows[25:35]), 1, root)
    store = root + "_views"
    incremental.refresh(spark, root, store)

    def act():
        if work == "append":
            archive.append_batch(probes(*rows[35:]), 2, root)
        elif work == "compact":
            archive.compact_archive(spark, root)
        elif work == "expire":
            archive.expire_archive(spark, root, T0 + 3 * 3600 + 30 * 86_400)
        else:
            archive.append_batch(probes(*rows[35:]), 2, root)
            incremental.refresh(spark, root, store)

    def crash(*args, **kwargs):
        raise OSError("lost")

    before = snapshots.newest(spark, root)
    with monkeypatch.context() as broken:
        broken.setattr(snapshots, {"write": "write_folder", "rename": "_put"}[step], crash)
        if (work, step) != ("expire", "write"):
            with pytest.raises(OSError):
                act()
            assert snapshots.newest(spark, root) == before
            assert ids(archive.read_archive(spark, root)) == names(rows[:30] + rows[25:35])
    act()
    snapshots.vacuum(spark, root, grace_s=0)
    want = {"append": rows, "refresh": rows, "compact": rows[:35]}.get(work)
    if want is None:
        want = [r for r in rows[:30] + rows[25:35] if r["unix_ts"] >= T0 + 3 * 3600]
        assert ids(archive.read_archive(spark, root)) == names(want)
    else:
        assert ids(dedup_events(archive.read_archive(spark, root))) == names(want)
    if work == "refresh":
        assert incremental.stored_cube(spark, store).agg(F.sum("n")).first()[0] == 40


def test_the_second_of_two_writers_takes_up_the_state_of_the_first(spark, probes, root, monkeypatch):
    rows = records(60)
    archive.append_batch(probes(*rows[:20]), 0, root)
    archive.append_batch(probes(*rows[20:40]), 1, root)
    real, raced = snapshots._put, []

    def put(session, at, snapshot):
        if not raced:
            raced.append(1)
            archive.append_batch(probes(*rows[40:]), 2, root)  # comes first
        return real(session, at, snapshot)

    monkeypatch.setattr(snapshots, "_put", put)
    archive.compact_archive(spark, root)
    assert ids(archive.read_archive(spark, root)) == names(rows)
    # an hour that was dropped meanwhile is not brought back by a compaction
    base = snapshots.newest(spark, root)
    hour = sorted(base.hours)[0]
    again = archive.read_archive(spark, root, [hour], base)
    snapshots.drop_hours(spark, root, lambda h: h == hour)
    snapshots.replace(again, root, base, [hour], same_records=True)
    assert hour not in snapshots.newest(spark, root).hours


def test_a_version_can_be_made_once(spark, root):
    assert snapshots._put(spark, root, Snapshot(0, {}, {"a": 1}))
    assert not snapshots._put(spark, root, Snapshot(0, {}, {"a": 2}))
    assert snapshots.newest(spark, root).marks == {"a": 1}


def rounded(frame, skip=()):
    doubles = {c: F.round(c, 6) for c, t in frame.dtypes if t == "double"}
    kept = [c for c in frame.columns if c not in skip]
    return sorted(map(repr, (r.asDict() for r in frame.withColumns(doubles).select(*kept).collect())))


def test_incremental_views_equal_those_of_all_records(spark, probes, root, tmp_path):
    store = str(tmp_path / "store")
    rows = records(400) + [{"unix_ts": T0 + 7, "region_id": None, "outage_detected": True}, {"region_id": "z"}]
    late = records(30, 400, hours=1) + rows[:5]
    archive.append_batch(probes(*rows), 0, root)
    incremental.refresh(spark, root, store)
    archive.compact_archive(spark, root, least=1)
    assert incremental.refresh(spark, root, store) == {"cube": [], "pieces": []}
    archive.append_batch(probes(*late), 1, root)
    read = incremental.refresh(spark, root, store)
    touched = {r[0] for r in archive.read_archive(spark, root).filter("event_id >= 'e00400'").select("hour").collect()}
    repeats = {r[0] for r in archive.read_archive(spark, root).filter("event_id < 'e00005'").select("hour").collect()}
    assert set(read["cube"]) == set(read["pieces"]) == touched | repeats and len(read["cube"]) < 7
    got = incremental.views(incremental.stored_cube(spark, store), incremental.stored_episodes(spark, store))
    whole = archive.read_archive(spark, root).drop("hour")
    want = batch_views(dedup_events(whole))
    assert set(got) == set(want)
    quantiles = ("p50_latency_ms", "p95_latency_ms")
    for name, view in want.items():
        assert rounded(got[name].select(*view.columns), quantiles) == rounded(view, quantiles), name


def test_only_changed_hours_are_read(spark, probes, root, tmp_path):
    store = str(tmp_path / "store")
    archive.append_batch(probes(*records(300, hours=48)), 0, root)
    incremental.refresh(spark, root, store)
    archive.append_batch(probes(*records(20, 300, hours=2)), 1, root)
    source = snapshots.newest(spark, root)
    _, hours = incremental.changed_hours(spark, source, f"{store}/tables/cube")
    files = archive.read_archive(spark, root, hours, source).inputFiles()
    assert len(hours) == 2 and {f.split("hour=")[1].split("/")[0] for f in files} == set(hours)
    archive.expire_archive(spark, root, T0 + 24 * 3600 + 30 * 86_400)
    assert incremental.refresh(spark, root, store)["cube"] == []
    first = incremental.stored_cube(spark, store).agg(F.min("hour")).first()[0]
    assert first.timestamp() == T0 + 24 * 3600


def test_sketches_keep_their_bounds(spark, probes, root):
    rng = random.Random(8)
    rows = probes(
        *[
            {"event_id": str(i), "unix_ts": T0 + i % 7200, "region_id": f"r{rng.randrange(3)}",
             "avg_rtt_ms": rng.choice([rng.random() * 9, 5.0, rng.expovariate(0.01)]), "outage_detected": i % 2 == 0}
            for i in range(6000)
        ]
    )
    archive.append_batch(rows, 0, root)
    cube = incremental.cube_rows(archive.read_archive(spark, root))
    for row in incremental.latency_range(cube).collect():
        values = sorted(r[0] for r in rows.filter(F.col("region_id") == row["region_id"]).select("avg_rtt_ms").collect())
        for p, got in ((0.5, row["p50_latency_ms"]), (0.95, row["p95_latency_ms"])):
            below, upto = (sum(f(v) for v in values) / len(values) for f in (got.__gt__, got.__ge__))
            assert below - 0.02 <= p <= upto + 0.02
    none = cube.filter("FALSE")
    assert incremental.regions_in_outage(cube, cube).first()[:] == (3, 3, 3, 3)
    assert incremental.regions_in_outage(cube, none).first()[:] == (3, 0, 3, 0)
    assert incremental.latency_range(none).count() == 0


def test_empty_archive(spark, root, tmp_path):
    store = str(tmp_path / "store")
    assert archive.read_archive(spark, root).count() == 0
    assert archive.compact_archive(spark, root) == [] and archive.expire_archive(spark, root, T0) == []
    assert snapshots.vacuum(spark, root) == 0
    assert incremental.refresh(spark, root, store) == {"cube": [], "pieces": []}
    assert incremental.stored_cube(spark, store).count() == incremental.stored_episodes(spark, store).count() == 0


def test_unknown_fields_go_through_archive_and_compaction(spark, root, tmp_path):
    import json

    from netvitals.streaming.run import ingest_batch

    lines = [
        {"event_id": "a", "unix_ts": T0, "sensor": {"id": "s1", "gain": [1, 2.5]}, "hop_count": "x"},
        {"event_id": "b", "unix_ts": T0 + 1}, {"event_id": "c", "unix_ts": T0 + 2, "sensor": "text", "x.y": None},
    ]
    values = [json.dumps(x) for x in lines] + ["{broken"]
    live = str(tmp_path / "live")
    ingest_batch(spark.createDataFrame([(v,) for v in values], "value string"), 0, live)
    source = tmp_path / "in"
    source.mkdir()
    (source / "0.ndjson").write_text("\n".join(values))
    assert archive.append_delivery(spark, str(source), f"{live}/history", rejects=str(tmp_path / "bad")) == {"records": 3, "rejects": 1}
    archive.compact_archive(spark, f"{live}/history")
    got = {r.event_id: r.extra and json.loads(r.extra) for r in archive.read_archive(spark, f"{live}/history").collect()}
    assert got == {"a": {"sensor": {"id": "s1", "gain": [1, 2.5]}}, "b": None, "c": {"sensor": "text", "x.y": None}}
