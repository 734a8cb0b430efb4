"""NDJSON reading, connector normalisation, stored views, batch and compaction jobs."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from netvitals import schema
from netvitals.operators import history
from netvitals.plans import batch_job, compact, serve, sql_views, store
from netvitals.plans.shared import settle, shared_dir
from netvitals.sources import ndjson, normalize, views

T0 = 1_700_000_000


def write_lines(folder, *lines, name="a.ndjson"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def probe(i, **extra):
    at = {"timestamp": "2023-11-14T22:13:20.250000+00:00", "unix_ts": T0}
    return json.dumps({"event_id": f"e{i}", "region_id": "a", "avg_rtt_ms": 1.5, **at, **extra})


def test_lenient_reading_routes_rejects(spark, tmp_path):
    path = write_lines(
        tmp_path / "raw", probe(1), "", "{broken", probe(2, unix_ts="no number"), "   ",
        probe(3, hop_count=7, unknown_field=1), "[1, 2]",
    )
    good, rejects = ndjson.lenient_ndjson(spark, path)
    rows = {r["event_id"]: r for r in good.collect()}
    # a wrong field is null in a kept row; its time then comes from the other column
    assert set(rows) == {"e1", "e2", "e3"} and rows["e3"]["hop_count"] == 7
    assert rows["e2"]["unix_ts"] == T0 and rows["e2"]["avg_rtt_ms"] == 1.5
    assert rows["e1"]["ts"].microsecond == 250000
    assert {r["line"] for r in rejects.collect()} == {"{broken", "[1, 2]"}
    assert ndjson.read_probes(spark, path).count() == 3


def test_wrong_typed_fields_keep_their_record(spark, tmp_path):
    path = write_lines(
        tmp_path / "raw", probe(1, hop_count="7"), probe(2, hop_count=7.0),
        probe(3, health_score="x", outage_detected="maybe", state="warning"), probe(4, state=None),
    )
    rows = {r["event_id"]: r for r in ndjson.read_probes(spark, path).collect()}
    assert set(rows) == {"e1", "e2", "e3", "e4"}
    assert rows["e3"]["health_score"] is None and rows["e3"]["outage_detected"] is None
    assert rows["e3"]["state"] == "warning" and rows["e3"]["region_id"] == "a"


def test_rows_without_an_id_are_never_merged(spark, tmp_path):
    path = write_lines(
        tmp_path / "raw", probe(1), probe(1), *[json.dumps({"region_id": "a", "unix_ts": T0 + i}) for i in (1, 2, 2)],
        json.dumps({"event_id": "e1", "region_id": "b", "unix_ts": T0 + 5}),
    )
    kept = ndjson.dedup_events(ndjson.read_probes(spark, path)).collect()
    assert sorted((r["event_id"] or "", r["region_id"]) for r in kept) == [("", "a")] * 3 + [("e1", "b")]


def test_time_comes_from_either_column(spark, tmp_path):
    path = write_lines(
        tmp_path / "raw", probe(1, timestamp="garbage"), probe(2, unix_ts=None),
        probe(3, timestamp="2023-11-14T23:13:20+01:00"),
    )
    got = ndjson.read_probes(spark, path).select("unix_ts", F.unix_seconds("ts").alias("s"))
    assert {tuple(r) for r in got.collect()} == {(T0, T0)}


def test_raw_table_and_view(spark, tmp_path):
    path = write_lines(tmp_path / "raw", probe(1, outage_detected=True), "{broken", probe(2))
    ndjson.raw_table(spark, "probe_events", path)
    try:
        assert spark.table("probe_events").count() == 2
        assert len(spark.table("probe_events").select("event_id", "unix_ts").collect()) == 2
        (span,) = sql_views.run_report(spark, "dataset_span", "probe_events").collect()
        assert span["total_records"] == 2
        sql_views.create_batch_view(spark, "probe_events")
        (row,) = spark.sql("SELECT total_probes, total_outages FROM v_batch_summary").collect()
        assert tuple(row) == (2, 1)
    finally:
        spark.catalog.dropTempView("probe_events")


def test_envelopes_of_every_kind(spark):
    b64 = lambda s: base64.b64encode(s.encode()).decode()
    body = '{"event_id": "%s"}'
    frame = spark.createDataFrame(
        [
            ((b64(body % "k"),), None, None),
            (None, "aws:sqs", body % "q"),
            (None, "aws:other", body % "x"),
            (None, None, body % "x"),
            (("!! no base64",), None, None),
            ((b64("no json"),), None, None),
            (None, "aws:sqs", "{broken"),
            (None, "aws:sqs", None),
            (None, None, None),
        ],
        schema.ENVELOPE_DDL,
    )
    decoded, rejected = normalize.decode_envelopes(frame, "event_id STRING")
    assert sorted(r[0] for r in decoded.collect()) == ["k", "q"]
    assert rejected.count() == 7


def test_atlas_zero_and_null_mean_no_reply(spark):
    frame = spark.createDataFrame(
        [(1, None, None), (2, 0.0, 10.0), (3, 501.0, 0.0), (4, 20.0, 31.0), (None, 20.0, None)],
        schema.ATLAS_DDL,
    )
    rows = {r["probe_id"]: r for r in normalize.atlas_probes(frame).collect()}
    assert (rows["ripe-1"]["avg_rtt_ms"], rows["ripe-1"]["is_reachable"]) == (999.0, False)
    assert rows["ripe-2"]["health_score"] == 0.0 and rows["ripe-2"]["outage_detected"]
    assert rows["ripe-3"]["is_reachable"] and rows["ripe-3"]["outage_detected"]
    assert rows["ripe-4"]["outage_detected"] and not rows["ripe-0"]["outage_detected"]


def test_edit_events_without_a_region_drop_out(spark):
    events = [
        {"meta": {"domain": "xx.wiki.org", "dt": "2023-11-14T22:13:20Z"}, "timestamp": 5},
        {"meta": {"domain": "yy.wiki.org"}, "timestamp": 0, "bot": True, "type": "edit"},
        {"meta": {"domain": "zz.wiki.org"}},
        {"meta": {}},
        {},
    ]
    lines = spark.createDataFrame(
        [(str(i), json.dumps(e)) for i, e in enumerate(events)], "event_id string, data string"
    )
    languages = spark.createDataFrame([("xx", "a"), ("yy", "a"), ("zz", "gone")], schema.LANGUAGE_DDL)
    regions = spark.createDataFrame(
        [("a", "A", "AA", "Aland", "EU", 1.0, 2.0, "", "P")], schema.REGION_DDL
    )
    now = F.timestamp_seconds(F.lit(T0))
    got = normalize.edit_activity(lines, languages, regions, received_at=now).collect()
    rows = {r["event_id"]: r for r in got}
    assert set(rows) == {"0", "1"}
    assert (rows["0"]["unix_ts"], rows["0"]["is_bot"], rows["0"]["wiki_type"]) == (5, False, "")
    assert (rows["1"]["unix_ts"], rows["1"]["is_bot"]) == (T0, True)
    assert rows["1"]["probe_id"] == "wiki-yy.wiki.org"


def test_views_are_empty_until_written(spark, tmp_path):
    path = str(tmp_path / "view")
    assert views.read_view(spark, path, schema.HISTORY_DDL).count() == 0
    assert store.read_version(spark, path, schema.HISTORY_DDL).count() == 0
    assert serve.live_state(spark, path).count() == 0
    assert serve.serve_view(spark, path, "map-data").count() == 0
    some = spark.range(3)
    nothing = some.limit(0)
    assert views.first_non_empty(nothing, some, nothing).count() == 3
    assert views.first_non_empty(nothing, nothing).count() == 0


def test_versions_take_turns_and_reruns_see_the_same_past(spark, tmp_path):
    path, ddl = str(tmp_path / "v"), "x BIGINT"
    read = lambda **k: sorted(
        r[0] for r in store.read_version(spark, path, ddl, **k).collect()
    )
    for batch in range(4):
        past = store.read_version(spark, path, ddl, before=batch)
        store.write_version(past.unionByName(spark.range(batch, batch + 1).toDF("x")), path, batch)
    assert read() == [0, 1, 2, 3]
    past = store.read_version(spark, path, ddl, before=3)
    store.write_version(past.unionByName(spark.range(3, 4).toDF("x")), path, 3)
    assert read() == [0, 1, 2, 3] and read(before=3) == [0, 1, 2]
    store.write_version(spark.range(0).toDF("x"), path, 4)
    assert read() == []


def test_a_reader_keeps_its_version(spark, tmp_path):
    path, ddl = str(tmp_path / "v"), "x BIGINT"
    store.write_version(spark.range(1).toDF("x"), path, 0)
    early = store.read_version(spark, path, ddl)
    for batch in (1, 2, 3):
        store.write_version(spark.range(batch + 1).toDF("x"), path, batch)
    assert early.count() == 1 and store.read_version(spark, path, ddl).count() == 4
    for batch in range(4, 9):
        store.write_version(spark.range(1).toDF("x"), path, batch)
    assert store.versions(spark, path) == [4, 5, 6, 7, 8]


def test_settle_uses_the_configured_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    frame = settle(spark.range(5))
    assert frame.count() == 5 and shared_dir(spark) in frame.inputFiles()[0]


def test_batch_job_and_compaction(spark, tmp_path):
    lines = [
        probe(i, region_id="ab"[i % 2], country_code="C", health_score=90.0, packet_loss_pct=0.0,
              outage_detected=i % 5 == 0, timestamp=None, unix_ts=T0 + i * 600)
        for i in range(40)
    ]
    raw = write_lines(tmp_path / "raw", *lines, lines[0], "{broken")
    table = str(tmp_path / "history")
    compact.compact_history(spark, raw, table)
    compact.compact_history(spark, raw, table)  # a second run replaces the hours
    stored = ndjson.read_history(spark, table)
    assert stored.count() == 40
    assert stored.select("hour").distinct().count() == 7
    plan = stored.filter("hour >= '20231115_00'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan

    root = str(tmp_path / "out")
    batch_job.run_batch(stored, root)
    want = {tuple(r) for r in history.outage_frequency(stored).collect()}
    got = views.read_view(spark, f"{root}/batch/outage_frequency", history_ddl(stored))
    assert {tuple(r) for r in got.collect()} == want
    assert serve.serve_view(spark, root, "batch-summary").first()["total_records"] == 40
    serve.run_merge(spark, root)
    rows = serve.serve_view(spark, root, "map-data").collect()
    assert {r["region_id"] for r in rows} == {"a", "b"}
    assert serve.serve_view(spark, root, "global").first()["total_records_batch"] == 40
    with pytest.raises(KeyError):
        serve.serve_view(spark, root, "nothing")


def history_ddl(stored):
    schema_ = history.outage_frequency(stored).schema
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema_)


def test_a_late_delivery_adds_to_its_hour(spark, tmp_path):
    rows = [probe(i, timestamp=None, unix_ts=T0 + i) for i in range(10)]
    nameless = json.dumps({"region_id": "a", "unix_ts": T0 + 3})
    table, rejects = str(tmp_path / "history"), str(tmp_path / "rejects")
    first = write_lines(tmp_path / "one", *rows, nameless, nameless)
    assert compact.compact_history(spark, first, table, rejects=rejects) == {"records": 12, "rejects": 0}
    late = write_lines(tmp_path / "two", probe(99, timestamp=None, unix_ts=T0 + 1), rows[4], "{broken")
    got = compact.compact_history(spark, late, table, rejects=rejects)
    assert got == {"records": 2, "rejects": 1}
    stored = ndjson.read_history(spark, table)
    assert stored.count() == 13 and stored.filter("event_id IS NULL").count() == 2
    assert [r["line"] for r in spark.read.parquet(rejects).collect()] == ["{broken"]
    assert compact.drop_expired(spark, table, T0 + 3 * 86_400, days=1) == ["20231114_22"]
    assert ndjson.read_history(spark, table).count() == 0


def test_reports_over_history_prune_hours(spark, tmp_path):
    table = str(tmp_path / "history")
    rows = [probe(i, timestamp=None, unix_ts=T0 + i * 3600, country_code="US", health_score=50.0,
                  outage_detected=True) for i in range(30)]
    compact.compact_history(spark, write_lines(tmp_path / "raw", *rows), table)
    stored = ndjson.read_history(spark, table)
    plain = ndjson.read_probes(spark, str(tmp_path / "raw"))
    for name in ("top_affected", "latency_trend", "global_trend", "outage_hotspots"):
        for as_of in (T0 + 29 * 3600, None):
            found = sql_views.run_report(spark, name, stored, as_of)
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [isnotnull(hour" in plan, (name, as_of)
            want = sql_views.run_report(spark, name, plain, as_of)
            assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_json_views_are_served(spark, tmp_path):
    rows = [probe(i, timestamp=None, unix_ts=T0 + i, health_score=90.0) for i in range(5)]
    raw = write_lines(tmp_path / "raw", *rows)
    batch_job.run_batch(ndjson.read_probes(spark, raw), str(tmp_path / "out"), "json")
    assert serve.serve_view(spark, str(tmp_path / "out"), "batch-summary").first()["total_records"] == 5


def test_quantiles_are_exact_at_any_size(spark):
    rows = spark.range(200_000).selectExpr(
        "'a' AS region_id", "CAST(id AS DOUBLE) AS avg_rtt_ms", "1.0D AS health_score",
        "0.0D AS packet_loss_pct", "false AS outage_detected",
        *[f"CAST(NULL AS STRING) AS {c}" for c in schema.REGION_COLUMNS if c not in ("region_id", "lat", "lon")],
        "0.0D AS lat", "0.0D AS lon",
    )
    (got,) = history.latency_by_region(rows).collect()
    assert (got["p50_latency_ms"], got["p95_latency_ms"]) == (99_999.0, 189_999.0)


def test_compaction_drops_what_is_past_retention(spark, tmp_path):
    raw = write_lines(
        tmp_path / "raw", probe(1, timestamp=None), probe(2, timestamp=None, unix_ts=T0 - 86_401)
    )
    table = str(tmp_path / "history")
    compact.compact_history(spark, raw, table, as_of=T0, days=1)
    assert [r["event_id"] for r in ndjson.read_history(spark, table).collect()] == ["e1"]
