"""Registered queries: every operator over the whole driver tables.

Results are put in comparable form: doubles on a 1e-4 grid, instants as zone-less
timestamps, lists as joined text. Reference times are scalar subqueries over the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netvitals.functions import rules
from netvitals.operators import (
    alerts,
    episodes,
    feed,
    history,
    latest,
    ranks,
    serving,
    speed,
    storage,
)
from netvitals.plans import archive, compact, incremental, serve, snapshots, sql_views
from netvitals.plans.shared import fresh_path, settle
from netvitals.sources import driver_tables as tables
from netvitals.sources import drift, ndjson, normalize
from netvitals.streaming import jobs, stateful

WEEK_S = 7 * 86_400
MERGE_WINDOW_S = 7_200
STATE_WINDOW_S = 3_600
RETENTION_SHIFT_S = 10 * 86_400

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(frame: DataFrame) -> DataFrame:
    columns = []
    for field in frame.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            # the nudge makes exact ties go up whatever the summation order was
            c = F.floor(c * F.lit(1e4) + F.lit(0.50001)) / F.lit(1e4)
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.concat_ws(",", c)
        columns.append(c.alias(field.name))
    return frame.select(*columns)


_plans: dict[tuple[int, str, str], tuple[SparkSession, DataFrame]] = {}


def source(spark: SparkSession, sf: str, build) -> DataFrame:
    """The lazy plan of an input view, built once per session and folder. Only views that
    write nothing qualify, so no data is kept: every query scans the tables again."""
    key = (id(spark), sf, build.__name__)
    if key not in _plans or _plans[key][0] is not spark:
        _plans[key] = (spark, build(spark, sf))
    return _plans[key][1]


def probes(spark: SparkSession, sf: str) -> DataFrame:
    return source(spark, sf, tables.probes)


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(spark, sf_dir))

    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return build


# ---- scoring and projections ------------------------------------------------------------


@query
def health_score(spark, sf):
    return probes(spark, sf).select("event_id", "health_score")


@query
def outage_flag(spark, sf):
    p = probes(spark, sf)
    return p.select("event_id", "state", "packet_loss_pct", "outage_detected")


@query
def status_band(spark, sf):
    p = probes(spark, sf)
    return p.select("event_id", rules.status_band(F.col("health_score")).alias("status"))


@query
def domain_region(spark, sf):
    events = source(spark, sf, tables.raw_events).select(
        "event_id", F.concat("event_type", F.lit(".example.org")).alias("domain")
    )
    dims = tables.language_map(spark, sf), tables.regions(spark, sf)
    return normalize.domain_region(events, *dims)


@query
def edit_activity(spark, sf):
    dims = tables.language_map(spark, sf), tables.regions(spark, sf)
    return normalize.edit_activity(source(spark, sf, tables.edit_events), *dims)


@query
def ripe_normalize(spark, sf):
    return normalize.atlas_probes(source(spark, sf, tables.atlas_results))


@query
def envelope_decode(spark, sf):
    ddl = "event_id BIGINT, user_id BIGINT, value DOUBLE"
    return normalize.decode_envelopes(source(spark, sf, tables.envelopes), ddl)[0]


@query
def feed_event(spark, sf):
    return feed.feed_event(probes(spark, sf))


@query
def feed_search(spark, sf):
    return feed.feed_search(feed.feed_event(probes(spark, sf)), "COUNTRY 3")


@query
def outage_alert_stream(spark, sf):
    return feed.outage_alert_stream(probes(spark, sf))


@query
def metrics_long(spark, sf):
    return storage.metrics_long(probes(spark, sf))


# ---- history ----------------------------------------------------------------------------


@query
def latency_by_region(spark, sf):
    return history.latency_by_region(probes(spark, sf))


@query
def outage_frequency(spark, sf):
    return history.outage_frequency(probes(spark, sf))


@query
def hourly_health_trend(spark, sf):
    return history.hourly_health_trend(probes(spark, sf))


@query
def global_summary(spark, sf):
    return history.global_summary(probes(spark, sf))


@query
def country_rollup(spark, sf):
    return history.country_rollup(probes(spark, sf))


@query
def region_rollup(spark, sf):
    return history.region_rollup(probes(spark, sf))


@query
def rank_percentiles(spark, sf):
    return ranks.rank_percentiles(probes(spark, sf), "region_id", "avg_rtt_ms")


@query
def top_affected(spark, sf):
    p = probes(spark, sf)
    return history.top_affected(history.region_means(p), history.outage_frequency(p))


@query
def batch_summary(spark, sf):
    return sql_views.batch_summary(spark, probes(spark, sf))


@query
def q_top_affected(spark, sf):
    return sql_views.run_report(spark, "top_affected", probes(spark, sf))


@query
def q_latency_trend(spark, sf):
    return sql_views.run_report(spark, "latency_trend", probes(spark, sf), country="C3")


@query
def q_global_trend(spark, sf):
    return sql_views.run_report(spark, "global_trend", probes(spark, sf))


@query
def q_outage_hotspots(spark, sf):
    return sql_views.run_report(spark, "outage_hotspots", probes(spark, sf))


@query
def q_dataset_span(spark, sf):
    return sql_views.run_report(spark, "dataset_span", probes(spark, sf))


@query
def outage_episodes(spark, sf):
    return episodes.outage_episodes(probes(spark, sf))


@query
def outage_duration(spark, sf):
    return episodes.outage_duration(episodes.outage_episodes(probes(spark, sf)))


@query
def rate_drop(spark, sf):
    return episodes.rate_drop(probes(spark, sf))


@query
def edit_rate_drop(spark, sf):
    """Hours in which a region's edits fell below half of their mean: the disruption signal."""
    return episodes.rate_drop(edit_activity(spark, sf))


# ---- storage ----------------------------------------------------------------------------


@query
def hourly_raw(spark, sf):
    return storage.hourly_raw(probes(spark, sf))


@query
def retention_30d(spark, sf):
    """Retention ten days after the newest event, so that a part of the data is old."""
    as_of = tables.newest_event(spark, sf) + RETENTION_SHIFT_S
    kept = storage.retained(probes(spark, sf), as_of)
    return kept.select("event_id", "ts", "unix_ts", "region_id")


@query
def dedup_events(spark, sf):
    """Every record delivered twice, outage records three times."""
    p = probes(spark, sf).select("event_id", "ts", "region_id", "state", "avg_rtt_ms")
    again = probes(spark, sf).filter("outage_detected").select(*p.columns)
    return ndjson.dedup_events(p.unionByName(p).unionByName(again))


# ---- windows and state ------------------------------------------------------------------


def _week_window(spark, sf):
    return speed.trailing_window(
        probes(spark, sf), tables.newest_event(spark, sf), WEEK_S
    )


@query
def trailing_window(spark, sf):
    return _week_window(spark, sf)


@query
def microbatch_aggregates(spark, sf):
    return speed.microbatch_aggregates(probes(spark, sf))


@query
def sliding_windows(spark, sf):
    return speed.sliding_windows(probes(spark, sf))


@query
def speed_global(spark, sf):
    return speed.speed_global(speed.sliding_windows(probes(spark, sf)))


@query
def kpi_history(spark, sf):
    windows = speed.sliding_windows(probes(spark, sf))
    return speed.kpi_history(speed.speed_global(windows))


@query
def trending_issues(spark, sf):
    p, as_of = probes(spark, sf), tables.newest_event(spark, sf)
    return speed.trending_issues(p, as_of, WEEK_S)


@query
def current_state(spark, sf):
    return latest.latest_per_key(probes(spark, sf))


@query
def live_global(spark, sf):
    return speed.live_global(latest.latest_per_key(probes(spark, sf)))


@query
def normalized_regions(spark, sf):
    return serving.normalized_regions(latest.latest_per_key(probes(spark, sf)))


@query
def state_upsert_ttl(spark, sf):
    """State of everything but the last day, then the last day applied to it."""
    p, as_of = probes(spark, sf), tables.newest_event(spark, sf)
    day_ago = as_of - 86_400
    before, last_day = p.filter(F.col("unix_ts") < day_ago), p.filter(F.col("unix_ts") >= day_ago)
    stored = latest.upsert_state(None, before, day_ago, STATE_WINDOW_S)
    return latest.upsert_state(stored, last_day, as_of, STATE_WINDOW_S)


@query
def live_events(spark, sf):
    return feed.live_events(feed.feed_event(probes(spark, sf)))


# ---- serving ----------------------------------------------------------------------------


def _merged(spark, sf, ordered=False):
    p, as_of = probes(spark, sf), tables.newest_event(spark, sf)
    window = speed.trailing_window(p, as_of, MERGE_WINDOW_S, ordered=False)
    # p95 within 1/10000 of rank, so one pass will do
    latency = history.latency_sketch(p, ordered=False)
    return serving.merge_regions(window, latency, ordered)


def _stored_merged(spark, sf):
    """The merged view as readers see it: a stored table."""
    return settle(_merged(spark, sf), "merged")


@query
def merge_regions(spark, sf):
    return _merged(spark, sf, ordered=True).select(
        "*",
        F.col("data_sources.speed_layer").alias("from_speed"),
        F.col("data_sources.batch_layer").alias("from_batch"),
    ).drop("data_sources")


@query
def merge_global(spark, sf):
    p, as_of = probes(spark, sf), tables.newest_event(spark, sf)
    window = speed.trailing_window(p, as_of, MERGE_WINDOW_S, ordered=False)
    window = settle(window, "window_view")
    latency = history.latency_sketch(p, ordered=False)
    regions = serving.merge_regions(window, latency, ordered=False)
    totals = settle(history.global_summary(p), "batch_totals")
    return serving.merge_global(regions, totals, speed.speed_global(window))


@query
def top_affected_regions(spark, sf):
    return serving.top_affected_regions(_merged(spark, sf)).drop("data_sources")


@query
def event_region_context(spark, sf):
    return feed.event_region_context(
        feed.feed_event(probes(spark, sf)), _merged(spark, sf)
    )


@query
def feed_counters(spark, sf):
    events = feed.feed_event(probes(spark, sf))
    return feed.feed_counters(events, _stored_merged(spark, sf))


@query
def observability_summary(spark, sf):
    return alerts.observability_summary(_merged(spark, sf))


@query
def incidents(spark, sf):
    return alerts.incidents(_stored_merged(spark, sf))


@query
def incident_timeline(spark, sf):
    found = alerts.incidents(_stored_merged(spark, sf))
    return alerts.incident_timeline(found, episodes.outage_episodes(probes(spark, sf)))


@query
def alert_list(spark, sf):
    return alerts.alerts(_stored_merged(spark, sf))


QUERIES["alerts"] = QUERIES.pop("alert_list")


@query
def alert_dedupe(spark, sf):
    live = alerts.live_alerts(feed.feed_event(probes(spark, sf)), None)
    return alerts.alert_dedupe(live, alerts.alerts(_stored_merged(spark, sf)))


# ---- files and streams ------------------------------------------------------------------


def _ndjson(spark, sf):
    path = fresh_path(spark, "ndjson")
    tables.ndjson_copy(spark, sf, path)
    return path


@query
def read_probes(spark, sf):
    """Probe rows written as NDJSON and read back under the fixed schema."""
    rows = ndjson.read_probes(spark, _ndjson(spark, sf))
    return rows.select(
        "event_id", "ts", "unix_ts", "region_id", "avg_rtt_ms", "hop_count", "is_reachable",
        "outage_detected", "health_score", "state",
    )


@query
def compact_history(spark, sf):
    """NDJSON compacted to hourly Parquet; what each hour holds."""
    path = fresh_path(spark, "history")
    compact.compact_history(spark, _ndjson(spark, sf), path)
    stored = ndjson.read_history(spark, path)
    return stored.groupBy("hour").agg(
        F.count(F.lit(1)).alias("records"), F.avg("health_score").alias("avg_health_score")
    )


def _damaged(lines: DataFrame) -> DataFrame:
    """Lines of a copy, every tenth cut short and every tenth with a text for a number."""
    number = F.get_json_object("value", "$.event_id").cast("bigint") % 10
    wrong = F.regexp_replace("value", r'"hop_count":(\d+)', '"hop_count":"n$1"')
    cut = F.substring("value", 2, 1_000_000)
    return lines.select(F.when(number == 0, cut).when(number == 1, wrong).otherwise(F.col("value")).alias("value"))


@query
def lenient_ndjson(spark, sf):
    """Damaged lines: a wrong field becomes null, a line that is no object a reject."""
    path = fresh_path(spark, "damaged")
    _damaged(spark.read.text(_ndjson(spark, sf))).write.text(path)
    rows, rejects = ndjson.lenient_ndjson(spark, path)
    kept = rows.select(F.lit("row").alias("kind"), "hop_count")
    broken = rejects.select(F.lit("reject").alias("kind"), F.lit(None).cast("int").alias("hop_count"))
    return kept.unionByName(broken).groupBy("kind", "hop_count").agg(F.count(F.lit(1)).alias("records"))


@query
def compact_incremental(spark, sf):
    """Two deliveries: the second brings late records of stored hours, records of the first
    once more, and both hold records without an id."""
    lines = spark.read.text(_ndjson(spark, sf))
    number = F.get_json_object("value", "$.event_id").cast("bigint")
    nameless = F.regexp_replace("value", r'"event_id":"?\d+"?,', "")
    lines = lines.select(F.when(number % 11 == 0, nameless).otherwise(F.col("value")).alias("value"), number.alias("n"))
    late = F.col("n") % 3 == 0
    again = (F.col("n") % 7 == 0) & (F.col("n") % 11 != 0)
    first, second, table = (fresh_path(spark, f"delivery_{i}") for i in ("a", "b", "table"))
    lines.filter(~late).select("value").write.text(first)
    lines.filter(late | again).select("value").write.text(second)
    compact.compact_history(spark, first, table)
    compact.compact_history(spark, second, table)
    stored = ndjson.read_history(spark, table)
    return stored.groupBy("hour").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("event_id").isNull()).alias("nameless")
    )


@query
def raw_archive_stream(spark, sf):
    """The newer half of the records arrives first: the archive holds late ones too."""
    lines = spark.read.text(_ndjson(spark, sf))
    half = F.get_json_object("value", "$.unix_ts").cast("bigint") >= tables.newest_event(spark, sf) - 15 * 86_400
    source_, path = fresh_path(spark, "arriving"), fresh_path(spark, "archive")
    lines.filter(half).write.text(source_)
    lines.filter(~half).write.mode("append").text(source_)
    _run(spark, jobs.raw_history(ndjson.probe_stream(spark, source_, 50), path))
    return storage.hourly_raw(ndjson.read_history(spark, path).drop("hour"))


def _run(spark, writer, progress: str | None = None) -> None:
    query_ = jobs.paced(writer, progress or fresh_path(spark, "progress"), every=None).start()
    query_.awaitTermination()


LIFECYCLE_SHIFT_S = 20 * 86_400


@query
def archive_lifecycle(spark, sf):
    """One archive through its life: two thirds of the records stream in, hours are compacted,
    late and repeated records stream in, the oldest ten days expire, a delivery brings records
    once more, and what changed is compacted again."""
    lines = spark.read.text(_ndjson(spark, sf))
    number = F.get_json_object("value", "$.event_id").cast("bigint")
    source_, root, progress = (fresh_path(spark, f"life_{p}") for p in ("in", "archive", "progress"))
    lines.filter(number % 3 != 0).write.text(source_)
    _run(spark, archive.archive_stream(ndjson.probe_stream(spark, source_, 50), root), progress)
    archive.compact_archive(spark, root, least=1)
    lines.filter((number % 3 == 0) | (number % 7 == 0)).write.mode("append").text(source_)
    _run(spark, archive.archive_stream(ndjson.probe_stream(spark, source_, 50), root), progress)
    as_of = spark.range(1).select(tables.newest_event(spark, sf)).first()[0] + LIFECYCLE_SHIFT_S
    archive.expire_archive(spark, root, as_of)
    delivery = fresh_path(spark, "life_delivery")
    lines.filter(number % 5 == 0).write.text(delivery)
    archive.append_delivery(spark, delivery, root, as_of)
    archive.expire_archive(spark, root, as_of)
    archive.compact_archive(spark, root)
    snapshots.vacuum(spark, root, keep=1, grace_s=0)
    stored = archive.read_archive(spark, root)
    return stored.groupBy("hour").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("event_id").alias("events"),
        F.avg("health_score").alias("avg_health_score"),
    )


@query
def batch_incremental(spark, sf):
    """Batch views of an archive after a first run over all but the last two hours and a second
    over these: the summary per region with its last outage episode."""
    root, store = fresh_path(spark, "increment"), fresh_path(spark, "increment_archive")
    p = jobs.as_probe_rows(probes(spark, sf))
    late = F.col("unix_ts") >= tables.newest_event(spark, sf) - 3_600
    snapshots.append(storage.time_ordered(storage.with_hour(p.filter(~late))), store)
    incremental.refresh(spark, store, root)
    snapshots.append(storage.time_ordered(storage.with_hour(p.filter(late))), store)
    incremental.refresh(spark, store, root)
    made = incremental.views(incremental.stored_cube(spark, root), incremental.stored_episodes(spark, root))
    return made["batch_summary"].join(made["last_episodes"], "region_id", "left")


def _cube(spark, sf) -> DataFrame:
    """The stored cube of all records, with its hours as times."""
    rows = incremental.cube_rows(storage.with_hour(probes(spark, sf)))
    stored = settle(rows, "cube")
    return stored.withColumn("hour", F.to_timestamp("hour", "yyyyMMdd_HH"))


@query
def latency_range(spark, sf):
    """Median and 95th percentile of the last week's hours from the cube's sketches: whether the
    rank of each among the records is within 2.5 % of what it should be."""
    start = F.date_trunc("hour", F.timestamp_seconds(tables.newest_event(spark, sf) - WEEK_S))
    view = incremental.latency_range(_cube(spark, sf).filter(F.col("hour") >= start))
    view = settle(view.select("region_id", "probe_count", "p50_latency_ms", "p95_latency_ms"), "ranges")
    rows = probes(spark, sf).filter(F.date_trunc("hour", "ts") >= start).select("region_id", "avg_rtt_ms")
    near = [
        (F.count_if(F.col("avg_rtt_ms") < F.col(c)) / F.count(F.lit(1)) <= p + 0.025)
        & (F.count_if(F.col("avg_rtt_ms") <= F.col(c)) / F.count(F.lit(1)) >= p - 0.025)
        for c, p in (("p50_latency_ms", 0.5), ("p95_latency_ms", 0.95))
    ]
    return rows.join(view, "region_id").groupBy("region_id", "probe_count").agg(
        near[0].alias("p50_near"), near[1].alias("p95_near")
    )


@query
def outage_overlap(spark, sf):
    """Regions with an outage in the last hour of records, in the day before it, and in both."""
    cube, end = _cube(spark, sf), F.date_trunc("hour", F.timestamp_seconds(tables.newest_event(spark, sf)))
    day = end - F.expr("INTERVAL 1 DAY")
    return incremental.regions_in_outage(
        cube.filter(F.col("hour") >= end), cube.filter((F.col("hour") < end) & (F.col("hour") >= day))
    )


@query
def stream_sliding_windows(spark, sf):
    """The events table as a stream: every window its watermark closes."""
    path = fresh_path(spark, "windows")
    _run(spark, jobs.sliding_window_table(tables.probes(spark, sf, stream=True), path))
    return spark.read.parquet(path)


@query
def stream_outage_alerts(spark, sf):
    """The push stream of outage records, kept in a table."""
    path = fresh_path(spark, "alerts")
    alerts_ = feed.outage_alert_stream(tables.probes(spark, sf, stream=True))
    _run(spark, alerts_.writeStream.format("parquet").option("path", path))
    return spark.read.parquet(path)


@query
def stream_live_state(spark, sf):
    """The live views kept by the speed layer over the events as a stream: latest state."""
    root = fresh_path(spark, "live")
    rows = tables.probes(spark, sf, stream=True).select(
        "*", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp")
    )
    _run(spark, jobs.speed_layer(jobs.as_probe_rows(rows), root, STATE_WINDOW_S))
    return serve.live_state(spark, root)


@query
def windows_repaired(spark, sf):
    """The table of sliding windows after all records but a third of the last two days', and then
    after these."""
    root, store = fresh_path(spark, "repair"), fresh_path(spark, "repair_archive")
    p = jobs.as_probe_rows(probes(spark, sf))
    recent = F.col("unix_ts") >= tables.newest_event(spark, sf) - 2 * 86_400
    late = (F.col("event_id").cast("bigint") % 3 == 0) & recent
    for part in (p.filter(~late), p.filter(late)):
        snapshots.append(storage.time_ordered(storage.with_hour(part)), store)
        incremental.repair_windows(spark, store, root)
    return incremental.stored_windows(spark, root)


SESSION_GAPS = ("6 hours", "3 hours")


@query
def outage_sessions(spark, sf):
    """Outages by silence: six hours after a critical record, three after another."""
    return stateful.outage_sessions(probes(spark, sf), *SESSION_GAPS).drop("closed_at")


@query
def stream_outage_sessions(spark, sf):
    """The same sessions from the events as a stream, as far as its watermark closes them."""
    path = fresh_path(spark, "sessions")
    rows = stateful.outage_sessions(tables.probes(spark, sf, stream=True), *SESSION_GAPS)
    _run(spark, stateful.appended(rows, path))
    return spark.read.parquet(path).drop("closed_at")


@query
def stream_alert_windows(spark, sf):
    """Critical records joined with their region's outage window of an hour, two streams; those
    that both watermarks have passed."""
    path, hour = fresh_path(spark, "alert_windows"), 3600
    stream = [tables.probes(spark, sf, stream=True) for _ in range(2)]
    _run(spark, stateful.appended(stateful.alerts_with_window(*stream, hour), path))
    # the stream of critical records has the later watermark of the two
    newest = probes(spark, sf).filter("state = 'critical'").agg(F.max("unix_ts")).scalar()
    passed = F.unix_seconds("alert_ts") < newest - 3 * hour
    return spark.read.parquet(path).filter(passed)


@query
def stream_state_log(spark, sf):
    """Latest state per region from the log of changes that a streaming aggregation writes."""
    root = fresh_path(spark, "state_log")
    _run(spark, stateful.state_log(tables.probes(spark, sf, stream=True), root, STATE_WINDOW_S))
    now = spark.range(1).select(tables.newest_event(spark, sf)).first()[0]
    return stateful.logged_state(spark, root, now, STATE_WINDOW_S)


# ---- search, seasons, heavy hitters, drift ----------------------------------------------


@query
def feed_search_index(spark, sf):
    """The search of `feed_search` through a trigram index of the whole feed."""
    return feed.indexed_search(feed.search_index(feed.feed_event(probes(spark, sf))), "COUNTRY 3")


@query
def seasonal_drop(spark, sf):
    """Hours far below the same hour of earlier days, by region."""
    return episodes.seasonal_drop(probes(spark, sf), season_h=24, seasons=14)


@query
def window_issues(spark, sf):
    """The five most frequent issues of every day-long window that begins on an hour."""
    return speed.window_issues(speed.issue_panes(probes(spark, sf)), 86_400)


@query
def schema_drift(spark, sf):
    """Fields outside the schema, with their types: two are put into some of the records."""
    lines = spark.read.text(_ndjson(spark, sf))
    number = F.get_json_object("value", "$.event_id").cast("bigint")
    with_sensor = F.concat(F.expr("left(value, length(value) - 1)"), F.lit(',"sensor":{"id":"s1","gain":0.5}}'))
    with_jitter = F.concat(
        F.expr("left(value, length(value) - 1)"), F.when(number % 2 == 0, ',"jitter_ms":7}').otherwise(',"jitter_ms":"7"}')
    )
    value = F.when(number % 4 == 1, with_sensor).when(number % 6 < 2, with_jitter).otherwise(F.col("value"))
    return drift.schema_drift(drift.variant_lines(lines.select(value.alias("value"))))
