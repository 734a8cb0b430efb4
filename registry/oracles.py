"""The registered queries in plain SQL, written against the driver tables on their own."""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(floor(epoch(ts)) AS BIGINT) AS unix_ts
  FROM events
)"""

DIM = """
dim AS (
  SELECT n_nationkey AS region_key, n_name AS region_id, 'Region ' || n_name AS region_name,
         'C' || CAST(n_nationkey % 10 AS VARCHAR) AS country_code,
         'Country ' || CAST(n_nationkey % 10 AS VARCHAR) AS country_name,
         r_name AS continent,
         CAST(n_nationkey * 5 - 60 AS DOUBLE) AS lat, CAST(n_nationkey * 14 - 170 AS DOUBLE) AS lon,
         '' AS flag, 'ISP' || CAST(n_nationkey % 7 AS VARCHAR) AS provider
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

PROBES = f"""
{EVENTS}, {DIM},
measured AS (
  SELECT event_id, ts, unix_ts,
         'probe-' || region_id || '-' || CAST(user_id % 5 + 1 AS VARCHAR) AS probe_id,
         region_id, region_name, country_code, country_name, continent, lat, lon, flag, provider,
         value * 4 AS avg_rtt_ms, value * 3 AS min_rtt_ms, value * 6 AS max_rtt_ms,
         k * CAST(0.4 AS DOUBLE) AS packet_loss_pct, k % 15 + 6 AS hop_count,
         CASE WHEN event_type <> 'error' THEN 'healthy' WHEN k % 4 = 0 THEN 'critical'
              WHEN k % 4 = 1 THEN 'warning' ELSE 'degraded' END AS state,
         k
  FROM ev JOIN dim ON user_id % 25 = region_key
),
reached AS (
  SELECT *, NOT (state = 'critical' AND k % 5 < 2) AS is_reachable,
         state IN ('warning', 'critical') OR packet_loss_pct > 30 AS outage_detected
  FROM measured
),
probes AS (
  SELECT *, CASE WHEN NOT is_reachable THEN CAST(0 AS DOUBLE) ELSE
      greatest(CAST(0 AS DOUBLE), CAST(100 AS DOUBLE)
        - least(CAST(40 AS DOUBLE), greatest(CAST(0 AS DOUBLE),
                (avg_rtt_ms - CAST(30 AS DOUBLE)) / CAST(12 AS DOUBLE)))
        - least(CAST(40 AS DOUBLE), packet_loss_pct * CAST(0.8 AS DOUBLE))) END AS health_score
  FROM reached
),
clock AS (SELECT max(unix_ts) AS as_of FROM ev)"""

REGION = "region_id, region_name, country_code, country_name, continent, lat, lon, flag, provider"
BAND = (
    "CASE WHEN {0} >= 80 THEN 'healthy' WHEN {0} >= 60 THEN 'degraded' "
    "WHEN {0} >= 40 THEN 'warning' ELSE 'critical' END"
)
AT = "make_timestamp(CAST({0} AS BIGINT) * 1000000)"


def sql(body: str, *doubles: str, ctes: str = PROBES) -> str:
    """``body`` with the shared CTEs, its double columns put on the 1e-4 grid."""
    grid = ", ".join(f"floor({c} * 1e4 + 0.50001) / 1e4 AS {c}" for c in doubles)
    star = f"* REPLACE ({grid})" if grid else "*"
    head, _, tail = body.rpartition("---")
    extra = f", {head}" if head.strip() else ""
    return f"WITH {ctes}{extra} SELECT {star} FROM ({tail}) AS result"


LATENCY = f"""
SELECT {REGION}, count(*) AS probe_count,
       avg(avg_rtt_ms) AS avg_latency_ms, min(avg_rtt_ms) AS min_latency_ms,
       max(avg_rtt_ms) AS max_latency_ms,
       quantile_disc(avg_rtt_ms, 0.5) AS p50_latency_ms,
       quantile_disc(avg_rtt_ms, 0.95) AS p95_latency_ms,
       avg(packet_loss_pct) AS avg_packet_loss_pct, avg(health_score) AS avg_health_score
FROM probes GROUP BY {REGION}"""
LATENCY_DOUBLES = (
    "avg_latency_ms", "min_latency_ms", "max_latency_ms", "p50_latency_ms", "p95_latency_ms",
    "avg_packet_loss_pct", "avg_health_score",
)

OUTAGES = """
SELECT country_code, country_name, count(*) AS outage_events,
       count(DISTINCT region_id) AS affected_regions,
       avg(packet_loss_pct) AS avg_packet_loss_during_outage,
       avg(avg_rtt_ms) AS avg_latency_during_outage
FROM probes WHERE outage_detected GROUP BY country_code, country_name"""


def windowed(rows: str, unknown: str) -> str:
    """Sums per region of a CTE and the newest row's metadata."""
    return f"""
{rows}_last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY region_id
                                              ORDER BY ts DESC, event_id DESC) AS rn FROM {rows})
  WHERE rn = 1),
{rows}_sum AS (
  SELECT region_id, count(*) AS sample_count, avg(health_score) AS avg_health_score,
         avg(avg_rtt_ms) AS avg_latency_ms, avg(packet_loss_pct) AS avg_packet_loss,
         min(avg_rtt_ms) AS min_latency_ms, max(avg_rtt_ms) AS max_latency_ms,
         count(*) FILTER (outage_detected) AS outage_count
  FROM {rows} GROUP BY region_id),
{rows}_agg AS (
  SELECT s.*, l.region_name, l.country_code, l.country_name, l.continent, l.lat, l.lon, l.flag,
         l.provider, coalesce(l.state, '{unknown}') AS current_state, l.ts AS last_ts,
         s.outage_count > s.sample_count * CAST(0.3 AS DOUBLE) AS is_outage
  FROM {rows}_sum s JOIN {rows}_last l ON s.region_id = l.region_id)"""


def trailing(seconds: int) -> str:
    return f"""
recent AS (SELECT p.* FROM probes p, clock
           WHERE p.unix_ts BETWEEN as_of - {seconds} AND as_of),
{windowed('recent', 'unknown')}"""


WINDOW_DOUBLES = ("avg_health_score", "avg_latency_ms", "avg_packet_loss")

SLIDING = f"""
slid AS (
  SELECT unix_ts - unix_ts % 60 - 60 * i AS start_s, p.*
  FROM probes p, (SELECT unnest(range(5)) AS i)),
windows AS (
  SELECT {AT.format('start_s')} AS window_start, {AT.format('start_s + 300')} AS window_end,
         region_id, count(*) AS sample_count, avg(health_score) AS avg_health_score,
         avg(avg_rtt_ms) AS avg_latency_ms, avg(packet_loss_pct) AS avg_packet_loss,
         count(*) FILTER (outage_detected) AS outage_count,
         count(*) FILTER (outage_detected) > count(*) * CAST(0.3 AS DOUBLE) AS is_outage
  FROM slid GROUP BY start_s, region_id),
kpis AS (
  SELECT window_end AS computed_at, avg(avg_health_score) AS global_health_score,
         avg(avg_latency_ms) AS global_avg_latency, avg(avg_packet_loss) AS global_avg_loss,
         count(*) FILTER (is_outage) AS active_outages, count(*) AS regions_monitored,
         'speed' AS layer
  FROM windows GROUP BY window_end)"""
KPI_DOUBLES = ("global_health_score", "global_avg_latency", "global_avg_loss")

NEWEST = """
state AS (
  SELECT * EXCLUDE (rn, k) FROM (
    SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM probes)
  WHERE rn = 1)"""

MERGED = f"""
{trailing(7200)},
latency AS ({LATENCY}),
merged AS (
  SELECT *, (100 - current_health_score) * CAST(0.6 AS DOUBLE) + current_packet_loss
            + CASE WHEN is_outage THEN 20 ELSE 0 END AS impact_score,
         {BAND.format('current_health_score')} AS status
  FROM (
    SELECT coalesce(s.region_id, b.region_id) AS region_id,
           coalesce(s.region_name, b.region_name) AS region_name,
           coalesce(s.country_code, b.country_code) AS country_code,
           coalesce(s.country_name, b.country_name) AS country_name,
           coalesce(s.continent, b.continent) AS continent,
           coalesce(s.lat, b.lat) AS lat, coalesce(s.lon, b.lon) AS lon,
           coalesce(s.flag, b.flag) AS flag, coalesce(s.provider, b.provider) AS provider,
           coalesce(s.avg_health_score, b.avg_health_score) AS current_health_score,
           coalesce(s.avg_latency_ms, b.avg_latency_ms) AS current_latency_ms,
           coalesce(s.avg_packet_loss, b.avg_packet_loss_pct) AS current_packet_loss,
           coalesce(s.is_outage, FALSE) AS is_outage,
           coalesce(s.current_state, 'healthy') AS state,
           coalesce(b.avg_health_score, s.avg_health_score) AS hist_health_score,
           coalesce(b.avg_latency_ms, s.avg_latency_ms) AS hist_latency_ms,
           coalesce(b.avg_packet_loss_pct, s.avg_packet_loss) AS hist_packet_loss,
           coalesce(b.probe_count, 0) AS hist_probe_count, b.p95_latency_ms AS hist_p95_latency_ms,
           s.region_id IS NOT NULL AS from_speed, b.region_id IS NOT NULL AS from_batch
    FROM recent_agg s FULL OUTER JOIN latency b ON s.region_id = b.region_id)),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY impact_score DESC, region_id) AS rank FROM merged)"""
MERGED_DOUBLES = (
    "current_health_score", "current_latency_ms", "current_packet_loss", "hist_health_score",
    "hist_latency_ms", "hist_packet_loss", "hist_p95_latency_ms", "impact_score",
)

FEED = """
feed AS (
  SELECT ts, CAST(event_id AS VARCHAR) AS event_id, region_id, region_name,
         country_name AS country, flag, state AS severity, avg_rtt_ms AS latency_ms,
         packet_loss_pct AS packet_loss, health_score AS health,
         'Network telemetry' AS event_type
  FROM probes)"""
FEED_DOUBLES = ("latency_ms", "packet_loss", "health")

EPISODES = """
runs AS (
  SELECT *, count(*) FILTER (NOT outage_detected)
         OVER (PARTITION BY region_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM probes),
episodes AS (
  SELECT region_id, country_code, country_name, min(ts) AS start_ts, max(ts) AS end_ts,
         (epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(1e6 AS DOUBLE) AS duration_s,
         count(*) AS records
  FROM runs WHERE outage_detected GROUP BY region_id, country_code, country_name, run)"""

SESSIONS = """
gapped AS (
  SELECT *, ts + CASE WHEN state = 'critical' THEN INTERVAL 6 HOUR ELSE INTERVAL 3 HOUR END AS until
  FROM probes WHERE outage_detected),
begun AS (
  SELECT *, CASE WHEN ts <= max(until) OVER (PARTITION BY region_id ORDER BY ts, event_id
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 THEN 0 ELSE 1 END AS first
  FROM gapped),
numbered AS (
  SELECT *, sum(first) OVER (PARTITION BY region_id ORDER BY ts, event_id) AS session FROM begun),
sessions AS (
  SELECT region_id, min(ts) AS start_ts, max(ts) AS end_ts, max(until) AS closed_at,
         (epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(1e6 AS DOUBLE) AS duration_s,
         count(*) AS records, max(packet_loss_pct) AS worst_loss_pct
  FROM numbered GROUP BY region_id, session)"""
SESSION_DOUBLES = ("duration_s", "worst_loss_pct")

ALERTS = """
raised AS (
  SELECT 'alert-' || CAST(row_number() OVER (ORDER BY rank) AS VARCHAR) AS id,
         region_name || ' traffic anomaly' AS title,
         CASE WHEN current_health_score < 60 THEN 'critical' ELSE 'warning' END AS severity,
         'Latency ' || format('{:.1f}', floor(current_latency_ms * 10 + 0.5) / 10)
           || 'ms and loss ' || format('{:.2f}', floor(current_packet_loss * 100 + 0.5) / 100)
           || '%' AS message
  FROM ranked WHERE rank <= 6 AND current_health_score < 80),
alerts AS (
  SELECT * FROM raised
  UNION ALL
  SELECT 'alert-0', 'All services nominal', 'information',
         'No critical issues detected across monitored regions.'
  WHERE NOT EXISTS (SELECT 1 FROM raised))"""

INCIDENTS = """
incidents AS (
  SELECT 'inc-' || CAST(rank AS VARCHAR) AS id, region_name || ' degradation' AS title,
         CASE WHEN current_health_score >= 70 THEN 'warning' ELSE 'critical' END AS severity,
         region_name AS region, region_id, current_health_score AS score
  FROM ranked WHERE rank <= 8 AND current_health_score < 90)"""

LANGUAGES = """
languages AS (
  SELECT * FROM (VALUES ('click', 'NATION_1'), ('view', 'NATION_2'), ('signup', 'NATION_3'),
                        ('purchase', 'NATION_4')) AS t(language, lang_region))"""

HOUR = "date_trunc('hour', {0})"
DAY_AGO = "unix_ts >= (SELECT as_of FROM clock) - 86400"

ORACLES: dict[str, str] = {
    "health_score": sql("SELECT event_id, health_score FROM probes", "health_score"),
    "outage_flag": sql(
        "SELECT event_id, state, packet_loss_pct, outage_detected FROM probes", "packet_loss_pct"
    ),
    "status_band": sql(f"SELECT event_id, {BAND.format('health_score')} AS status FROM probes"),
    "domain_region": sql(
        f"""{LANGUAGES} ---
        SELECT event_id, event_type || '.example.org' AS domain, language, {REGION}
        FROM ev JOIN languages ON event_type = language JOIN dim ON region_id = lang_region""",
        "lat", "lon",
    ),
    "edit_activity": sql(
        f"""{LANGUAGES} ---
        SELECT event_id, date_trunc('second', ts) AS ts, unix_ts,
               'wiki-' || event_type || '.example.org' AS probe_id, {REGION},
               'wikimedia.org' AS target_ip,
               'Wikipedia (' || event_type || '.example.org)' AS target_name,
               TRUE AS is_reachable, FALSE AS outage_detected, 'healthy' AS state,
               'wikimedia-edit-proxy' AS measurement_type,
               event_type || '.example.org' AS wiki_domain,
               CASE WHEN k % 2 = 0 THEN 'edit' ELSE 'categorize' END AS wiki_type,
               k % 3 = 0 AS is_bot
        FROM ev JOIN languages ON event_type = language JOIN dim ON region_id = lang_region""",
        "lat", "lon",
    ),
    "ripe_normalize": sql(
        """given AS (
          SELECT event_id, ts, user_id,
                 CASE WHEN k % 10 IN (0, 1) THEN CAST(999 AS DOUBLE)
                      WHEN value = 0 THEN CAST(999 AS DOUBLE) ELSE value * 10 END AS rtt,
                 CASE WHEN k % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(k AS DOUBLE) END AS loss
          FROM ev) ---
        SELECT event_id, ts, 'ripe-' || CAST(user_id AS VARCHAR) AS probe_id,
               'ripe-atlas' AS region_id, 'RIPE Atlas' AS region_name, 'XX' AS country_code,
               'Unknown' AS country_name, rtt AS avg_rtt_ms, loss AS packet_loss_pct,
               rtt < 999 AS is_reachable, rtt > 500 OR loss > 30 AS outage_detected,
               CASE WHEN rtt >= 999 THEN CAST(0 AS DOUBLE) ELSE
                 greatest(CAST(0 AS DOUBLE), CAST(100 AS DOUBLE)
                   - least(CAST(40 AS DOUBLE),
                           greatest(CAST(0 AS DOUBLE), (rtt - 30) / CAST(12 AS DOUBLE)))
                   - least(CAST(40 AS DOUBLE), loss * CAST(0.8 AS DOUBLE))) END AS health_score,
               'ping' AS measurement_type, 'ripe-atlas' AS source
        FROM given""",
        "avg_rtt_ms", "packet_loss_pct", "health_score",
    ),
    "envelope_decode": sql(
        "SELECT event_id, user_id, value FROM ev WHERE event_id % 3 IN (0, 1)", "value"
    ),
    "feed_event": sql(f"{FEED} --- SELECT * FROM feed", *FEED_DOUBLES),
    "feed_search": sql(
        f"""{FEED} --- SELECT * FROM feed
        WHERE lower(region_name || ' ' || country) LIKE '%country 3%'""",
        *FEED_DOUBLES,
    ),
    "outage_alert_stream": sql(
        """SELECT region_name AS region, country_name AS country, flag, state AS severity,
                  avg_rtt_ms AS latency, packet_loss_pct AS loss, health_score AS health, ts
        FROM probes WHERE outage_detected OR state IN ('warning', 'critical')""",
        "latency", "loss", "health",
    ),
    "metrics_long": sql(
        """SELECT event_id, ts, region_id AS region, country_code AS country, metric, value, unit
        FROM (
          SELECT *, 'HealthScore' AS metric, health_score AS value, 'None' AS unit FROM probes
          UNION ALL
          SELECT *, 'AvgLatencyMs', avg_rtt_ms, 'Milliseconds' FROM probes
          UNION ALL
          SELECT *, 'PacketLossPct', packet_loss_pct, 'Percent' FROM probes)""",
        "value",
    ),
    "latency_by_region": sql(LATENCY, "lat", "lon", *LATENCY_DOUBLES),
    "outage_frequency": sql(
        OUTAGES, "avg_packet_loss_during_outage", "avg_latency_during_outage"
    ),
    "hourly_health_trend": sql(
        f"""SELECT {HOUR.format('ts')} AS hour, region_id, region_name, country_code,
               avg(health_score) AS avg_health_score, avg(avg_rtt_ms) AS avg_latency_ms,
               avg(packet_loss_pct) AS avg_packet_loss_pct, count(*) AS sample_count
        FROM probes GROUP BY 1, 2, 3, 4""",
        "avg_health_score", "avg_latency_ms", "avg_packet_loss_pct",
    ),
    "global_summary": sql(
        """SELECT coalesce(avg(health_score), 0) AS global_health_score,
               coalesce(avg(avg_rtt_ms), 0) AS global_avg_latency,
               coalesce(avg(packet_loss_pct), 0) AS global_avg_loss, count(*) AS total_records,
               count(*) FILTER (outage_detected) AS total_outage_events,
               count(DISTINCT country_code) AS countries_monitored,
               count(DISTINCT region_id) AS regions_monitored FROM probes""",
        *KPI_DOUBLES,
    ),
    "country_rollup": sql(
        """SELECT country_code, count(*) AS probe_count, avg(avg_rtt_ms) AS avg_latency_ms,
               avg(packet_loss_pct) AS avg_packet_loss_pct,
               count(*) FILTER (outage_detected) AS total_outage_events,
               avg(health_score) AS avg_health_score,
               string_agg(DISTINCT region_id, ',' ORDER BY region_id) AS affected_regions
        FROM probes GROUP BY country_code""",
        "avg_latency_ms", "avg_packet_loss_pct", "avg_health_score",
    ),
    "region_rollup": sql(
        """SELECT region_id, avg(avg_rtt_ms) AS avg_latency, avg(packet_loss_pct) AS avg_loss,
               avg(health_score) AS avg_health, count(*) FILTER (outage_detected) AS outages
        FROM probes GROUP BY region_id""",
        "avg_latency", "avg_loss", "avg_health",
    ),
    "rank_percentiles": sql(
        """placed AS (
          SELECT region_id, avg_rtt_ms AS v,
                 row_number() OVER (PARTITION BY region_id ORDER BY avg_rtt_ms) - 1 AS pos,
                 count(*) OVER (PARTITION BY region_id) AS n
          FROM probes) ---
        SELECT region_id, max(n) AS n,
               max(v) FILTER (pos = CAST(floor(CAST(0.50 AS DOUBLE) * n) AS BIGINT)) AS p50,
               max(v) FILTER (pos = CAST(floor(CAST(0.95 AS DOUBLE) * n) AS BIGINT)) AS p95,
               max(v) FILTER (pos = CAST(floor(CAST(0.99 AS DOUBLE) * n) AS BIGINT)) AS p99,
               (max(v) FILTER (pos = (n - 1) // 2) + max(v) FILTER (pos = n // 2)) / 2 AS median,
               avg(v) AS mean
        FROM placed GROUP BY region_id""",
        "p50", "p95", "p99", "median", "mean",
    ),
    "top_affected": sql(
        f"""latency AS ({LATENCY}), outages AS ({OUTAGES}) ---
        SELECT l.country_code, l.country_name, avg_latency_ms, avg_packet_loss_pct,
               avg_health_score, coalesce(outage_events, 0) AS outage_events,
               coalesce(affected_regions, 0) AS affected_regions,
               (100 - avg_health_score) * CAST(0.6 AS DOUBLE)
                 + coalesce(outage_events, 0) * CAST(0.4 AS DOUBLE) AS impact_score
        FROM latency l LEFT JOIN outages o ON l.country_code = o.country_code
        ORDER BY impact_score DESC, region_id LIMIT 10""",
        "avg_latency_ms", "avg_packet_loss_pct", "avg_health_score", "impact_score",
    ),
    "batch_summary": sql(
        """SELECT country_code, country_name, region_id, region_name, continent,
               count(*) AS total_probes, avg(avg_rtt_ms) AS avg_latency_ms,
               min(avg_rtt_ms) AS min_latency_ms, max(avg_rtt_ms) AS max_latency_ms,
               avg(packet_loss_pct) AS avg_packet_loss_pct, avg(health_score) AS avg_health_score,
               CAST(sum(CAST(outage_detected AS INT)) AS BIGINT) AS total_outages
        FROM probes GROUP BY 1, 2, 3, 4, 5""",
        "avg_latency_ms", "min_latency_ms", "max_latency_ms", "avg_packet_loss_pct",
        "avg_health_score",
    ),
    "q_top_affected": sql(
        f"""SELECT country_code, country_name, avg(health_score) AS avg_health,
               avg(avg_rtt_ms) AS avg_latency, avg(packet_loss_pct) AS avg_loss,
               CAST(sum(CAST(outage_detected AS INT)) AS BIGINT) AS outage_events,
               count(*) AS probe_count
        FROM probes WHERE {DAY_AGO} GROUP BY 1, 2 ORDER BY avg_health, country_code LIMIT 10""",
        "avg_health", "avg_latency", "avg_loss",
    ),
    "q_latency_trend": sql(
        f"""SELECT {HOUR.format(AT.format('unix_ts'))} AS hour_bucket, country_code,
               avg(avg_rtt_ms) AS avg_latency_ms, avg(packet_loss_pct) AS avg_loss_pct,
               avg(health_score) AS avg_health
        FROM probes WHERE {DAY_AGO} AND country_code = 'C3' GROUP BY 1, 2""",
        "avg_latency_ms", "avg_loss_pct", "avg_health",
    ),
    "q_global_trend": sql(
        f"""SELECT {HOUR.format(AT.format('unix_ts'))} AS hour_bucket,
               avg(health_score) AS global_health, avg(avg_rtt_ms) AS global_latency,
               avg(packet_loss_pct) AS global_loss,
               CAST(sum(CAST(outage_detected AS INT)) AS BIGINT) AS outage_events
        FROM probes WHERE unix_ts >= (SELECT as_of FROM clock) - 604800 GROUP BY 1""",
        "global_health", "global_latency", "global_loss",
    ),
    "q_outage_hotspots": sql(
        f"""SELECT region_id, region_name, country_code, country_name,
               CAST(sum(CAST(outage_detected AS INT)) AS BIGINT) AS outage_count,
               avg(avg_rtt_ms) AS avg_latency_during_outage, avg(packet_loss_pct) AS avg_loss
        FROM probes WHERE outage_detected AND {DAY_AGO} GROUP BY 1, 2, 3, 4
        ORDER BY outage_count DESC, region_id LIMIT 10""",
        "avg_latency_during_outage", "avg_loss",
    ),
    "q_dataset_span": sql(
        """SELECT count(*) AS total_records, count(DISTINCT region_id) AS regions,
               min(unix_ts) AS first_ts, max(unix_ts) AS last_ts FROM probes"""
    ),
    "outage_episodes": sql(f"{EPISODES} --- SELECT * FROM episodes", "duration_s"),
    "outage_duration": sql(
        f"""{EPISODES} ---
        SELECT country_code, country_name, count(*) AS episodes,
               CAST(sum(records) AS BIGINT) AS outage_records,
               sum(duration_s) AS total_duration_s, max(duration_s) AS longest_s
        FROM episodes GROUP BY 1, 2""",
        "total_duration_s", "longest_s",
    ),
    "rate_drop": sql(
        f"""hourly AS (SELECT region_id, {HOUR.format('ts')} AS hour, count(*) AS events
                       FROM probes GROUP BY 1, 2),
        spans AS (SELECT region_id, min(hour) AS lo, max(hour) AS hi, sum(events) AS total
                  FROM hourly GROUP BY 1),
        grid AS (SELECT region_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour,
                        CAST(total AS DOUBLE) / (date_diff('hour', lo, hi) + 1) AS mean_per_hour
                 FROM spans) ---
        SELECT g.region_id, g.hour, coalesce(h.events, 0) AS events, mean_per_hour
        FROM grid g LEFT JOIN hourly h ON g.region_id = h.region_id AND g.hour = h.hour
        WHERE coalesce(h.events, 0) < mean_per_hour * CAST(0.5 AS DOUBLE)""",
        "mean_per_hour",
    ),
    "edit_rate_drop": sql(
        f"""{LANGUAGES}, edits AS (
          SELECT region_id, date_trunc('second', ts) AS ts
          FROM ev JOIN languages ON event_type = language JOIN dim ON region_id = lang_region),
        hourly AS (SELECT region_id, {HOUR.format('ts')} AS hour, count(*) AS events
                   FROM edits GROUP BY 1, 2),
        spans AS (SELECT region_id, min(hour) AS lo, max(hour) AS hi, sum(events) AS total
                  FROM hourly GROUP BY 1),
        grid AS (SELECT region_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour,
                        CAST(total AS DOUBLE) / (date_diff('hour', lo, hi) + 1) AS mean_per_hour
                 FROM spans) ---
        SELECT g.region_id, g.hour, coalesce(h.events, 0) AS events, mean_per_hour
        FROM grid g LEFT JOIN hourly h ON g.region_id = h.region_id AND g.hour = h.hour
        WHERE coalesce(h.events, 0) < mean_per_hour * CAST(0.5 AS DOUBLE)""",
        "mean_per_hour",
    ),
    "hourly_raw": sql(
        "SELECT strftime(ts, '%Y%m%d_%H') AS hour, count(*) AS records FROM probes GROUP BY 1"
    ),
    "retention_30d": sql(
        """SELECT event_id, ts, unix_ts, region_id FROM probes
        WHERE unix_ts >= (SELECT as_of FROM clock) + 864000 - 30 * 86400"""
    ),
    "dedup_events": sql(
        "SELECT event_id, ts, region_id, state, avg_rtt_ms FROM probes", "avg_rtt_ms"
    ),
    "trailing_window": sql(
        f"""{trailing(604800)} ---
        SELECT {REGION}, {AT.format('as_of - 604800')} AS window_start,
               {AT.format('as_of')} AS window_end, 604800 AS window_size_s, sample_count,
               avg_health_score, avg_latency_ms, avg_packet_loss,
               avg_health_score AS current_health_score, avg_latency_ms AS current_latency_ms,
               avg_packet_loss AS current_packet_loss, avg_health_score AS hist_health_score,
               avg_latency_ms AS hist_latency_ms, {BAND.format('avg_health_score')} AS status,
               100 - avg_health_score AS impact_score, min_latency_ms, max_latency_ms,
               outage_count, is_outage, current_state
        FROM recent_agg, clock""",
        "lat", "lon", *WINDOW_DOUBLES, "current_health_score", "current_latency_ms",
        "current_packet_loss", "hist_health_score", "hist_latency_ms", "impact_score",
        "min_latency_ms", "max_latency_ms",
    ),
    "microbatch_aggregates": sql(
        f"""{windowed('probes', 'healthy')} ---
        SELECT region_id, region_name, country_code, country_name, lat, lon, flag, sample_count,
               avg_health_score, avg_latency_ms, avg_packet_loss, outage_count, is_outage,
               current_state, last_ts AS updated_at
        FROM probes_agg""",
        "lat", "lon", *WINDOW_DOUBLES,
    ),
    "sliding_windows": sql(f"{SLIDING} --- SELECT * FROM windows", *WINDOW_DOUBLES),
    "speed_global": sql(f"{SLIDING} --- SELECT * FROM kpis", *KPI_DOUBLES),
    "kpi_history": sql(
        f"""{SLIDING} ---
        SELECT computed_at AS ts, global_health_score AS health_score,
               global_avg_latency AS latency_ms, global_avg_loss AS loss_pct
        FROM kpis ORDER BY computed_at DESC LIMIT 120""",
        "health_score", "latency_ms", "loss_pct",
    ),
    "trending_issues": sql(
        """SELECT region_id, region_name, state, count(*) AS occurrences,
               avg(health_score) AS avg_health_score
        FROM probes, clock WHERE unix_ts BETWEEN as_of - 604800 AND as_of AND state <> 'healthy'
        GROUP BY 1, 2, 3 ORDER BY occurrences DESC, region_id, state LIMIT 5""",
        "avg_health_score",
    ),
    "current_state": sql(
        f"{NEWEST} --- SELECT *, 'ping' AS measurement_type FROM state",
        "lat", "lon", "avg_rtt_ms", "min_rtt_ms", "max_rtt_ms", "packet_loss_pct", "health_score",
    ),
    "live_global": sql(
        f"""{NEWEST} ---
        SELECT avg(health_score) AS global_health_score, avg(avg_rtt_ms) AS global_avg_latency,
               avg(packet_loss_pct) AS global_avg_loss,
               count(*) FILTER (outage_detected) AS active_outages,
               count(*) AS regions_monitored, 'live' AS layer
        FROM state""",
        *KPI_DOUBLES,
    ),
    "normalized_regions": sql(
        f"""{NEWEST} ---
        SELECT {REGION}, health_score AS current_health_score, avg_rtt_ms AS current_latency_ms,
               packet_loss_pct AS current_packet_loss, outage_detected AS is_outage, state,
               {BAND.format('health_score')} AS status, health_score AS hist_health_score,
               avg_rtt_ms AS hist_latency_ms, 100 - health_score AS impact_score
        FROM state""",
        "lat", "lon", "current_health_score", "current_latency_ms", "current_packet_loss",
        "hist_health_score", "hist_latency_ms", "impact_score",
    ),
    "state_upsert_ttl": sql(
        f"""{NEWEST} ---
        SELECT region_id, CAST(event_id AS VARCHAR) AS event_id, ts, unix_ts, country_code,
               country_name, region_name, continent, provider, avg_rtt_ms, packet_loss_pct,
               health_score, is_reachable, outage_detected, state, lat, lon, flag,
               unix_ts + 7200 AS expires_at
        FROM state, clock WHERE unix_ts + 7200 > as_of""",
        "lat", "lon", "avg_rtt_ms", "packet_loss_pct", "health_score",
    ),
    "live_events": sql(
        f"{FEED} --- SELECT * FROM feed ORDER BY ts DESC, event_id DESC LIMIT 50", *FEED_DOUBLES
    ),
    "merge_regions": sql(
        f"{MERGED} --- SELECT * FROM merged", "lat", "lon", *MERGED_DOUBLES
    ),
    "merge_global": sql(
        f"""{MERGED} ---
        SELECT avg(current_health_score) AS global_health_score,
               avg(current_latency_ms) AS global_avg_latency,
               avg(current_packet_loss) AS global_avg_loss,
               count(*) FILTER (is_outage) AS active_outages, count(*) AS regions_monitored,
               (SELECT count(*) FROM probes) AS total_records_batch,
               (SELECT count(*) FROM probes WHERE outage_detected) AS total_outage_events,
               (SELECT avg(health_score) FROM probes) AS batch_health,
               (SELECT avg(avg_health_score) FROM recent_agg) AS speed_health,
               'merged' AS layer
        FROM merged""",
        *KPI_DOUBLES, "batch_health", "speed_health",
    ),
    "top_affected_regions": sql(
        f"""{MERGED} --- SELECT * EXCLUDE (from_speed, from_batch) FROM merged
        ORDER BY impact_score DESC, region_id LIMIT 10""",
        "lat", "lon", *MERGED_DOUBLES,
    ),
    "event_region_context": sql(
        f"""{MERGED}, {FEED} ---
        SELECT f.event_id, f.ts, f.severity, m.region_id AS matched_region_id,
               coalesce(m.region_name, f.region_name) AS region_name, m.provider,
               coalesce(m.is_outage, lower(f.severity) = 'critical') AS is_outage,
               coalesce(m.current_health_score, f.health) AS current_health_score,
               coalesce(m.current_latency_ms, f.latency_ms) AS current_latency_ms,
               coalesce(m.current_packet_loss, f.packet_loss) AS current_packet_loss
        FROM feed f LEFT JOIN merged m
          ON m.region_id = f.region_id
             OR (m.region_name = f.region_name
                 AND NOT EXISTS (SELECT 1 FROM merged x WHERE x.region_id = f.region_id))""",
        "current_health_score", "current_latency_ms", "current_packet_loss",
    ),
    "feed_counters": sql(
        f"""{MERGED}, {FEED} ---
        SELECT count(*) FILTER (severity = 'warning') AS warning_events,
               count(*) AS total_events,
               (SELECT count(*) FILTER (is_outage) FROM merged) AS outage_regions
        FROM feed"""
    ),
    "observability_summary": sql(
        f"""{MERGED},
        raw AS (SELECT floor(avg(current_latency_ms) * 10 + 0.5) / 10 AS latency,
                       floor(avg(current_packet_loss) * 100 + 0.5) / 100 AS packet_loss,
                       floor(avg(current_health_score) * 10 + 0.5) / 10 AS overall,
                       count(*) FILTER (current_health_score >= 80) AS healthy_regions,
                       count(*) FILTER (current_health_score < 60) AS failed_regions,
                       count(*) FILTER (is_outage OR current_health_score < 60)
                         AS active_incidents
                FROM merged) ---
        SELECT overall, CAST(floor(overall) AS INTEGER) AS availability, packet_loss, latency,
               active_incidents, healthy_regions, failed_regions,
               CAST(floor(400 + (100 - overall) * 2) AS INTEGER) AS requests_per_sec,
               CASE WHEN latency > 80 THEN 'warning' ELSE 'healthy' END AS latency_tone,
               CASE WHEN packet_loss > 1 THEN 'warning' ELSE 'healthy' END AS loss_tone,
               CASE WHEN overall >= 80 THEN 'healthy' ELSE 'critical' END AS availability_tone
        FROM raw""",
        "overall", "packet_loss", "latency",
    ),
    "incidents": sql(f"{MERGED}, {INCIDENTS} --- SELECT * FROM incidents", "score"),
    "incident_timeline": sql(
        f"""{MERGED}, {INCIDENTS}, {EPISODES},
        last_episode AS (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY region_id
                                                      ORDER BY start_ts DESC) AS rn FROM episodes)
          WHERE rn = 1) ---
        SELECT i.*, e.start_ts AS start, e.end_ts AS "end", e.duration_s
        FROM incidents i LEFT JOIN last_episode e ON i.region_id = e.region_id""",
        "score", "duration_s",
    ),
    "alerts": sql(f"{MERGED}, {ALERTS} --- SELECT * FROM alerts"),
    "alert_dedupe": sql(
        f"""{MERGED}, {ALERTS}, {FEED},
        both_lists AS (
          SELECT 'live-' || CAST(epoch_us(ts) // 1000 AS VARCHAR) AS id,
                 region_name || ' traffic event' AS title, lower(severity) AS severity,
                 event_type AS message, 0 AS list, -epoch_us(ts) AS position, event_id
          FROM feed WHERE lower(severity) <> 'information'
          UNION ALL
          SELECT id, title, severity, message, 1, 0, '' FROM alerts) ---
        SELECT id, title, severity, message FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY list, position, event_id) AS rn
          FROM both_lists)
        WHERE rn = 1"""
    ),
    "read_probes": sql(
        """SELECT CAST(event_id AS VARCHAR) AS event_id, ts, unix_ts, region_id, avg_rtt_ms,
               hop_count, is_reachable, outage_detected, health_score, state FROM probes""",
        "avg_rtt_ms", "health_score",
    ),
    "compact_history": sql(
        """SELECT strftime(ts, '%Y%m%d_%H') AS hour, count(*) AS records,
               avg(health_score) AS avg_health_score
        FROM probes GROUP BY 1""",
        "avg_health_score",
    ),
    "lenient_ndjson": sql(
        """SELECT CASE WHEN event_id % 10 = 0 THEN 'reject' ELSE 'row' END AS kind,
               CASE WHEN event_id % 10 > 1 THEN hop_count END AS hop_count, count(*) AS records
        FROM probes GROUP BY 1, 2"""
    ),
    "compact_incremental": sql(
        """SELECT strftime(ts, '%Y%m%d_%H') AS hour, count(*) AS records,
               count(*) FILTER (event_id % 11 = 0) AS nameless
        FROM probes GROUP BY 1"""
    ),
    "raw_archive_stream": sql(
        "SELECT strftime(ts, '%Y%m%d_%H') AS hour, count(*) AS records FROM probes GROUP BY 1"
    ),
    "archive_lifecycle": sql(
        """SELECT strftime(ts, '%Y%m%d_%H') AS hour, count(*) AS records, count(*) AS events,
               avg(health_score) AS avg_health_score
        FROM probes, clock
        WHERE date_trunc('hour', ts) >= date_trunc('hour', make_timestamp((as_of - 10 * 86400) * 1000000))
        GROUP BY 1""",
        "avg_health_score",
    ),
    "batch_incremental": sql(
        f"""{EPISODES},
        last_episode AS (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY start_ts DESC) AS rn
                         FROM episodes) WHERE rn = 1),
        summary AS (
          SELECT country_code, country_name, region_id, region_name, continent,
                 count(*) AS total_probes, avg(avg_rtt_ms) AS avg_latency_ms,
                 min(avg_rtt_ms) AS min_latency_ms, max(avg_rtt_ms) AS max_latency_ms,
                 avg(packet_loss_pct) AS avg_packet_loss_pct, avg(health_score) AS avg_health_score,
                 CAST(sum(CAST(outage_detected AS INT)) AS BIGINT) AS total_outages
          FROM probes GROUP BY 1, 2, 3, 4, 5) ---
        SELECT s.*, start_ts, end_ts, duration_s
        FROM summary s LEFT JOIN last_episode e ON s.region_id = e.region_id""",
        "avg_latency_ms", "min_latency_ms", "max_latency_ms", "avg_packet_loss_pct",
        "avg_health_score", "duration_s",
    ),
    "latency_range": sql(
        f"""SELECT region_id, count(*) AS probe_count, TRUE AS p50_near, TRUE AS p95_near
        FROM probes, clock
        WHERE {HOUR.format('ts')} >= {HOUR.format(AT.format('as_of - 604800'))} GROUP BY 1"""
    ),
    "outage_overlap": sql(
        f"""ends AS (SELECT {HOUR.format(AT.format('as_of'))} AS hour FROM clock),
        first AS (SELECT DISTINCT region_id FROM probes, ends WHERE outage_detected AND ts >= hour),
        second AS (SELECT DISTINCT region_id FROM probes, ends
                   WHERE outage_detected AND ts < hour AND ts >= hour - INTERVAL 1 DAY) ---
        SELECT (SELECT count(*) FROM first) AS in_first, (SELECT count(*) FROM second) AS in_second,
               (SELECT count(*) FROM (FROM first UNION FROM second)) AS in_either,
               (SELECT count(*) FROM (FROM first INTERSECT FROM second)) AS in_both"""
    ),
    "seasonal_drop": sql(
        f"""hourly AS (SELECT region_id, {HOUR.format('ts')} AS hour, count(*) AS events FROM probes GROUP BY 1, 2),
        began AS (SELECT region_id, min(hour) AS first FROM hourly GROUP BY 1),
        filled AS (
          SELECT region_id, hour, coalesce(events, 0) AS events
          FROM began JOIN (SELECT DISTINCT hour FROM hourly) ON hour >= first LEFT JOIN hourly USING (region_id, hour)),
        past AS (
          SELECT *, list(events) OVER (PARTITION BY region_id, date_part('hour', hour) ORDER BY hour
                      RANGE BETWEEN INTERVAL 14 DAY PRECEDING AND INTERVAL 1 SECOND PRECEDING) AS before
          FROM filled),
        middle AS (SELECT *, list_median(before) AS median FROM past WHERE len(before) >= 2),
        spread AS (
          SELECT *, list_median(list_transform(before, lambda x: abs(x - median))) AS mad FROM middle) ---
        SELECT region_id, hour, events, CAST(median AS DOUBLE) AS median, CAST(mad AS DOUBLE) AS mad
        FROM spread WHERE events < median * 0.5 AND median - events > 3 * mad""",
        "median", "mad",
    ),
    "window_issues": sql(
        f"""starts AS (
          SELECT {HOUR.format('ts')} - INTERVAL 1 HOUR * i AS window_start, region_id, state
          FROM probes, (SELECT unnest(range(24)) AS i) WHERE state <> 'healthy'),
        counted AS (SELECT window_start, region_id, state, count(*) AS occurrences FROM starts GROUP BY 1, 2, 3),
        placed AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY window_start
                    ORDER BY occurrences DESC, region_id || '|' || state) AS INT) AS rank FROM counted) ---
        SELECT window_start, rank, state, region_id, occurrences FROM placed WHERE rank <= 5"""
    ),
    "schema_drift": sql(
        """told AS (
          SELECT CASE WHEN event_id % 4 = 1 THEN 'sensor' WHEN event_id % 6 < 2 THEN 'jitter_ms' END AS field,
                 CASE WHEN event_id % 4 = 1 THEN 'OBJECT<gain: DECIMAL(1,1), id: STRING>'
                      WHEN event_id % 2 = 0 THEN 'BIGINT' ELSE 'STRING' END AS kind
          FROM probes) ---
        SELECT field, kind, count(*) AS records FROM told WHERE field IS NOT NULL GROUP BY 1, 2"""
    ),
    "windows_repaired": sql(f"{SLIDING} --- SELECT * FROM windows", *WINDOW_DOUBLES),
    "outage_sessions": sql(f"{SESSIONS} --- SELECT * EXCLUDE (closed_at) FROM sessions", *SESSION_DOUBLES),
    "stream_outage_sessions": sql(
        f"""{SESSIONS} --- SELECT * EXCLUDE (closed_at) FROM sessions
        WHERE closed_at + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM probes WHERE outage_detected)""",
        *SESSION_DOUBLES,
    ),
    "stream_alert_windows": sql(
        f"""hours AS (
          SELECT region_id, {HOUR.format('ts')} AS window_start, count(*) AS sample_count,
                 avg(health_score) AS avg_health_score, count(*) FILTER (outage_detected) AS outage_count,
                 count(*) FILTER (outage_detected) > count(*) * CAST(0.3 AS DOUBLE) AS is_outage
          FROM probes GROUP BY 1, 2) ---
        SELECT event_id, p.region_id, ts AS alert_ts, avg_rtt_ms, packet_loss_pct, window_start,
               window_start + INTERVAL 1 HOUR AS window_end, sample_count, h.avg_health_score, outage_count, is_outage
        FROM probes p LEFT JOIN hours h
          ON p.region_id = h.region_id AND {HOUR.format('ts')} = window_start AND is_outage
        WHERE state = 'critical' AND unix_ts < (SELECT max(unix_ts) FROM probes WHERE state = 'critical') - 10800""",
        "avg_rtt_ms", "packet_loss_pct", "avg_health_score",
    ),
    # the watermark is ten minutes behind the newest event
    "stream_sliding_windows": sql(
        f"""{SLIDING} ---
        SELECT * FROM windows
        WHERE window_end + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM ev)""",
        *WINDOW_DOUBLES,
    ),
}
ORACLES["stream_outage_alerts"] = ORACLES["outage_alert_stream"]
ORACLES["stream_live_state"] = ORACLES["state_upsert_ttl"]
ORACLES["stream_state_log"] = ORACLES["state_upsert_ttl"]
ORACLES["feed_search_index"] = ORACLES["feed_search"]
