"""Column layouts of the tables the jobs read and write, as DDL strings."""

# The wire's field names and the published views' columns, here and below.

# One row per probe measurement. Sources fill different subsets, so every
# column is nullable and the schema is always given, never inferred.
PROBE_DDL = """
    event_id STRING, timestamp STRING, unix_ts BIGINT, probe_id STRING,
    region_id STRING, region_name STRING, country_code STRING, country_name STRING,
    continent STRING, lat DOUBLE, lon DOUBLE, flag STRING, provider STRING,
    target_ip STRING, target_name STRING,
    avg_rtt_ms DOUBLE, min_rtt_ms DOUBLE, max_rtt_ms DOUBLE,
    packet_loss_pct DOUBLE, hop_count INT,
    is_reachable BOOLEAN, outage_detected BOOLEAN, health_score DOUBLE, state STRING,
    measurement_type STRING, wiki_domain STRING, wiki_type STRING, is_bot BOOLEAN,
    source STRING
"""

PROBE_COLUMNS = [field.split()[0] for field in PROBE_DDL.split(",")]

REGION_DDL = """
    region_id STRING, region_name STRING, country_code STRING, country_name STRING,
    continent STRING, lat DOUBLE, lon DOUBLE, flag STRING, provider STRING
"""
REGION_COLUMNS = [field.split()[0] for field in REGION_DDL.split(",")]

LANGUAGE_DDL = "language STRING, region_id STRING"

EDIT_EVENT_DDL = """
    meta STRUCT<domain: STRING, dt: STRING>, timestamp BIGINT, type STRING, bot BOOLEAN
"""

ATLAS_DDL = "prb_id BIGINT, avg DOUBLE, loss DOUBLE"

ENVELOPE_DDL = "kinesis STRUCT<data: STRING>, eventSource STRING, body STRING"

WINDOW_DDL = REGION_DDL + """,
    window_start TIMESTAMP, window_end TIMESTAMP, window_size_s INT, sample_count BIGINT,
    avg_health_score DOUBLE, avg_latency_ms DOUBLE, avg_packet_loss DOUBLE,
    current_health_score DOUBLE, current_latency_ms DOUBLE, current_packet_loss DOUBLE,
    hist_health_score DOUBLE, hist_latency_ms DOUBLE, status STRING, impact_score DOUBLE,
    min_latency_ms DOUBLE, max_latency_ms DOUBLE, outage_count BIGINT, is_outage BOOLEAN,
    current_state STRING
"""

SPEED_GLOBAL_DDL = """
    computed_at TIMESTAMP, global_health_score DOUBLE, global_avg_latency DOUBLE,
    global_avg_loss DOUBLE, active_outages BIGINT, regions_monitored BIGINT, layer STRING
"""

HISTORY_DDL = "ts TIMESTAMP, health_score DOUBLE, latency_ms DOUBLE, loss_pct DOUBLE"

FEED_DDL = """
    ts TIMESTAMP, event_id STRING, region_id STRING, region_name STRING, country STRING,
    flag STRING, severity STRING, latency_ms DOUBLE, packet_loss DOUBLE, health DOUBLE,
    event_type STRING
"""

LATENCY_DDL = REGION_DDL + """,
    probe_count BIGINT, avg_latency_ms DOUBLE, min_latency_ms DOUBLE, max_latency_ms DOUBLE,
    p50_latency_ms DOUBLE, p95_latency_ms DOUBLE, avg_packet_loss_pct DOUBLE,
    avg_health_score DOUBLE
"""

EPISODE_DDL = "region_id STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, duration_s BIGINT"

BATCH_GLOBAL_DDL = """
    global_health_score DOUBLE, global_avg_latency DOUBLE, global_avg_loss DOUBLE,
    total_records BIGINT, total_outage_events BIGINT, countries_monitored BIGINT,
    regions_monitored BIGINT, computed_at TIMESTAMP
"""

MERGED_DDL = REGION_DDL + """,
    current_health_score DOUBLE, current_latency_ms DOUBLE, current_packet_loss DOUBLE,
    is_outage BOOLEAN, state STRING, status STRING,
    hist_health_score DOUBLE, hist_latency_ms DOUBLE, hist_packet_loss DOUBLE,
    hist_probe_count BIGINT, hist_p95_latency_ms DOUBLE,
    impact_score DOUBLE,
    data_sources STRUCT<speed_layer: BOOLEAN, batch_layer: BOOLEAN>, merged_at TIMESTAMP
"""

MERGED_GLOBAL_DDL = """
    global_health_score DOUBLE, global_avg_latency DOUBLE, global_avg_loss DOUBLE,
    active_outages BIGINT, regions_monitored BIGINT, total_records_batch BIGINT,
    total_outage_events BIGINT, batch_health DOUBLE, speed_health DOUBLE, layer STRING,
    merged_at TIMESTAMP
"""

# What the latest-state table keeps per region, and the value an absent field gets.
STATE_DDL = """
    region_id STRING, event_id STRING, ts TIMESTAMP, unix_ts BIGINT,
    country_code STRING, country_name STRING, region_name STRING, continent STRING,
    provider STRING, avg_rtt_ms DOUBLE, packet_loss_pct DOUBLE, health_score DOUBLE,
    is_reachable BOOLEAN, outage_detected BOOLEAN, state STRING, lat DOUBLE, lon DOUBLE,
    flag STRING, expires_at BIGINT
"""
