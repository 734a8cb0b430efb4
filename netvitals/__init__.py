"""netvitals: network-health telemetry analytics as Spark jobs.

Probe events (latency, packet loss, reachability, health per region) go in as
DataFrames or streams; full-history views, trailing and sliding windows, latest
state, merged serving views, alerts and outage episodes come out as DataFrames.
"""
