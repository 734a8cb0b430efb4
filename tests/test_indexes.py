"""The search index, seasonal baselines, heavy hitters of windows and schema drift."""

import json
import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from netvitals.operators import episodes, feed, speed
from netvitals.sources import drift

T0 = 1_700_000_000 - 1_700_000_000 % 86_400


@pytest.fixture(scope="module")
def rows(probes):
    rng = random.Random(2)
    names = ["Île-de-France", "Norte 7", "Área", "ab", "", None, "aaa aaa", "%_x"]
    return probes(
        *[
            {"event_id": str(i), "unix_ts": T0 + i, "region_id": f"r{i % 9}", "region_name": rng.choice(names),
             "country_name": rng.choice(["France", "FRANCE", None, "Ab"]), "state": rng.choice(["healthy", "warning"])}
            for i in range(300)
        ]
    )


@pytest.mark.parametrize("term", ["france", "FRANCE", "e", "", "ab", "aaa", "aaaa", "a a", "île", "7 fr", "%_x", "nowhere", " "])
def test_indexed_search_equals_the_scan(rows, term):
    events = feed.feed_event(rows)
    index = feed.search_index(events)
    want = sorted(r["event_id"] for r in feed.feed_search(events, term).collect())
    assert sorted(r["event_id"] for r in feed.indexed_search(index, term).collect()) == want


def test_the_index_reads_the_lists_wanted(rows):
    index = feed.search_index(feed.feed_event(rows))
    plan = feed.indexed_search(index, "norte")._jdf.queryExecution().toString()
    assert "In(gram, [nor,ort,rte])" in plan
    assert feed.indexed_search(feed.search_index(feed.feed_event(rows).limit(0)), "x").count() == 0


def naive_season(rows, season_h=24, seasons=3, ratio=0.5):
    counts = Counter((r, t // 3600) for r, t in rows)
    hours = sorted({h for _, h in counts})
    out = set()
    for region in {r for r, _ in counts}:
        first = min(h for r, h in counts if r == region)
        for h in (h for h in hours if h >= first):
            past = [counts[region, p] for p in hours if first <= p < h and (h - p) % season_h == 0 and (h - p) // season_h <= seasons]
            if len(past) >= 2:
                m = median(past)
                mad = median(abs(x - m) for x in past)
                n = counts[region, h]
                if n < m * ratio and m - n > 3 * mad:
                    out.add((region, h * 3600, n, m, mad))
    return out


def seasonal(spark, rows):
    frame = spark.createDataFrame(rows, "region_id string, at long").withColumn("ts", F.timestamp_seconds("at"))
    found = episodes.seasonal_drop(frame, season_h=24, seasons=3).withColumn("at", F.unix_seconds("hour"))
    return {(r.region_id, r["at"], r.events, r.median, r.mad) for r in found.collect()}


def test_seasonal_drop_equals_the_rule_and_reads_no_future(spark):
    rng = random.Random(7)
    rows = []
    for region in "ab":
        for h in range(24 * 6):
            n = 8 + h % 24 if rng.random() > 0.15 else rng.randrange(2)
            rows += [(region, T0 + h * 3600 + rng.randrange(3600)) for _ in range(n)]
    want = naive_season(rows)
    assert len(want) > 5 and seasonal(spark, rows) == want
    cut = T0 + 4 * 86_400
    early = {w for w in want if w[1] < cut}
    # later records, a stray stamp in the past and one far ahead change no verdict on the hours before
    assert {w for w in seasonal(spark, [r for r in rows if r[1] < cut]) if w[1] < cut} == early
    stray = [("a", 3600 * 11), ("b", T0 + 3600 * 24 * 365 * 70)]
    assert {w for w in seasonal(spark, rows + stray) if T0 <= w[1] < cut} == early
    assert seasonal(spark, rows[:0]) == set()


def issues_of(spark, probes, n_keys, keys):
    rng = random.Random(n_keys)
    rows = [(f"r|{int(n_keys * rng.random() ** 3)}", rng.randrange(6 * 3600)) for _ in range(4000)]
    frame = probes(*[{"region_id": r, "unix_ts": T0 + t, "state": "warning"} for r, t in rows], {"unix_ts": T0, "state": "healthy"})
    got = speed.window_issues(speed.issue_panes(frame, keys=keys), 7200, keys=keys).collect()
    counts = {}
    for r, t in rows:
        for start in (t // 3600, t // 3600 - 1):
            counts.setdefault(T0 + start * 3600, Counter())[r] += 1
    return got, counts


def test_top_issues_are_exact_while_keys_fit(spark, probes):
    got, counts = issues_of(spark, probes, 40, 1000)
    want = {
        (start, i + 1, key, n)
        for start, c in counts.items()
        for i, (key, n) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0] + "|warning"))[:5])
    }
    assert {(int(r.window_start.timestamp()), r["rank"], r.region_id, r.occurrences) for r in got} == want


def test_top_issues_keep_their_bound_beyond(spark, probes):
    got, counts = issues_of(spark, probes, 3000, 64)
    for r in got:
        c = counts[int(r.window_start.timestamp())]
        # at most the rows of the window over the keys followed, in each of two panes and the union
        assert c[r.region_id] <= r.occurrences <= c[r.region_id] + 4 * sum(c.values()) / 64
    with pytest.raises(ValueError):
        speed.window_issues(speed.issue_panes(probes(), 3600), 5000)


def test_unknown_fields_are_kept_and_counted(spark):
    lines = [
        {"event_id": "a", "hop_count": 3, "x.y": 1}, {"event_id": "b", "hop_count": "three", "x.y": "s", "deep": {"k": [1]}},
        {"event_id": "c", "deep": {"k": [2]}}, {"event_id": "d", "gone": None},
    ]
    text = [json.dumps(x) for x in lines] + ["", "  ", "{broken", "[1,2]", "7"]
    variants = drift.variant_lines(spark.createDataFrame([(t,) for t in text], "value string"))
    found = {(r.field, r.kind): r.records for r in drift.schema_drift(variants).collect()}
    assert found == {
        ("x.y", "BIGINT"): 1, ("x.y", "STRING"): 1, ("deep", "OBJECT<k: ARRAY<BIGINT>>"): 2, ("gone", "VOID"): 1,
    }
    typed = {r.event_id: r.hop_count for r in drift.typed_probes(variants).collect()}
    assert (typed["a"], typed["b"], typed["c"]) == (3, None, None)
    extra = {json.loads(r.value)["event_id"]: r.extra for r in drift.extra_fields(variants).collect()}
    assert extra["b"] == {"x.y": '"s"', "deep": '{"k":[1]}'} and extra["a"] == {"x.y": "1"}
    assert "hop_count" in drift.drift_schema(variants.filter("value LIKE '{%'")).first()["merged"]
    assert drift.schema_drift(variants.limit(0)).count() == 0
