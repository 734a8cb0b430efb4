import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from netvitals.llm.components import components
from netvitals.llm.exact_dedup import exact_dedup, exact_groups
from netvitals.llm.mixing import mix, mixed_documents


def test_exact_groups_edge_rows(documents):
    rows = [(1, "a"), (7, "a"), (3, None), (4, ""), (5, "A"), (5, "A"), (None, "a"), (None, "solo"), (9, "x" * 200_000), (8, "x" * 200_000)]
    docs = documents(*rows)
    for name in ("keep_id", "_text", "row", "id", "content", "sha", "kept", "text_sha256"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = exact_groups(docs).collect()
    size = defaultdict(int)
    best = {}
    for i, t in rows:
        t = t or ""
        size[t] += 1
        best[t] = max(x for x in (best.get(t), i, -1) if x is not None)
    want = []
    for i, t in rows:
        t = t or ""
        keep = None if best[t] == -1 else best[t]
        want.append((i, keep, size[t], keep is None or i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    left = exact_dedup(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(7, "a"), (4, ""), (5, "A"), (None, "solo"), (9, "x" * 200_000)], key=repr
    )


def test_exact_on_no_rows_and_smallest_id(documents):
    assert exact_groups(documents().limit(0)).count() == 0
    assert exact_dedup(documents((1, "a"), (2, "a")), prefer="min").collect()[0].doc_id == 1
    folded = exact_groups(documents((1, "Ab"), (2, "aB")), text=F.lower("text"))
    assert {r.keep_id for r in folded.collect()} == {2}


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(900, 901), (901, 902), (902, 900), (7, 7)]
    edges += [(rng.randint(2000, 2060), rng.randint(2000, 2060)) for _ in range(45)] + [(1, None)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    assert got == {x: top(x) for x in list(up)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def targets_by_hand(sizes):
    """Shares by weight, the excess over two sizes given to the rest until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full, left = {}, 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        over = [s for s in rest if left * weight[s] / sum(weight[x] for x in rest) > 2 * sizes[s] + 1e-9]
        if not over:
            return {**full, **{s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}}
        for s in over:
            full[s] = 2.0 * sizes[s]
        left = 1.5 * sum(sizes.values()) - sum(full.values())


def test_mix_meets_its_budgets(documents, prose):
    rng = random.Random(1)
    rows = [(i, prose(rng.randint(0, 60), i), "en", rng.choice(["b", "a", "ä", None, "big", "big", "big"])) for i in range(300)]
    rows += [(301, None, "en", "a"), (None, "two words", "en", "a"), (5, rows[5][1], "en", rows[5][3]), (302, "  \t", None, "none")]
    docs = documents(*rows).withColumn("size", F.lit("clash"))
    got = mix(docs, rows_per_range=16).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = targets_by_hand(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    assert {s: int(want[s] + 1e-9) - taken[s] in (0, 1) for s in sizes} == {s: True for s in sizes}
    again = mix(docs, rows_per_range=7).collect()
    key = lambda r: repr((r.doc_id, r.size, r.taken))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_documents_repeat_and_cut(documents, prose):
    docs = documents(*[(i, " " + prose(20, i), "en", "ab"[i % 2], 121) for i in range(20)], (99, None, None, "a"))
    for name in ("row", "row_id", "size", "words", "taken", "copy", "id"):
        docs = docs.withColumn(name, F.lit("clash"))
    assert mixed_documents(docs).columns == docs.columns
    plan = {r.doc_id: r.taken for r in mix(docs).collect()}
    rows = mixed_documents(docs).collect()
    count = defaultdict(int)
    whole = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        count[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert whole[r.doc_id].startswith(r.text)
        assert r.n_chars == (121 if r.text == whole[r.doc_id] else len(r.text)) and r.row == "clash"
    assert dict(count) == {i: n for i, n in plan.items() if n}
    assert mixed_documents(docs.limit(0)).count() == 0 and mix(docs.limit(0)).count() == 0


def test_mixed_documents_meet_their_budget_whatever_the_ids(spark):
    """Rows without an id, repeated ids and wholly equal rows: as many words as the targets say."""
    rows = [(None, f"w{i % 7} " * (3 + i % 4), "a") for i in range(300)] + [(5, "x y z", "a")] * 40
    rows += [(i % 9, "same text here and there", "b") for i in range(90)] + [(None, None, None), (1, "one", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {r.source: (r.target, r.taken) for r in mix(docs).groupBy("source").agg(
        F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()}
    got = {r.source: r.words for r in mixed_documents(docs).groupBy("source").agg(
        F.sum(F.size(F.split(F.trim("text"), " +"))).alias("words")).collect()}
    for source, (target, taken) in want.items():
        assert taken == int(target) == got.get(source, 0)
    # the same key for each row in every run, and rows without an id in many ranges
    assert sorted(map(tuple, mix(docs).collect()), key=repr) == sorted(map(tuple, mix(docs).collect()), key=repr)


def test_rows_without_id_are_spread_over_ranges(spark):
    from netvitals.llm.mixing import random_key

    rows = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    spots = rows.select(F.substring(random_key(F.col("doc_id"), F.col("text"), "mix"), 1, 1).alias("s"))
    counts = [r["count"] for r in spots.groupBy("s").count().collect()]
    assert len(counts) == 16 and max(counts) < 400


def test_every_conversation_gives_a_pair_that_parts_at_some_turn(spark):
    from netvitals.llm.preference import alternate_answers, preference_rows

    def talk(conv, *roles):
        return [(conv, i, r, f"{conv}-{i}") for i, r in enumerate(roles)]

    u, a = "user", "assistant"
    rows = talk(4, u, a, u, a, u) + talk(5, u, a, u, a, u, a) + talk(6, u) + talk(7, a, u) + talk(8, u, a, u, a) + talk(3, a, a)
    rows += [(None, 0, u, "x"), (2, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r.conv_id: r for r in preference_rows(alternate_answers(turns)).collect()}
    assert set(got) == {2, 3, 4, 5, 6, 7, 8}
    # 4 mod 2: the first answer; 5 mod 3: the last; 3 mod 2: the second; 7 and 8 have no neighbour's answer
    assert {c: got[c].n_common for c in got} == {2: 1, 3: 1, 4: 1, 5: 5, 6: 1, 7: 0, 8: 1}
    assert got[6].chosen == got[6].rejected == "" and got[6].chosen_spans == []
    assert len(got[4].chosen_spans) == len(got[4].rejected_spans) == 2 and "5-5" in got[4].rejected
    assert len(got[8].rejected_spans) == 1 and got[8].rejected.endswith("8-3<|end|>\n")
    assert got[4].rejected.endswith("4-4<|end|>\n") and alternate_answers(turns.limit(0)).count() == 0
