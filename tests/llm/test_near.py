import random
import re

import numpy as np
from pyspark.sql import functions as F

from netvitals.llm import near_dedup as nd
from netvitals.llm import substring_dedup as sd
from netvitals.llm.substring_dedup import compact_windows, passages, possible, repeated_passages


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in w]
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def groups_by_hand(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def edited(text, rng, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = "".join(rng.choice("xyz") for _ in range(6))
    return " ".join(w)


def test_groups_against_brute_force(documents, prose):
    rng = random.Random(8)
    rows = [(i, prose(rng.randint(1, 80), i)) for i in range(60)]
    base, other = prose(120, "base"), prose(60, "line")
    # A large group of near copies around the limit, beyond a short list and one block.
    rows += [(100 + i, edited(base, rng, rng.randint(0, 5))) for i in range(150)]
    rows += [(300 + i, other + " " + prose(rng.randint(2, 25), 1000 + i)) for i in range(90)]
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, "one"), (404, "ONE"), (405, "one two"), (406, rows[3][1].upper())]
    docs = documents(*rows)
    for name in ("kept", "sig", "gone", "n_shingles", "component_id"):
        docs = docs.withColumn(name, F.lit("clash"))
    for size, percent in ((3, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_groups(docs, size, percent, short_list=8).collect()}
        assert got == groups_by_hand(rows, size, percent)
    left = nd.near_dedup(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, v in groups_by_hand(rows, 5, 80).items() if v[2]}


def test_repeated_and_null_ids_and_no_rows(documents, prose):
    text = prose(40, 1)
    got = nd.near_groups(documents((5, text), (5, text), (None, text), (2, text), (5, "short"))).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=repr) == sorted(
        [(5, 2, False), (2, 2, True), (None, None, True)], key=repr
    )
    assert nd.near_groups(documents().limit(0)).count() == 0


def test_spanning_forest_against_union_find():
    rng = np.random.default_rng(6)
    for n, m in ((1, 0), (50, 30), (200, 220), (300, 299)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        if m == 299:
            a, b = np.arange(299), np.arange(1, 300)  # a sorted chain
        up = list(range(n))

        def top(x):
            while up[x] != x:
                x = up[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            x, y = top(x), top(y)
            up[max(x, y)] = min(x, y)
        v, t = nd.spanning_forest(n, a, b)
        assert dict(zip(v.tolist(), t.tolist())) == {x: top(x) for x in range(n) if top(x) != x}


def test_threshold_keeps_its_promise():
    from math import comb

    for s in (0.8, 0.85):
        t = nd.match_threshold(s)
        miss = sum(comb(48, i) * s**i * (1 - s) ** (48 - i) for i in range(t))
        assert miss <= nd.MISS and t > 20


def test_windows_are_exactly_the_passages_with_one_minimum():
    rng = np.random.default_rng(0)
    values = rng.permutation(400).astype(np.uint64)
    first = np.array([0, 0, 130, 133, 400])
    l, c, r = compact_windows(values, first, 10)
    for a, b in zip(first[:-1], first[1:]):
        for i in range(a, b):
            for j in range(i + 10, b + 1):
                hold = np.flatnonzero((l <= i) & (c >= i) & (c < j) & (r >= j))
                assert len(hold) == 1 and values[c[hold[0]]] == values[i:j].min()


def test_repeated_passages(documents, prose):
    passage, near = prose(60, "p"), prose(90, "q")
    rng = random.Random(5)
    rows = [(i, prose(100, i)) for i in range(40)]
    rows += [(100 + i, f"{prose(30, 200 + i)} {passage} {prose(20, 300 + i)}") for i in range(40)]
    rows += [(200, f"{prose(70, 'x')} {near}"), (201, f"{edited(near, rng, 1)} {prose(70, 'y')}")]
    rows += [(300, rows[0][1]), (301, prose(49, "short")), (302, prose(49, "short")), (303, None), (None, passage), (304, " ")]
    docs = documents(*rows, rows[1]).withColumn("tokens", F.lit(1))
    got = {r.doc_id: r for r in repeated_passages(docs).collect()}
    assert set(got) == {*range(101, 140), 201, 300}
    for i in range(101, 140):
        assert (got[i].first_word, got[i].last_word, got[i].rep_doc_id) == (30, 90, 100)
    assert got[201].rep_doc_id == 200 and got[201].last_word - got[201].first_word >= 50
    assert (got[300].first_word, got[300].last_word, got[300].rep_doc_id) == (0, 100, 0)
    assert repeated_passages(docs.limit(0)).count() == 0


def test_every_occurrence_in_a_document_is_found(documents, prose):
    rows = []
    for i in range(60):
        passage = prose(50 + i % 30, f"twice {i}")
        rows.append((i, f"{prose(40, f'a {i}')} {passage} {prose(40, f'b {i}')}"))
        rows.append((100 + i, f"{prose(30, f'c {i}')} {passage} {prose(150, f'd {i}')} {passage} {prose(30, f'e {i}')}"))
    got = sorted((r.doc_id, r.first_word, r.last_word, r.rep_doc_id) for r in repeated_passages(documents(*rows)).collect())
    want = [(100 + i, at, at + 50 + i % 30, i) for i in range(60) for at in (30, 230 + i % 30)]
    assert len(got) == len(want)
    # A word beside the passage may agree by chance.
    assert all(g[0] == w[0] and g[3] == w[3] and abs(g[1] - w[1]) + abs(g[2] - w[2]) < 3 for g, w in zip(got, want))


def test_repeating_passages_are_aligned(documents, prose):
    rows, size = [], {}
    for i, (n, times) in enumerate(((30, 3), (12, 10), (20, 4), (40, 2))):
        line = " ".join([prose(n, f"line {i}")] * times)
        size[100 + i] = n * times
        rows.append((i, f"{prose(120, f'a {i}')} {line} {prose(40, f'b {i}')}"))
        rows.append((100 + i, f"{prose(70, f'c {i}')} {line} {prose(40, f'd {i}')}"))
    got = {r.doc_id: r for r in repeated_passages(documents(*rows)).collect()}
    assert set(got) == set(size)
    for i, n in size.items():
        assert abs(got[i].first_word - 70) < 3 and abs(got[i].last_word - 70 - n) < 3
        assert got[i].rep_doc_id == i - 100 and got[i].similarity == 1


def test_partner_is_the_best_of_all_passages():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = rng.integers(0, 12, 40), rng.integers(0, 12, 30)
        for p, q, x, y, share in passages(a, b, 4, 60, 0, 60):
            every = (set(b[max(0, s) : s + q - p]) for s in range(p - q + 1, len(b)))
            mine = set(a[p:q])
            assert abs(share - max(len(mine & o) / len(mine | o) for o in every if o)) < 1e-9
            assert abs(share - len(mine & set(b[x:y])) / len(mine | set(b[x:y]))) < 1e-9


def test_passages_of_least_length_with_an_edit(documents, prose):
    rows = []
    for n in (50, 54):
        for at in range(n):
            i = 1000 * n + at
            words = prose(n, f"edge {i}").split(" ")
            rows.append((i, f"{prose(60, f'a {i}')} {' '.join(words)} {prose(60, f'b {i}')}"))
            words[at] = "edited"
            rows.append((i + 100, f"{prose(80, f'c {i}')} {' '.join(words)} {prose(60, f'd {i}')}"))
    least = 46
    for (i, a), (_, b) in zip(rows[::2], rows[1::2]):
        tokens = [np.array([hash(tuple(t.split(" ")[k : k + 5])) for k in range(len(t.split(" ")) - 4)]) for t in (b, a)]
        n, at = divmod(i, 1000)
        common = n - 4 - min(at + 1, 5, n - at, n - 4)
        found = list(passages(*tokens, least, 80, -20, 92))
        # The whole passage, or its best part of 46 shingles, is 80 % alike.
        assert len(found) == (common / (2 * (n - 4) - common) >= 0.8 or max(n - 4 - at - 1, at - 4) >= 41), (n, at)
        assert all(p >= 70 and q <= 90 + n and q - p >= least for p, q, *_ in found)
    got = {r.doc_id for r in repeated_passages(documents(*rows)).collect()}
    assert len(got) >= 98, len(got)


def test_a_short_head_hides_no_later_pair(documents, prose):
    rows = []
    for t in range(60):
        # Of a passage of 50 words the first document holds 40; two later ones hold it whole.
        passage = prose(50, f"short head {t}")
        rows.append((10 * t, f"{prose(60, f'a {t}')} {' '.join(passage.split()[:40])} {prose(60, f'b {t}')}"))
        rows += [(10 * t + i, f"{prose(60, f'c {t} {i}')} {passage} {prose(60, f'd {t} {i}')}") for i in (1, 2)]
    got = {r.doc_id: r for r in repeated_passages(documents(*rows)).collect()}
    assert sorted(got) == [10 * t + 2 for t in range(60)]
    assert all(r.rep_doc_id == i - 1 and r.first_word <= 60 and r.last_word >= 110 for i, r in got.items())


def test_a_confirmed_partner_is_still_compared(documents, prose):
    rows = []
    for t in range(40):
        # The second document is like the first and the third like the second, but not like the first.
        words = prose(50, f"chain {t}").split()
        for i, at in enumerate((None, 12, 36)):
            if at:
                words[at] = f"edit{i}"
            rows.append((10 * t + i, f"{prose(60, f'a {t} {i}')} {' '.join(words)} {prose(60, f'b {t} {i}')}"))
    docs = documents(*rows)
    alone = {r.doc_id for r in repeated_passages(docs.filter("doc_id % 10 > 0")).collect()}
    got = {r.doc_id: r for r in repeated_passages(docs).collect()}
    assert len(alone) > 36 and {i for i in got if i % 10 == 2} >= alone
    assert all(got[i].rep_doc_id == i - 1 and got[i].first_word <= 60 and got[i].last_word >= 110 for i in alone)


def test_lists_longer_than_their_heads_are_used_up(documents, prose):
    # Eighty documents share a line too short to be a passage; pairs of them share a passage around it.
    line, rows = prose(30, "line"), []
    for t in range(40):
        passage = f"{prose(25, f'x {t}')} {line} {prose(25, f'y {t}')}"
        rows += [(2 * t + i, f"{prose(50, f'e {t} {i}')} {passage} {prose(50, f'f {t} {i}')}") for i in (0, 1)]
    got = {r.doc_id: r for r in repeated_passages(documents(*rows)).collect()}
    assert set(got) == {2 * t + 1 for t in range(40)}
    assert all(r.first_word <= 50 and r.last_word >= 130 and r.rep_doc_id == i - 1 for i, r in got.items())


def test_pairs_left_out_at_once_hold_no_passage():
    rng = np.random.default_rng(4)
    lists = []
    for t in range(1500):
        words = int(rng.choice([3, 8, 30, 400]))
        a, b = rng.integers(-words, words, rng.integers(1, 60)), rng.integers(-words, words, rng.integers(1, 60))
        if t % 2 and len(a) > 14:  # a passage of the other with some changes
            n = int(rng.integers(8, 15))
            b = np.concatenate([b[:20], np.where(rng.random(n) < 0.15, 999, a[:n]), b[20:]])
        lists.append((a.astype(np.int32), b.astype(np.int32)))
    a_at, b_at = (np.concatenate([[0], np.cumsum([len(x[k]) for x in lists])]) for k in (0, 1))
    a, b = (np.concatenate([x[k] for x in lists]) for k in (0, 1))
    some = possible(a, a_at, b, b_at, 10, 80)
    found = np.array([any(True for _ in passages(x, y, 10, 80, 0, 60)) for x, y in lists])
    assert found.sum() > 100 and not (found & ~some).any()
    assert np.count_nonzero(some) < 2 * np.count_nonzero(found)


def test_a_frequent_line_asks_for_few_pairs_and_little_room(documents, prose, monkeypatch):
    # A line in all documents, repeated in some: no passage but the one of documents 50 and 51.
    line, whole, rows = prose(13, "line"), prose(40, "whole"), []
    for i in range(160):
        end = " ".join([prose(4, f"own {i}")] * 12) if i % 4 == 0 else prose(40, f"end {i}")
        rows.append((i, f"{prose(50, f'start {i}')} {line} {whole if i in (50, 51) else end}"))
    seen, settle = {}, sd.settle

    def noted(frame, purpose):
        out = settle(frame, purpose)
        seen.setdefault(purpose, []).append(out)
        return out

    monkeypatch.setattr(sd, "settle", noted)
    got = [(r.doc_id, r.rep_doc_id) for r in repeated_passages(documents(*rows)).collect()]
    assert got == [(51, 50)]
    # The pairs of the heads in the first step, and then none but those that may be alike.
    assert sum(f.count() for f in seen["window_pairs"][1:]) < 20
    for frame in seen["window_contexts"]:
        long = frame.groupBy("key").count().filter(F.col("count") > sd.LONG_LIST)
        assert frame.join(long, "key", "left_anti").filter("context IS NOT NULL").count() == 0
