import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from netvitals.llm import lexical_search
from netvitals.llm.lexical_search import ImpactLists, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    df = Counter(t for _, c in counts for t in c)
    total, n = sum(sum(c.values()) for _, c in counts), len(counts)
    out = []
    for item, text in items:
        scored = []
        for d, c in counts:
            m = 50 + (50 * sum(c.values()) * n) // total
            score = sum(
                floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text))
                if c[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0))
        for rank, (score, missing, d) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if missing else d, -score))
    return out


@pytest.fixture
def tables(spark, documents):
    rng = random.Random(3)
    names = [f"{a}{b}" for a in ("Été", "x", "abc", "W") for b in range(40)]
    weights = [1 / (i + 1) for i in range(len(names))]

    def text(n):
        return rng.choice([" ", ", ", "-", "\n"]).join(rng.choices(names, weights, k=n))

    docs = [(i, text(rng.randint(1, 120))) for i in range(700)]
    docs += [(i + 700, docs[i % 5][1]) for i in range(60)]  # equal scores
    docs += [(3, docs[3][1]), (None, docs[2][1]), (None, docs[2][1]), (900, None), (901, ""), (902, "?! ..")]
    docs += [(903, "x1 " * 20000)]
    items = [(i, text(rng.randint(1, 40))) for i in range(25)]
    items += [(25, items[0][1]), (26, None), (27, ""), (28, "unheard of"), (29, "x1 X1 x1"), (3, items[3][1])]
    return docs, items, documents(*docs), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("slice_bytes,entries", [(1 << 18, 1 << 24), (600, 1 << 10)])
def test_results_equal_brute_force(tables, monkeypatch, slice_bytes, entries):
    docs, items, d, q = tables
    monkeypatch.setattr(lexical_search, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(lexical_search, "BLOCK_ENTRIES", entries)
    got = [tuple(r) for r in search(d.repartition(3), q).collect()]
    assert sorted(got, key=repr) == sorted(brute(docs, items), key=repr)
    few = [tuple(r) for r in search(d, q, k=3).collect()]
    assert sorted(few, key=repr) == sorted(brute(docs, items, 3), key=repr)


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    none = items.limit(0)
    assert search(documents(), items).collect() == []
    assert search(documents((1, "a b")), none).collect() == []
    assert search(documents((1, None)), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_the_bound_ends_a_query_before_its_lists_do():
    """One list holds the best documents at its head; most documents are never met."""
    rng = np.random.default_rng(5)
    n = 4000
    doc = np.tile(np.arange(n), 3)
    term = np.repeat(np.arange(3), n)
    impact = rng.integers(1, 50, 3 * n)
    impact[:30] += 1000
    impact[n : n + 30] += 1000
    lists = ImpactLists(doc, term, impact, n, 3)
    total = np.bincount(doc, impact).astype(int)
    order = np.lexsort((np.arange(n), -total))[:10]
    reads = []
    lists.position = _Counting(lists.position, reads)
    found, scores = lists.best(np.arange(3), 10, 1)
    best = np.lexsort((found, -scores))[:10]
    assert found[best].tolist() == order.tolist() and scores[best].tolist() == total[order].tolist()
    assert sum(reads) < 3 * n / 10
    # a lower bound known from other blocks ends it at once where nothing can reach it
    reads.clear()
    assert len(lists.best(np.arange(3), 10, 10**6)[0]) == 0 and sum(reads) < 100


class _Counting:
    def __init__(self, position, reads):
        self.position, self.reads, self.shape = position, reads, position.shape

    def __getitem__(self, key):
        out = self.position[key]
        self.reads.append(np.size(out))
        return out
