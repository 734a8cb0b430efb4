import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from netvitals.llm.periodic_runs import find_runs, likely_parts, run_digests, runs_of
from netvitals.llm.words import spans, word_hashes


def brute(words, least=24, exponent=3):
    """All runs by comparing the words at every distance."""
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                own = words[i : i + length]
                if not any(own[d:] == own[:-d] for d in range(1, q)):
                    out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def in_parts(words):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    start, end, first = spans(data, np.array([0, len(data)]))
    parts = likely_parts(word_hashes(data, start, end, fold=False), first, 24, 3)
    raw = [w.encode() for w in words]
    return sorted(((a + s, n, q) for _, a, b in parts for s, n, q in runs_of(raw[a:b])), key=lambda r: (r[0], r[2]))


PHRASES = st.lists(
    st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 7), st.integers(0, 8)), max_size=6
)


@settings(max_examples=150, deadline=None)
@given(PHRASES)
def test_runs_equal_brute_force(phrases):
    words = [w for phrase, times, rest in phrases for w in phrase * times + phrase[:rest]]
    want = brute(words)
    assert (runs_of([w.encode() for w in words]) if words else []) == want
    assert in_parts(words) == want


@pytest.mark.parametrize("seed", range(6))
def test_long_periods_and_nested_runs(seed):
    rng = random.Random(seed)
    inner = ["x", "y"] * 15
    phrase = [str(rng.randrange(50)) for _ in range(rng.randint(30, 90))] + inner
    words = [str(rng.randrange(50)) for _ in range(60)] + phrase * 4 + phrase[:17] + ["end"]
    want = brute(words)
    assert len(want) >= 5 and in_parts(words) == want


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    return words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests(doc_id, text):
    words = planted(doc_id, text)
    runs = brute(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *four, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_query_equals_brute_force(spark, documents, prose):
    rows = [(i, prose(5 + i % 90, i)) for i in range(240)]
    rows += [(300, "one two three  four\t" * 9 + "five"), (301, "a " * 400), (302, "ab\x0bcd\n" * 30 + "é " * 24)]
    rows += [(303, ""), (304, None), (None, "w " * 24), (305, "a " * 23), (306, " \n\t"), (301, "a " * 400)]
    got = [tuple(r) for r in run_digests(documents(*rows)).collect()]
    want = [digests(*r) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(w[1] > 0 for w in want) > 12


def test_empty_table_and_clashing_columns(spark, documents):
    assert run_digests(documents()).count() == 0
    docs = spark.createDataFrame([(1, "b " * 30, 7, "k")], "id long, text string, runs int, `row.x` string")
    row = find_runs(docs).first()
    assert (row["id"], row["row.x"], row["collapsed"]) == (1, "k", "b")
    assert [tuple(r) for r in row["runs"]] == [(0, 30, 1)]
    with pytest.raises(ValueError):
        find_runs(docs, least=12)
