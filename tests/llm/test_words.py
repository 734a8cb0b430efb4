import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from netvitals.llm.words import pieces, shingle_sets, spans, utf8, word_hashes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab AZ\t\n\x0b\xa0é😀", max_size=30)), max_size=6)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    data, offsets = utf8(pa.array(texts, pa.string()))
    start, end, first = spans(data, offsets)
    got = [bytes(data[a:b]).decode() for a, b in zip(start, end)]
    assert got == [w for t in texts for w in words(t)]
    assert np.diff(first).tolist() == [len(words(t)) for t in texts]
    fold = str.maketrans("AZ", "az")
    names = {}
    for word, h in zip(got, word_hashes(data, start, end)):
        assert names.setdefault(word.translate(fold), h) == h
    assert len(set(names.values())) == len(names)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_shingle_sets_have_the_sizes_of_sets_of_words(texts, size):
    data, offsets = utf8(pa.array(texts, pa.string()))
    _, first = shingle_sets(data, offsets, size)
    fold = str.maketrans("AZ", "az")
    for t, n in zip(texts, np.diff(first)):
        w = words((t or "").translate(fold))
        want = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        assert n == len(want)


def test_pieces_cover_every_text_and_longer_ones_alone():
    texts = ["a" * 10, None, "b" * 300, "", "c", "d" * 40]
    seen = []
    for lo, hi, data, offsets in pieces(pa.array(texts), 64):
        seen += [bytes(data[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:])]
        assert hi - lo == len(offsets) - 1
    assert seen == [t or "" for t in texts]


def thue_morse(bits, zero="a", one="b"):
    out = [0]
    for _ in range(bits):
        out += [1 - x for x in out]
    return "".join(one if x else zero for x in out)


def test_words_that_defeat_polynomial_hashes_differ():
    for bits in (3, 5, 6, 10, 12):
        w, v = thue_morse(bits), thue_morse(bits, "b", "a")
        data, offsets = utf8(pa.array([w, v, w.upper(), w + "c", w]))
        h = word_hashes(data, offsets[:-1], offsets[1:])
        assert h[0] == h[2] == h[4] and len(set(h.tolist())) == 3
        exact = word_hashes(data, offsets[:-1], offsets[1:], fold=False)
        assert exact[0] == exact[4] != exact[2]
        values, first = shingle_sets(data, offsets, 3)
        assert set(values[first[0] : first[1]]) != set(values[first[1] : first[2]])
