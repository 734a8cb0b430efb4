"""License scans: MinHash bands over overlapping text windows retrieve templates.

A template of n shingles belongs to the class of the least power of two L >= n. For a class,
windows of 3L shingles begin every L shingles, so any passage of up to 2L lies whole within
one. A passage that holds m = ceil(c * n) of a template's shingles has with its window a Jaccard
similarity of at least J = m / (3L + n - m). Bands are one row each; their number is
taken from J so that a window fails to collide with probability ``miss`` at most. Every
window of every text gets its signature and looks up the templates of its class by band;
retrieved templates are then verified by exact containment of their word shingles.

A window is three blocks of L shingles, so a coordinate is mixed once per shingle and reduced
to block minima, each class from the blocks of the one below it.
"""

from __future__ import annotations

import re
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvitals.llm.words import pieces, shingle_hashes, word_hashes

#: Widely used license notices, as their licenses give them.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "Apache-2.0-header": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License."],
    "MIT-permission": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:"
    ],
    "BSD-conditions": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:"
    ],
    "ISC-permission": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "GPL-notice": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
}

SHINGLE = 5
CONTAINED = 0.8
MISS = 1e-6

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True


def license_words(data: np.ndarray, offsets: np.ndarray):
    """(start, end, first) of runs of ASCII letters, digits and other characters' bytes;
    everything else, punctuation included, separates."""
    solid = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(solid & (edge[:-1] | ~np.concatenate([[False], solid[:-1]])))
    end = np.flatnonzero(solid & (edge[1:] | ~np.concatenate([solid[1:], [False]]))) + 1
    return start, end, np.searchsorted(start, offsets)


def _shingles(data, offsets, size):
    start, end, first = license_words(data, offsets)
    hashes, begin = shingle_hashes(word_hashes(data, start, end), first, size)
    return start, end, first, hashes, begin


class Templates:
    """Signatures of the templates: a bounded table that is sent to tasks."""

    def __init__(self, texts: dict[str, list[str]], shingle: int, contained: float, miss: float):
        self.shingle, self.contained = shingle, contained
        self.names, self.sets, self.words = [], [], []
        for name, forms in sorted(texts.items()):
            for form in forms:
                raw = np.frombuffer(form.encode(), np.uint8)
                values = _shingles(raw, np.array([0, len(raw)]), shingle)[3]
                if len(values):
                    self.names.append(name)
                    self.sets.append(np.unique(values))
                    self.words.append(word_shingles(form, shingle))
        sizes = np.array([len(s) for s in self.sets], np.int64)
        self.length = np.array([1 << (int(n) - 1).bit_length() for n in sizes], np.int64)
        self.classes = [int(L) for L in np.unique(self.length)]
        need = np.ceil(contained * sizes - 1e-9)
        likeness = need / (3 * self.length + sizes - need)
        self.bands = {L: ceil(log(miss) / log(1 - likeness[self.length == L].min())) for L in self.classes}
        most = max(self.bands.values(), default=0)
        self.mul = np.random.default_rng(2).integers(0, 2**31, most, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.signatures = np.array([[coordinate(s.astype(np.uint32), m).min() for m in self.mul] for s in self.sets])
        self.index = {L: [self._band(L, band) for band in range(self.bands[L])] for L in self.classes}

    def _band(self, length: int, band: int):
        """(sorted values, their templates, marks of the values' low 16 bits) of a class's band."""
        which = np.flatnonzero(self.length == length)
        which = which[np.argsort(self.signatures[which, band], kind="stable")]
        values, marks = self.signatures[which, band], np.zeros(1 << 16, bool)
        marks[values.astype(np.uint16)] = True
        return values, which, marks

    def retrieve(self, hashes: np.ndarray, begin: np.ndarray):
        """(class, text numbers, window numbers, templates) of windows that share a band with a
        template of their class, each once; window k begins at shingle k * class."""
        count = np.diff(begin)
        found = {L: [np.zeros((0, 3), np.int64)] for L in self.classes}
        if self.classes:
            # Texts go by the least power of two that holds them, up to the largest class.
            width = np.minimum(1 << np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), self.classes[-1])
            for own in np.unique(width[count > 0]).tolist():
                self._retrieve(hashes, begin, np.flatnonzero((count > 0) & (width == own)), own, found)
        for L in self.classes:
            rows = np.unique(np.concatenate(found[L]), axis=0)
            yield L, rows[:, 0], rows[:, 1], rows[:, 2]

    def _retrieve(self, hashes, begin, texts, width, found):
        """Texts are laid out in multiples of ``width``, filled up with their last shingle, which
        changes no minimum; so blocks halve evenly, down to one block of a short text."""
        count = begin[texts + 1] - begin[texts]
        full = -(-count // width) * width
        first = np.concatenate([[0], np.cumsum(full)])
        rank = np.arange(first[-1]) - np.repeat(first[:-1], full)
        rank = np.minimum(rank, np.repeat(count - 1, full))
        flat = hashes[np.repeat(begin[texts], full) + rank].astype(np.uint32)
        for band, mul in enumerate(self.mul):
            least, block = coordinate(flat, mul), 1
            for L in self.classes:
                while block < min(L, width):
                    least, block = np.minimum(least[0::2], least[1::2]), block * 2
                if band >= self.bands[L]:
                    continue
                last = first[1:] // block - 1
                window = least
                for _ in range(2):
                    ahead = window.copy()
                    np.minimum(window[:-1], window[1:], out=ahead[:-1])
                    ahead[last] = window[last]
                    window = ahead
                values, which, marks = self.index[L][band]
                at = np.flatnonzero(marks.take(window.astype(np.uint16)))
                lo, hi = (np.searchsorted(values, window[at], side) for side in ("left", "right"))
                n = hi - lo
                number = which[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
                at = np.repeat(at, n)
                text = np.searchsorted(last, at)
                k = at - first[text] // block
                real = k * L < count[text]
                found[L].append(np.stack([texts[text], k, number], 1)[real])


def coordinate(values: np.ndarray, mul: np.uint32) -> np.ndarray:
    """A bijection of 32-bit integers for each odd ``mul``; equal values stay equal, so fewer
    bits than the shingles' own lose no collision."""
    x = values * mul
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(12)
    return x


def word_shingles(text: str, size: int) -> set[tuple[bytes, ...]]:
    """The exact shingles of a text: tuples of lower-case words."""
    words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), text.encode()))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def _scan(t: Templates, data: np.ndarray, offsets: np.ndarray):
    """(text number, template, first byte, last byte + 1, containment) of verified passages."""
    start, end, first, hashes, begin = _shingles(data, offsets, t.shingle)
    raw = data.tobytes()
    for L, texts, windows, templates in t.retrieve(hashes, begin):
        at, window = None, set()
        for text, k, number in zip(texts.tolist(), windows.tolist(), templates.tolist()):
            lo = int(begin[text] + k * L)
            hi = int(min(lo + 3 * L, begin[text + 1]))
            base = int(first[text] - begin[text])
            if at != lo:
                at, words_end = lo, int(min(hi + base + t.shingle - 1, first[text + 1]))
                window = word_shingles(raw[start[lo + base] : end[words_end - 1]].decode(errors="replace"), t.shingle)
            share = len(t.words[number] & window) / len(t.words[number])
            if share >= t.contained:
                inside = lo + np.flatnonzero(np.isin(hashes[lo:hi], t.sets[number])) + base
                stop = min(int(inside[-1]) + t.shingle, int(first[text + 1])) - 1
                yield text, number, int(start[inside[0]]), int(end[stop]), share


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, list[str]] | None = None,
    shingle: int = SHINGLE,
    contained: float = CONTAINED,
    miss: float = MISS,
) -> DataFrame:
    """``doc_id, license, passages, containment, first_byte, last_byte``: a row for each
    (row of ``docs``, license) with a verified passage.

    passages counts disjoint passages (overlapping ones are one), containment is the best
    share, the bytes are those of the first passage in the UTF-8 text, end exclusive. Defined
    cases: null and empty texts match nothing; a null doc_id is carried along; repeated rows
    give repeated results; texts and templates with fewer words than a shingle are one
    shingle; without templates or rows there are no results. Only ``doc_id`` and ``text`` are
    read. Templates are a caller's bounded list and are sent to every task.
    """
    t = Templates(TEMPLATES if templates is None else templates, shingle, contained, miss)
    names = ["doc_id", "license", "passages", "containment", "first_byte", "last_byte"]

    def run(batches):
        for batch in batches:
            ids, out = batch.column("doc_id"), []
            for lo, hi, data, offsets in pieces(batch.column("text")):
                found: dict = {}
                for text, number, a, b, share in _scan(t, data, offsets) if t.sets else ():
                    found.setdefault((text, t.names[number]), []).append((a, b, share))
                for (text, name), spans in sorted(found.items()):
                    spans.sort()
                    count, reach = 0, -1
                    for a, b, _ in spans:
                        count, reach = count + (a >= reach), max(reach, b)
                    a, b = spans[0][0], min(s[1] for s in spans if s[0] == spans[0][0])
                    at = int(offsets[text])
                    out.append((ids[lo + text].as_py(), name, count, max(s[2] for s in spans), a - at, b - at))
            rows = list(zip(*out)) if out else [()] * 6
            types = [pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, types)], names=names)

    shape = "doc_id long, license string, passages long, containment double, first_byte long, last_byte long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, shape)
