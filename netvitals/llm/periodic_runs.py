"""Periodic runs of words: stretches that repeat one phrase three times and more.

A run is a maximal stretch of words with least period q and at least max(24, 3q) words. Every
run has a root that is the longest Lyndon word starting at its place under one of the two orders
of the alphabet. So the roots of all places under both orders are the candidates, and each is
extended to both sides by the longest common extension (LCE) of two places a root apart:

* Ukkonen's algorithm makes the suffix trees of the words and of their reversal;
* a walk of a tree gives its leaves in order and the depth at each turning point between two of
  them, and the LCE of two places is the least depth between their leaves, found in constant
  time in a sparse table;
* the order of the leaves also gives the next smaller suffix, and thereby the Lyndon words.

The trees are built over the parts of a text where runs may lie. Every 8-gram of a run occurs
again at distance q, before or after (its length is at least 2q + 7), and q is at most a third of
the part around it; so a part is a stretch of places whose 8-gram recurs within a third of the
part's length, and no run is cut or lost. Equal 8-grams are found by hashes, words in the trees
are compared whole.

Defined results: null and empty texts have no runs and an empty collapsed text; repeated rows
and rows without an id give a row each; an empty table gives none. Memory is some 600 bytes for
each word of the longest part; a text is one row and is never split over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netvitals.llm.words import mix, pieces, shingle_hashes, spans, word_hashes

LEAST_WORDS = 24
LEAST_EXPONENT = 3
GRAM = 8
RUNS_DDL = "array<struct<start: bigint, length: bigint, period: bigint>>"


def suffix_tree(s: list[int], width: int) -> tuple[dict[int, int], list[int], list[int]]:
    """(children, starts, ends) of Ukkonen's suffix tree of ``s``, whose last symbol occurs once.

    Symbols are below ``width``; the child of node v by symbol c is children[v * width + c]; a
    node's edge is s[start:end]. Leaves end at len(s) and are made in the order of their suffixes.
    """
    n = len(s)
    children: dict[int, int] = {}
    starts, ends, links = [0], [0], [0]
    node = edge = length = waiting = 0
    for i, c in enumerate(s):
        waiting += 1
        made = 0
        while waiting:
            if not length:
                edge = i
            key = node * width + s[edge]
            below = children.get(key)
            if below is None:
                children[key] = len(starts)
                starts.append(i)
                ends.append(n)
                links.append(0)
                upper = node
            else:
                start = starts[below]
                span = min(ends[below], i + 1) - start
                if length >= span:
                    node, edge, length = below, edge + span, length - span
                    continue
                if s[start + length] == c:
                    length += 1
                    if made:
                        links[made] = node
                    break
                upper = len(starts)
                children[key] = upper
                starts += [start, i]
                ends += [start + length, n]
                links += [0, 0]
                starts[below] = start + length
                children[upper * width + s[start + length]] = below
                children[upper * width + c] = upper + 1
            if made:
                links[made] = upper
            made = upper if below is not None else 0
            waiting -= 1
            if node:
                node = links[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return children, starts, ends


def leaf_tour(tree, width: int, backwards: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, turns): suffixes in lexical order, and the depth of the tour's turning point
    between each and the one before it. ``backwards`` reverses the order of the symbols other
    than the last, 0, which comes first in both orders."""
    children, starts, ends = tree
    keys = np.fromiter(children.keys(), np.int64, len(children))
    below = np.fromiter(children.values(), np.int64, len(children))
    parent, symbol = keys // width, keys % width
    if backwards:
        symbol = (width - symbol) % width
    order = np.lexsort((-symbol, parent))  # a stack gives them back in rising order
    below = below[order].tolist()
    first = np.searchsorted(parent[order], np.arange(len(starts) + 1)).tolist()
    # leaves are numbered in the order of their making
    inner = np.diff(np.array(first)) > 0
    suffix = (np.cumsum(~inner) - 1).tolist()
    depth = [0] * len(starts)
    suffixes, turns, low = [], [], 0
    stack, above = below[first[0] : first[1]], [0] * (first[1] - first[0])
    while stack:
        node, up = stack.pop(), above.pop()
        if up >= 0:
            low = depth[up]
        else:
            up = -up - 1
        a, b = first[node], first[node + 1]
        if a == b:
            suffixes.append(suffix[node])
            turns.append(low)
            continue
        depth[node] = depth[up] + ends[node] - starts[node]
        stack += below[a:b]
        above += [node] * (b - a - 1)
        above.append(-node - 1)  # the first child does not turn at its parent
    return np.array(suffixes, np.int64), np.array(turns, np.int64)


class Extensions:
    """LCE queries between places of a text in constant time each."""

    def __init__(self, suffixes: np.ndarray, turns: np.ndarray):
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.table = [turns.astype(np.int32)]
        step = 1
        while 2 * step <= len(turns):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(i), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.table[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k)) + 1])
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """For each place, the next one whose suffix is smaller."""
    out, stack = [0] * len(rank), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    for i in stack:
        out[i] = len(rank)
    return out


def runs_of(
    words: list[bytes], least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT
) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a list of words, by start and period."""
    n = len(words)
    names: dict[bytes, int] = {}
    s = [names.setdefault(w, len(names) + 1) for w in words]
    width = len(names) + 1
    tree = suffix_tree([*s, 0], width)
    rising = leaf_tour(tree, width)
    ahead = Extensions(*rising)
    falling = np.empty(n + 1, np.int64)
    falling[leaf_tour(tree, width, backwards=True)[0]] = np.arange(n + 1)
    del tree
    back = Extensions(*leaf_tour(suffix_tree([*s[::-1], 0], width), width))
    places = np.arange(n)
    found = []
    for rank in (ahead.rank, falling):
        root = np.array(next_smaller(rank[:n].tolist()), np.int64) - places
        i, p = places[places + root <= n - 1], root[places + root <= n - 1]
        right = ahead(i, i + p)
        # a run of the least exponent has a root in which it goes on for a root at least
        i, p, right = i[right >= p], p[right >= p], right[right >= p]
        left = np.zeros(len(i), np.int64)
        inside = i > 0
        left[inside] = back(n - i[inside], n - i[inside] - p[inside])
        length = left + p + right
        whole = length >= np.maximum(least, exponent * p)
        found.append(np.stack([i - left, length, p], 1)[whole])
    both = np.unique(np.concatenate(found), axis=0)
    return sorted((int(a), int(b), int(q)) for a, b, q in both)


def likely_parts(words: np.ndarray, first: np.ndarray, least: int, exponent: int) -> list[tuple[int, int, int]]:
    """(text, from, to): parts of texts that hold all runs, from hashes of words."""
    grams, begin = shingle_hashes(words, first, GRAM)
    text = np.repeat(np.arange(len(first) - 1), np.diff(begin))
    key = grams ^ mix(text.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    step = np.where(same, order[1:] - order[:-1], len(key) + 1)
    near = np.full(len(key), len(key) + 1, np.int64)
    near[order[:-1]] = step
    near[order[1:]] = np.minimum(near[order[1:]], step)
    live = near <= len(key)
    while True:
        edge = np.ones(len(live) + 1, bool)
        edge[1:-1] = text[1:] != text[:-1]
        ahead = np.concatenate([[False], live])
        behind = np.concatenate([live, [False]])
        start = np.flatnonzero(behind & (~ahead | edge))
        end = np.flatnonzero(ahead & (~behind | edge))
        length = end - start + GRAM - 1
        bound = np.where(length >= least, length // exponent, 0)
        limit = np.zeros(len(live), np.int64)
        limit[live] = np.repeat(bound, end - start)
        kept = live & (near <= limit)
        if kept.sum() == live.sum():
            break
        live = kept
    at = begin[text[start]]
    return list(zip(text[start].tolist(), (start - at).tolist(), (end - at + GRAM - 1).tolist()))


def _runs(batches: Iterator[pa.RecordBatch], least: int, exponent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, offsets in pieces(batch.column("text")):
            start, end, first = spans(data, offsets)
            parts = likely_parts(word_hashes(data, start, end, fold=False), first, least, exponent)
            raw = data.tobytes()
            found: dict[int, list] = {}
            for text, a, b in parts:
                words = raw[offsets[text] : offsets[text + 1]].split()
                own = found.setdefault(text, [])
                own += [(a + s, n, q) for s, n, q in runs_of(words[a:b], least, exponent)]
            kept, runs = [], []
            for text in range(high - low):
                words = raw[offsets[text] : offsets[text + 1]].split()
                own = sorted(found.get(text, ()), key=lambda r: (r[0], r[2]))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                if own:
                    stays = np.ones(len(words), bool)
                    for s, n, q in own:
                        stays[s + q : s + n] = False
                    words = [w for w, stay in zip(words, stays.tolist()) if stay]
                kept.append(b" ".join(words).decode())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(low, high - low), pa.array(runs, kind), pa.array(kept, pa.large_string())],
                names=["row", "runs", "collapsed"],
            )


def find_runs(
    docs: DataFrame,
    text: str = "text",
    least: int = LEAST_WORDS,
    exponent: int = LEAST_EXPONENT,
    keep: list[str] | None = None,
) -> DataFrame:
    """The rows of ``docs`` with ``runs`` (start, length, period; in words, by start and period)
    and ``collapsed``, the text's words without the repeats, joined by spaces: of each run only
    the first period stays. ``keep`` names the columns of docs that go along, all by default; one
    that is called runs or collapsed is replaced.

    ``least`` is at least three times ``GRAM``, ``exponent`` at least 3: below that the parts
    searched would not hold every run.
    """
    if least < 3 * GRAM or exponent < 3:
        raise ValueError(f"runs of {3 * GRAM} words and exponent 3 are the least")
    others = [c for c in (docs.columns if keep is None else keep) if c not in ("runs", "collapsed")]
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")
    given = docs.select(row, F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([given.schema["row"], *T.StructType.fromDDL(f"runs {RUNS_DDL}, collapsed string")])
    found = given.mapInArrow(lambda batches: _runs(batches, least, exponent), schema)
    return found.select(*[F.col("row").getField(c).alias(c) for c in others], "runs", "collapsed")


def longest_exponent(runs: Column) -> Column:
    """The run with the greatest length / period; of equal ones the first. Whole numbers only."""
    return F.aggregate(
        runs,
        F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by the checksum of its id, goes on periodically from some
    word: word i becomes word a + (i - a) % p."""
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    staged = docs.withColumns({"_h": h, "_w": F.when(h % 10 == 0, words)})
    n, g = F.size("_w"), F.floor(F.col("_h") / 10)
    a = F.try_mod(g, n.cast("bigint")).cast("int")
    tail = n - a
    p = (1 + F.floor(tail / (3 + g % 8))).cast("int")
    times = F.ceil(tail / p).cast("int")
    cycle = F.slice(F.flatten(F.array_repeat(F.slice("_w", a + 1, p), times)), F.lit(1), tail)
    planted = F.array_join(F.concat(F.slice("_w", F.lit(1), a), cycle), " ")
    text = F.when((F.col("_h") % 10 == 0) & (n > 0), planted).otherwise(F.col("text"))
    return staged.withColumn("text", text).drop("_h", "_w")


def run_digests(docs: DataFrame) -> DataFrame:
    """Runs of every document with planted periods: their number, the run of the greatest
    exponent, and digests of all runs and of the collapsed text."""
    found = find_runs(with_planted_periods(docs.select("doc_id", "text")), keep=["doc_id"])
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = longest_exponent(F.col("runs"))
    rows = found.select("doc_id", "runs", "collapsed", best.alias("best"), F.array_join(line, "").alias("lines"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
