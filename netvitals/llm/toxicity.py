"""Toxicity scores of deobfuscated text.

1. A character trigram model is counted over every document (a table of at most 36**3 counts).
2. Words written with look-alike signs, separators, stray spaces or stretched letters are
   restored: a lattice holds what each sign may stand for, a space in a run of short tokens being
   a word boundary or nothing, and a Viterbi pass finds the reading that is likeliest under the
   character model and the noisy channel below. Tokens of any length are decoded; of a sign
   repeated more than three times three are read, which the channel takes alike.
3. Restored words are scored by a logistic model over words, word beginnings and character
   n-grams. It is fitted on a bounded sample of the labelled rows outside the held-out fold;
   candidate features are counted over that sample by Spark and the best ones kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvitals.llm.words import mix, pieces, spans, word_hashes
from netvitals.plans.shared import settle

#: Labelled rows a model is fitted on, at most (about; rows are drawn by a hash of their id).
TRAIN_ROWS = 20_000
#: Features of the model, at most, and the number of slots features are hashed into.
FEATURES = 4096
SLOTS = 1 << 20
LEAST_ROWS = 3

#: What a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "l", "+": "t",
}
SYMBOLS = 36  # word boundary, a-z, nine classes of other bytes
#: The channel: a letter written as a look-alike, a separator put in, a look-alike put in for no
#: letter, a letter doubled by mistake, a letter or sign stretched to three and more, a space put
#: into a word.
LOOKALIKE, INSERTED, SIGN_INSERTED, DOUBLED, STRETCHED = log(0.05), log(0.05), log(1e-6), log(0.002), log(0.3)
SPACED = log(0.1)
#: Tokens of so many bytes may be parts of a spaced word; a run of them is decoded as one if two
#: are no usual words: below this log probability as a word of their own, and as much a letter.
SHORT = 4
USUAL, USUAL_LETTER = -4.0, -2.0
EDGES = ".,;:?!\"'()[]{}%&#*~<>/\\=^`_-"

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = 27 + np.arange(128) % 9
_LETTER = _SYMBOL > 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TRIM = np.zeros(256, bool)
_TRIM[[ord(c) for c in EDGES]] = True
_TRIM_FRONT = _TRIM.copy()
_TRIM_FRONT[ord("!")] = False  # before a letter it is one itself
_SIGN = _LETTER.copy()
_SIGN[[ord(c) for c in LOOKALIKES]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_REPEATED = re.compile(rb"([\x21-\x7f])\1{3,}")


def _lower(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the capitals of Latin-1 in lower case."""
    low = _LOWER[data]
    if len(low) > 1:
        second = np.flatnonzero((low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)) + 1
        low[second] += 0x20
    return low


# --- character model ---------------------------------------------------------------------


def _trigrams(batches):
    total = np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        for _, _, data, _ in pieces(batch.column("text")):
            s = np.zeros(len(data) + 3, np.int64)
            s[2:-1] = _SYMBOL[data]
            total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["code", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(symbol | two before it), counted over all texts; at most 36**3 numbers."""
    counts = docs.select("text").mapInArrow(_trigrams, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    table = np.full(SYMBOLS**3, 0.1)
    seen = counts.toArrow()  # columns, not row objects
    table[seen["code"].to_numpy()] += seen["n"].to_numpy()
    table = table.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    return np.log(table / table.sum(2, keepdims=True)).astype(np.float32)


class Restorer:
    """Reads obfuscated words; answers are remembered up to a fixed number of words."""

    def __init__(self, model: np.ndarray, remember: int = 200_000):
        self.table, self.model, self.known, self.remember = model, model.tolist(), {}, remember
        self.first = np.log(np.exp(model[1:27, 0]).mean(0))  # the first letter of a word

    def __call__(self, token: bytes) -> bytes:
        if token not in self.known:
            if len(self.known) >= self.remember:
                self.known.clear()
            self.known[token] = self.decode(token)
        return self.known[token]

    def choices(self, token: bytes, i: int) -> list[tuple[bytes, float]]:
        """Readings of the sign at i, each a letter or nothing, with the channel's log probability."""
        sign, drop = token[i : i + 1], []
        if i and token[i - 1] == token[i] and token[i] < 128:
            long = token[i - 2 : i] == sign * 2 or token[i + 1 : i + 2] == sign
            drop = [(b"", STRETCHED if long else DOUBLED)]
        if _LETTER[token[i]]:
            return [(sign, 0.0)] + drop
        told = LOOKALIKES.get(chr(token[i]))
        if told is None:
            return [(b"", INSERTED)]
        return [(c.encode(), LOOKALIKE) for c in told] + (drop or [(b"", SIGN_INSERTED)])

    def decode(self, token: bytes) -> bytes:
        """The likeliest reading of a lower-case token, or of tokens with spaces between them;
        ties go to the first choice. Linear in the token: readings are linked backwards."""
        token = _REPEATED.sub(rb"\1\1\1", token)
        best: dict = {(0, 0): (0.0, None)}
        for i, sign in enumerate(token):
            now: dict = {}
            ways = [(b" ", 0.0), (b"", SPACED)] if sign == 32 else self.choices(token, i)
            for (a, b), (score, read) in best.items():
                for letter, chance in ways:
                    if letter:
                        c = int(_SYMBOL[letter[0]])
                        key, value, node = (b, c), score + chance + self.model[a][b][c], (read, letter)
                    else:
                        key, value, node = (a, b), score + chance, read
                    if key not in now or value > now[key][0]:
                        now[key] = (value, node)
            best = now
        node = max(best.items(), key=lambda x: x[1][0] + self.model[x[0][0]][x[0][1]][0])[1][1]
        letters = []
        while node:
            node, letter = node
            letters.append(letter)
        return b"".join(letters[::-1])

    def usual(self, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether each short token is likely as a word of its own."""
        a = b = np.zeros(len(start), np.int64)
        total = np.zeros(len(start))
        for i in range(SHORT + 1):
            live = start + i <= end
            c = np.where(start + i < end, _SYMBOL[low[np.minimum(start + i, len(low) - 1)]], 0)
            total += np.where(live, self.table[a, b, c] if i else self.first[c], 0)
            a, b = b, c
        return total >= USUAL + USUAL_LETTER * (end - start)


def _count(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many flags are set in each span."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[end] - total[start]


def noisy(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which tokens have to be decoded: letters with other signs among them, a letter three times
    in a row, or look-alikes alone that are not all digits."""
    letters = _count(_LETTER[low], start, end)
    thrice = np.zeros(len(low), bool)
    if len(low) > 2:
        thrice[:-2] = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & (low[2:] < 128)
    stretched = _count(thrice, start, np.maximum(end - 2, start)) > 0
    size = end - start
    signs = (letters == 0) & (size > 1) & (_count(_SIGN[low], start, end) == size) & (_count(_DIGIT[low], start, end) < size)
    return ((letters > 0) & (stretched | (letters < size))) | signs


def trimmed(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans without punctuation at their edges (an inner sign stays)."""
    front, back = np.flatnonzero(~_TRIM_FRONT[low]), np.flatnonzero(~_TRIM[low])
    if not len(back):
        return start, start.copy()
    first = front[np.minimum(np.searchsorted(front, start), len(front) - 1)]
    last = back[np.maximum(np.searchsorted(back, end) - 1, 0)] + 1
    empty = (first < start) | (first >= end) | (last <= first)
    return np.where(empty, start, first), np.where(empty, start, last)


def spaced_runs(low: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray, restore: Restorer):
    """(from, to) of the runs of short tokens of one text that may be words with spaces put in."""
    size = end - start
    short = (size > 0) & (size <= SHORT) & (_count(_SIGN[low], start, end) == size)
    at = np.flatnonzero(short)
    if not len(at):
        return at, at
    own, stop = start[at], end[at]
    odd = ~restore.usual(low, own, stop)
    lettered = odd & (_count(_LETTER[low], own, stop) > 0)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (text[at[1:]] != text[at[:-1]])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at))
    runs = (_count(odd, head, tail) > 1) & (_count(lettered, head, tail) > 0)
    return at[head[runs]], at[tail[runs] - 1] + 1


def restored_words(data: np.ndarray, offsets: np.ndarray, restore: Restorer):
    """(bytes, start, end, text number) of the words to score: tokens without punctuation at
    their edges, decoded where noisy, and the words read in runs of short tokens."""
    low = _lower(data)
    start, end, first = spans(low, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    start, end = trimmed(low, start, end)
    odd = noisy(low, start, end)
    plain = ~odd & (end > start)
    extra, own = [], []
    raw = low.tobytes()
    for a, b in zip(*spaced_runs(low, start, end, text, restore)):
        words = restore(b" ".join(raw[i:j] for i, j in zip(start[a:b], end[a:b]))).split()
        extra += words
        own += [text[a]] * len(words)
        odd[a:b] = plain[a:b] = False
    for i in np.flatnonzero(odd):
        extra.append(restore(raw[start[i] : end[i]]))
        own.append(text[i])
    added = np.frombuffer(b"".join(extra), np.uint8)
    size = np.array([len(x) for x in extra], np.int64)
    to = len(low) + np.cumsum(size)
    return (
        np.concatenate([low, added]),
        np.concatenate([start[plain], to - size]),
        np.concatenate([end[plain], to]),
        np.concatenate([text[plain], np.array(own, np.int64)]),
    )


# --- features and the model --------------------------------------------------------------


def hashed_features(data, start, end):
    """(distinct words, the word of each place, owner, slot): the slots of each distinct word,
    which are the word itself, its beginnings of 3 to 6 bytes and all its runs of 5 bytes."""
    def hashes(a, b, kind):
        return mix(word_hashes(data, a, b, fold=False) + np.uint64(kind << 32))

    whole = hashes(start, end, 1)
    word, at = np.unique(whole, return_index=True)
    a, b = start[at], end[at]
    slots, owner = [word], [np.arange(len(word))]
    for size in (3, 4, 5, 6):
        has = np.flatnonzero(b - a >= size)
        slots.append(hashes(a[has], a[has] + size, 2))
        owner.append(has)
    runs = np.maximum(b - a - 4, 0)
    has = np.repeat(np.arange(len(word)), runs)
    inner = np.arange(len(has)) - np.repeat(np.cumsum(runs) - runs, runs)
    slots.append(hashes(a[has] + inner, a[has] + inner + 5, 3))
    owner.append(has)
    return word, whole, np.concatenate(owner), (np.concatenate(slots) >> np.uint64(44)).astype(np.int64)


def text_slots(data, start, end, text, wanted: np.ndarray | None = None):
    """Distinct (text, feature) pairs; with ``wanted`` (a number for each slot, -1: none) only
    those, under their numbers."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word, whole, owner, slot = hashed_features(data, start, end)
    if wanted is not None:
        slot = wanted[slot].astype(np.int64)
        owner, slot = owner[slot >= 0], slot[slot >= 0]
    order = np.argsort(owner, kind="stable")
    owner, slot = owner[order], slot[order]
    low, high = np.searchsorted(owner, np.arange(len(word))), np.searchsorted(owner, np.arange(len(word)), "right")
    place = np.searchsorted(word, whole)
    count = (high - low)[place]
    hit = np.flatnonzero(count)
    place, count, of = place[hit], count[hit], text[hit]
    # A word counts once for its text.
    pair, at = np.unique(of * len(word) + place, return_index=True)
    place, count, of = place[at], count[at], of[at]
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    got = slot[np.repeat(low[place], count) + inner]
    both = np.unique(np.repeat(of, count) * SLOTS + got)
    return both // SLOTS, both % SLOTS


@dataclass
class ToxicModel:
    """Fixed-size tables: a number for each slot (-1: unused), weights, the character model."""

    characters: np.ndarray
    wanted: np.ndarray = field(default_factory=lambda: np.full(SLOTS, -1, np.int16))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -20.0

    def score(self, texts) -> np.ndarray:
        """Probability of the toxic label for each text of an Arrow string array."""
        restore = Restorer(self.characters)
        return self._scores(texts, restore)

    def _scores(self, texts, restore) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        if len(self.weights):
            for lo, hi, data, offsets in pieces(texts):
                row, number = text_slots(*restored_words(data, offsets, restore), self.wanted)
                out[lo:hi] += np.bincount(row, self.weights[number], hi - lo)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no model sees: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def _slot_counter(characters):
    def run(batches):
        restore = Restorer(characters)
        for batch in batches:
            label = np.array(batch.column("toxic").to_pylist(), np.int64)
            for lo, hi, data, offsets in pieces(batch.column("text")):
                row, slot = text_slots(*restored_words(data, offsets, restore))
                both, n = np.unique(slot * 2 + label[lo:hi][row], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(both), pa.array(n)], names=["slot", "n"])

    return run


def _slot_finder(characters, wanted):
    def run(batches):
        restore = Restorer(characters)
        for batch in batches:
            label = batch.column("toxic")
            for lo, hi, data, offsets in pieces(batch.column("text")):
                row, number = text_slots(*restored_words(data, offsets, restore), wanted)
                cuts = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(cuts), pa.array(number.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([label.slice(lo, hi - lo), found], names=["toxic", "numbers"])

    return run


def fit_weights(labels: np.ndarray, rows: np.ndarray, numbers: np.ndarray, n: int, ridge: float = 0.5):
    """(weights, bias) of a logistic model over present features, by accelerated gradient steps."""
    size = len(labels)
    often = np.bincount(numbers, minlength=n) + 1.0
    w, bias = np.zeros(n), log((labels.sum() + 0.5) / (size - labels.sum() + 0.5))
    v, vb = w.copy(), bias
    most = max(1.0, np.bincount(rows, minlength=size).max(initial=1))
    step = 4.0 / most
    for t in range(400):
        p = 1 / (1 + np.exp(-np.clip(vb + np.bincount(rows, v[numbers], size), -30, 30)))
        gap = p - labels
        grad = np.bincount(numbers, gap[rows], n) + ridge * v
        new, nb = v - step * grad / often, vb - step * gap.mean()
        v, vb = new + (new - w) * t / (t + 3), nb + (nb - bias) * t / (t + 3)
        w, bias = new, nb
    return w, float(bias)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, features: int = FEATURES) -> ToxicModel:
    """A model of ``toxic`` from labelled rows outside the held-out fold.

    About ``rows`` of them at most are drawn by a hash of their id; of several labels of one
    id the larger counts; null labels and ids are left out. Without rows of both labels the
    model knows no words and its score is the share of toxic labels (0 without labels).
    """
    spark = docs.sparkSession
    characters = character_model(docs)
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("_id")))
    known = settle(known.groupBy("_id").agg(F.max("toxic").alias("toxic")), "toxic_labels")
    share = min(1.0, rows / max(1, known.count()))
    draw = F.pmod(F.xxhash64(F.col("_id"), F.lit("train")), F.lit(1 << 30)) < int(share * (1 << 30))
    drawn = known.filter(draw)
    # About ``rows`` ids: a bounded broadcast.
    met = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
    met = settle(met.select("text", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic")), "toxic_train")
    seen = dict(met.groupBy("toxic").count().collect())
    clean, toxic = seen.get(0, 0), seen.get(1, 0)
    if not clean or not toxic:
        return ToxicModel(characters, bias=log((toxic + 1e-9) / (clean + 1e-9)) if clean + toxic else -20.0)
    counts = met.mapInArrow(_slot_counter(characters), "slot long, n long").groupBy(
        F.shiftright("slot", 1).alias("slot")
    ).agg(
        F.sum(F.when(F.col("slot") % 2 == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("slot") % 2 == 0, F.col("n")).otherwise(0)).alias("c"),
    )
    seen_rows, all_rows = F.col("t") + F.col("c"), F.lit(float(clean + toxic))

    def part(found, row, column):
        return F.when(found > 0, found * F.log(found * all_rows / (row * column))).otherwise(0.0)

    rest = all_rows - seen_rows
    gain = (
        part(F.col("t"), seen_rows, F.lit(float(toxic)))
        + part(F.col("c"), seen_rows, F.lit(float(clean)))
        + part(F.lit(float(toxic)) - F.col("t"), rest, F.lit(float(toxic)))
        + part(F.lit(float(clean)) - F.col("c"), rest, F.lit(float(clean)))
    )
    best = counts.filter(seen_rows >= LEAST_ROWS).withColumn("gain", gain).filter("gain > 3")
    slots = [r[0] for r in best.orderBy(F.desc("gain"), "slot").limit(features).select("slot").collect()]
    wanted = np.full(SLOTS, -1, np.int16)
    wanted[slots] = np.arange(len(slots))
    # The sample's features that were kept: rows * features numbers at most, far fewer in fact.
    found = met.mapInArrow(_slot_finder(characters, wanted), "toxic int, numbers array<int>").toArrow()
    lists = found["numbers"].combine_chunks()
    of = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    numbers = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    weights, bias = fit_weights(found["toxic"].to_numpy().astype(np.float64), of, numbers, len(slots))
    return ToxicModel(characters, wanted, weights, bias)


def toxicity_scores(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """``docs`` with a column ``score`` added (an existing one is replaced); every whole text,
    null as empty. Repeated rows are scored alike; other columns pass through unread."""
    names = [c for c in docs.columns if c != "score"]
    shape = docs.select(*names).withColumn("score", F.lit(0.0)).schema

    def run(batches):
        restore = Restorer(model.characters)
        for batch in batches:
            score = pa.array(model._scores(batch.column("text"), restore))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, "score"])

    return docs.select(*names).mapInArrow(run, shape)


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row: the model is trained on the
    labels and applied to all texts. Null ids are scored and count as not held out."""
    model = train(docs, labels, rows)
    scored = toxicity_scores(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns kept."""
    names = docs.columns
    free = "text_score"
    while free.lower() in [c.lower() for c in names]:
        free += "_"
    model = train(docs, labels, rows)
    shape = docs.withColumn(free, F.lit(0.0)).schema

    def run(batches):
        restore = Restorer(model.characters)
        at = names.index("text")
        for batch in batches:
            score = pa.array(model._scores(batch.column(at), restore))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, free])

    return docs.mapInArrow(run, shape).filter(F.col(free) < threshold).drop(free)
