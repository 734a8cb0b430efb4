"""MinHash near-duplicates by a signature-coordinate inverted join.

A document's signature has ``coordinates`` MinHash values. It is posted under each of its
(coordinate, value) pairs that another document has too. Pairs of documents that agree in at
least ``matches`` coordinates are wanted, so

* skip: a document with fewer than ``matches`` shared pairs is not posted at all;
* prefix: with its pairs ordered from rare to frequent, only as many are posted as must hold
  one of any ``matches`` pairs. Frequent pairs (lines and passages that very many documents
  contain) are posted only by documents that consist of little else.

Short posting lists give candidate pairs, whose collisions are counted on full signatures. A
long list (a large group of near copies) gives none: its members are joined to one cluster.
Clusters of candidates are then compared block against block inside tasks on full shingle
sets; of the links found, a block pair passes on a spanning forest, never all pairs. So a
group of any size is split over many tasks, no link between different sets within it is
lost, and nothing but linked ids leaves the comparison.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvitals.llm.components import components
from netvitals.llm.words import mix, pieces, shingle_sets
from netvitals.plans.shared import settle

COORDINATES = 48
#: Bound of the probability that a pair exactly at the similarity asked for is no candidate.
MISS = 1e-6
SHORT_LIST = 64
BLOCK_ROWS = 256
BLOCK_VALUES = 1 << 19
IDS_TO_BROADCAST = 1_000_000


def match_threshold(similarity: float, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The largest number of coordinates in which a pair of this similarity agrees save with
    probability ``miss``: 27 of 48 for 0.85."""
    below, t = 0.0, 0
    while t < coordinates:
        below += comb(coordinates, t) * similarity**t * (1 - similarity) ** (coordinates - t)
        if below > miss:
            break
        t += 1
    return max(t, 1)


def _signer(shingle: int, coordinates: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key_a", pa.int64()), ("key_b", pa.int64())]
        + [("sig", pa.list_(pa.int64()))]
    )
    rng = np.random.default_rng(3)
    mul = rng.integers(0, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, coordinates, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, data, offsets in pieces(batch.column("text")):
                values, first = shingle_sets(data, offsets, shingle)
                size = np.diff(first)
                some = np.flatnonzero(size)
                at = first[:-1][some]
                keys = np.zeros((2, hi - lo), np.uint64)
                sig = np.zeros((len(some), coordinates), np.uint64)
                if len(some):
                    keys[0, some] = np.add.reduceat(mix(values), at)
                    keys[1, some] = np.add.reduceat(mix(values ^ np.uint64(0xA5A5A5A5)), at)
                    for j in range(coordinates):
                        low = np.minimum.reduceat(values * mul[j] + add[j], at)
                        sig[:, j] = (np.uint64(j) << np.uint64(48)) | (low >> np.uint64(16))
                ends = np.zeros(hi - lo + 1, np.int32)
                ends[1:] = np.cumsum(np.where(size > 0, coordinates, 0))
                sigs = pa.ListArray.from_arrays(pa.array(ends), pa.array(sig.ravel().view(np.int64)))
                columns = [ids.slice(lo, hi - lo), pa.array(size), *(pa.array(k.view(np.int64)) for k in keys), sigs]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run, "doc_id long, n_shingles long, key_a long, key_b long, sig array<long>"


def _set_maker(shingle: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, data, offsets in pieces(batch.column("text")):
                values, first = shingle_sets(data, offsets, shingle)
                sets = [values[first[i] : first[i + 1]].tobytes() for i in range(hi - lo)]
                columns = [ids.slice(lo, hi - lo), pa.array(np.diff(first)), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "members"])

    return run, "doc_id long, n long, members binary"


def spanning_forest(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, smallest vertex of their tree) of a graph, for all but those smallest ones.
    Every round joins each tree to the smallest one it has an edge to."""
    up = np.arange(n)
    while len(left):
        x, y = up[left], up[right]
        open_ = x != y
        left, right, x, y = left[open_], right[open_], x[open_], y[open_]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up[up] != up).any():
            up = up[up]
    rest = np.flatnonzero(up != np.arange(n))
    return rest, up[rest]


def linked_within(sets: list[np.ndarray], part: np.ndarray, percent: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose sets have 100 * intersection >= percent * union; between different
    parts, or all if ``same``. Intersections come from products of incidence matrices over the
    values that occur twice, a slice of values at a time."""
    size = np.array([len(s) for s in sets], np.int64)
    row = np.repeat(np.arange(len(sets)), size)
    values, spot, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    name = np.cumsum(times > 1) - 1
    row, spot = row[times[spot] > 1], name[spot[times[spot] > 1]]
    order = np.argsort(spot, kind="stable")
    row, spot = row[order], spot[order]
    meet = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for lo in range(0, int(spot[-1]) + 1 if len(spot) else 0, width):
        a, b = np.searchsorted(spot, [lo, lo + width])
        has = np.zeros((len(sets), width), np.float32)
        has[row[a:b], spot[a:b] - lo] = 1
        meet += has @ has.T
    common = meet.astype(np.int64)  # sums of ones: exact in float32 below 2**24 values
    either = size[:, None] + size[None, :] - common
    link = np.triu((100 * common >= percent * either) & (common > 0), 1)
    if not same:
        link &= part[:, None] != part[None, :]
    return np.nonzero(link)


def _comparer(percent: int):
    def links(rows):
        ids = np.array([r[0] for r in rows], np.int64)
        part = np.array([r[1] for r in rows])
        order = np.argsort(ids, kind="stable")
        sets = [np.frombuffer(rows[i][2], np.uint64) for i in order]
        same = rows[0][3] == rows[0][4]
        x, y = linked_within(sets, part[order], percent, same)
        ids = ids[order]
        v, top = spanning_forest(len(ids), x, y)
        return list(zip(ids[v].tolist(), ids[top].tolist()))

    def run(batches):
        held, key, found = [], None, []
        for batch in batches:
            names = ("cluster", "low", "high", "doc_id", "block", "members")
            for c, lo, hi, i, k, m in zip(*(batch.column(n).to_pylist() for n in names)):
                if (c, lo, hi) != key:
                    if len(held) > 1:
                        found += links(held)
                    held, key = [], (c, lo, hi)
                held.append((i, k, m, lo, hi))
            if len(found) > 10_000:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], SCHEMA)
                found = []
        if len(held) > 1:
            found += links(held)
        yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], SCHEMA)

    return run


SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def candidate_clusters(
    signed: DataFrame, matches: int, short_list: int = SHORT_LIST
) -> DataFrame:
    """(id, component): clusters that hold every pair agreeing in ``matches`` coordinates.

    ``signed`` has one row (doc_id, sig) per set; sig holds coordinate-value pairs as longs.
    """
    posts = signed.select("doc_id", F.explode("sig").alias("pair"))
    often = posts.groupBy("pair").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    shared = posts.join(often, "pair").groupBy("doc_id").agg(
        F.collect_list(F.struct("times", "pair")).alias("pairs")
    )
    shared = shared.filter(F.size("pairs") >= matches).select(
        "doc_id", F.slice(F.sort_array("pairs"), F.lit(1), F.size("pairs") - (matches - 1)).alias("prefix")
    )
    prefix = settle(shared.select("doc_id", F.explode("prefix.pair").alias("pair")), "near_prefix")
    lists = prefix.groupBy("pair").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"))
    lists = settle(lists.filter("n > 1"), "near_lists")
    long = prefix.join(lists.filter(F.col("n") > short_list), "pair")
    together = long.select(F.col("doc_id").alias("a"), F.col("least").alias("b")).filter("a != b").distinct()
    short = prefix.join(lists.filter(F.col("n") <= short_list).select("pair"), "pair")
    short = settle(short, "near_short")
    pairs = short.select("pair", F.col("doc_id").alias("a")).join(
        short.select("pair", F.col("doc_id").alias("b")), "pair"
    )
    pairs = pairs.filter("a < b").select("a", "b").distinct()
    pairs = pairs.join(signed.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a")
    pairs = pairs.join(signed.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b")
    agree = pairs.filter(F.size(F.array_intersect("sig_a", "sig_b")) >= matches).select("a", "b")
    return components(together.unionByName(agree))


def verified_links(
    docs: DataFrame, clusters: DataFrame, shingle: int, percent: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(a, b): a spanning set of the links within ``clusters``, decided on full shingle sets."""
    ids = clusters.select(F.col("id").alias("doc_id"))
    if clusters.count() <= IDS_TO_BROADCAST:  # 8 bytes each; more go by a shuffled join
        ids = F.broadcast(ids)
    run, schema = _set_maker(shingle)
    wanted = docs.join(ids, "doc_id", "left_semi").select("doc_id", "text")
    sets = settle(wanted.mapInArrow(run, schema).filter("n > 0"), "near_sets")
    # Of rows that repeat an id, the largest set counts.
    one = sets.groupBy("doc_id").agg(F.max("n").alias("n"))
    sizes = clusters.select(F.col("id").alias("doc_id"), F.col("component").alias("cluster")).join(one, "doc_id")
    blocks = sizes.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.ceil(F.sum("n") / BLOCK_VALUES)).cast("int").alias("blocks")
    )
    placed = sizes.join(blocks, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    )
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    placed = placed.withColumn("other", F.explode(every)).select(
        "doc_id",
        "n",
        "cluster",
        "block",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    )
    placed = settle(placed, "near_blocks")
    rows = placed.join(sets, ["doc_id", "n"]).withColumn("spot", F.xxhash64("cluster", "low", "high"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "spot").sortWithinPartitions("spot", "cluster", "low", "high", "doc_id")
    names = ("cluster", "low", "high", "doc_id", "block", "members")
    return settle(rows.select(*names).mapInArrow(_comparer(percent), "a long, b long"), "near_links")


def near_groups(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    coordinates: int = COORDINATES,
    miss: float = MISS,
    short_list: int = SHORT_LIST,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when 100 * |intersection| >= percent * |union| of their shingle
    sets; component_id is the smallest id reachable. Defined cases: null or empty texts and
    texts of white space have n_shingles 0 and are linked with nothing; fewer words than a
    shingle form one shingle; rows that repeat an id are one document, counted with its
    largest set (links of any set of that size count); each row with a null id is a document alone, its
    component_id null and kept true; no rows give no rows. Only ``doc_id`` and ``text`` are
    read. Shingles are 64-bit hashes; sets with equal 128-bit sums count as equal.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run, schema = _signer(shingle, coordinates)
    signed = settle(docs.mapInArrow(run, schema), "near_signed")
    lone = signed.filter("doc_id IS NULL").select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")
    )
    light = signed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.struct("n_shingles", "key_a", "key_b")).alias("s")
    )
    light = settle(light.select("doc_id", "s.*"), "near_keys")
    keys = ["n_shingles", "key_a", "key_b"]
    classes = light.filter("n_shingles > 0").groupBy(*keys).agg(F.min("doc_id").alias("head"))
    classes = settle(classes, "near_classes")
    heads = classes.select(F.col("head").alias("doc_id"), *keys)
    sigs = signed.join(heads, ["doc_id", *keys], "left_semi").dropDuplicates(["doc_id"])
    sigs = settle(sigs.select("doc_id", "sig"), "near_heads")
    matches = match_threshold(percent / 100, coordinates, miss)
    clusters = settle(candidate_clusters(sigs, matches, short_list), "near_clusters")
    links = verified_links(docs, clusters, shingle, percent)
    found = components(links).select(F.col("id").alias("head"), "component")
    named = settle(classes.join(found, "head", "left"), "near_named").select(
        *keys, F.coalesce("component", "head").alias("class_component")
    )
    # A large group of copies shares one class: members are joined with AQE's skew handling.
    whole = light.join(named, keys, "left").select(
        "doc_id", "n_shingles", F.coalesce("class_component", "doc_id").alias("component_id")
    )
    return whole.withColumn("kept", F.col("doc_id") == F.col("component_id")).unionByName(lone)


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document stays: one of each group, all columns kept. Rows
    with a null id stay. Takes the options of `near_groups`."""
    gone = near_groups(docs, **options).filter("NOT kept").select(F.col("doc_id").alias("gone"))
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
