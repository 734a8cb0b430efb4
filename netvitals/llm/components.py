"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvitals.plans.shared import settle


#: Rows that a join may broadcast. A table's compressed files tell too little of its size.
ROWS_TO_BROADCAST = 100_000


def joinable(frame: DataFrame, rows: int) -> DataFrame:
    """The frame as a smaller side of joins, broadcast by its number of rows or not at all."""
    return frame.hint("broadcast" if rows <= ROWS_TO_BROADCAST else "merge")


def _rank(name: str, turn: int) -> Column:
    """A random order of vertices, another in each round: a hub or a sorted chain is then
    contracted by a constant share per round whatever its ids are."""
    return F.struct(F.xxhash64(F.col(name), F.lit(turn)).alias("h"), F.col(name).alias("v"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id with an edge to another; component is the smallest id reachable.

    Each round gives every vertex the lowest-ranked of itself and its neighbours as its
    parent, follows parents one step further, and replaces edges by those between different
    parents. Both tables of a round are written to the shared folder, so that the lineage
    stays short and a lost executor costs one round at most. Neighbour minima are combined
    map-side, so a hub's edges do not meet in one task. Null ends and loops are left out.
    """
    live = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    live = live.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    live = settle(live.distinct(), "edges")
    maps = []
    while not live.isEmpty():
        turn = len(maps)
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(_rank("b", turn)).alias("n"))
        parent = low.select(F.col("a").alias("id"), F.least(_rank("a", turn), F.col("n"))["v"].alias("up"))
        parent = settle(parent, "parents")
        n = parent.count()
        above = parent.select(F.col("id").alias("up"), F.col("up").alias("top"))
        parent = settle(parent.join(joinable(above, n), "up").select("id", F.col("top").alias("up")), "parents")
        left = parent.select(F.col("id").alias("a"), F.col("up").alias("x"))
        right = parent.select(F.col("id").alias("b"), F.col("up").alias("y"))
        moved = live.join(joinable(left, n), "a").join(joinable(right, n), "b").filter("x != y")
        moved = moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        live = settle(moved.distinct(), "edges")
        maps.append((parent, n))
    if not maps:
        return live.select(F.col("a").alias("id"), F.col("b").alias("component")).limit(0)

    def follow(have: DataFrame, step: tuple[DataFrame, int]) -> DataFrame:
        up, n = step
        up = up.select(F.col("id").alias("root"), F.col("up").alias("next"))
        return have.join(joinable(up, n), "root", "left").select("id", F.coalesce("next", "root").alias("root"))

    rooted = reduce(follow, maps[1:], maps[0][0].select("id", F.col("up").alias("root")))
    rooted = settle(rooted, "roots")
    names = settle(rooted.groupBy("root").agg(F.min("id").alias("component")), "names")
    return rooted.join(joinable(names, names.count()), "root").select("id", "component")
