"""Mixing sources to target weights with exact budgets, in DataFrame operations only.

Every row gets a hash-random key from its id and text. Keys are cut into equal ranges per source, so
that a range holds a bounded number of rows however large its source is; rows are sorted
within a range, sums of ranges give each range its start, and a row's place in its source is
the start of its range plus the words before it. A source's budget is cut at exactly that
many words of its sorted rows, after as many full epochs as fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netvitals.plans.shared import settle

WEIGHTS = (3, 1, 2)
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_RANGE = 4096


def word_count(text: Column) -> Column:
    """Number of words of a text, null as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column, seed: str) -> Column:
    """Hex digits that order rows at random, the same in every run; rows without an id and rows
    that repeat one are spread by their texts."""
    name = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.md5(F.concat(name, F.lit(f":{seed}:"), F.coalesce(text, F.lit(""))))


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, epochs: float = 2.0
) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size), one row per source.

    Sources by code point, null last, weigh ``weights`` in turn. They share ``share`` times
    all words; nobody's target passes ``epochs`` times its own size, and the excess goes to
    the others by weight until none is above. That fixed point fills up the sources in the
    order of limit / weight; one ordered pass finds the level at which the budget is spent.
    The table has a row per source, which is all that meets in one task here.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    rows = totals.select("source", "source_size", (F.row_number().over(order) - 1).alias("_rank"))
    rows = rows.select(
        "source",
        "source_size",
        "_rank",
        weight.alias("_w"),
        (F.col("source_size") * F.lit(float(epochs))).alias("_limit"),
    ).withColumn("_level", F.col("_limit") / F.col("_w"))
    upto = Window.orderBy("_level", "_rank").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("_level", "_rank").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rows = rows.select(
        "*",
        F.sum("_limit").over(upto).alias("_full"),
        (F.sum("_w").over(everything) - F.sum("_w").over(upto)).alias("_open"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("_budget"),
    )
    sated = F.col("_full") + F.col("_level") * F.col("_open") <= F.col("_budget")
    rows = rows.withColumn("_sated", sated)
    spent = F.coalesce(F.sum(F.when(F.col("_sated"), F.col("_limit"))).over(everything), F.lit(0.0))
    left = F.sum(F.when(~F.col("_sated"), F.col("_w"))).over(everything)
    rows = rows.withColumn("_per_weight", (F.col("_budget") - spent) / left)
    target = F.when(F.col("_sated"), F.col("_limit")).otherwise(F.col("_w") * F.col("_per_weight"))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    epochs: float = 2.0,
    seed: str = "mix",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``docs``.

    ``taken`` counts the words the mix takes of a row: its size for each full epoch of its
    source and once more if it lies before the cut. The row at the cut gives the part that
    is left, so a source's taken words are its target rounded down. Defined cases: a null or
    empty text has size 0 and is taken 0 times; a null source is a source of its own, last
    in order; null ids and rows that repeat an id are ordinary rows (rows equal in id and text
    are interchangeable); no rows give no rows; further columns are not read.
    """
    return _decisions(docs, weights, share, epochs, seed, rows_per_range).drop("_key")


def _decisions(docs, weights=WEIGHTS, share=1.5, epochs=2.0, seed="mix", rows_per_range=ROWS_PER_RANGE) -> DataFrame:
    """The rows of `mix` with their keys."""
    key = random_key(F.col("doc_id"), F.col("text"), seed)
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("_key"))
    rows = settle(rows, "mix_sizes")
    totals = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows")
    )
    totals = settle(totals, "mix_totals")
    targets = settle(source_targets(totals, weights, share, epochs), "mix_targets")
    known = totals.withColumnRenamed("source", "_source").drop("source_size")
    ranges = F.greatest(F.ceil(F.col("_rows") / rows_per_range), F.lit(1)).cast("long")
    # The key's first 28 bits, cut into equal ranges.
    spot = F.conv(F.substring("_key", 1, 7), 16, 10).cast("long")
    placed = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "_key", F.floor(spot * ranges / F.lit(2**28)).alias("_range")
    )
    placed = settle(placed, "mix_placed")
    sums = placed.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    ahead = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_source"),
        F.col("_range").alias("_at"),
        F.coalesce(F.sum("_words").over(ahead), F.lit(0)).alias("_start"),
    )
    aims = targets.select(F.col("source").alias("_name"), "source_size", "target")
    starts = settle(
        starts.join(aims, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name"), "mix_starts"
    )
    inner = (
        Window.partitionBy("source", "_range")
        .orderBy("_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ordered = placed.withColumn("_before", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    met = ordered.join(
        starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_at"))
    )
    budget = F.floor("target")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - passes * F.col("source_size") - F.col("_start") - F.col("_before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return met.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (passes * F.col("size") + part).cast("long").alias("taken"),
        "_key",
    )


def mixed_documents(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: one copy for each full pass and, for the
    row at a source's cut, one more with the words that are left of its budget.

    Takes the options of `mix`; rows of no words are not taken. ``n_chars``, if there, is set
    to the length of a text that is cut. Rows equal in source, id and text take the words that
    `mix` gives them together: alike where it takes all or none of them once more, and one after
    the other where a source's cut lies among them.
    """
    decided = _decisions(docs, seed=seed, **options).groupBy(F.col("_key").alias("key"), F.col("source").alias("of"))
    decided = decided.agg(
        F.sum("taken").alias("all"), F.count(F.lit(1)).alias("n"), F.max("size").alias("size")
    ).filter(F.col("all") > 0)
    # The row travels as one value, so that its columns clash with nothing here.
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col("source").alias("row_source"),
        random_key(F.col("doc_id"), F.col("text"), seed).alias("row_key"),
    )
    met = packed.join(decided, (F.col("row_key") == F.col("key")) & F.col("row_source").eqNullSafe(F.col("of")))
    alike = F.col("all") % (F.col("n") * F.col("size")) == 0
    even = met.filter(alike).withColumn("taken", F.expr("all div n"))
    # the rows at the cut: one group of equal rows of each source at most
    place = F.row_number().over(Window.partitionBy("key", "of").orderBy("key")) - 1
    each = F.expr("all div (n * size)") * F.col("size")
    rest = F.col("all") - each * F.col("n") - F.col("place") * F.col("size")
    cut = met.filter(~alike).withColumn("place", place)
    cut = cut.withColumn("taken", each + F.greatest(F.lit(0), F.least(F.col("size"), rest))).drop("place")
    met = even.unionByName(cut).filter("taken > 0")
    copies = F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))
    rows = met.withColumn("copy", F.explode(copies))
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    # Words, each with the white space before it, up to the cut.
    text = F.col("row.text")
    pieces = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), 1)
    head = F.array_join(F.slice(pieces, 1, left.cast("int")), "")
    whole = left >= F.col("size")
    row = F.col("row").withField("text", F.when(whole, text).otherwise(head))
    if "n_chars" in docs.columns:
        length = F.when(whole, F.col("row.n_chars")).otherwise(F.length(head))
        row = row.withField("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return rows.select(row.alias("row")).select("row.*")
