"""Exact deduplication by skew-safe combining, in DataFrame operations only.

1. Rows are deduplicated within their task and merged per (digest, salt, text): the hash
   aggregation's map-side step is the local one, its shuffle the salted one.
2. The salt winners of a digest are combined over all salts.
Text is a grouping key in both steps, so full contents are compared each time and the
digest only decides where rows meet. Members are then sent their winner by (digest, salt),
which splits a group of any size over its salts; only where one digest has several texts
are they told apart by text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvitals.plans.shared import settle

SALTS = 64


def exact_groups(
    docs: DataFrame,
    text: Column | None = None,
    id_col: str = "doc_id",
    prefer: str = "max",
    salts: int = SALTS,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``text`` is the (normalised) content to compare, by default the column ``text``
    unchanged. The row with the largest id (``prefer="min"``: smallest) of equal contents
    stays. Defined cases: null text is the empty text; a null id never wins against a
    present one, and a group of null ids only keeps a null ``keep_id`` with every row kept;
    rows that repeat an id with the same text count in ``group_size`` and are all kept if
    they carry the winning id (`exact_dedup` then leaves one); no rows give no rows. Other columns
    are not read, whatever their names.
    """
    content = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        content.alias("_text"),
    ).select(
        "doc_id",
        "_text",
        F.sha2(F.encode("_text", "UTF-8"), 256).alias("text_sha256"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("_salt"),
    )
    best = F.max if prefer == "max" else F.min
    salted = rows.groupBy("text_sha256", "_salt", "_text").agg(
        best("doc_id").alias("_best"), F.count(F.lit(1)).alias("_n")
    )
    winners = salted.groupBy("text_sha256", "_text").agg(
        best("_best").alias("keep_id"), F.sum("_n").alias("group_size")
    )
    by_digest = winners.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("_texts"),
        F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size"),
    )
    by_digest = settle(by_digest, "exact_winners")
    # Written, so that Spark knows how small it is: without clashes the texts are read once more
    # and not shuffled.
    clashing = settle(by_digest.filter("_texts > 1").select("text_sha256"), "exact_clashes")
    # One row per (digest, salt): the winner reaches each salt once, members meet it there.
    member = rows.select("doc_id", "text_sha256", "_salt")
    spread = member.select("text_sha256", "_salt").distinct()
    spread = spread.join(by_digest.filter("_texts = 1"), "text_sha256")
    told = member.join(spread, ["text_sha256", "_salt"]).select(
        "doc_id", "keep_id", "group_size", "text_sha256"
    )
    doubtful = rows.join(clashing, "text_sha256", "left_semi")
    exact = doubtful.groupBy("text_sha256", "_text").agg(
        best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    apart = doubtful.join(exact, ["text_sha256", "_text"]).select(
        "doc_id", "keep_id", "group_size", "text_sha256"
    )
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return told.unionByName(apart).select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"
    )


def exact_dedup(docs: DataFrame, text: Column | None = None, prefer: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept, one per distinct content.

    Rows that repeat the winning id with equal text are one content and leave one row.
    Rows with a null id stay only when no row of their content has an id.
    """
    content = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    kept = exact_groups(docs, text, prefer=prefer).filter("kept")
    kept = kept.groupBy(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    kept = settle(kept.agg(F.count(F.lit(1)).alias("kept_rows")), "exact_kept")
    # The row travels as one value, so that its columns clash with nothing here.
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("id"),
        F.sha2(F.encode(content, "UTF-8"), 256).alias("sha"),
        content.alias("content"),
    )
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("kept_sha"))
    # The winner's id identifies its row save for repeats, which alone are merged by content.
    single = packed.drop("content").join(kept.filter("kept_rows = 1"), same, "left_semi")
    repeated = packed.join(kept.filter("kept_rows > 1"), same, "left_semi").dropDuplicates(["id", "sha", "content"])
    return single.select("row.*").unionByName(repeated.select("row.*"))
