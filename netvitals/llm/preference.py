"""Preference formatting: a shared prompt and paired, masked completions.

The longest common prefix of turns of the chosen and the rejected conversation is rendered
once as the prompt; the turns after it are rendered as two completions. A completion's mask is
the list of spans (start, end in characters, end exclusive) that training reads: what the
assistant says and the end mark that closes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>", "<|end|>"
TRAINED_ROLE = "assistant"


def _plain(text: Column) -> Column:
    """Text that cannot be read as a mark of the template."""
    return F.replace(text, F.lit(OPEN), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _plain(turn["role"]), F.lit(CLOSE + "\n"))


def _body(turn: Column) -> Column:
    return F.concat(_plain(turn["text"]), F.lit(END))


def rendered(turns: Column) -> Column:
    """All turns of an array as one string."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit("\n"))), "")


def trained_spans(turns: Column, role: str = TRAINED_ROLE) -> Column:
    """array<struct<first, last>>: the spans of `rendered` text in turns of ``role``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        first = state["at"] + F.length(_head(turn))
        last = first + F.length(_body(turn))
        span = F.array(F.struct(first.alias("first"), last.alias("last")))
        spans = F.when(turn["role"] == role, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((last + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, add, lambda s: s["spans"])


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as array<struct<role, text>>.

    Null roles and texts count as empty; ties of the turn number are ordered by role and text,
    exact repeats of a turn count once; a null turn number comes first. Turns without a
    conv_id belong to nothing and are left out. A conversation is one value of a row, so its
    size is bounded by what one row may hold.
    """
    said = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = said.distinct().groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return ordered.select(
        "conv_id",
        F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
    )


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def preference_rows(pairs: DataFrame, role: str = TRAINED_ROLE) -> DataFrame:
    """``pairs`` (chosen, rejected: arrays of turns, further columns passed through) in the form
    ``n_common, prompt, chosen, rejected, chosen_spans, rejected_spans``.

    Defined cases: equal conversations leave two empty completions, conversations without a
    common turn an empty prompt; a null array counts as no turns; repeated pairs give repeated
    rows; columns of ``pairs`` named like the new ones are replaced.
    """
    new = ("chosen", "rejected", "n_common", "prompt", "chosen_spans", "rejected_spans")
    rest = [c for c in pairs.columns if c not in new]
    none = F.array().cast("array<struct<role:string,text:string>>")
    rows = pairs.select(*rest, F.coalesce("chosen", none).alias("_c"), F.coalesce("rejected", none).alias("_r"))
    rows = rows.withColumn("n_common", common_turns(F.col("_c"), F.col("_r")))
    after = F.col("n_common") + 1
    rows = rows.select(
        *rest,
        "n_common",
        F.slice("_c", F.lit(1), F.col("n_common")).alias("_p"),
        F.slice("_c", after, F.greatest(F.size("_c"), F.lit(1))).alias("_c"),
        F.slice("_r", after, F.greatest(F.size("_r"), F.lit(1))).alias("_r"),
    )
    return rows.select(
        *rest,
        "n_common",
        rendered(F.col("_p")).alias("prompt"),
        rendered(F.col("_c")).alias("chosen"),
        rendered(F.col("_r")).alias("rejected"),
        trained_spans(F.col("_c"), role).alias("chosen_spans"),
        trained_spans(F.col("_r"), role).alias("rejected_spans"),
    )


def alternate_answers(turns: DataFrame, role: str = TRAINED_ROLE) -> DataFrame:
    """(conv_id, chosen, rejected) from one table of conversations: every whole conversation
    against itself with one answer replaced by the last answer of its neighbour (conv_id xor 1),
    or left out where the neighbour has none. Of n answers it is number conv_id mod n, so pairs
    part at different turns and go on after it. A conversation without an answer is paired with
    itself: its completions are empty."""
    rows = conversations(turns)
    places = F.transform("turns", lambda t, i: F.when(t["role"] == role, i + 1))
    rows = rows.withColumn("_at", F.filter(places, lambda i: i.isNotNull()))
    some = F.size("_at") > 0
    number = F.when(some, F.pmod(F.col("conv_id"), F.size("_at")).cast("int"))
    rows = rows.withColumns({"_spot": F.get("_at", number), "_last": F.get("_at", F.size("_at") - 1)})
    answers = rows.filter("_last IS NOT NULL").select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.slice("turns", F.col("_last"), F.lit(1)).alias("_other")
    )
    none = F.array().cast("array<struct<role:string,text:string>>")
    n = F.size("turns")
    swapped = F.concat(
        F.slice("turns", F.lit(1), F.col("_spot") - 1),
        F.coalesce("_other", none),
        F.slice("turns", F.col("_spot") + 1, n),
    )
    return rows.join(answers, "conv_id", "left").select(
        "conv_id", F.col("turns").alias("chosen"), F.coalesce(swapped, F.col("turns")).alias("rejected")
    )
