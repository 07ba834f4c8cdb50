"""Preference formatting: the shared first turns as one prompt, what differs as two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a turn is written out.
OPEN, BETWEEN, CLOSE = "<|turn|>", "\n", "<|end|>\n"
ANSWERS = "assistant"


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turns): each conversation's turns in order, as an array of (turn, role, text).

    A group is one conversation. Rows without id or without turn number are left out; of repeated rows
    one counts; turns of one number stand in the order of role and text, nulls first.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    known = turns.where(F.col(key).isNotNull() & F.col("turn").isNotNull())
    return known.groupBy(key).agg(F.sort_array(F.collect_set(turn)).alias("turns"))


def _said(turn: Column) -> Column:
    """What makes turns equal: role and text, nulls as empty."""
    return F.struct(*[F.coalesce(turn[c], F.lit("")).alias(c) for c in ("role", "text")])


def _segments(turns: Column) -> Column:
    """Written turns with a mask: trained on are the words and the end of an answer, not its head."""

    def pieces(turn):
        said = _said(turn)
        answer = (said["role"] == ANSWERS).cast("int")
        head = F.concat(F.lit(OPEN), said["role"], F.lit(BETWEEN))
        return F.array(
            F.struct(head.alias("text"), F.lit(0).alias("mask")),
            F.struct(F.concat(said["text"], F.lit(CLOSE)).alias("text"), answer.alias("mask")),
        )

    return F.flatten(F.transform(turns, pieces))


def written(segments: Column) -> Column:
    return F.concat_ws("", F.transform(segments, lambda s: s["text"]))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Formats rows (pair_id, chosen, rejected) of turn arrays.

    Returns pair_id, n_prompt_turns, prompt, chosen and rejected (arrays of text and mask), the texts of
    both completions, and n_chosen_trained and n_rejected_trained, the characters under the mask. The
    prompt is the longest run of first turns that both share in role and text, written once; equal
    conversations share all turns and have empty completions (``usable`` is false, as where one
    completion trains on nothing). A null conversation counts as one without turns. Ids may be null or
    repeated; no rows give no rows.
    """
    turn = "array<struct<turn: bigint, role: string, text: string>>"
    empty = F.array().cast(turn)
    rows = pairs.select("pair_id", *[F.coalesce(F.col(c).cast(turn), empty).alias(c) for c in ("chosen", "rejected")])
    # the first place where the two differ; beyond the shorter one, all places do
    equal = F.zip_with("chosen", "rejected", lambda a, b: F.coalesce(_said(a) == _said(b), F.lit(False)) & a.isNotNull() & b.isNotNull())
    differ = F.array_position(equal, False)
    rows = rows.withColumn("n_prompt_turns", F.when(differ > 0, differ - 1).otherwise(F.size(equal)).cast("int"))
    rows = rows.select(
        "pair_id", "n_prompt_turns",
        written(_segments(F.slice("chosen", F.lit(1), F.col("n_prompt_turns")))).alias("prompt"),
        *[_segments(F.slice(c, F.col("n_prompt_turns") + 1, F.size(c))).alias(c) for c in ("chosen", "rejected")],
    )
    trained = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, s: n + s["mask"] * F.length(s["text"]))
    return rows.select(
        "*",
        *[written(F.col(c)).alias(f"{c}_text") for c in ("chosen", "rejected")],
        *[trained(c).alias(f"n_{c}_trained") for c in ("chosen", "rejected")],
    ).withColumn("usable", (F.col("n_chosen_trained") > 0) & (F.col("n_rejected_trained") > 0))


def pairs_by_next(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected): each conversation against itself with another's last answer.

    The other is the conversation of the next whole number; where there is none, as for ids that are no
    numbers, the rejected one lacks the last turn. A stand-in for labelled pairs where a table holds single conversations.
    """
    number = F.col("conv_id").try_cast("long")
    number = F.when(number.cast("string") == F.col("conv_id").cast("string"), number)  # "01" is no number here
    whole = conversations(turns)
    last = whole.where(number.isNotNull()).select((number - 1).alias("before"), F.element_at("turns", -1).alias("other"))
    joined = whole.withColumn("before", number).join(last, "before", "left")
    start = F.slice("turns", F.lit(1), F.size("turns") - 1)
    own = F.element_at("turns", -1)
    swapped = F.struct(own["turn"].alias("turn"), own["role"].alias("role"), F.col("other")["text"].alias("text"))
    rejected = F.when(F.col("other").isNull(), start).otherwise(F.concat(start, F.array(swapped)))
    return joined.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))
