"""Mixing sources to target weights by Pfair scheduling: blocks have releases and deadlines, the earliest deadline goes first."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import numbered

SLOTS = 16_384  # a corpus is cut into about so many blocks at most; larger ones get larger blocks
LEAST_BLOCK = 64
_EPS = 1e-9  # of a slot: quotients of real weights are not exact


def weights_of(counts: DataFrame, weights: Mapping[str, float] | None, power: float) -> DataFrame:
    """(mix_source, rows, share) of the sources that take part; shares add up to 1.

    Without ``weights`` a source weighs as its rows to the ``power``.
    """
    if weights is None:
        weighed = counts.withColumn("w", F.pow("rows", F.lit(power)))
    else:
        pairs = [x for k, v in weights.items() if v > 0 for x in (F.lit(k), F.lit(float(v)))]
        table = F.create_map(*pairs) if pairs else F.create_map(F.lit(""), F.lit(0.0))
        weighed = counts.withColumn("w", F.try_element_at(table, F.col("mix_source"))).where("w is not null and w > 0")
    total = F.sum("w").over(W.partitionBy())  # one row a source
    return weighed.select("mix_source", "rows", (F.col("w") / total).alias("share"))


def timetable(shared: DataFrame) -> DataFrame:
    """(mix_source, mix_share, mix_block, mix_slot, mix_complete): the slot of each block of each source.

    ``shared`` has mix_source, share and ``need``, the source's blocks. Block j of a source with share w is
    released at floor(j / w) and due at ceil((j + 1) / w). In each slot the released block with the
    earliest deadline goes. The shares fill all slots, so every deadline holds, and after any slot each
    source is less than one block away from its share of the slots. That goes on until a source has no
    block for its slot; what is left then follows in the order of its deadlines, with mix_complete false.

    One row holds all sources and is folded over the slots: steps are slots times sources.
    """
    one = F.struct("mix_source", "share", "need")
    listed = shared.groupBy().agg(F.sort_array(F.collect_list(one)).alias("s"), F.sum("need").alias("blocks")).where("size(s) > 0")

    def step(state, t):
        def urgent(s, k):
            done = F.element_at(state["done"], k + 1)
            window = F.struct(F.ceil((done + 1) / s["share"] - _EPS).alias("due"), k.alias("k"))
            return F.when(F.floor(done / s["share"] + _EPS) <= t, window)

        def taken(chosen):
            lacking = F.element_at(state["done"], chosen + 1) >= F.element_at("s", chosen + 1)["need"]
            return F.struct(chosen.alias("k"), (state["over"] | F.coalesce(lacking, F.lit(True))).alias("over"))

        def moved(c):
            done = F.transform(state["done"], lambda n, k: n + (~c["over"] & (k == c["k"])).cast("long"))
            order = F.when(c["over"], state["order"]).otherwise(F.concat(state["order"], F.array(F.coalesce(c["k"], F.lit(0)).cast("int"))))
            return F.struct(done.alias("done"), order.alias("order"), c["over"].alias("over"))

        # arrays of one element name the choice, so that it is made once a slot
        chosen = F.array(F.array_min(F.transform(F.col("s"), urgent))["k"])
        return F.transform(F.transform(chosen, taken), moved)[0]

    start = F.struct(
        F.transform(F.col("s"), lambda s: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("order"),
        F.lit(False).alias("over"),
    )
    folded = listed.select("s", F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("blocks")), start, step).alias("f"))
    folded = folded.select("s", F.col("f.done").alias("done"), F.col("f.order").alias("order"))

    slots = folded.select("s", F.posexplode("order").alias("slot", "k")).select(F.element_at("s", F.col("k") + 1).alias("s"), "slot")
    nth = F.row_number().over(W.partitionBy("s.mix_source").orderBy("slot")) - 1
    placed = slots.select("s.*", nth.cast("long").alias("mix_block"), F.col("slot").cast("long").alias("mix_slot"), F.lit(True).alias("mix_complete"))

    each = folded.select(F.size("order").alias("end"), F.posexplode(F.arrays_zip("s", "done")).alias("k", "z")).where("z.done < z.s.need")
    left = each.select("end", "z.s.*", F.explode(F.sequence(F.col("z.done"), F.col("z.s.need") - 1)).alias("mix_block"))
    due = F.ceil((F.col("mix_block") + 1) / F.col("share") - _EPS)
    after = F.row_number().over(W.partitionBy().orderBy(due, "mix_source", "mix_block")) - 1  # one row a block
    rest = left.select("mix_source", "share", "need", "mix_block", (F.col("end") + after).cast("long").alias("mix_slot"), F.lit(False).alias("mix_complete"))
    return placed.unionByName(rest).select("mix_source", F.col("share").alias("mix_share"), "mix_block", "mix_slot", "mix_complete")


def interleave(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    block: int | None = None,
    slots: int = SLOTS,
    power: float = 0.7,
) -> DataFrame:
    """The rows of ``docs`` with their place in a mixture of sources.

    Adds mix_share (the source's target weight, all weights adding up to 1), mix_block (within the
    source), mix_slot, mix_position and mix_complete. Blocks follow a hash of the id; the rows in the
    order of mix_position are the mixture. A block has ``block`` rows; without it LEAST_BLOCK, or more
    where the rows would fill over ``slots`` blocks. mix_complete is true as long as no source has run
    out before, that is where each source is less than one block away from its weight after any slot;
    later rows follow by their deadlines. All rows are returned. A null source counts as the empty
    name; sources without a weight have null slots; ids may be null or repeated; no rows give no rows.
    Columns named mix_* are replaced.
    """
    added = ("mix_source", "mix_share", "mix_block", "mix_slot", "mix_position", "mix_complete")
    rows = docs.drop(*added).withColumn("mix_source", F.coalesce(F.col("source"), F.lit("")))
    counts = rows.groupBy("mix_source").agg(F.count("*").alias("rows"))
    if block is None:
        block = max(LEAST_BLOCK, -(-(counts.agg(F.sum("rows")).first()[0] or 0) // slots))
    shared = weights_of(counts, weights, power).withColumn("need", F.ceil(F.col("rows") / block))
    table = timetable(shared)
    placed = numbered(rows, ["mix_source"], F.xxhash64("doc_id"), "mix_n")
    placed = placed.withColumn("mix_block", F.floor(F.col("mix_n") / block))
    placed = placed.join(table, ["mix_source", "mix_block"], "left")
    position = F.col("mix_slot") * block + F.col("mix_n") % block
    kept = [c for c in docs.columns if c not in added]
    named = F.when(F.col("mix_slot").isNotNull(), F.col("mix_block")).alias("mix_block")
    return placed.select(
        *kept, "mix_share", named, "mix_slot", position.alias("mix_position"), F.coalesce("mix_complete", F.lit(False)).alias("mix_complete")
    )
