"""Conversation prefixes: a double-array trie for each shard of prefixes, upper nodes merged over all shards.

Equal conversations are counted first. What is left is cut into shards by first turns, by longer
prefixes where too many share a shorter one, so that no shard is large. A shard numbers its turns
densely, packs its trie into BASE and CHECK and walks its conversations through them. Nodes at or
below the depth of the cut are complete there; the few above it are merged over all shards.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingstrata.operators.joins import splittable_join
from filingstrata.sources.staging import stage

_WORD = r"[^\x20\x09-\x0D]+"
_BLOCK = 8  # ids are joined to text in blocks of 2 ** 8
_TRIES = 64  # free places that are tried for a node before its children go to the end of the arrays
_EMPTY = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class DoubleArray:
    """A trie as two arrays: the child of node ``s`` by turn ``c`` is ``t = base[s] + c`` where ``check[t] == s``."""

    base: np.ndarray
    check: np.ndarray

    def step(self, nodes: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """The child of each node by its turn; -1 where there is none."""
        places = self.base[nodes] + turns
        inside = (places > 0) & (places < len(self.check)) & (nodes >= 0)
        found = np.where(inside, places, 0)
        return np.where(inside & (self.check[found] == nodes), found, -1)


def pack(starts: np.ndarray, turns: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
    """The double array of sequences of dense turn numbers, and the numbers that stand for them in it.

    Sequence ``k`` is ``turns[starts[k]:starts[k + 1]]``. Turns are numbered anew in the order in which
    the trie meets them from the top, so the children of a node lie close together. Nodes with several
    children take the first place that fits, those with one then fill the gaps.
    """
    lengths = np.diff(starts)
    n = int(turns.max()) + 1 if len(turns) else 1
    parents, labels = [], []
    at, first = np.zeros(len(lengths), np.int64), 1
    for d in range(int(lengths.max()) if len(lengths) else 0):
        live = np.flatnonzero(lengths > d)
        edges, at[live] = np.unique(at[live] * n + turns[starts[live] + d], return_inverse=True)
        at[live] += first
        parents.append(edges // n)
        labels.append(edges % n)
        first += len(edges)
    if not parents:
        return DoubleArray(np.zeros(1, np.int64), np.full(1, -1, np.int64)), turns
    parent, label = np.concatenate(parents), np.concatenate(labels)
    seen, met = np.unique(label, return_index=True)
    renamed = np.zeros(n, np.int64)
    renamed[seen[np.argsort(met)]] = np.arange(len(seen))
    label = renamed[label]

    order = np.lexsort((label, parent))
    inner, begin, size = np.unique(parent[order], return_index=True, return_counts=True)
    base = np.zeros(first, np.int64)  # by node
    place = np.zeros(first, np.int64)  # by node; the root's is 0
    used = np.zeros(first + n + 1, bool)
    used[0] = True
    low = top = 1  # all below low are taken, all from top on are free
    for k in np.flatnonzero(size > 1):
        children = label[order[begin[k] : begin[k] + size[k]]]
        offsets = children - children[0]
        while used[low]:
            low += 1
        free = low + np.flatnonzero(~used[low : low + 16 * _TRIES])[:_TRIES]
        spot = next((f for f in free if not used[np.minimum(f + offsets, len(used) - 1)].any()), top)
        end = spot + offsets[-1] + 1
        if end + 1 >= len(used):
            used = np.append(used, np.zeros(max(end + 2, len(used)), bool))
        used[spot + offsets] = True
        top = max(top, end)
        base[inner[k]] = spot - children[0]
    single = np.flatnonzero(size == 1)
    gaps = np.flatnonzero(~np.append(used, np.zeros(len(single) + 1, bool)))[: len(single)]
    base[inner[single]] = gaps - label[order[begin[single]]]
    place[1:] = base[parent] + label
    check = np.full(int(place.max()) + 1, -1, np.int64)
    check[place[1:]] = place[parent]
    by_place = np.zeros(len(check), np.int64)
    by_place[place] = base
    return DoubleArray(by_place, check), renamed[turns]


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, path): the turns of each conversation in order, as (id, words).

    ``id`` is 16 bytes of a hash of role and text, ``words`` the number of words of the text. A null
    role or text counts as empty. The order is that of ``turn``, null first; turns of one number stand
    by role and then by their hash. Repeated rows are turns of their own; rows without conv_id are left
    out. A conversation is one row, without its texts.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.sha2(F.concat(F.sha2(role.cast("binary"), 256), text).cast("binary"), 256)
    turn = F.struct(
        "turn", role.alias("role"), F.unhex(F.substring(said, 1, 32)).alias("id"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"),
    )
    rows = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    path = F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words")))
    return rows.groupBy("conv_id").agg(path.alias("path"))


def with_shared_heads(convs: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """Conversations whose first turns come from the first conversation of their family.

    Conversation c takes the first h = crc32(c) mod ``heads`` turns of c - c mod ``family`` (fewer where
    that has fewer) and its own turns after its first h.
    """
    convs = stage(convs, "conversations")
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    first = convs.select(F.col("conv_id").alias("base"), F.slice("path", 1, heads - 1).alias("head"))
    joined = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(first, "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice("path", 1, 0))
    rest = F.slice("path", h + 1, F.greatest(F.size("path") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(head, rest).alias("path"))


def _key() -> Column:
    """What tells sequences of turns apart: a hash of their turns' ids."""
    ids = F.transform("path", lambda t: F.hex(t["id"]))
    return F.sha2(F.concat_ws("", ids).cast("binary"), 256)


def _sharded(sequences: DataFrame, limit: int) -> DataFrame:
    """Sequences with the depth of their ``cut`` and their ``shard``.

    All that share their first ``cut`` turns are in one shard. Where these are more than ``limit`` turns,
    the cut is made at twice the depth; longer sequences than that stand alone.
    """
    spark = sequences.sparkSession
    weight = F.size("path") + 1
    total = sequences.agg(F.sum(weight)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // limit)
    done, cut, rest = None, 1, sequences
    while True:
        rest = rest.withColumn("prefix", F.xxhash64(F.slice("path", 1, cut)))
        crowds = rest.groupBy("prefix").agg(F.sum(weight).alias("weight"), F.count(F.lit(1)).alias("n"))
        crowds = stage(crowds.where((F.col("weight") > limit) & (F.col("n") > 1)).select("prefix"), "crowds")
        last = crowds.isEmpty()
        settled = rest if last else splittable_join(rest, crowds, ["prefix"], "left_anti")
        settled = settled.withColumns({"cut": F.lit(cut).cast("long"), "shard": F.pmod("prefix", F.lit(shards))})
        done = settled if done is None else done.unionByName(settled)
        if last:
            return done.drop("prefix")
        rest = stage(splittable_join(rest, crowds, ["prefix"], "left_semi").drop("prefix"), "crowded")
        cut *= 2


_PART = (
    "upper boolean, key string, parent_key string, ancestors array<string>, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, words long"
)


def _nodes_of_shard(table: pa.Table) -> pa.Table:
    """The nodes of one shard; those above the cut (``upper``) with what lies completely below them."""
    paths = table["path"].combine_chunks()
    starts = paths.offsets.to_numpy().astype(np.int64)
    flat = paths.values.slice(starts[0], starts[-1] - starts[0])
    starts = starts - starts[0]
    ids = flat.field("id").dictionary_encode()
    trie, codes = pack(starts, ids.indices.to_numpy().astype(np.int64))
    names, name_of = ids.dictionary.to_pylist(), ids.indices.to_numpy()
    said = flat.field("words").to_numpy()
    n, low, cuts, keys = (table[c].to_pylist() if c == "key" else table[c].to_numpy() for c in ("n", "conv_id", "cut", "key"))
    lengths, size = np.diff(starts), len(trie.check)

    count, words, cut = (np.zeros(size, np.int64) for _ in range(3))
    least, depth, ends, by = np.full(size, np.iinfo(np.int64).max), np.full(size, -1), np.full(size, -1), np.zeros(size, np.int64)
    at = np.zeros(len(lengths), np.int64)
    for d in range(int(lengths.max()) + 1):
        live = np.flatnonzero(lengths >= d)
        if d:
            turn = starts[live] + d - 1
            at[live] = trie.step(at[live], codes[turn])
            words[at[live]], by[at[live]] = said[turn], turn
        here = at[live]
        np.add.at(count, here, n[live])
        np.minimum.at(least, here, low[live])
        depth[here], cut[here] = d, cuts[live]
        over = live[lengths[live] == d]
        ends[at[over]] = over

    nodes = np.flatnonzero(depth >= 0)
    nodes = nodes[np.argsort(depth[nodes], kind="stable")]
    below, parent = depth[nodes] >= cut[nodes], trie.check
    children = np.bincount(parent[nodes[below & (nodes > 0)]], minlength=size)
    lower = np.zeros(size, bool)
    lower[nodes[below]] = True
    leaves = np.where(lower & (children == 0), 1, 0)
    saved = np.where(lower, (count - 1) * words, 0)
    bounds = np.searchsorted(depth[nodes], np.arange(int(lengths.max()) + 2))
    for d in range(int(lengths.max()), 0, -1):
        row = nodes[bounds[d] : bounds[d + 1]]
        row = row[lower[row]]
        np.add.at(leaves, parent[row], leaves[row])
        np.add.at(saved, parent[row], saved[row])

    upper = nodes[~below]
    hashes, lineage = {0: hashlib.sha256()}, {0: [_EMPTY]}  # of upper nodes, with the keys from the root down
    for node in upper[upper > 0].tolist():
        made = hashes[int(parent[node])].copy()
        made.update(names[name_of[by[node]]].hex().upper().encode())
        hashes[node] = made
        lineage[node] = [*lineage[int(parent[node])], made.hexdigest()]
    is_upper = ~below
    key = [lineage[v][-1] if u else (keys[ends[v]] if ends[v] >= 0 else None) for v, u in zip(nodes.tolist(), is_upper.tolist())]
    above = lambda v: lineage[int(parent[v])] if v else []
    edge = (depth[nodes] <= cut[nodes]) & (nodes > 0)  # the parent is an upper node
    return pa.table(
        {
            "upper": pa.array(is_upper),
            "key": pa.array(key, pa.string()),
            "parent_key": pa.array([above(v)[-1] if e else None for v, e in zip(nodes.tolist(), edge.tolist())], pa.string()),
            "ancestors": pa.array([above(v) if u else None for v, u in zip(nodes.tolist(), is_upper.tolist())], pa.list_(pa.string())),
            "conv_id": pa.array(least[nodes]),
            "depth": pa.array(depth[nodes].astype(np.int64)),
            "parent_conv_id": pa.array(least[parent[nodes]], mask=edge | (nodes == 0)),
            "n_convs": pa.array(count[nodes]),
            "n_children": pa.array(children[nodes].astype(np.int64)),
            "n_leaves": pa.array(leaves[nodes].astype(np.int64)),
            "saved_tokens": pa.array(saved[nodes]),
            "words": pa.array(words[nodes]),
        }
    )


def _merged_upper(parts: DataFrame) -> DataFrame:
    """The nodes above the cuts, each once, with what all shards know of them.

    A node gives its own leaf and saving to all nodes above it, so the subtrees take one aggregation
    whatever their depth.
    """
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    same = [F.first(c).alias(c) for c in ("parent_key", "ancestors", "depth", "words")]
    upper = stage(parts.where("upper").groupBy("key").agg(F.min("conv_id").alias("conv_id"), *same, *sums), "upper")
    more = upper.where("depth > 0").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    known = upper.join(more, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    leaves = F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)
    saved = F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")
    known = stage(known.select("key", "parent_key", "ancestors", "depth", "conv_id", "n_convs", "n_children", leaves.alias("l"), saved.alias("s")), "merged")
    line = F.explode(F.concat("ancestors", F.array("key"))).alias("key")
    totals = known.select(line, "l", "s").groupBy("key").agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens"))
    return known.drop("ancestors", "l", "s").join(totals, "key")


def _ends(convs: DataFrame) -> DataFrame:
    """(key, ends_sha256) of each sequence that conversations (conv_id, key) are.

    Ids are joined to text in blocks of bounded size; a task passes the blocks of a key on to the hash
    one after the other, so it holds one batch of them, however many conversations are equal.
    """
    block = F.shiftright("conv_id", _BLOCK).alias("block")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    blocks = convs.groupBy("key", block).agg(F.array_join(ids, ",").alias("ids"))

    def hashed(batches):
        key, made = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
                if k == key:
                    made.update(b",")
                else:
                    if key is not None:
                        done.append((key, made.hexdigest()))
                    key, made = k, hashlib.sha256()
                made.update(ids.encode())
            yield _pairs(done)
        if key is not None:
            yield _pairs([(key, made.hexdigest())])

    ordered = blocks.repartition("key").sortWithinPartitions("key", "block")
    return ordered.mapInArrow(hashed, "key string, ends_sha256 string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["key", "ends_sha256"])


def prefix_nodes(convs: DataFrame, limit: int = 2_000) -> DataFrame:
    """The nodes of the trie of conversations (conv_id, path), as :func:`conversations` gives them.

    A node is a distinct sequence of first turns; the root has none. Returned are conv_id, the smallest
    member; depth; parent_conv_id (null for the root); n_convs; n_children; n_leaves, the childless nodes
    of its subtree, itself included; saved_tokens, over its subtree the sum of (n_convs - 1) times the
    words of the last turn; and ends_sha256, of the comma-joined ids of the members that end there.
    ``limit`` is about how many turns a shard holds.

    A conversation without turns belongs to the root; no conversations give no nodes. conv_id must be
    unique; other columns are ignored.
    """
    convs = stage(convs.select("conv_id", "path").withColumn("key", _key()), "paths")
    equal = convs.groupBy("key", "path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    sequences = stage(equal, "sequences")
    parts = _sharded(sequences, limit).groupBy("shard").applyInArrow(_nodes_of_shard, _PART)
    parts = stage(parts, "nodes")
    upper = stage(_merged_upper(parts), "upper")

    owner = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    root = F.broadcast(upper.where("depth = 0").select(F.col("conv_id").alias("parent_conv_id")))  # one row
    result = ["key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    lower = parts.where("not upper")
    deep = lower.where(F.col("parent_key").isNull()).select(*result)
    edge = lower.where(F.col("parent_key").isNotNull()).drop("parent_conv_id")
    edge = edge.select("parent_key", *[c for c in result if c != "parent_conv_id"]).unionByName(
        upper.where("depth > 0").select("parent_key", *[c for c in result if c != "parent_conv_id"])
    )
    top = upper.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*result)
    first = edge.where("depth = 1").crossJoin(root).select(*result)
    other = splittable_join(edge.where("depth > 1"), owner, ["parent_key"], "inner").select(*result)
    nodes = top.unionByName(first).unionByName(other).unionByName(deep)

    sha = _ends(convs)
    ended = nodes.where(F.col("key").isNotNull()).join(sha, "key", "left")
    ended = ended.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))).drop("key")
    passed = nodes.where(F.col("key").isNull()).withColumn("ends_sha256", F.lit(_EMPTY)).drop("key")
    return ended.unionByName(passed)
