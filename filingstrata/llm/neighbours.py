"""Embedding near-dedup by NN-descent: a neighbour graph is refined through neighbours of neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from filingstrata.operators.joins import splittable_join
from filingstrata.sources.staging import stage

from .components import connected

TREES = 12  # orders of the vectors that start the graph
REACH = 5  # neighbours looked at in each order
LIST = 16  # neighbours a vector keeps at first
FLOOR = 0.6  # cosine below which a neighbour leads nowhere
BLOCK = 1_024  # vectors multiplied with each other at once
_AUDIT = 1_024  # vectors compared with all others for the audit


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): normalised doubles as bytes. Vectors that can link with nothing are left out."""
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column("embedding").to_pylist():
                found = None
                if value and None not in value:
                    x = np.array(value, np.float64)
                    top = np.abs(x).max()
                    if 0 < top < np.inf:
                        x = x / top
                        found = (x / np.linalg.norm(x) + 0.0).tobytes()
                out.append(found)
            keep = pa.array(out, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), keep], ["vec_id", "label", "v"])

    usable = vectors.where("label is not null and vec_id is not null and embedding is not null").select("vec_id", "label", "embedding")
    return usable.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, v binary").where("v is not null")


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)


def _edges(batch_ids, pairs) -> pa.RecordBatch:
    a, b, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in pairs)
    return pa.RecordBatch.from_arrays(
        [batch_ids.take(pa.array(a.astype(np.int64))), batch_ids.take(pa.array(b.astype(np.int64))), pa.array(s.astype(np.float64))], ["a", "b", "cosine"]
    )


def first_graph(points: DataFrame, seed: int) -> DataFrame:
    """Neighbours in TREES orders: each sorts the vectors of a label by the signs of random projections."""
    kind = points.schema["a"].dataType.simpleString()
    label = points.schema["label"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = 2 ** np.arange(31, -1, -1)
        for batch in batches:
            blobs = batch.column("v").to_pylist()
            codes = np.zeros((len(blobs), TREES), np.int64)
            for size in {len(b) for b in blobs}:
                if size not in planes:
                    planes[size] = np.random.default_rng([seed, size]).normal(size=(size // 8, TREES * 32))
                at = [k for k, b in enumerate(blobs) if len(b) == size]
                signs = (_matrix([blobs[k] for k in at]) @ planes[size] > 0).reshape(len(at), TREES, 32)
                codes[at] = signs @ powers
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("a", "label", "v")), pa.array(codes.tolist(), pa.list_(pa.int64()))], ["a", "label", "v", "codes"]
            )

    coded = points.select("a", "label", "v").mapInArrow(code, f"a {kind}, label {label}, v binary, codes array<long>")
    rows = coded.select("a", "label", F.length("v").alias("size"), "v", F.posexplode("codes").alias("tree", "code"))
    keys = ["tree", "label", "size", "code", "hash"]
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.withColumn("hash", F.xxhash64("a")).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            group = table.select(["tree", "label", "size"]).to_pandas()
            changes = (group != group.shift()).any(axis=1).to_numpy().cumsum()
            blobs, pairs = table.column("v").to_pylist(), ([], [], [])
            for g in np.unique(changes):
                at = np.flatnonzero(changes == g)
                x = _matrix([blobs[k] for k in at])
                for d in range(1, REACH + 1):
                    if len(x) > d:
                        s = np.einsum("ij,ij->i", x[:-d], x[d:])
                        hit = np.flatnonzero(s >= FLOOR)
                        for column, values in zip(pairs, (at[hit], at[hit + d], s[hit])):
                            column.append(values)
            yield _edges(batch.column("a"), pairs)

    return ordered.select("a", "tree", "label", "size", "v").mapInArrow(near, f"a {kind}, b {kind}, cosine double")


def refine(graph: DataFrame, points: DataFrame, size: int) -> DataFrame:
    """Compares the neighbours of each vector with each other: its ``size`` nearest, and as many of those
    that count it among theirs."""
    kind = points.schema["a"].dataType.simpleString()
    both = graph.union(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    rank = F.row_number().over(W.partitionBy("a").orderBy(F.desc("cosine"), F.xxhash64("b"), "b"))
    lists = both.withColumn("rank", rank).where(F.col("rank") <= size).select("a", "b")
    back = lists.select(F.col("b").alias("a"), F.col("a").alias("b"))
    some = F.row_number().over(W.partitionBy("a").orderBy(F.xxhash64("a", "b"), "b"))
    back = back.withColumn("rank", some).where(F.col("rank") <= size).select("a", "b")
    met = lists.union(back).union(lists.select("a", F.col("a").alias("b"))).distinct()
    met = splittable_join(met, points.select(F.col("a").alias("b"), "v"), ["b"], "inner")
    groups = met.groupBy("a").agg(F.collect_list(F.struct("b", "v")).alias("met"))  # 2 * size + 1 at most

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = batch.column("met")
            ids, blobs = met.values.field("b"), met.values.field("v").to_pylist()
            ends, pairs = met.offsets.to_numpy(), ([], [], [])
            for lo, hi in zip(ends, ends[1:]):
                x = _matrix(blobs[lo:hi])
                i, j = np.triu_indices(hi - lo, 1)
                s = (x @ x.T)[i, j]
                hit = s >= FLOOR
                for column, values in zip(pairs, (i[hit] + lo, j[hit] + lo, s[hit])):
                    column.append(values)
            yield _edges(ids, pairs)

    return groups.mapInArrow(join, f"a {kind}, b {kind}, cosine double")


def _merged(*graphs: DataFrame) -> DataFrame:
    """One row for each pair of different vectors."""
    every = graphs[0]
    for g in graphs[1:]:
        every = every.union(g)
    ordered = every.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine").where("a <> b")
    return ordered.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))


def audit(points: DataFrame, roots: DataFrame, threshold: float) -> float:
    """Recall of the links of at most _AUDIT vectors, compared with all others: the share of a vector's
    links whose other end is in its component, averaged over vectors.

    Vectors of few and of many links are averaged apart and the lower mean counts, so that a dense group,
    whose links are many and easily found, does not hide the loss of lone pairs.
    """
    kind = points.schema["a"].dataType.simpleString()
    rooted = points.select("a", "label", "v").join(roots.select(F.col("node").alias("a"), "root"), "a", "left")
    asked = rooted.orderBy(F.xxhash64("a"), "a").limit(_AUDIT).collect()
    by_kind: dict[tuple, list] = {}
    for q in asked:
        by_kind.setdefault((q.label, len(q.v)), []).append(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, total, hit = [], [], []
            ids, labels, blobs, root = (batch.column(c).to_pylist() for c in ("a", "label", "v", "root"))
            places: dict[tuple, list[int]] = {}
            for k, (label, blob) in enumerate(zip(labels, blobs)):
                if (label, len(blob)) in by_kind:
                    places.setdefault((label, len(blob)), []).append(k)
            for group, at in places.items():
                linked = _matrix([blobs[k] for k in at]) @ _matrix([q.v for q in by_kind[group]]).T >= threshold
                for q, column in zip(by_kind[group], linked.T):
                    others = [at[k] for k in np.flatnonzero(column) if ids[at[k]] != q.a]
                    if others:
                        names.append(q.a)
                        total.append(len(others))
                        hit.append(sum(root[k] is not None and root[k] == q.root for k in others))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, batch.column("a").type), pa.array(total, pa.int64()), pa.array(hit, pa.int64())], ["a", "total", "hit"]
            )

    found = rooted.select("a", "label", "v", "root").mapInArrow(run, f"a {kind}, total long, hit long")
    each = found.groupBy("a").agg(F.sum("total").alias("total"), F.sum("hit").alias("hit"))
    shares = each.groupBy((F.col("total") > LIST).alias("dense")).agg(F.avg(F.col("hit") / F.col("total")).alias("recall"))
    return min((row.recall for row in shares.collect()), default=1.0)  # two rows at most


def count_links(points: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(a, n): how many vectors, copies included, each vector of a component links with.

    The list of a vector in a dense component would hold the whole component, so the component itself
    takes its place: cut into blocks of about BLOCK vectors, of which each meets each. Only counts leave
    a task.
    """
    kind = points.schema["a"].dataType.simpleString()
    root = roots.schema["root"].dataType.simpleString()
    inside = splittable_join(points, roots.select(F.col("node").alias("a"), "root"), ["a"], "inner")
    sizes = inside.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    inside = splittable_join(inside, sizes, ["root"], "inner")
    inside = inside.withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    packed = inside.groupBy("root", "blocks", "block").agg(F.collect_list(F.struct("a", "copies", "v")).alias("vectors"))
    packed = stage(packed, "blocks")
    left = packed.select("root", "vectors", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    right = packed.select("root", "block", F.col("vectors").alias("others"))
    met = left.join(right, ["root", "block"]).select("vectors", "others")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [(c.values.field("a"), c.values.field("v").to_pylist(), c.values.field("copies").to_numpy(), c.offsets.to_numpy()) for c in (batch.column("vectors"), batch.column("others"))]
            (ids, own, _, ends), (_, other, copies, other_ends) = lists
            counts = np.zeros(len(own), np.int64)
            for k in range(batch.num_rows):
                x, y = _matrix(own[ends[k] : ends[k + 1]]), _matrix(other[other_ends[k] : other_ends[k + 1]])
                linked = x @ y.T >= threshold
                counts[ends[k] : ends[k + 1]] = linked @ copies[other_ends[k] : other_ends[k + 1]]
            yield pa.RecordBatch.from_arrays([ids.slice(ends[0], ends[-1] - ends[0]), pa.array(counts[ends[0] : ends[-1]])], ["a", "n"])

    return met.mapInArrow(run, f"a {kind}, n long").groupBy("a").agg(F.sum("n").alias("n"))


def _full(graph: DataFrame, threshold: float, size: int) -> bool:
    """Whether some vector has as many links as its list holds."""
    links = graph.where(F.col("cosine") >= threshold)
    ends = links.select("a").union(links.select(F.col("b").alias("a")))
    return not ends.groupBy("a").count().where(F.col("count") >= size).isEmpty()


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, rounds: int = 3, recall: float = 0.99) -> DataFrame:
    """vec_id, n_links, component_id, kept and audited_recall of each vector.

    Equal vectors of a label stand for each other. Their graph starts from neighbours in random orders
    and is refined round by round; lists double only where some vector's list is full of links, and
    edges of at least ``threshold`` stay. An audit compares some vectors with all others; below
    ``recall``, further orders are added, up to four times. What the last audit found stands in
    ``audited_recall``, so a graph that stays below says so. Links are counted exactly inside the components found.
    Vectors that are null, zero, empty or hold null or non-finite components, null labels and null ids
    link with nothing; vectors of different lengths do not meet; repeated rows count as vectors of
    their own; other columns do no harm; no rows give no rows.
    """
    units = stage(unit_vectors(vectors), "vectors")
    points = stage(units.groupBy("label", "v").agg(F.min("vec_id").alias("a"), F.count("*").alias("copies")), "points")
    graph, roots = None, None
    for attempt in range(4):
        start = first_graph(points, attempt)
        graph = stage(_merged(start) if graph is None else _merged(graph, start), "graph")
        size, links = LIST, -1
        for _ in range(rounds):
            graph = stage(_merged(graph, refine(graph, points, size)), "graph")
            found = graph.where(F.col("cosine") >= threshold).count()
            if found <= links * 1.001:
                break
            size, links = 2 * size if _full(graph, threshold, size) else size, found
        roots = stage(connected(graph.where(F.col("cosine") >= threshold).select("a", "b")), "roots")
        reached = audit(points, roots, threshold)
        if reached >= recall:
            break
    counts = count_links(points, roots, threshold)
    # a vector's copies link with each other too, alone or in a component
    own = splittable_join(points, counts, ["a"], "left").join(roots.select(F.col("node").alias("a"), "root"), "a", "left")
    own = own.select(
        "label", "v", (F.coalesce("n", "copies") - 1).alias("n_links"), F.coalesce("root", "a").alias("component_id")
    )  # each vector is in its own count
    own = stage(own, "counted")
    linked = units.join(own, ["label", "v"]).select("vec_id", "n_links", "component_id", F.lit(True).alias("usable"))
    rest = vectors.select("vec_id", F.col("label").alias("__l"), F.col("embedding").alias("__e"))
    bad = F.col("vec_id").isNull() | F.col("__l").isNull() | F.col("__e").isNull()
    bad = bad | F.exists("__e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists("__e", lambda x: x != 0)
    alone = rest.where(F.coalesce(bad, F.lit(True)))
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    whole = linked.drop("usable").union(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return whole.withColumns({"kept": kept, "audited_recall": F.lit(float(reached))})
