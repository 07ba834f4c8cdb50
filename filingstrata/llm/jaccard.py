"""Exact Jaccard join of shingle sets by metric-space partitioning.

The Jaccard distance obeys the triangle inequality. Documents meet in the Voronoi regions of pivots:

1. Two sets that link share a shingle among the first few of each in one global order, rarest first, and
   are of similar size. Of the sets of a size class that hold such a shingle, or of the next larger one,
   that of least hash is the pivot, so both sets of a pair have a pivot in common. Sets without such a
   shingle are far from every pivot and link with nothing.
2. Each set is compared with its pivots. Sets within reach of a pivot link with it, and so belong together.
   How many of their first shingles two sets share bounds their distance from below, so most far pairs
   are told from these alone.
3. What may be left in a region are pairs of different components and similar size. Of these, sets that by
   their first shingles may be near another one are taken on in blocks of bounded size, and split again
   by pivots of their own, with copies of those that the triangle inequality puts on a boundary, down to
   a few sets that are all compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from filingstrata.operators.joins import splittable_join
from filingstrata.sources.staging import stage, stage_made, staging_scope

from .common import grams, word_hashes
from .components import connected

WIDTH = 5
SHARE = 80  # of 100: the least intersection over union
REACH = 1 - SHARE / 100 + 1e-9  # the distance within which sets link; the exact test is on whole numbers
LEAF = 24  # sets that are all compared
BLOCK = 256  # sets of a region that meet in one task
PIVOTS = 6
_STEP = 1.2500001  # between size classes: sets that link are in one class or in two neighbouring ones
_BITS = 24  # of a key, that the filter of often shared keys looks at
_FREQUENT = 2_000_000  # shingles whose frequency all tasks know, at most
_HELD = 3_000_000  # shingles that a task counts at once
_LEAST = 3  # documents of a task that make a shingle worth a report


def shingles(texts: pa.Array) -> Iterator[np.ndarray]:
    """Of each text the sorted hashes of its distinct runs of WIDTH words; of all words where there are fewer."""
    for found, at in word_hashes(texts):
        runs = grams(found, WIDTH)
        for a, b in zip(at.tolist(), at[1:].tolist()):
            if b - a >= WIDTH:
                yield np.unique(runs[a : b - WIDTH + 1])
            else:
                yield grams(found[a:b], b - a) if b > a else found[:0]


def _lists(values: list[np.ndarray], kind: str) -> pa.ListArray:
    ends = np.cumsum([0] + [len(v) for v in values]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind)))


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles and in how many documents each task at least saw them.

    They only order the shingles, so it is enough that all tasks use the same numbers. The bound on
    frequency is raised until at most _FREQUENT are left.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            flat = np.sort(np.concatenate(held))
            begin = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
            n = np.diff(np.append(begin, len(flat)))
            often = n >= _LEAST
            return pa.RecordBatch.from_arrays([pa.array(flat[begin][often].view(np.int64)), pa.array(n[often].astype(np.int64))], ["shingle", "n"])

        for batch in batches:
            for found in shingles(batch.column(0)):
                if len(found):
                    held.append(found)
                    size += len(found)
                if size > _HELD:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    seen = docs.select("text").mapInArrow(count, "shingle long, n long")
    seen = stage(seen.groupBy("shingle").agg(F.sum("n").alias("n")), "frequent")
    steps = seen.groupBy(F.floor(F.log2("n")).alias("step")).count().collect()  # 64 rows at most
    least, left = 0, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        left += row["count"]
        if left > _FREQUENT:
            least = 2 ** (row["step"] + 1)
            break
    top = seen.where(F.col("n") >= least).toPandas()
    keys = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], top["n"].to_numpy(np.int64)[order]


def _keyed(docs: DataFrame, frequent) -> DataFrame:
    """doc_id, size, h (hash of the set) and keys (of the first shingles) of each row; empty sets have no h."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = frequent.value
        for batch in batches:
            sizes, ids, keys = [], [], []
            for found in shingles(batch.column("text")):
                n = len(found)
                sizes.append(n)
                if not n:
                    ids.append(None)
                    keys.append(np.zeros(0, np.int32))
                    continue
                ids.append(xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63))
                first = n - (SHARE * n + 99) // 100 + 1
                if len(known):
                    at = np.searchsorted(known, found)
                    at[at == len(known)] = 0
                    rank = np.where(known[at] == found, often[at], 0)
                    found = found[np.argsort(rank, kind="stable")[:first]]
                # 32 bits are enough here: a chance meeting only costs a comparison
                keys.append((found[:first] >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), _lists(keys, "int32")], ["doc_id", "size", "h", "keys"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, size long, h long, keys array<int>")


def _packed(found: np.ndarray) -> bytes:
    """Six bytes a shingle."""
    return (found >> np.uint64(32)).astype(np.uint32).tobytes() + ((found >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16).tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    n = len(blob) // 6
    high, low = np.frombuffer(blob, np.uint32, n), np.frombuffer(blob, np.uint16, n, 4 * n)
    return (high.astype(np.uint64) << np.uint64(16)) | low


def size_class(size):
    return F.floor(F.log(size) / np.log(_STEP)).cast("int")


def _slots_held(slots: DataFrame) -> np.ndarray:
    """A table of 2 ** _BITS bits; those that ``slots`` (slot) names are set."""
    bits = slots.groupBy(F.shiftrightunsigned("slot", 6).alias("word"))
    bits = bits.agg(F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("bits")).toPandas()
    table = np.zeros(1 << (_BITS - 6), np.int64)
    table[bits["word"].to_numpy(np.int64)] = bits["bits"].to_numpy(np.int64)
    return table


def _held(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which of ``slots`` are set, as their places."""
    return np.flatnonzero(table[slots >> 6] >> (slots & 63).astype(np.int64) & 1)


def _shared(keyed: DataFrame) -> DataFrame:
    """(h, keys) of the sets that share a key with another set: the keys that they share.

    Most shared keys have two sets, which their least and greatest hash name. Rows of the others are
    read again, past a filter of 2 ** _BITS bits that leaves few rows of other keys.
    """
    spark = keyed.sparkSession
    rows = keyed.where("doc_id is not null").select(F.explode("keys").alias("key"), "h", "size")
    ends = rows.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b"), F.count("*").alias("n")).where("a <> b")
    ends = stage(ends, "ends")
    two = ends.where("n = 2").select("key", F.explode(F.array("a", "b")).alias("h"))
    often = ends.where("n > 2").select("key")
    known = spark.sparkContext.broadcast(_slots_held(often.select(F.shiftrightunsigned("key", 32 - _BITS).alias("slot"))))

    def past(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("keys")
            keys = lists.values.to_numpy()
            ends = lists.offsets.to_numpy()
            keys = keys[ends[0] : ends[-1]]
            hit = _held(known.value, keys.view(np.uint32) >> np.uint32(32 - _BITS))
            owner = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(ends))[hit])
            yield pa.RecordBatch.from_arrays([pa.array(keys[hit]), batch.column("h").take(owner)], ["key", "h"])

    passed = keyed.where("doc_id is not null and h is not null").select("h", "keys").mapInArrow(past, "key int, h long")
    return two.union(passed.join(often, "key")).groupBy("h").agg(F.collect_set("key").alias("keys"))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (doc_id, ...) with the set of each document's shingles as bytes.

    Only texts past a filter of 2 ** _BITS bits of the wanted ids are shuffled.
    """
    slot = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - _BITS).cast("int").alias("slot")
    asked = docs.sparkSession.sparkContext.broadcast(_slots_held(wanted.select(slot)))

    def past(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = _held(asked.value, batch.column("slot").to_numpy())
            yield batch.select(["doc_id", "text"]).take(pa.array(hit))

    kind = docs.schema["doc_id"].dataType.simpleString()
    known = docs.where("doc_id is not null").select("doc_id", "text", slot).mapInArrow(past, f"doc_id {kind}, text string")
    # what is wanted grows with the documents, so no size of it calls for a broadcast
    joined = known.join(wanted.hint("merge"), "doc_id")
    rest = [c for c in wanted.columns if c != "doc_id"]
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema if f.name != "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingles(batch.column("text")))
            same = [None if not len(s) else xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
            blobs = pa.array([_packed(s) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(same, pa.int64()), blobs], [*rest, "same", "set"])

    # rows that share an id may hold other texts
    return joined.mapInArrow(run, f"{shape}, same long, set binary").where("same = h").drop("same")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def links(common: int, a: int, b: int) -> bool:
    return 100 * common >= SHARE * (a + b - common)


def distance(common: int, a: int, b: int) -> float:
    return 1 - common / (a + b - common)


class _Roots(dict):
    """Components within one task."""

    def find(self, x):
        while (y := self.setdefault(x, x)) != x:
            self[x] = x = self.setdefault(y, y)
        return x

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        self[max(x, y)] = min(x, y)
        return x != y


def join_region(sets: list[np.ndarray], components: list, found: _Roots) -> list[tuple[int, int]]:
    """Links between sets of different components, as few as connect them all. Splits by pivots, recursively."""
    sizes = [len(s) for s in sets]
    out: list[tuple[int, int]] = []

    def compare(i: int, j: int) -> float | None:
        """The distance; links what links."""
        if 100 * min(sizes[i], sizes[j]) < SHARE * max(sizes[i], sizes[j]):
            return None
        common = _common(sets[i], sets[j])
        if links(common, sizes[i], sizes[j]) and found.join(components[i], components[j]):
            out.append((i, j))
        return distance(common, sizes[i], sizes[j])

    def search(members: list[int], level: int) -> None:
        if len({found.find(components[i]) for i in members}) < 2:
            return
        if len(members) <= LEAF:
            for k, i in enumerate(members):
                for j in members[:k]:
                    if found.find(components[i]) != found.find(components[j]):
                        compare(i, j)
            return
        pivots = members[:: max(1, len(members) // PIVOTS)][:PIVOTS]
        far = np.ones((len(members), len(pivots)))
        for k, i in enumerate(members):
            for q, p in enumerate(pivots):
                common = _common(sets[i], sets[p])
                far[k, q] = distance(common, sizes[i], sizes[p])
                if links(common, sizes[i], sizes[p]) and found.join(components[i], components[p]):
                    out.append((i, p))
        home = far.argmin(1)
        least = far.min(1)
        for q in range(len(pivots)):
            own = np.flatnonzero(home == q)
            if not len(own):
                continue
            # y may link with x of this region: d(y, q) - d(y, its own pivot) <= 2 reach, and d(y, q) near some d(x, q)
            near = (far[:, q] - least <= 2 * REACH) & (far[:, q] >= far[own, q].min() - REACH) & (far[:, q] <= far[own, q].max() + REACH)
            region = [members[k] for k in np.flatnonzero(near) if members[k] not in pivots]
            if len(region) < 0.9 * len(members) and level < 40:
                search(region, level + 1)
            else:  # the pivots tell nothing apart: compare the region's own with all near them
                for k in own:
                    for y in np.flatnonzero(near & (np.abs(far - far[k]).max(1) <= REACH)):
                        if found.find(components[members[k]]) != found.find(components[members[y]]):
                            compare(members[k], members[y])

    search(sorted(range(len(sets)), key=lambda i: sizes[i]), 0)
    return out


def _reach_of(common, a, b, first_a, first_b):
    """The most shingles that sets of ``a`` and ``b`` can share when ``common`` of their first ones agree.

    The prefix that ends first in the global order counts wholly; behind it at most the rest of its set
    is common. Two more make up for first shingles of one hash.
    """
    return F.least(common + 2 + F.greatest(a - first_a, b - first_b), a, b)


def _may_link(most, a, b):
    return 100 * most >= SHARE * (a + b - most)


def _near_pairs(pairs: DataFrame, met: DataFrame) -> DataFrame:
    """The pairs of set and pivot that may link by their first shingles."""
    own = met.select("h", "size", "firsts", "keys")
    other = met.select(F.col("h").alias("pivot"), *[F.col(c).alias(f"pivot_{c}") for c in ("size", "firsts", "keys")])
    both = pairs.join(own, "h").join(other, "pivot")
    common = F.size(F.array_intersect("keys", "pivot_keys"))
    most = _reach_of(common, F.col("size"), F.col("pivot_size"), F.col("firsts"), F.col("pivot_firsts"))
    return both.where(_may_link(most, F.col("size"), F.col("pivot_size"))).select("h", "pivot")


def _block_pairs(packed: DataFrame) -> DataFrame:
    """``packed`` (pivot, class, blocks, block, members) once by itself, and each two blocks of a region as ``members`` and ``others``.

    Only regions of several blocks are shuffled.
    """
    alone = packed.withColumn("others", F.lit(None).cast(packed.schema["members"].dataType))
    first = packed.where("block + 1 < blocks").withColumn("with", F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)))
    second = packed.where("block > 0").select("pivot", "class", F.col("block").alias("with"), F.col("members").alias("others"))
    met = first.join(second, ["pivot", "class", "with"])
    columns = ["pivot", "class", "members", "others"]
    return alone.select(*columns).union(met.select(*columns))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row after the other, as Python objects."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _promising(regions: DataFrame, met: DataFrame) -> DataFrame:
    """Rows of ``regions`` (pivot, class, h, component) that may link with one of another component there."""
    size = regions.groupBy("pivot", "class").agg(F.count("*").alias("n"), F.min("component").alias("c1"), F.max("component").alias("c2"))
    size = size.where("c1 <> c2").select("pivot", "class", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    left = splittable_join(regions, size, ["pivot", "class"], "inner")
    left = stage(left.withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")), "unsolved")
    named = left.join(met.select("h", "size", "firsts", "keys"), "h")
    packed = named.groupBy("pivot", "class", "blocks", "block").agg(
        F.collect_list(F.struct("h", F.xxhash64("component").alias("component"), "size", "firsts", "keys")).alias("members")
    )  # about BLOCK
    packed = stage(packed, "firsts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            members = row["members"] + (row["others"] or [])
            sizes = np.array([m["size"] for m in members])
            held = np.array([len(m["keys"]) for m in members])
            component = np.array([m["component"] for m in members])
            flat = np.concatenate([np.array(m["keys"], np.int64) for m in members])
            keys, at, n = np.unique(flat, return_inverse=True, return_counts=True)
            column = np.cumsum(n > 1) - 1
            holds = np.zeros((len(members), int((n > 1).sum())), np.float32)
            shared = n[at] > 1
            holds[np.repeat(np.arange(len(members)), held)[shared], column[at[shared]]] = 1
            rest = sizes - np.array([m["firsts"] for m in members])
            most = holds @ holds.T + 2 + np.maximum(rest[:, None], rest)
            most = np.minimum(np.minimum(most, sizes[:, None]), sizes)
            near = (100 * most >= SHARE * (sizes[:, None] + sizes - most)) & (component[:, None] != component)
            found = [members[k]["h"] for k in np.flatnonzero(near.any(1))]
            where = [pa.array([row[c]] * len(found), kind) for c, kind in (("pivot", pa.int64()), ("class", pa.int32()))]
            yield pa.RecordBatch.from_arrays([*where, pa.array(found, pa.int64())], ["pivot", "class", "h"])

    kept = _block_pairs(packed).mapInArrow(run, "pivot long, class int, h long").distinct()
    return left.select("pivot", "class", "h", "rep", "component").join(kept, ["pivot", "class", "h"])


def _pivoted(pairs: DataFrame) -> DataFrame:
    """(a, b, linked) of each set and its pivot; rows of ``pairs`` hold both sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            last, pivot = None, None
            for p, own, other in zip(batch.column("pivot").to_pylist(), batch.column("set").to_pylist(), batch.column("pivot_set").to_pylist()):
                if p != last:
                    last, pivot = p, _unpacked(other)
                s = _unpacked(own)
                linked.append(links(_common(s, pivot), len(s), len(pivot)))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("pivot_rep"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    kind = pairs.schema["rep"].dataType.simpleString()
    return pairs.mapInArrow(run, f"a {kind}, b {kind}, linked boolean")


def _inside(docs: DataFrame, pairs: DataFrame, reps: DataFrame, met: DataFrame, roots: DataFrame) -> DataFrame:
    """Further links (a, b): between sets of a region that are in different components so far."""
    kind = reps.schema["rep"].dataType.simpleString()
    known = roots.select(F.col("node").alias("rep"), F.col("root").alias("component"))
    placed = pairs.join(reps.select("h", "rep", "size"), "h").join(known, "rep", "left")
    own = size_class(F.col("size"))  # sets of one size class and the next meet
    regions = placed.select("pivot", F.explode(F.array(own, own - 1)).alias("class"), "h", "rep", F.coalesce("component", "rep").alias("component"))
    left = stage_made(docs.sparkSession, "promising", lambda: _promising(stage(regions, "regions"), met))
    size = left.groupBy("pivot", "class").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    left = splittable_join(left, size, ["pivot", "class"], "inner")
    left = left.withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int"))
    spot = F.struct("pivot", "class", "blocks", "block", "component")
    wanted = stage(left.groupBy("h", "rep").agg(F.collect_list(spot).alias("spots")), "wanted")
    sets = _sets(docs, wanted.select(F.col("rep").alias("doc_id"), "h", "spots", F.col("rep").alias("id")))
    rows = sets.select("id", "set", F.explode("spots").alias("s")).select("id", "set", "s.*")
    packed = rows.groupBy("pivot", "class", "blocks", "block").agg(F.collect_list(F.struct("id", "component", "set")).alias("members"))  # about BLOCK
    packed = stage(packed, "packed")
    arrow = to_arrow_type(reps.schema["rep"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            members = row["members"] + (row["others"] or [])
            got = join_region([_unpacked(m["set"]) for m in members], [m["component"] for m in members], _Roots())
            if got:
                ids = [m["id"] for m in members]
                yield pa.RecordBatch.from_arrays([pa.array([ids[p[side]] for p in got], arrow) for side in (0, 1)], ["a", "b"])

    return _block_pairs(packed).mapInArrow(run, f"a {kind}, b {kind}")


def _pairs(met: DataFrame) -> DataFrame:
    """(h, pivot) of each set and the pivots of its first shingles."""
    own = size_class(F.col("size"))
    shared = met.select(F.explode("keys").alias("key"), "h", F.array(own, own - 1).alias("classes"))
    shared = shared.select("key", "h", F.explode("classes").alias("class"))
    pivots = shared.groupBy("key", "class").agg(F.min("h").alias("pivot"), F.max("h").alias("other")).where("pivot <> other")
    pivots = stage(pivots.drop("other"), "pivots")
    return shared.join(pivots, ["key", "class"]).where("h <> pivot").select("h", "pivot").distinct()


def _stars(docs: DataFrame, pairs: DataFrame, reps: DataFrame, met: DataFrame) -> DataFrame:
    """(a, b) of each set and pivot that link."""

    def make() -> DataFrame:
        near = stage(_near_pairs(pairs, met), "near")
        # each set goes to its pivots once, a pivot's own set to its region
        mine = near.groupBy("h").agg(F.collect_list("pivot").alias("pivots"))
        heads = near.select(F.col("pivot").alias("h")).distinct().withColumn("head", F.lit(True))
        wanted = mine.join(heads, "h", "full").join(reps.select("h", "rep"), "h")
        wanted = wanted.select(F.col("rep").alias("doc_id"), "h", F.col("rep").alias("id"), "pivots", F.coalesce("head", F.lit(False)).alias("head"))
        sets = stage(_sets(docs, stage(wanted, "wanted")), "sets")
        members = sets.where("pivots is not null").select("h", F.col("id").alias("rep"), "set", F.explode("pivots").alias("pivot"))
        middle = sets.where("head").select(F.col("h").alias("pivot"), F.col("id").alias("pivot_rep"), F.col("set").alias("pivot_set"))
        return _pivoted(members.join(middle, "pivot"))

    return stage_made(pairs.sparkSession, "compared", make).where("linked").select("a", "b")


def similar_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each row: what links of a Jaccard similarity of SHARE reach.

    Null and empty texts and texts of white space have no shingles and stand alone; texts of fewer than
    WIDTH words are one shingle; equal texts link. Rows without id have a null component unless their
    set is that of a row with one. Rows that share an id count as one node of the graph, each with its
    own set. Long texts count whole; other columns do no harm; no rows give no rows.
    """
    spark = docs.sparkSession
    with staging_scope(spark):
        frequent = spark.sparkContext.broadcast(frequent_shingles(docs))  # _FREQUENT * 16 bytes at most
    keyed = stage(_keyed(docs, frequent), "keyed")
    named = keyed.where("h is not null and doc_id is not null")
    reps = named.select("h", "doc_id", "size", F.size("keys").alias("firsts")).groupBy("h")
    reps = stage(reps.agg(F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("firsts").alias("firsts")), "reps")
    # of its first shingles a set needs those only that another set shares: the others are common to no two
    met = stage_made(spark, "met", lambda: _shared(keyed).join(reps.select("h", "size", "firsts"), "h"))
    pairs = stage_made(spark, "pairs", lambda: _pairs(met))
    roots = stage_made(spark, "roots", lambda: connected(_stars(docs, pairs, reps, met)))
    more = stage_made(spark, "more", lambda: _inside(docs, pairs, reps, met, roots))
    if not more.isEmpty():
        kept = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = stage_made(spark, "roots", lambda: connected(kept.union(more)))
    named = reps.select("h", "rep").join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    named = stage(named.select("h", F.coalesce("root", "rep").alias("component")), "named")
    done = keyed.select("doc_id", F.col("size").alias("n_shingles"), "h").join(named, "h", "left")
    return done.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
