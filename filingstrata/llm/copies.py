"""Exact copies: batches are screened by the filters of earlier snapshots, and what passes is checked byte by byte.

A snapshot is what is known of a batch once it is in: its distinct digests as exact buckets, and a
binary-fuse filter for each shard of them. Both are written once and never change. A later batch
groups its own copies first, so that one row for each distinct digest is screened; only those that a
filter lets through meet the buckets, and only the texts of such pairs are read again and compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingstrata.operators.joins import splittable_join
from filingstrata.sources.staging import stage

from .fuse import FuseFilter, build_filter

KEY_DIGITS = 15  # hexadecimal digits of a digest that make the key of filters and buckets
_SIEVE_BITS = 24  # 16 M bits, 2 MB: which rows' texts are read again


@dataclass(frozen=True)
class Snapshot:
    """The digests of one batch, written once.

    ``filters`` has one row for each shard with the filter of its keys; ``buckets`` one row for each
    distinct text with ``key``, ``digest`` and the row that stands for it.
    """

    number: int
    shards: int
    filters: DataFrame
    buckets: DataFrame


def digest_of(text: Column) -> Column:
    """SHA-256 in lower-case hexadecimal; null as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def grouped(rows: DataFrame, digits: int = KEY_DIGITS) -> DataFrame:
    """One row for each distinct digest of rows (row, doc_id, digest): key, digest, n and the row that stays.

    That is the row of the largest doc_id, a null id before all others, and of those the last ``row``.
    Copies are counted map-side, so a digest that most rows have is one row a task.
    """
    key = F.conv(F.substring("digest", 1, digits), 16, 10).cast("long").alias("key")
    counted = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row")).alias("keep"))
    return counted.select(key, "digest", "n", "keep")


def freeze(groups: DataFrame, number: int, per_shard: int = 8192) -> Snapshot:
    """The snapshot of a batch's groups; the shards grow in number with its digests, not in size."""
    buckets = stage(groups.select("key", "digest", "keep"), f"buckets-{number}")
    at_least = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(at_least, buckets.count() // per_shard)

    def made(shard: tuple, keys: pa.Table) -> pa.Table:
        made = build_filter(keys["key"].to_numpy().astype(np.int64).view(np.uint64))
        return pa.table(
            {"shard": pa.array([shard[0].as_py()], pa.int64()), "seed": pa.array([made.seed], pa.int32()), "segment": pa.array([made.segment], pa.int32()),
             "segments": pa.array([made.segments], pa.int32()), "cells": pa.array([made.cells.tobytes()], pa.binary())}
        )

    keys = buckets.select(_shard(shards), "key").distinct()
    filters = keys.groupBy("shard").applyInArrow(made, "shard long, seed int, segment int, segments int, cells binary")
    return Snapshot(number, shards, stage(filters, f"filters-{number}"), buckets)


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("long").alias("shard")


def screened(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The groups whose key the snapshot's filters let through: all it holds and one in 256 of the others.

    A shard's keys meet the one filter of that shard; digests spread evenly, and each comes once.
    """

    def passed(shard: tuple, keys: pa.Table, found: pa.Table) -> pa.Table:
        if not found.num_rows or not keys.num_rows:
            return keys.slice(0, 0)
        row = found.to_pylist()[0]
        known = FuseFilter(row["seed"], row["segment"], row["segments"], np.frombuffer(row["cells"], np.uint8))
        return keys.filter(pa.array(known.contains(keys["key"].to_numpy().astype(np.int64).view(np.uint64))))

    spread = groups.select(_shard(snapshot.shards), *groups.columns)
    pairs = spread.groupBy("shard").cogroup(snapshot.filters.groupBy("shard"))
    return pairs.applyInArrow(passed, spread.schema).drop("shard")


def meetings(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Pairs of a group and a stored bucket of one key, found through the filters: what has to be compared."""
    stored = snapshot.buckets.select("key", F.col("digest").alias("old_digest"), F.col("keep").alias("old_keep"))
    return (
        screened(groups, snapshot).select("key", "digest", "keep").join(stored, "key")
        .select("digest", "keep", "old_digest", "old_keep", F.lit(snapshot.number).alias("home"))
    )


def _sieve(rows: DataFrame) -> DataFrame:
    """One row of 2 MB: a bit for the hash of each (doc_id, digest) of ``rows``; a bit may stand for several."""
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "digest"), 64 - _SIEVE_BITS)
    word, bit = F.shiftright(place, 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    words = rows.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = words.toArrow()  # at most 2 ** 18 words
    sieve = np.zeros(1 << (_SIEVE_BITS - 6), np.int64)
    sieve[found["word"].to_numpy()] = found["bits"].to_numpy()
    return rows.sparkSession.createDataFrame(pa.table({"sieve": pa.array([sieve], pa.list_(pa.int64()))}))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, digest, text) of the ``wanted`` rows (doc_id, digest); the others' texts are not shuffled."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", digest_of(F.col("text")))
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "digest"), 64 - _SIEVE_BITS)
    word = F.element_at("sieve", (F.shiftright(place, 6) + 1).cast("int"))
    likely = rows.join(F.broadcast(_sieve(wanted)), F.getbit(word, (place % 64).cast("int")) == 1, "left_semi")
    ids = wanted.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"))
    same = (F.col("digest") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    return likely.join(ids, same, "left_semi").dropDuplicates(["doc_id", "digest"])


def same_bytes(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Of the pairs that :func:`meetings` found those whose texts are the same, with their digest and home.

    Further columns of the pairs stay. ``docs`` has the rows of both sides.
    """
    kept = [c for c in pairs.columns if c not in ("keep", "old_digest", "old_keep")]
    pairs = stage(pairs, "meetings")
    sides = [pairs.select(F.col(f"{side}keep")["doc_id"].alias("doc_id"), F.col(f"{side}digest").alias("digest")) for side in ("", "old_")]
    texts = stage(_texts(docs, sides[0].unionByName(sides[1]).distinct()), "compared")
    for side in ("", "old_"):
        found = texts.select(
            F.col("doc_id").alias(f"__{side}id"), F.col("digest").alias(f"{side}digest"), F.col("text").alias(f"{side}text")
        )
        same_row = F.col(f"{side}keep")["doc_id"].eqNullSafe(F.col(f"__{side}id"))
        pairs = pairs.join(found, f"{side}digest").where(same_row)
    return pairs.where(F.col("text") == F.col("old_text")).select(*kept)


def exact_copies(docs: DataFrame, batches: int = 3, digits: int = KEY_DIGITS, per_shard: int = 8192) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of each row of ``docs``.

    The rows come in ``batches`` by a hash of doc_id. All but the last become snapshots; each batch is
    screened by every earlier one. A group lives in the first batch that holds its text; of all its
    rows that of the largest doc_id is kept.

    Texts are equal when their bytes are. Inside a batch that is told by SHA-256, between batches by
    the bytes themselves (``digits`` shortens the keys: more rows are then compared, with the same
    result). A null text counts as empty, and empty texts are copies of each other. Null ids come
    before all others; of rows that share id and text one is kept, the others count as its copies. Other
    columns are ignored; no rows give no rows.
    """
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    rows = stage(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", batch.alias("batch"), digest_of(F.col("text")).alias("digest")),
        "digests",
    )
    each = [stage(grouped(rows.where(F.col("batch") == k), digits), f"groups-{k}") for k in range(batches)]
    snapshots = [freeze(each[k], k, per_shard) for k in range(batches - 1)]
    pairs = [meetings(each[k], s).withColumn("batch", F.lit(k)) for k in range(1, batches) for s in snapshots[:k]]
    groups = _union([groups.withColumn("batch", F.lit(k)) for k, groups in enumerate(each)])
    if pairs:
        first = same_bytes(_union(pairs), docs).groupBy("batch", "digest").agg(F.min("home").alias("home"))
        groups = groups.join(first, ["batch", "digest"], "left")
    else:
        groups = groups.withColumn("home", F.lit(None).cast("int"))
    settled = groups.withColumn("home", F.coalesce("home", "batch")).select("batch", "home", "digest", "n", "keep")
    totals = settled.groupBy("home", "digest").agg(F.sum("n").alias("group_size"), F.max("keep").alias("kept_row"))
    known = settled.select("batch", "home", "digest").join(totals, ["home", "digest"]).drop("home")
    return splittable_join(rows, known, ["batch", "digest"], "inner").select(
        "doc_id", F.col("kept_row")["doc_id"].alias("keep_id"), "group_size",
        (F.col("row") == F.col("kept_row")["row"]).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
