"""What the operators share: reading, folds, words, hashes and skew-safe numbering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """True in the held-out fold: crc32 of the id's text divides evenly. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; bytes methods know ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, bound: int = 400_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x632BE59BD9B4E019))
_S1, _S2 = np.uint64(29), np.uint64(32)


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash from an ordered pair of hashes, element by element."""
    value = (left * _K1) ^ (right + _K3)
    value ^= value >> _S1
    value *= _K2
    value ^= value >> _S2
    return value


def splitmix(value: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly."""
    value = value * _K1 + _K3
    value ^= value >> _S2
    value *= _K2
    value ^= value >> _S1
    return value


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbours; shorter input gives an empty array."""
    if len(hashes) < width:
        return hashes[:0]
    value = hashes[: len(hashes) - width + 1]
    for k in range(1, width):
        value = mixed(value, hashes[k : len(hashes) - width + 1 + k])
    return value


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = splitmix(np.arange(256, dtype=np.uint64))
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]


def _hashed_words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of joined texts that begin at ``begins``, and where the words start."""
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins = begins[begins < len(data)]
    first[begins] = word[begins]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    kept = np.flatnonzero(word)
    own = np.flatnonzero(first[kept])
    place = kept - np.repeat(starts, np.diff(np.append(own, len(kept))))
    powers = np.cumprod(np.append(np.uint64(1), np.full(int(place.max()), _K1)), dtype=np.uint64)
    return splitmix(np.add.reduceat(_BYTE[data[kept]] * powers[place], own)), starts


def word_hashes(texts: pa.Array, step: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """64-bit hashes of the words that :func:`words` finds, for a few texts of about ``step`` bytes after the other.

    Each time the hashes of all words, and at which of them each text starts, and the end. A word is hashed from
    its bytes as a polynomial with random coefficients, so words need no Python objects.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8) if len(texts) else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        until = min(len(texts), max(at + 1, int(np.searchsorted(ends, ends[at] + step))))
        bounds = ends[at : until + 1] - ends[at]
        found, starts = _hashed_words(data[ends[at] : ends[until]], bounds[:-1])
        yield found, np.searchsorted(starts, bounds)
        at = until


def numbered(df: DataFrame, group: list[str], order: Column, name: str, slices: int = 512, few_groups: bool = False) -> DataFrame:
    """Numbers the rows of each group from 0 in the order of ``order``, an even 64-bit hash.

    A group is cut into ``slices`` (a power of two) ranges of the hash. Rows are numbered inside a range;
    ranges are shifted by a running total over one row per range, so no task needs a whole group.
    ``few_groups``: the caller knows a bound of the groups, so that these totals may be broadcast.
    """
    cut = F.shiftrightunsigned("__order", 64 - slices.bit_length() + 1).cast("int")
    rows = df.withColumn("__order", order).withColumn("__slice", cut)
    keys = [f"__group_{k}" for k in range(len(group))]
    before = W.partitionBy(*keys).orderBy("__at").rowsBetween(W.unboundedPreceding, -1)
    counts = rows.groupBy(*[F.col(c).alias(k) for c, k in zip(group, keys)], F.col("__slice").alias("__at")).count()
    shifts = counts.select(*keys, "__at", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__shift"))
    rest = [c for c in df.columns if c not in group]
    inside = W.partitionBy(*group, "__slice").orderBy("__order", *rest)
    ranked = rows.withColumn("__in", F.row_number().over(inside) - 1)
    same = ranked["__slice"] == shifts["__at"]
    for c, k in zip(group, keys):
        same = same & ranked[c].eqNullSafe(shifts[k])
    shifts = F.broadcast(shifts) if few_groups else shifts
    return ranked.join(shifts, same).select(*df.columns, (F.col("__in") + F.col("__shift")).alias(name))
