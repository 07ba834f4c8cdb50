"""Token counts: the pieces of each distinct pre-token are counted once and summed per document."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from filingstrata.sources.staging import stage

from .common import splitmix

_CHARS = 2_000_000  # code points that a task cuts at once
_HELD = 300_000  # distinct pre-tokens a task holds before it hands on their counts
LETTER, NUMBER, SPACE = 1, 2, 3


def char_classes() -> np.ndarray:
    """The class of each code point (letter, number, white space, else 0), as the library sees it."""
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    table = np.zeros(0x110000, np.uint8)
    for mark, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        runs = pre_tokenizers.Split(Regex(f"{name}+"), "isolated").pre_tokenize_str(text)
        single = pre_tokenizers.Split(Regex(name), "removed")
        for run, _ in runs:
            if not single.pre_tokenize_str(run[0]):
                table[ord(run[0]) : ord(run[-1]) + 1] = mark
    return table


def starts_of(code: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of byte-level BPE start; ``first`` marks the start of each text.

    A run of letters, of numbers or of other signs is one pre-token, with one space before it. Of white
    space before something else the last character stands apart. A lone apostrophe that no space
    precedes takes s, t, m, d, re, ve or ll with it.
    """
    n = len(code)
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:])
    start[last] = True
    start[last[code[last] == 32] + 1] = False
    mark = np.flatnonzero((code[:-1] == 39) & start[:-1] & (kind[1:] == LETTER) & ~first[1:])
    if len(mark):
        one = code[mark + 1]
        single = mark[np.isin(one, [ord(c) for c in "stmd"])]
        start[single + 1] = False
        start[single[single + 2 < n] + 2] = True
        pair = mark[mark + 2 < n]
        pair = pair[~first[pair + 2]]
        a, b = code[pair + 1], code[pair + 2]
        double = pair[((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)]
        start[double + 1] = False
        start[double[double + 3 < n] + 3] = True
    return np.flatnonzero(start)


def _segments(texts: list[str | None], special: list[str]) -> Iterator[tuple[int, str, int]]:
    """(text's number, stretch of it, special strings before the stretch); long texts come in stretches."""
    for k, text in enumerate(texts):
        if not text:
            yield k, "", 0
            continue
        parts, at = [text], 0
        for s in special:
            parts = [q for part in parts for q in part.split(s)]
        for number, part in enumerate(parts):
            marks, at = int(number > 0), 0
            while len(part) - at > _CHARS:
                cut = at + _CHARS
                # a space between two letters always starts a pre-token
                while cut < len(part) - 1 and not (part[cut] == " " and part[cut - 1].isascii() and part[cut - 1].isalpha() and part[cut + 1].isascii() and part[cut + 1].isalpha()):
                    cut += 1
                if cut >= len(part) - 1:
                    break
                yield k, part[at:cut], marks
                at, marks = cut, 0
            yield k, part[at:], marks


class Cut:
    """The pre-tokens of a few texts: number of the text, hash, start and length of each."""

    def __init__(self, segments: list[tuple[int, str, int]], classes: np.ndarray):
        self.joined = "".join(s for _, s, _ in segments)
        self.code = code = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(s) for _, s, _ in segments])
        begin = np.cumsum(sizes) - sizes
        first = np.zeros(len(code), bool)
        first[begin[sizes > 0]] = True
        if not len(code):
            self.start = self.size = np.zeros(0, np.int64)
            self.hash, self.owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return
        self.start = starts_of(code, classes[code], first)
        self.size = np.diff(np.append(self.start, len(code)))
        place = (np.arange(len(code)) - np.repeat(self.start, self.size)).astype(np.uint64)
        self.hash = np.add.reduceat(splitmix(code.astype(np.uint64) | (place << np.uint64(21))), self.start)
        numbers = np.array([k for k, _, _ in segments])[sizes > 0]
        self.owner = numbers[np.searchsorted(begin[sizes > 0], self.start, "right") - 1]

    def string(self, k: int) -> str:
        return self.joined[self.start[k] : self.start[k] + self.size[k]]


def _cuts(texts: list[str | None], special: list[str], classes: np.ndarray) -> Iterator[tuple[list, Cut]]:
    group, held = [], 0
    for segment in _segments(texts, special):
        group.append(segment)
        held += len(segment[1])
        if held >= _CHARS:
            yield group, Cut(group, classes)
            group, held = [], 0
    if group:
        yield group, Cut(group, classes)


def _specials(path: str) -> list[str]:
    found = [t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()]
    return sorted(found, key=len, reverse=True)


def piece_table(texts: DataFrame, path: str, classes: Broadcast) -> DataFrame:
    """Hash, frequency ``n`` and number of ``pieces`` of each distinct pre-token of column ``text``."""
    special = _specials(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.fromiter(held, np.uint64, len(held)).view(np.int64)), pa.array([v[0] for v in held.values()], pa.string()),
                 pa.array([v[1] for v in held.values()], pa.int64())], ["hash", "pre", "n"],
            )
            held.clear()
            return out

        for batch in batches:
            for _, cut in _cuts(batch.column(0).to_pylist(), special, classes.value):
                keys, at, n = np.unique(cut.hash, return_index=True, return_counts=True)
                for key, k, times in zip(keys.tolist(), at.tolist(), n.tolist()):
                    entry = held.get(key)
                    if entry is None:
                        held[key] = [cut.string(k), times]
                    else:
                        entry[1] += times
                if len(held) > _HELD:
                    yield flush()
        yield flush()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = Tokenizer.from_file(path)
        for batch in batches:
            found, strings = [], batch.column(1).to_pylist()
            for at in range(0, len(strings), 1000):
                found += [len(e) for e in library.encode_batch_fast(strings[at : at + 1000], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.int32())], ["hash", "n", "pieces"])

    counted = texts.select("text").mapInArrow(count, "hash long, pre string, n long")
    distinct = counted.groupBy("hash").agg(F.first("pre").alias("pre"), F.sum("n").alias("n"))
    return distinct.mapInArrow(pieces, "hash long, n long, pieces int")


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, frequent: int = 1_000_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row of ``docs``.

    One pass makes the table of distinct pre-tokens, which the tokenizer sees once each. A second pass
    makes the pre-token frequencies of each document. The ``frequent`` most frequent pre-tokens, a
    table of bounded size, are summed on the spot, which also leaves no hot key; all others are
    joined with the table. No token ids are kept. Pre-tokens are told apart by 64-bit hashes.

    A null text counts as empty (0 bytes, 0 tokens). Repeated rows and rows that share a doc_id are
    counted each by itself; null ids stay null; other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    special = _specials(path)
    rows = docs.select("doc_id", "text")
    classes = spark.sparkContext.broadcast(char_classes())  # one byte a code point
    table = stage(piece_table(rows, path, classes), "pieces")
    total = table.agg(F.sum("n")).first()[0] or 0
    top = table.where(F.col("n") * frequent >= total).select("hash", "pieces").toPandas()
    order = np.argsort(top["hash"].to_numpy(np.int64).view(np.uint64))
    known = spark.sparkContext.broadcast(
        (top["hash"].to_numpy(np.int64).view(np.uint64)[order], top["pieces"].to_numpy(np.int64)[order])
    )

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, pieces = known.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sums = np.zeros(len(texts), np.int64)
            owners, rest = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for group, cut in _cuts(texts, special, classes.value):
                for k, _, marks in group:
                    sums[k] += marks
                at = np.searchsorted(hashes, cut.hash)
                at[at == len(hashes)] = 0
                hit = hashes[at] == cut.hash if len(hashes) else np.zeros(len(at), bool)
                sums += np.bincount(cut.owner[hit], pieces[at[hit]], len(texts)).astype(np.int64)
                owners.append(cut.owner[~hit])
                rest.append(cut.hash[~hit])
            owner, other = np.concatenate(owners), np.concatenate(rest)
            order = np.lexsort((other, owner))
            owner, other = owner[order], other[order]
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
            begin = np.flatnonzero(new)
            times = np.diff(np.append(begin, len(owner)))
            ends = np.searchsorted(owner[begin], np.arange(len(texts) + 1))
            items = pa.StructArray.from_arrays([pa.array(other[begin].view(np.int64)), pa.array(times.astype(np.int64))], ["hash", "n"])
            sizes = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), items)],
                ["row", "doc_id", "n_bytes", "sum", "rest"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    counted = keyed.mapInArrow(
        per_document, f"row long, doc_id {kind}, n_bytes long, sum long, rest array<struct<hash: long, n: long>>"
    )
    apart = counted.select("row", "doc_id", "n_bytes", "sum", F.explode_outer("rest").alias("r"))
    apart = apart.select("row", "doc_id", "n_bytes", "sum", F.col("r.hash").alias("hash"), F.col("r.n").alias("times"))
    joined = apart.join(table.select("hash", "pieces"), "hash", "left")
    more = F.coalesce(F.sum(F.col("times") * F.col("pieces")), F.lit(0))
    n = F.col("sum") + F.col("more")
    summed = joined.groupBy("row", "doc_id", "n_bytes", "sum").agg(more.alias("more"))
    return summed.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
