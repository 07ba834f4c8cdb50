"""Benchmark decontamination by pigeonhole edit matching: exact hits of pieces, then bit-parallel edit distance."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from filingstrata.sources.staging import stage

_RUN = re.compile(r"\S+")
_BLOCK = 4_000_000  # characters of test items that a task holds at once
_SHAPE = "item_id {item}, distance int, budget int, offset long, length long"


def plain(text: str | None) -> str:
    """Lower case, one space between words. Keeps the number of letters of each word."""
    return " ".join(text.replace("İ", "i").lower().split()) if text else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces of nearly equal length; ``budget`` edits leave one untouched."""
    n = budget + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def nearest(item: str, text: str, anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of ``item`` to a stretch of ``text``, and where the first such stretch ends.

    Columns of the distance table are bits of whole numbers (Myers 1999). ``anchored``: the stretch
    starts where the text does.
    """
    m = len(item)
    equal: dict[str, int] = defaultdict(int)
    for k, c in enumerate(item):
        equal[c] |= 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, distance = full, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        eq = equal.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise = down | (full & ~(diagonal | up))
        fall = up & diagonal
        if rise & top:
            distance += 1
        elif fall & top:
            distance -= 1
        rise = (rise << 1) | anchored
        fall <<= 1
        vertical = eq | down
        up = full & (fall | ~(vertical | rise))
        down = full & rise & vertical
        if distance < best:
            best, end = distance, at
    return best, end


class Matcher:
    """Test items of one block and the automaton of their pieces."""

    def __init__(self, items: list[tuple], rate: float, least: int):
        self.least = least
        self.items = [(key, text, int(rate * len(text)) if len(text) >= least else 0) for key, text in items]
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list] = defaultdict(list)
        for k, (_, text, budget) in enumerate(self.items):
            for at, piece in pieces(text, budget):
                places[piece].append((k, at, len(piece)))
        for piece, found in places.items():
            self.automaton.add_word(piece, found)
        self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item's number, distance, start, end) of the best stretch for each item within its budget."""
        starts: dict[int, set[int]] = defaultdict(set)
        for last, found in self.automaton.iter(text):
            for k, at, size in found:
                starts[k].add(last + 1 - size - at)  # where the item would start if nothing were added before
        for k, shifts in starts.items():
            _, item, budget = self.items[k]
            if len(item) < self.least:  # whole words only
                at = next((at for at in sorted(starts[k]) if _apart(text, at) and _apart(text, at + len(item))), None)
                if at is not None:
                    yield k, 0, at, at + len(item)
                continue
            best = None
            low = high = None
            windows = []
            for shift in sorted(shifts):
                a, b = max(0, shift - budget), min(len(text), shift + len(item) + budget)
                if high is not None and a <= high and b - low <= 2 * len(item):
                    high = max(high, b)
                else:
                    if high is not None:
                        windows.append((low, high))
                    low, high = a, b
            windows.append((low, high))
            for low, high in windows:
                distance, end = nearest(item, text[low:high])
                if distance <= budget and (best is None or distance < best[0]):
                    best = (distance, low, low + end)
                    if not distance:
                        break
            if best:
                distance, low, end = best
                back = nearest(item[::-1], text[low:end][::-1], anchored=True)[1]
                yield k, distance, end - back, end


def _apart(text: str, at: int) -> bool:
    """Whether no word goes on across a place."""
    return not (0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum())


def _original(text: str, start: int, end: int) -> tuple[int, int]:
    """Offset and length in the text of a stretch of plain(text)."""
    at, first, last = 0, None, 0
    for m in _RUN.finditer(text):
        size = m.end() - m.start()
        if first is None and start < at + size + 1:
            first = m.start() + min(max(start - at, 0), size)
        if at < end:
            last = m.start() + min(end - at, size)
        at += size + 1
        if at >= end:
            break
    return first or 0, max(0, last - (first or 0))


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.06, least: int = 20) -> DataFrame:
    """Rows (doc_id, item_id, distance, budget, offset, length) for each document that holds a test item.

    An item of n characters (lower case, single spaces) is held where a stretch of the document is at
    most floor(rate * n) edits away; of several stretches the nearest and then first counts. The items
    come in blocks of bounded size, each matched against all rows. Items below ``least`` characters are held
    where they stand letter by letter as whole words. Null and empty items match nothing, as do null and
    empty texts; long texts are searched whole.
    Repeated rows give repeated matches; ids may be null; other columns do no harm; no rows give none.
    """
    kinds = {"doc_id": docs.schema["doc_id"].dataType.simpleString(), "item": benchmark.schema["item_id"].dataType.simpleString()}
    shape = f"doc_id {kinds['doc_id']}, " + _SHAPE.format(item=kinds["item"])
    out = None
    for items in item_blocks(docs, benchmark):
        found = docs.select("doc_id", "text").mapInArrow(_search(items, rate, least, to_arrow_type(benchmark.schema["item_id"].dataType)), shape)
        out = found if out is None else out.union(found)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = 0.06, least: int = 20) -> DataFrame:
    """The rows of ``docs`` that hold no test item, as they are; see :func:`find_leaks`."""

    def without(items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items.value, rate, least) if items.value else None
            for batch in batches:
                texts = batch.column("text").to_pylist()
                clean = [matcher is None or next(matcher.matches(plain(t)), None) is None for t in texts]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for items in item_blocks(docs, benchmark):
        docs = docs.mapInArrow(without(items), docs.schema)
    return docs


def item_blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator:
    """The test items in broadcast blocks of about _BLOCK characters."""
    spark = docs.sparkSession
    known = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = known.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // _BLOCK) or 1
    if blocks > 1:
        known = stage(known.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    for block in range(blocks):
        part = known.where(F.col("block") == block) if blocks > 1 else known
        items = [(r.item_id, p) for r in part.collect() if (p := plain(r.text))]  # about _BLOCK characters
        yield spark.sparkContext.broadcast(items)


def _search(items, rate: float, least: int, key_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, rate, least) if items.value else None
        for batch in batches:
            rows = []
            for k, text in enumerate(batch.column("text").to_pylist() if matcher else []):
                for item, distance, start, end in matcher.matches(plain(text)):
                    key, _, budget = matcher.items[item]
                    rows.append((k, key, distance, budget, *_original(text, start, end)))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(columns[0], pa.int64())), pa.array(columns[1], key_type),
                 *(pa.array(c, t) for c, t in zip(columns[2:], (pa.int32(), pa.int32(), pa.int64(), pa.int64())))],
                ["doc_id", "item_id", "distance", "budget", "offset", "length"],
            )

    return run
