"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, kept as sorted hash arrays, scored from mapped files."""

from __future__ import annotations

import io
import json
import mmap
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingstrata.sources import files
from filingstrata.sources.staging import scoped_folder

from .common import WordHashes, fold, mixed, words

BEGIN, END = np.uint64(1), np.uint64(2)
_FLUSH = 2_000_000  # tokens a task counts at once
_BATCH = 400_000  # tokens scored at once
_SAMPLE = 64  # one row in so many shows which contexts are common; only the layout depends on them


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _sequences(texts: list[str | None], hashes: WordHashes, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts behind order-1 begin marks each; places of the tokens; the text of each token."""
    pieces, sizes = [], []
    begin = np.full(order - 1, BEGIN, np.uint64)
    for text in texts:
        found = hashes.of(words(text))
        pieces += [begin, found, np.array([END], np.uint64)]
        sizes.append(len(found) + 1)
    flat = np.concatenate(pieces) if pieces else np.zeros(0, np.uint64)
    sizes = np.array(sizes, np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(owner)) + (owner + 1) * (order - 1)
    return flat, place, owner


def _hashed(columns: list[np.ndarray]) -> tuple[np.ndarray | None, np.ndarray]:
    """Hashes of the context and of the whole n-gram."""
    if len(columns) == 1:
        return None, columns[0]
    context = columns[0]
    for c in columns[1:-1]:
        context = mixed(context, c)
    return context, mixed(context, columns[-1])


def _shard(context: np.ndarray | None, gram: np.ndarray, common: np.ndarray, shards: int) -> np.ndarray:
    """Grams of one context lie together; those of common contexts are spread by their own hash."""
    key = gram if context is None else np.where(_among(context, common), gram, context)
    return ((key >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)).astype(np.int64)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return at, sorted_keys[at] == keys


def _among(keys: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    return _find(sorted_keys, keys)[1]


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where rows of sorted columns start that differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _packed(columns: list[np.ndarray], counts: np.ndarray, raw: np.ndarray | None) -> bytes:
    """Rows sorted by the first column, whose values are stored once a run; counts as narrow as they fit."""
    begin = _runs(columns[0])
    runs = np.diff(np.append(begin, len(columns[0])))
    kinds = []
    out = io.BytesIO()
    out.write(np.array([len(columns[0]), len(begin)], np.int64).tobytes())
    for a in (runs, counts, *([] if raw is None else [raw])):
        kind = next(k for k in ("u1", "u4", "u8") if a.max(initial=0) <= np.iinfo(k).max)
        kinds.append(int(kind[1]))
        out.write(bytes([kinds[-1]]) + a.astype(kind).tobytes())
    out.write(columns[0][begin].tobytes())
    for c in columns[1:]:
        out.write(c.tobytes())
    return out.getvalue()


def _unpacked(blob: bytes, width: int, with_raw: bool) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    n, m = np.frombuffer(blob, np.int64, 2)
    at = 16

    def read(kind: str, size: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(blob, kind, size, at)
        at += found.nbytes
        return found

    def narrow(size: int) -> np.ndarray:
        return read(f"u{read('u1', 1)[0]}", size).astype(np.int64)

    runs = narrow(m)
    counts = narrow(n)
    raw = narrow(n) if with_raw else counts
    first = np.repeat(read("u8", m), runs)
    return [first, *(read("u8", n) for _ in range(width - 1))], counts, raw


def _blocks(columns, counts, raw, common, shards) -> Iterator[tuple[int, bytes]]:
    """One packed block for each shard that has rows."""
    shard = _shard(*_hashed(columns), common, shards)
    order = np.lexsort((columns[0], shard))
    shard, columns = shard[order], [c[order] for c in columns]
    counts, raw = counts[order], None if raw is None else raw[order]
    begin = _runs(shard)
    for a, b in zip(begin, np.append(begin[1:], len(shard))):
        yield int(shard[a]), _packed([c[a:b] for c in columns], counts[a:b], None if raw is None else raw[a:b])


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, and the few numbers that all lookups need."""

    folder: str
    order: int
    shards: int
    discounts: list[list[float]]  # by order from 1: what is taken off counts of 1, 2 and more
    common: dict[int, tuple]  # by order: sorted hashes of spread contexts and their sums
    train_tokens: int
    vocabulary: int
    continuations: tuple[int, int, int, int]  # of order 1: the sum, and how many are 1, 2 and more
    written: dict[int, frozenset[int]]  # by order: the shards that have a file


def _write(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """A file of arrays, each on a multiple of eight bytes; a repeated task replaces it by the same."""
    system, path = _filesystem(folder)
    head, at = [], 0
    for a in arrays:
        head.append((str(a.dtype), len(a), at))
        at += -(-a.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 8)
    attempt = f"{path}/{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as out:
        out.write(np.int64(len(text)).tobytes() + text)
        for a in arrays:
            out.write(a.tobytes() + bytes(-a.nbytes % 8))
    system.move(attempt, f"{path}/{name}")


class _Files:
    """Mapped arrays of a model; files of a store that cannot be mapped are fetched first."""

    def __init__(self, folder: str):
        self.system, self.path = _filesystem(folder)
        self.open: dict[str, list[np.ndarray]] = {}

    def get(self, name: str) -> list[np.ndarray]:
        if name not in self.open:
            self.open[name] = self._map(name)
        return self.open[name]

    def _map(self, name: str) -> list[np.ndarray]:
        path = f"{self.path}/{name}"
        if self.system.get_file_info(path).type == fs.FileType.NotFound:
            raise FileNotFoundError(f"{path} of the model is gone or cannot be seen from here")
        if isinstance(self.system, fs.LocalFileSystem):
            with open(path, "rb") as file:
                data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        else:
            with tempfile.TemporaryFile() as file, self.system.open_input_stream(path) as remote:
                while chunk := remote.read(1 << 20):
                    file.write(chunk)
                file.flush()
                data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        size = int(np.frombuffer(data, np.int64, 1)[0])
        return [np.frombuffer(data, kind, n, 8 + size + at) for kind, n, at in json.loads(data[8 : 8 + size])]


def _discounts(n: list[int]) -> list[float]:
    """What modified Kneser-Ney takes off counts of 1, 2 and more, from the numbers of 1s, 2s, 3s and 4s."""
    if min(n) <= 0:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return [min(max(d, 0.0), k + 1.0) for k, d in enumerate(found)]


def train(texts: DataFrame, order: int = 2, shards: int | None = None) -> Model:
    """Counts column ``text`` and writes the model's arrays to the shared folder.

    Tasks count n-grams of up to _FLUSH tokens, pack them by shard, and each shard's blocks meet in one
    task; shards follow ``spark.sql.shuffle.partitions``, so give that in proportion to the data. A
    lower order counts the distinct n-grams that end in each of its own. All n-grams are kept.
    """
    spark = texts.sparkSession
    shards = shards or 3 * int(spark.conf.get("spark.sql.shuffle.partitions")) // 2
    folder = scoped_folder(spark, "ngrams")
    system, path = _filesystem(folder)
    system.create_dir(path)
    texts = texts.select("text")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            flat, place, _ = _sequences(batch.column(0).to_pylist(), hashes, order)
            for width in range(1, order):
                found = _hashed([flat[place - k] for k in range(width, -1, -1)])[0]
                keys, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), width + 1)), pa.array(keys.view(np.int64)), pa.array(n)], ["order", "context", "n"]
                )

    sample = texts.where(F.monotonically_increasing_id() % _SAMPLE == 0).mapInArrow(contexts, "order long, context long, n long")
    common = {k: np.zeros(0, np.uint64) for k in range(1, order + 1)}
    if order > 1:
        shares = sample.groupBy("order", "context").agg(F.sum("n").alias("n"))
        total = shares.groupBy("order").agg(F.sum("n").alias("total"))
        often = shares.join(total, "order").where(F.col("n") * shards >= 2 * F.col("total"))  # half as many as shards
        for r in often.groupBy("order").agg(F.collect_list("context").alias("keys")).collect():
            common[r.order] = np.sort(np.array(r["keys"], np.int64).view(np.uint64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0

        def flush():
            columns = [np.concatenate(parts) for parts in zip(*held)]
            key = columns[0] if order == 1 else (columns[0] & ~np.uint64(0xFFFFFFFF)) | (_hashed(columns)[1] >> np.uint64(32))
            at = np.argsort(key)
            columns = [c[at] for c in columns]
            begin = _runs(*columns)
            counts = np.diff(np.append(begin, len(at)))
            columns = [c[begin] for c in columns]
            for shard, blob in _blocks(columns, counts, None, common[order], shards):
                yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([blob], pa.binary())], ["shard", "block"])

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for at in range(0, len(texts), 500):
                flat, place, _ = _sequences(texts[at : at + 500], hashes, order)
                held.append([flat[place - k] for k in range(order - 1, -1, -1)])
                size += len(place)
                if size > _FLUSH:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    blocks, before = texts.mapInArrow(count, "shard long, block binary"), None
    found, written = {}, {}
    for width in range(order, 0, -1):
        into = scoped_folder(spark, f"ngrams-{width}")
        made = _merge(blocks, folder, width, width < order, common, shards)
        made.write.parquet(into)
        merged = spark.read.schema(made.schema).parquet(into)
        if before:
            files.delete(spark, before)  # the blocks of the order above have been read
        before = into
        written[width] = frozenset(r.shard for r in merged.where("kind = 'sums'").select("shard").collect())  # one a shard
        numbers = merged.where("kind = 'sums'").selectExpr(*[f"sum(n[{k}]) n{k}" for k in range(7)]).first()
        spread = merged.where("kind = 'context'").groupBy("shard").agg(*[F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(4)])
        rows = spread.collect()  # half as many as shards
        keys = np.array([r.shard for r in rows], np.int64).view(np.uint64)
        at = np.argsort(keys)
        found[width] = (numbers, (keys[at], np.array([[r[f"n{k}"] for k in range(4)] for r in rows], np.int64).reshape(-1, 4)[at]))
        blocks = merged.where("kind = 'block'").select("shard", "block")
    n1 = [found[1][0][k] or 0 for k in range(7)]
    return Model(
        folder, order, shards, [_discounts([found[k][0][i] or 0 for i in range(4)]) for k in range(1, order + 1)],
        {k: found[k][1] for k in range(2, order + 1)}, n1[6], n1[5], (n1[4], n1[0], n1[1], n1[5] - n1[0] - n1[1]), written,
    )


def _merge(blocks: DataFrame, folder: str, width: int, with_raw: bool, common: dict, shards: int) -> DataFrame:
    """Writes each shard's arrays of one order; returns sums, sums of spread contexts and the next order's blocks."""

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpacked(b, width, with_raw) for b in group["block"]]
        columns = [np.concatenate(c) for c in zip(*(p[0] for p in parts))]
        counts, raw = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        context, gram = _hashed(columns)
        at = np.argsort(gram)
        begin = _runs(gram[at])
        counts, raw = np.add.reduceat(counts[at], begin), np.add.reduceat(raw[at], begin)
        at = at[begin]
        columns, gram = [c[at] for c in columns], gram[at]
        out: list[tuple] = []
        many = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        out.append(("sums", int(key[0]), None, [*many, int(counts.sum()), len(counts), int(raw.sum())]))
        if width == 1:
            _write(folder, f"1-{key[0]}", [gram, counts, raw])
        else:
            context = context[at]
            by = np.argsort(context, kind="stable")
            begin = _runs(context[by])
            c = counts[by]
            keys = context[by][begin]
            sums = [np.add.reduceat(x, begin) for x in (c, (c == 1).astype(np.int64), (c == 2).astype(np.int64), (c > 2).astype(np.int64))]
            spread = _among(keys, common[width])
            out += [("context", k, None, list(v)) for k, *v in zip(keys[spread].view(np.int64).tolist(), *(s[spread].tolist() for s in sums))]
            narrow = np.minimum(counts, 0xFFFFFFFF).astype(np.uint32)
            _write(folder, f"{width}-{key[0]}", [gram, narrow, keys[~spread], sums[0][~spread], *(s[~spread].astype(np.uint32) for s in sums[1:])])
            shorter = columns[1:]
            _, end = _hashed(shorter)
            at = np.argsort(end)
            begin = _runs(end[at])
            distinct = np.diff(np.append(begin, len(at)))
            raw = np.add.reduceat(raw[at], begin)
            shorter = [c[at[begin]] for c in shorter]
            out += [("block", s, b, None) for s, b in _blocks(shorter, distinct, raw, common[width - 1], shards)]
        return pd.DataFrame(out, columns=["kind", "shard", "block", "n"])

    return blocks.groupBy("shard").applyInPandas(merge, "kind string, shard long, block binary, n array<long>")


class Scorer:
    """Log10 probabilities of tokens from the mapped arrays."""

    def __init__(self, model: Model):
        self.model, self.files = model, _Files(model.folder)

    def _by_shard(self, context, gram, width):
        """(rows, arrays) of each shard that rows need."""
        common = self.model.common[width][0] if width > 1 else np.zeros(0, np.uint64)
        shard = _shard(context, gram, common, self.model.shards)
        order = np.argsort(shard.astype(np.uint16) if self.model.shards < 65536 else shard, kind="stable")
        begin = _runs(shard[order])
        for a, b in zip(begin, np.append(begin[1:], len(order))):
            number = int(shard[order[a]])
            if number in self.model.written[width]:
                yield order[a:b], self.files.get(f"{width}-{number}")

    def unigrams(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of order 1 and counts in training."""
        m = self.model
        counts, raw = np.zeros(len(token), np.int64), np.zeros(len(token), np.int64)
        for rows, (keys, n, c) in self._by_shard(None, token, 1):
            at, hit = _find(keys, token[rows])
            counts[rows[hit]], raw[rows[hit]] = n[at[hit]], c[at[hit]]
        total, *many = m.continuations
        d = np.array([0.0, *m.discounts[0]])
        if not total:
            return np.full(len(token), 1.0), raw
        left = sum(x * y for x, y in zip(m.discounts[0], many)) / total
        return np.maximum(counts - d[np.minimum(counts, 3)], 0) / total + left / (m.vocabulary + 1), raw

    def probabilities(self, flat: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p, raw = self.unigrams(flat[place])
        for width in range(2, self.model.order + 1):
            context, gram = _hashed([flat[place - k] for k in range(width - 1, -1, -1)])
            count = np.zeros(len(place))
            sums = np.zeros((4, len(place)))
            spread, values = self.model.common[width]
            at, hit = _find(spread, context)
            if hit.any():
                sums[:, hit] = values[at[hit]].T
            for rows, (grams, n, contexts, *of) in self._by_shard(context, gram, width):
                at, hit = _find(grams, gram[rows])
                count[rows[hit]] = n[at[hit]]
                at, hit = _find(contexts, context[rows])
                for k in range(4):
                    sums[k, rows[hit]] = of[k][at[hit]]
            d = np.array([0.0, *self.model.discounts[width - 1]])
            known = sums[0] > 0
            total = np.where(known, sums[0], 1)
            left = np.where(known, (d[1] * sums[1] + d[2] * sums[2] + d[3] * sums[3]) / total, 1)
            p = np.maximum(count - d[np.minimum(count, 3).astype(np.int64)], 0) / total + left * p
        return p, raw


def score(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """Each row's log10 probability under the model and under smoothed single-token counts.

    A null or empty text is one end token. Null ids, repeated rows and other columns do no harm; no
    rows give no rows. A model of no texts gives every token probability 1 and every base share 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, scorer = WordHashes(), Scorer(model)
        whole, v = model.train_tokens, model.vocabulary
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out = [[] for _ in range(4)]
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars < 6 * _BATCH):
                    chars += len(texts[end] or "")
                    end += 1
                flat, place, owner = _sequences(texts[at:end], hashes, model.order)
                p, base, known = np.zeros(len(place)), np.zeros(len(place)), np.zeros(len(place))
                for a in range(0, len(place), _BATCH):
                    part = slice(a, a + _BATCH)
                    p[part], raw = scorer.probabilities(flat, place[part])
                    base[part] = (raw + 0.1) / (whole + 0.1 * (v + 1))
                    known[part] = raw > 0
                n = end - at
                for column, values in zip(out, (None, known, np.log10(base), np.log10(p))):
                    column.append(np.bincount(owner, values, n))
                at = end
            tokens, known, base, total = (np.concatenate(c) if c else np.zeros(0) for c in out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(tokens.astype(np.int64)), pa.array(known.astype(np.int64)),
                 pa.array(np.full(len(texts), whole, np.int64)), pa.array(base), pa.array(total),
                 pa.array(10 ** np.minimum(-total / np.maximum(tokens, 1), 300))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return docs.select("doc_id", "text", held_out.alias("held_out")).select("doc_id", "held_out", "text").mapInArrow(run, schema)


def score_corpus(docs: DataFrame, order: int = 2, folds: int = 10) -> DataFrame:
    """Trains on the rows outside the held-out fold and scores all rows."""
    held_out = fold(F.col("doc_id"), folds)
    return score(docs, train(docs.where(~held_out), order), held_out)
