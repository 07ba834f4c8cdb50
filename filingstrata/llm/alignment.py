"""Two tokenizers aligned by bytes: pairs of tokens that overlap, counted by inverted document bitmaps.

Documents are taken in chunks and numbered inside each. For every pair of tokens that overlap somewhere
in a chunk, a compressed bitmap tells in which of its documents, and further bitmaps are the binary
digits of how often more than once. Counting bits gives the pair's documents and links over the whole
corpus; with these counts the same bitmaps then lead back to the documents and give them their scores.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingstrata.sources.staging import stage

from .tokens import _cuts, char_classes

_CHUNK_DOCS = 1 << 16  # numbers inside a chunk have 16 bits
_CHUNK_LINKS = 2_000_000  # a chunk is closed once it holds so many links
_BATCH = 1_000_000  # characters that are encoded at once
_HELD = 400_000  # distinct pre-tokens whose ids a task remembers
_ID_BITS = 20  # of an id inside a pair
_CHUNK_BITS = 32  # a chunk's number: the task's above, the task's own count below

_DOC = "doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ROW = "chunk long, at int, pair long, plane int, dense boolean, n int, bits binary, " + _DOC


@dataclass(frozen=True)
class Bitmaps:
    """One chunk's bitmaps, ordered by (pair, plane).

    Plane 0 has the documents that hold the pair. Plane k > 0 has bit k - 1 of how often they hold it
    beyond once, so that a pair has ``sum(n of plane 0) + sum(n * 2 ** (k - 1) of plane k)`` links.
    Bitmap ``i`` is ``numbers[starts[i]:starts[i + 1]]``, increasing.
    """

    pair: np.ndarray
    plane: np.ndarray
    starts: np.ndarray
    numbers: np.ndarray


def bitmaps(pairs: np.ndarray, numbers: np.ndarray) -> Bitmaps:
    """The bitmaps of links given as pair and document number each."""
    keys, times = np.unique((pairs << 16) | numbers, return_counts=True)
    sets, planes = [keys], [np.zeros(len(keys), np.int64)]
    more, k = times - 1, 1
    while len(keys) and (more >> (k - 1)).any():
        held = ((more >> (k - 1)) & 1).astype(bool)
        sets.append(keys[held])
        planes.append(np.full(int(held.sum()), k))
        k += 1
    keys, planes = np.concatenate(sets), np.concatenate(planes)
    order = np.lexsort((keys, planes, keys >> 16))
    keys, planes = keys[order], planes[order]
    pair = keys >> 16
    new = np.ones(len(keys), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (planes[1:] != planes[:-1])
    starts = np.flatnonzero(new)
    return Bitmaps(pair[starts], planes[starts], np.append(starts, len(keys)), (keys & 0xFFFF).astype(np.uint16))


def compressed(found: Bitmaps, size: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(bits, dense, n): each bitmap as 16-bit numbers or, where that is shorter, as ``size`` plain bits."""
    n = np.diff(found.starts)
    dense = 2 * n > (size + 7) // 8
    raw = found.numbers.astype("<u2").tobytes()
    if not dense.any():
        offsets = (2 * found.starts).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]), dense, n
    bits = []
    for at, end, full in zip(found.starts[:-1].tolist(), found.starts[1:].tolist(), dense.tolist()):
        if full:
            plain = np.zeros(size, np.uint8)
            plain[found.numbers[at:end]] = 1
            bits.append(np.packbits(plain).tobytes())
        else:
            bits.append(raw[2 * at : 2 * end])
    return pa.array(bits, pa.binary()), dense, n


def scattered(bits: pa.Array, dense: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """For each document number, for each row of ``values``: the sum of the values of all bitmaps that have it."""
    out = np.zeros((len(values), size), np.int64)
    sparse = bits.filter(pa.array(~dense))
    offsets = np.frombuffer(sparse.buffers()[1], np.int32)[sparse.offset : sparse.offset + len(sparse) + 1]
    if len(sparse) and offsets[-1] > offsets[0]:
        numbers = np.frombuffer(sparse.buffers()[2], "<u2", (offsets[-1] - offsets[0]) // 2, offsets[0]).astype(np.int64)
        for k, row in enumerate(values[:, ~dense]):
            np.add.at(out[k], numbers, np.repeat(row, np.diff(offsets) // 2))
    full = bits.filter(pa.array(dense))
    for at in range(0, len(full), 256):
        block = np.frombuffer(b"".join(full.slice(at, 256).to_pylist()), np.uint8).reshape(-1, (size + 7) // 8)
        plain = np.unpackbits(block, axis=1, count=size).astype(bool)
        for k, row in enumerate(values[:, dense]):
            for bit, value in zip(plain, row[at : at + 256]):
                out[k][bit] += value
    return out


class Aligner:
    """Both tokenizers, with the byte length and the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str, classes: np.ndarray | None = None):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings inside a text are plain text
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = {c: b for b, c in enumerate(_byte_signs())}
        count = self.a.get_vocab_size()
        self.bytes_a = [bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in map(self.a.id_to_token, range(count))]
        self.bytes_b = [_piece_bytes(self.b, k) for k in range(self.b.get_piece_size())]
        if max(count, len(self.bytes_b)) >= 1 << _ID_BITS:
            raise ValueError(f"a vocabulary of more than {1 << _ID_BITS} ids")
        self.size_a, self.size_b = (np.array([len(t) for t in ts], np.int64) for ts in (self.bytes_a, self.bytes_b))
        # the written id with what follows it: inside a group, at its end on A's side, and on B's
        self.written = np.array(
            [f"{k}{s}".encode() for n, end in ((count, "|"), (len(self.bytes_b), ";")) for s in (",", end) for k in range(n)]
        )
        self.written_b = 2 * count
        self.classes = classes if cuts_apart(path_a) else None
        self.known: dict[int, tuple[list[int], bool]] = {}

    def _ids_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, how many each has, and whether they give back its bytes.

        Where the vocabulary is applied to each pre-token by itself, a pre-token is encoded once.
        """
        if self.classes is None:
            found = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
            same = [self._gives(ids, text) for ids, text in zip(found, texts)]
            return _flat(found), np.array([len(ids) for ids in found], np.int64), np.array(same, bool)
        counts, same, parts = np.zeros(len(texts), np.int64), np.ones(len(texts), bool), []
        for _, cut in _cuts(texts, [], self.classes):
            hashes, first, at = np.unique(cut.hash, return_index=True, return_inverse=True)
            if len(self.known) + len(hashes) > _HELD:
                self.known.clear()
            hashes = hashes.tolist()
            new = [k for k, h in enumerate(hashes) if h not in self.known]
            strings = [cut.string(first[k]) for k in new]
            for k, string, e in zip(new, strings, self.a.encode_batch_fast(strings, add_special_tokens=False)):
                self.known[hashes[k]] = (e.ids, self._gives(e.ids, string))
            entries = [self.known[h] for h in hashes]
            sizes = np.array([len(ids) for ids, _ in entries], np.int64)
            starts, wide = np.cumsum(sizes) - sizes, sizes[at]
            begin = np.cumsum(wide) - wide
            flat = _flat([ids for ids, _ in entries])
            parts.append(flat[np.repeat(starts[at] - begin, wide) + np.arange(int(wide.sum()))])
            np.add.at(counts, cut.owner, wide)
            same[cut.owner[~np.array([good for _, good in entries], bool)[at]]] = False
        return np.concatenate([np.zeros(0, np.int64), *parts]), counts, same

    def _gives(self, ids: list[int], text: str) -> bool:
        return b"".join(map(self.bytes_a.__getitem__, ids)) == text.encode("utf-8", "surrogatepass")

    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A, how many each text has, and the same of B; none where a text is empty or either side's bytes differ."""
        plain = [t or "" for t in texts]
        spaced = [" " + t for t in plain]
        a, n_a, same = self._ids_a(spaced)
        of_b = self.b.encode(plain, num_threads=1)
        for k, (text, ids) in enumerate(zip(spaced, of_b)):
            if len(text) == 1 or not same[k] or b"".join(map(self.bytes_b.__getitem__, ids)) != text.encode("utf-8", "surrogatepass"):
                of_b[k], same[k] = [], False
        a, n_a = a[np.repeat(same, n_a)], np.where(same, n_a, 0)
        return a, n_a, _flat(of_b), np.array([len(ids) for ids in of_b], np.int64)

    def align(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """Per text its counts and digest; and for each link the pair (A's id << 20 | B's id) and the text's number."""
        a, n_a, b, n_b = self.tokens(texts)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        # both sides cover the same bytes, so the pieces between neighbouring ends are the links
        both = np.concatenate([end_a, end_b])
        both.sort(kind="stable")
        again = both[1:][both[1:] == both[:-1]]  # where both end: the ends of groups
        ends = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
        left, right = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        owner = np.repeat(np.arange(len(texts)), n_a)
        link_owner = owner[left]
        last_a, last_b = np.searchsorted(end_a, again), np.searchsorted(end_b, again)
        counts = {
            "n_a": n_a, "n_b": n_b,
            "n_groups": np.bincount(owner[last_a], minlength=len(texts)).astype(np.int64),
            "n_links": np.bincount(link_owner, minlength=len(texts)).astype(np.int64),
            "groups_sha256": self._digests(a, b, n_a, n_b, last_a, last_b),
        }
        return counts, (a[left] << _ID_BITS) | b[right], link_owner

    def _digests(self, a, b, n_a, n_b, last_a, last_b) -> list[str]:
        """The hash of the written groups of each text."""
        group_a = np.repeat(np.arange(len(last_a)), np.diff(last_a, prepend=-1))
        group_b = np.repeat(np.arange(len(last_b)), np.diff(last_b, prepend=-1))
        signs = np.empty(len(a) + len(b), np.int64)
        # A's tokens stand after those of B in all earlier groups; B's after those of A in their own group too
        tail_a, tail_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        tail_a[last_a], tail_b[last_b] = True, True
        before = np.append(-1, last_b)[group_a] + 1 if len(a) else group_a
        signs[np.arange(len(a)) + before] = a + tail_a * (self.written_b // 2)
        signs[np.arange(len(b)) + last_a[group_b] + 1] = self.written_b + b + tail_b * len(self.bytes_b)
        sizes, out, at = (n_a + n_b).tolist(), [], 0
        for size in sizes:
            if size:
                line = self.written[signs[at : at + size]].tobytes().replace(b"\0", b"")
                out.append(hashlib.sha256(line[:-1]).hexdigest())
            else:
                out.append("")
            at += size
        return out


def cuts_apart(path: str) -> bool:
    """Whether a ``tokenizers`` file cuts texts by the byte-level rule and encodes each pre-token by itself."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    cut = made.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
    return plain and made.get("normalizer") is None


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _byte_signs() -> str:
    """The sign that byte-level vocabularies write for each byte: itself if it can be seen, else from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return "".join(chr(b) if b in seen else chr(next(hidden)) for b in range(256))


def _piece_bytes(model, k: int) -> bytes:
    piece = model.id_to_piece(k)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace("▁", " ").encode()


class _Chunk:
    """Links and documents of one task until they fill a chunk."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.made = schema, 0
        self._clear()

    def _clear(self):
        self.ids, self.counts, self.pairs, self.numbers, self.links, self.docs = [], [], [], [], 0, 0

    def add(self, ids: pa.Array, counts: dict, pairs: np.ndarray, owner: np.ndarray):
        self.ids.append(ids)
        self.counts.append(counts)
        self.pairs.append(pairs)
        self.numbers.append(owner + self.docs)
        self.links += len(pairs)
        self.docs += len(ids)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The chunk's documents, then its bitmaps."""
        if not self.docs:
            return
        chunk = (TaskContext.get().partitionId() << _CHUNK_BITS) + self.made
        columns = {name: np.concatenate([c[name] for c in self.counts]) for name in self.counts[0]}
        columns |= {"doc_id": pa.concat_arrays(self.ids), "chunk": np.full(self.docs, chunk), "at": np.arange(self.docs)}
        yield self._batch(self.docs, columns)
        found = bitmaps(np.concatenate(self.pairs), np.concatenate(self.numbers))
        bits, dense, n = compressed(found, self.docs)
        columns = {"chunk": np.full(len(n), chunk), "pair": found.pair, "plane": found.plane, "dense": dense, "n": n, "bits": bits}
        whole = self._batch(len(n), columns)
        for at in range(0, len(n), 50_000):
            yield whole.slice(at, 50_000)
        self.made += 1
        self._clear()

    def _batch(self, size: int, columns: dict) -> pa.RecordBatch:
        arrays = [
            pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array)
            else columns.get(f.name, pa.nulls(size, f.type))
            for f in self.schema
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def index(docs: DataFrame, path_a: str, path_b: str, chunk_links: int = _CHUNK_LINKS, chunk_docs: int = _CHUNK_DOCS) -> DataFrame:
    """The staged index: rows of documents (``at`` not null) and rows of bitmaps (``pair`` not null) of each chunk."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    classes = docs.sparkSession.sparkContext.broadcast(char_classes())  # one byte a code point

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, chunk = None, None
        for batch in batches:
            if chunk is None:
                types = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
                named = [part.split(" ", 1) for part in _ROW.split(", ")]
                chunk = _Chunk(pa.schema([(name, batch.schema.field("doc_id").type if name == "doc_id" else types[t]) for name, t in named]))
                aligner = Aligner(path_a, path_b, classes.value)
            texts, at = batch.column("text").to_pylist(), 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and end - at < chunk_docs - chunk.docs and (end == at or held < _BATCH):
                    held += len(texts[end] or "")
                    end += 1
                chunk.add(batch.column("doc_id").slice(at, end - at), *aligner.align(texts[at:end]))
                at = end
                if chunk.links >= chunk_links or chunk.docs >= chunk_docs:
                    yield from chunk.rows()
        if chunk is not None:
            yield from chunk.rows()

    return stage(docs.select("doc_id", "text").mapInArrow(indexed, _ROW.format(kind=kind)), "pair_index")


def pair_counts(indexed: DataFrame) -> DataFrame:
    """(pair, n_docs, n_links) over the whole corpus.

    Chunks number documents of their own, so a pair's bitmaps of different chunks are disjoint and the
    bits of their union are the sum of their bits.
    """
    plane = F.col("plane")
    links = F.col("n") * F.when(plane == 0, F.lit(1).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), plane - 1))
    rows = indexed.where(F.col("pair").isNotNull())
    return rows.groupBy("pair").agg(F.sum(F.when(plane == 0, F.col("n")).otherwise(0)).alias("n_docs"), F.sum(links).alias("n_links"))


def align_corpus(docs: DataFrame, path_a: str, path_b: str, **chunks: int) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row of ``docs``.

    A is a ``tokenizers`` file of byte-level pieces, applied to a space and the text, B a ``sentencepiece``
    model, applied to the text. Groups end where tokens of both do. A link is an occurrence of a token of
    A and one of B whose bytes overlap; the count of a pair of ids is that of its links in all documents;
    ``n_best`` are the document's links whose count is the highest of their B id, ties included, and
    ``count_sum`` adds up the counts of its links.

    Texts that are null or empty, or whose tokens of either side do not give back their bytes, have no
    tokens, zeros and an empty groups_sha256. Each row counts by itself, repeated ones too; ids may be
    null; other columns are ignored; no rows give no rows. ``chunk_links`` and ``chunk_docs`` bound what a
    task holds at once; they don't change the result.
    """
    indexed = index(docs, path_a, path_b, **chunks)
    counts = stage(pair_counts(indexed), "pair_counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << _ID_BITS) - 1)).alias("b")
    best = F.broadcast(counts.groupBy(b).agg(F.max("n_links").alias("most")))  # one row an id of B: its vocabulary bounds it
    scored = counts.select("pair", b, F.col("n_links").alias("count")).join(best, "b")
    scored = scored.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    postings = indexed.where(F.col("pair").isNotNull()).select("chunk", "pair", "plane", "dense", "bits")
    sizes = indexed.where(F.col("at").isNotNull()).groupBy(F.col("chunk").alias("of")).agg(F.count(F.lit(1)).alias("size"))
    # postings and counts both grow with the documents, so no size of the counts calls for a broadcast
    returned = postings.join(scored.hint("merge"), "pair").select("chunk", "plane", "dense", "bits", "count", "best")

    def summed(chunk: tuple, rows: pa.Table, size: pa.Table) -> pa.Table:
        docs = size["size"][0].as_py()
        plane = rows["plane"].to_numpy()
        times = np.where(plane == 0, 1, np.left_shift(1, np.maximum(plane - 1, 0)).astype(np.int64))
        values = np.stack([times * rows["best"].to_numpy(), times * rows["count"].to_numpy()]).astype(np.int64)
        bits = rows["bits"].combine_chunks() if rows.num_rows else pa.array([], pa.binary())
        n_best, count_sum = scattered(bits, rows["dense"].to_numpy().astype(bool), values, docs)
        return pa.table({"chunk": pa.array(np.full(docs, chunk[0].as_py())), "at": pa.array(np.arange(docs, dtype=np.int32)),
                         "n_best": pa.array(n_best), "count_sum": pa.array(count_sum)})

    scores = returned.groupBy("chunk").cogroup(sizes.groupBy("of")).applyInArrow(summed, "chunk long, at int, n_best long, count_sum long")
    texts = indexed.where(F.col("at").isNotNull()).select("chunk", "at", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return texts.join(scores, ["chunk", "at"]).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
