"""Exact copies, prefix tries and token alignments against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingstrata.llm import alignment, copies, fuse, tries


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 500, 40_000])
def test_fuse_filter_holds_all_its_keys(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
    made = fuse.build_filter(keys)
    assert made.contains(keys).all()
    strange = np.setdiff1d(rng.integers(0, 2**63, 50_000).astype(np.uint64), keys)
    assert made.contains(strange).mean() < 0.008
    assert len(made.cells) <= 3 * 1.5 * max(n, 20)
    again = fuse.build_filter(rng.permutation(keys))
    assert again.seed == made.seed and (again.cells == made.cells).all()


def _expected_copies(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    out = []
    for text, docs in groups.items():
        known = [d for d in docs if d is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        for k, doc in enumerate(docs):
            kept = doc == keep and docs.index(doc) == k
            out.append((doc, keep, len(docs), kept, sha))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches, digits", [(3, 15), (3, 1), (1, 15), (5, 2)])
def test_copies_are_those_of_equal_texts(spark, batches, digits):
    rng = random.Random(batches)
    texts = ["", "a", "A", "a ", "é", "x" * 300_000] + [f"text {k}" for k in range(60)]
    rows = [(k, rng.choice(texts)) for k in range(400)] + [(1000 + k, "hot") for k in range(200)]
    rows += [(2000, None), (None, "a"), (None, "hot"), (None, "lone"), rows[3], rows[3], (7000, "alone")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, row int, digest string").repartition(5)
    found = copies.exact_copies(docs, batches, digits, per_shard=16)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == _expected_copies(rows)


def test_copies_of_no_rows_and_of_text_ids(spark):
    assert copies.exact_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.createDataFrame([("b", "t"), ("a", "t"), (None, "t"), ("c", None)], "doc_id string, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in copies.exact_copies(docs).collect()} == {
        ("b", "b", True), ("a", "b", False), (None, "b", False), ("c", "c", True)
    }


def _digests(ids):
    return ids.select(F.col("id").alias("row"), F.col("id").alias("doc_id"), copies.digest_of(F.col("id").cast("string")).alias("digest"))


def test_filters_let_all_stored_digests_through(spark):
    stored = copies.grouped(_digests(spark.range(3000)))
    snapshot = copies.freeze(stored, 0, per_shard=100)
    other = copies.grouped(_digests(spark.range(2000, 12_000)))
    passed = {r.digest for r in copies.screened(other, snapshot).collect()}
    both = {r.digest for r in stored.join(other.select("digest"), "digest").collect()}
    assert len(both) == 1000 and both <= passed and len(passed) < 1000 + 9000 * 0.01


@pytest.mark.parametrize("seed", range(6))
def test_double_array_holds_its_sequences_and_no_others(seed):
    rng = random.Random(seed)
    sequences = [[rng.randrange(rng.choice([3, 40, 4000])) for _ in range(rng.randrange(9))] for _ in range(300)]
    sequences += [list(range(50)), list(range(50)), []]
    flat = sorted({c for s in sequences for c in s})
    dense = {c: k for k, c in enumerate(flat)}
    starts = np.cumsum([0] + [len(s) for s in sequences])
    turns = np.array([dense[c] for s in sequences for c in s], np.int64)
    trie, codes = tries.pack(starts, turns)
    nodes = {}
    for k in range(len(sequences)):
        at = np.zeros(1, np.int64)
        for d, j in enumerate(range(starts[k], starts[k + 1])):
            at = trie.step(at, codes[j : j + 1])
            assert at[0] > 0 and nodes.setdefault(int(at[0]), sequences[k][: d + 1]) == sequences[k][: d + 1]
    assert len(nodes) == len({tuple(s[:d]) for s in sequences for d in range(1, len(s) + 1)})
    known = {tuple(v) for v in nodes.values()}
    code_of = {sequences[k][d]: codes[starts[k] + d] for k in range(len(sequences)) for d in range(len(sequences[k]))}
    for node, path in nodes.items():
        c = rng.choice(flat)
        step = int(trie.step(np.array([node]), np.array([code_of[c]]))[0])
        assert (step > 0) == ((*path, c) in known)


def _rebuilt(rows, family=20, heads=4):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said = hashlib.sha256((hashlib.sha256(role.encode()).hexdigest() + text).encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0), role, said, text))
    own = {c: [(r, t) for _, r, _, t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        out[c] = own.get(c - int(math.fmod(c, family)), [])[:h] + ts[h:]
    return out


def _expected_nodes(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(held) - 1) * words
    return sorted(
        (min(held), len(node), min(members[node[:-1]]) if node else -1, len(held), len(children[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, held in members.items()
    )


def _talks(seed):
    rng = random.Random(seed)
    texts = ["", None, "hi", "a b", " a  b c ", "x" * 50_000, "é\u00a0f"]
    rows = []
    for c in range(0, 400):
        if c % 20 == 0 and c % 40:
            continue  # families without a first conversation
        n = rng.choice([1, 1, 2, 3, 5, 12])
        rows += [(c, t, rng.choice(["user", "user", None]), texts[min(rng.randrange(20), 6)] if t < 6 else f"t{rng.randrange(4)}") for t in range(n)]
    rows += [(c, t, "user", f"hot {t}") for c in range(1000, 1400) for t in range(9)]  # many alike, and long shared beginnings
    rows += [(c, 9 + t, "user", f"hot {t * c % 7}") for c in range(1200, 1400) for t in range(3)]
    rows += [(2000, t, "user", f"word {t}") for t in range(150)]
    rows += [(None, 1, "user", "x"), (3, None, "user", "first"), (4, 1, "b", "tie"), (4, 1, "a", "tie"), (4, 1, "a", "tie"), (-7, 0, "user", "neg")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [200_000, 300, 10])
def test_prefix_nodes_are_those_of_brute_force(spark, limit):
    rows = _talks(limit)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("path", F.lit(1)).repartition(4)
    found = tries.prefix_nodes(tries.with_shared_heads(tries.conversations(turns)), limit)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    ours = sorted(tuple(r) for r in found.select(*names).fillna({"parent_conv_id": -1}).collect())
    assert ours == _expected_nodes(_rebuilt([(c, t, r, x) for c, t, r, x in rows]))


def test_prefix_nodes_of_no_conversations(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert tries.prefix_nodes(tries.with_shared_heads(tries.conversations(turns))).collect() == []


def _paths():
    import public_tokenizers

    return [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def _spans(tokens):
    out, at = [], 0
    for k, size in tokens:
        out.append((k, at, at + size))
        at += size
    return out


def _aligned(texts):
    """Groups and links of each text, straight from the definition."""
    import json

    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    path_a, path_b = _paths()
    a, b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    signs = {c: n for n, c in zip([*range(33, 127), *range(161, 173), *range(174, 256)], map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]))}
    signs |= {chr(256 + k): n for k, n in enumerate(n for n in range(256) if chr(n) not in signs)}
    of_id = {k: t for t, k in json.load(open(path_a, encoding="utf-8"))["model"]["vocab"].items()}
    out = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        ta = [(k, bytes(signs[c] for c in of_id[k])) for k in a.encode(" " + (text or ""), add_special_tokens=False).ids]
        tb = []
        for k in b.encode(text or ""):
            piece = b.id_to_piece(k)
            tb.append((k, bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("\u2581", " ").encode()))
        if not text or b"".join(t for _, t in ta) != whole or b"".join(t for _, t in tb) != whole:
            out.append(([], [], [], []))
            continue
        sa, sb = _spans([(k, len(t)) for k, t in ta]), _spans([(k, len(t)) for k, t in tb])
        ends = sorted({e for _, _, e in sa} & {e for _, _, e in sb})
        groups, low = [], 0
        for end in ends:
            groups.append(tuple(",".join(str(k) for k, s, e in side if low < e <= end) for side in (sa, sb)))
            low = end
        links = [(x, y) for x, s, e in sa for y, p, q in sb if s < q and p < e]
        out.append((sa, sb, groups, links))
    return out


@pytest.mark.parametrize("chunks", [{}, {"chunk_links": 40, "chunk_docs": 3}, {"chunk_docs": 1}])
def test_alignment_is_that_of_brute_force(spark, chunks):
    texts = [
        "hello world", "Hello  world", "<|endoftext|> <s> </s>", "", None, " ", "\u2581a", "na\u00efve caf\u00e9 \U0001f600\u200d\u4e2d\u6587",
        "tab\tand\nnewline\r\n", "the the the the of the", "the of and", "a\u0301\ufb01 \uff21", "x" * 700, "1234567 89.01,23", "<unk>", "\x00\x01", "  lead",
        "<0x41>", "hello world", "supercalifragilistic tokenization isn't we'll",
    ]
    rng = random.Random(4)
    words = [w for t in texts if t for w in t.split()][:40]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    rows = [(k, t, 7) for k, t in enumerate(texts)] + [(None, "the of and", 1), (0, "hello world", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pair int").repartition(3)
    found = alignment.align_corpus(docs, *_paths(), **chunks)
    expected = _aligned([t for _, t, _ in rows])
    count = Counter(link for *_, links in expected for link in links)
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    lines = Counter()
    for (doc, _, _), (sa, sb, groups, links) in zip(rows, expected):
        written = ";".join("|".join(g) for g in groups)
        sha = hashlib.sha256(written.encode()).hexdigest() if sa else ""
        lines[(doc, len(sa), len(sb), len(groups), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), sha)] += 1
    assert Counter(map(tuple, found.collect())) == lines
    assert sum(sha == "" for *_, sha in lines) >= 2


def test_pair_counts_tell_documents_and_links(spark):
    docs = spark.createDataFrame([(k, "the the of") for k in range(300)] + [(300, "the")], "doc_id long, text string").repartition(2)
    counted = alignment.pair_counts(alignment.index(docs, *_paths(), chunk_docs=64)).collect()
    assert {(r.n_docs, r.n_links) for r in counted} == {(301, 601), (300, 300)}


def test_alignment_of_no_documents(spark):
    assert alignment.align_corpus(spark.createDataFrame([], "doc_id string, text string"), *_paths()).collect() == []
