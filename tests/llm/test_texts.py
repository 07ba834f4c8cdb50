"""Leaks, passages, similar documents, mixtures and preference pairs against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import plan
from pyspark.sql import functions as F

from filingstrata.llm import decontaminate, jaccard, mixing, passages, preferences, queries
from filingstrata.llm.common import word_hashes, words
from filingstrata.llm.components import connected


def _distance(item, text, anchored=False):
    """Last row's least value and where, of the distance table of a free (or anchored) start."""
    before = list(range(len(item) + 1))
    best, end = before[-1], 0
    for j, c in enumerate(text, 1):
        now = [j if anchored else 0]
        for i, x in enumerate(item, 1):
            now.append(min(before[i - 1] + (x != c), before[i] + 1, now[-1] + 1))
        before = now
        if now[-1] < best:
            best, end = now[-1], j
    return best, end


def test_bit_parallel_distance():
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    for _ in range(300):
        item, text = word(rng.randint(1, 80)), word(rng.randint(0, 60))
        for anchored in (False, True):
            assert decontaminate.nearest(item, text, anchored) == _distance(item, text, anchored)


@pytest.mark.parametrize("block", [4_000_000, 100])
def test_leaks_are_those_within_the_budget(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "_BLOCK", block)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    items = [(k, " ".join(word() for _ in range(rng.randint(8, 30)))) for k in range(8)] + [(8, None), (9, ""), (10, "too short")]
    rows = []
    for k in range(80):
        text = " ".join(word() for _ in range(rng.randint(0, 60)))
        if k % 2:
            leak = list(items[k % 8][1].upper() if k % 3 else items[k % 8][1])
            for _ in range(rng.randint(0, len(leak) // 10)):
                leak[rng.randrange(len(leak))] = rng.choice("abcdefgh ")
            text += "\n " + "".join(leak) + "  " + word()
        rows.append((k, text, "x"))
    rows += [(80, None, "x"), (81, "", "x"), (None, items[0][1], "x"), rows[1]]
    rows += [(82, "it is Too  short, she said", "x"), (83, "too shorter", "x"), (84, "stoo short", "x"), (85, "too short", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = Counter((r.doc_id, r.item_id, r.distance) for r in decontaminate.find_leaks(docs, bench).collect())
    expected = Counter()
    for doc, text, _ in rows:
        for key, item in items:
            plain = decontaminate.plain(item)
            least = _distance(plain, decontaminate.plain(text))[0]
            if len(plain) >= 20 and least <= int(0.06 * len(plain)):
                expected[doc, key, least] += 1
            elif 0 < len(plain) < 20 and re.search(rf"(?<![a-z0-9]){plain}(?![a-z0-9])", decontaminate.plain(text)):
                expected[doc, key, 0] += 1
    assert found == expected and len(found) > 20
    leaked = {doc for doc, _, _ in expected}
    kept = [r.doc_id for r in decontaminate.without_leaks(docs, bench).collect()]
    assert sorted(kept) == sorted(doc for doc, _, _ in rows if doc not in leaked)
    texts = {doc: text for doc, text, _ in rows}
    for r in decontaminate.find_leaks(docs, bench).collect():
        cut = decontaminate.plain(texts[r.doc_id][r.offset : r.offset + r.length])
        assert _distance(decontaminate.plain(items[r.item_id][1]), cut)[0] == r.distance


def test_item_ids_may_be_text(spark):
    docs = spark.createDataFrame([("d", "one two three four five six seven")], "doc_id string, text string")
    bench = spark.createDataFrame([("i", "two three four five six")], "item_id string, text string")
    assert [tuple(r)[:3] for r in decontaminate.find_leaks(docs, bench).collect()] == [("d", "i", 0)]
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0


def test_chains_are_the_best():
    rng = random.Random(3)
    for _ in range(150):
        pairs = sorted({(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(rng.randint(1, 25))})
        p, o = np.array(pairs).T
        found = passages.chains(p, o)
        assert sorted(i for c in found for i in c) == list(range(len(p)))
        score = {}
        for i in range(len(p)):  # pairs are sorted
            gains = [score[j] - passages.GAP_COST * (p[i] - p[j] + o[i] - o[j]) for j in range(i) if p[j] < p[i] and o[j] < o[i]]
            score[i] = passages.SEED + max([0, *gains])
        best = found[0]
        total = len(best) * passages.SEED - passages.GAP_COST * sum(p[b] - p[a] + o[b] - o[a] for a, b in zip(best, best[1:]))
        whole = all(p[b] - p[a] <= passages.MAX_GAP and o[b] - o[a] <= passages.MAX_GAP for a, b in zip(best, best[1:]))
        assert whole and all(p[a] < p[b] and o[a] < o[b] for a, b in zip(best, best[1:]))
        assert total <= max(score.values()) + 1e-9


def _texts(rng, n=2000):
    return lambda size: [f"w{rng.randrange(n)}" for _ in range(size)]


def test_passages_across_documents(spark):
    rng = random.Random(4)
    text = _texts(rng)
    common, rows, planted = text(70), [], {}
    for k in range(60):
        words = text(rng.randint(50, 300))
        if k % 3 == 0:
            passage = list(common)
            if k % 2:
                for _ in range(4):
                    passage[rng.randrange(70)] = rng.choice("xyz")
                del passage[30]
            at = rng.randint(0, len(words))
            words[at:at] = passage
            planted[k] = (at, at + len(passage))
        rows.append((k, " ".join(words), 7, "s"))
    rows += [(100, None, 1, "s"), (101, "", 1, "s"), (102, "few words", 1, "s"), (None, rows[0][1], 1, "s"), rows[6], (103, " ".join(common), 9, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, source_id string").repartition(5)
    found = passages.find_passages(docs).collect()
    # exact copies all, edited ones where runs between the edits hold two seeds
    assert {k for k in planted if k % 2 == 0} - {0} | {103} <= {r.doc_id for r in found} <= planted.keys() | {103}
    assert len({r.doc_id for r in found if r.doc_id % 2}) >= 5
    for r in found:
        a, b = planted.get(r.doc_id, (0, 70))
        assert a <= r.start and r.start + r.n_words <= b and r.n_words >= 45 and r.source_id < r.doc_id and r.identity >= 0.8
    cut = passages.cut_passages(docs, passages.find_passages(docs))
    assert cut.columns == docs.columns
    left = {r.doc_id: r for r in cut.collect()}
    assert 103 not in left and left[0].text == rows[0][1] and left[None].text == rows[0][1] and left[100].text is None
    words = rows[6][1].split()
    a, b = planted[6]
    assert left[6].text.split() == words[:a] + words[b:] and left[6].n_chars == len(left[6].text) and cut.count() == len(rows) - 1


@pytest.mark.parametrize("shape", [(60, 20, 15), (60, 24, 20), (55, 28, 55), (60, 20, 20, 20, 60)])
def test_exact_passages_stand_beside_anything(spark, shape):
    """``shape``: words that are the same and words that are not, in turn."""
    rng = random.Random(str(shape))
    text, rows, planted = _texts(rng, 10**6), [], {}
    for k in range(0, 60, 2):
        source, own, at = text(30), text(30), 30
        for j, n in enumerate(shape):
            if j % 2 == 0:
                run = text(n)
                if n >= 45:
                    planted.setdefault(k + 1, []).append((at, at + n))
            source += run if j % 2 == 0 else text(n)
            own += run if j % 2 == 0 else text(n)
            at += n
        rows += [(k, " ".join(source + text(30))), (k + 1, " ".join(own + text(30)))]
    found = defaultdict(list)
    for r in passages.find_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.identity >= 0.8 and r.source_id == r.doc_id - 1 and r.n_words >= 45
        found[r.doc_id].append((r.start, r.start + r.n_words))
    for doc, places in planted.items():
        for a, b in places:
            assert any(x <= a and b <= y for x, y in found[doc]), (doc, a, b, found[doc])


@pytest.mark.parametrize("lines", [(20, 20, 20), (30, 30), (44, 16), (15, 15, 15)])
def test_passages_of_lines_that_stand_alone_before(spark, lines):
    """Exact passages whose lines each stand in an earlier document of their own."""
    rng = random.Random(str(lines))
    text, rows, planted = _texts(rng, 10**6), [], {}
    for k in range(40):
        parts = [text(n) for n in lines]
        rows += [(1000 * j + k, " ".join(text(20) + part + text(20))) for j, part in enumerate(parts)]
        rows += [(10_000 + 2 * k + j, " ".join(text(30) + sum(parts, []) + text(30))) for j in range(2)]
        planted[10_001 + 2 * k] = (30, 30 + sum(lines))
    for k in range(40 * (sum(lines) == 45)):  # documents that hold all words but the last, and all but the first
        part = text(45)
        rows += [(4000 + k, " ".join(text(20) + part[:-1] + text(20))), (5000 + k, " ".join(text(20) + part[1:] + text(20)))]
        rows += [(20_000 + 2 * k + j, " ".join(text(30) + part + text(30))) for j in range(2)]
        planted[20_001 + 2 * k] = (30, 75)
    found = {(r.doc_id, r.source_id, r.start, r.n_words) for r in passages.find_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    lost = [d for d, (a, b) in planted.items() if not any(x[0] == d and x[1] == d - 1 and x[2] <= a and b <= x[2] + x[3] for x in found)]
    assert not lost


@pytest.mark.parametrize(("n", "every"), [(50, 8), (50, 6), (60, 5), (80, 0)])
def test_fuzzy_passages_are_all_found(spark, n, every):
    """Copies with each ``every``-th word changed, or (0) one word in six at random."""
    rng = random.Random(n + every)
    text, rows = _texts(rng, 10**6), []
    for k in range(50):
        passage = text(n)
        changed = set(range(every - 1, n - 1, every)) if every else set(rng.sample(range(n), n // 6))
        copy = [f"x{rng.randrange(10**6)}" if j in changed else w for j, w in enumerate(passage)]
        rows += [(2 * k, " ".join(text(60) + passage + text(60))), (2 * k + 1, " ".join(text(60) + copy + text(60)))]
    found = {r.doc_id for r in passages.find_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == set(range(1, 100, 2))


def test_fuzzy_passages_whose_runs_stand_alone_before(spark):
    """Fuzzy copies of which every run of equal words also stands in earlier documents, in few and in many."""
    rng = random.Random(8)
    text, rows, wanted = _texts(rng, 10**6), [], set()
    for k in range(8):
        passage = text(60)
        copy = [f"x{rng.randrange(10**6)}" if j % 10 == 9 else w for j, w in enumerate(passage)]
        for j in range(0, 60, 10):
            rows += [(1000 * k + 30 * j + i, " ".join(text(15) + passage[j : j + 9] + text(15))) for i in range(1 + (k % 2) * 25)]
        rows += [(10_000 + 2 * k, " ".join(text(30) + passage + text(30))), (10_001 + 2 * k, " ".join(text(30) + copy + text(30)))]
        wanted.add(10_001 + 2 * k)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = passages.find_passages(docs).collect()
    assert {(r.doc_id, r.source_id) for r in found} == {(d, d - 1) for d in wanted}
    assert all(r.start <= 32 and r.start + r.n_words >= 87 for r in found)


@pytest.mark.parametrize("block", [7, 1000])
def test_a_line_of_many_documents_beside_copies(spark, monkeypatch, block):
    """A line in many documents, that a few times is all that a fuzzy copy shares in runs of four words."""
    monkeypatch.setattr(passages, "BLOCK", block)
    rng = random.Random(9)
    text, rows, wanted = _texts(rng, 10**6), [], set()
    line = text(20)
    rows += [(k, " ".join(text(40) + line + text(40))) for k in range(60)] + [(70, "a b c"), (71, "a b c d"), (72, ""), (73, None)]
    for k in range(100, 120, 2):
        a, b = text(16), text(16)
        copies = [[f"x{rng.randrange(10**6)}" if j % 4 == off else w for j, w in enumerate(x)] for x, off in ((a, 3), (b, 0))]
        rows += [(k, " ".join(text(40) + a + line + b + text(40))), (k + 1, " ".join(text(40) + copies[0] + line + copies[1] + text(40)))]
        wanted.add((k + 1, k))
    found = passages.find_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.source_id) for r in found} == wanted
    assert all(r.identity >= 0.8 and r.n_words >= 45 for r in found)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert passages.find_passages(empty).count() == 0
    assert passages.cut_passages(empty, passages.find_passages(empty)).count() == 0
    assert jaccard.similar_documents(empty).count() == 0
    assert mixing.interleave(empty).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert preferences.format_pairs(preferences.pairs_by_next(turns)).count() == 0


def _components(rows):
    sets, holders = [], defaultdict(list)
    for k, (_, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
        for s in sets[-1]:
            holders[s].append(k)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, s in enumerate(sets):
        common = Counter(j for g in s for j in holders[g] if j < k)
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[find(k)] = find(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        r = find(k)
        least[r] = min(least.get(r, doc), doc)
    return sorted((doc, len(sets[k]), least[find(k)]) for k, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("step", [1, 8, 1 << 19])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_hashed_words_are_those_of_the_text(step, kind):
    odd = [None, "", " ", "\n\x0b a\tB  c ", "A b", "x", " y", "é\xa0Ü a", "ab ba", "a" * 5000, "q w e r t y", "q w e r t  Y "]
    for texts in (pa.array(odd, kind), pa.array(odd, kind).slice(3, 5), pa.array([], kind), pa.array([None, None], kind)):
        got = [found[a:b].tolist() for found, at in word_hashes(texts, step) for a, b in zip(at, at[1:])]
        expected = [words(t) for t in texts.to_pylist()]
        assert [len(g) for g in got] == [len(e) for e in expected]
        pairs = {(w, h) for e, g in zip(expected, got) for w, h in zip(e, g)}
        assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})


@pytest.mark.parametrize(("block", "leaf"), [(256, 24), (20, 4)])
def test_similar_documents_are_exact(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "_BITS", 8)
    rng = random.Random(5)
    text = _texts(rng)

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = f"w{rng.randrange(2000)}"
        return words

    bases = [text(rng.randint(40, 200)) for _ in range(6)]
    rows = [(k, " ".join(edited(rng.choice(bases), rng.choice([0, 1, 2, 3, 5, 8, 12])))) for k in range(300)]
    chain = text(150)
    for k in range(300, 340):
        chain = edited(chain, 2)
        rows.append((k, " ".join(chain)))
    passage = text(60)
    rows += [(k, " ".join(text(rng.randint(5, 30)) + passage)) for k in range(340, 420)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "a b"), (504, "A B"), (505, "a b c"), (506, "long " * 30_000), rows[3]]
    wide = [(d, t, "x", 0) for d, t in rows]
    docs = spark.createDataFrame(wide, "doc_id long, text string, h string, size int").repartition(5)
    assert sorted(map(tuple, jaccard.similar_documents(docs).collect())) == _components(rows)


def test_sets_travel_with_shared_shingles_only(spark, monkeypatch):
    """Of the first shingles those go on that another set holds; of the texts those that are wanted."""
    rng = random.Random(8)
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(100))) for k in range(60)]
    rows += [(100 + k, t + " end") for k, t in rows[:5]]
    met, texts = [], []
    pairs, word_sets = jaccard._pairs, jaccard._sets
    monkeypatch.setattr(jaccard, "_pairs", lambda m: met.append(m.select("h", "keys", "firsts").collect()) or pairs(m))

    def sets(docs, wanted):
        made = word_sets(docs, wanted)
        texts.append((made, wanted.count()))
        assert plan(made).count("MapInArrow") == 2  # texts are told apart before they are shuffled
        return made

    monkeypatch.setattr(jaccard, "_sets", sets)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted(map(tuple, jaccard.similar_documents(docs).collect()))
    assert found == _components(rows)
    assert sum(c == d for d, _, c in found) == 60
    assert len(met[0]) == 10 and all(0 < len(r.keys) <= r.firsts for r in met[0])
    assert texts and all(n <= 10 for _, n in texts)


def test_blocks_of_a_region_meet_once(spark):
    """Every two blocks, and each by itself; regions of one block are not joined."""
    packed = [(1, 0, 1, 0, ["a"]), *[(2, 0, 4, b, [f"b{b}"]) for b in range(4)]]
    packed = spark.createDataFrame(packed, "pivot long, class int, blocks int, block int, members array<string>")
    found = Counter((r.pivot, *r.members, *(r.others or ["-"])) for r in jaccard._block_pairs(packed).collect())
    pairs = [(2, f"b{i}", f"b{j}") for i in range(4) for j in range(i + 1, 4)]
    assert found == Counter([(1, "a", "-"), *[(2, f"b{b}", "-") for b in range(4)], *pairs])


def test_rows_without_id(spark):
    data = [(None, "a b c d e f"), (4, "A b c d e f"), (9, "a b c d e f"), (None, "alone"), (None, None)]
    found = jaccard.similar_documents(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert Counter(map(tuple, found)) == Counter({(None, 2, 4): 1, (4, 2, 4): 1, (9, 2, 4): 1, (None, 1, None): 1, (None, 0, None): 1})


def test_components_of_a_random_graph(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(400 + k, 401 + k) for k in range(60)]
    edges += [(1000, 2000 + k) for k in range(100)] + [(5, None), (7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    found = dict(map(tuple, connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {x: find(x) for x in root}


@pytest.mark.parametrize("weights", [None, {"a": 5, "b": 3, "": 1, "c": 0.01}])
def test_mixture_stays_within_a_block_of_its_weights(spark, weights):
    sizes = {"a": 700, "b": 250, "c": 40, None: 90, "few": 3}
    rows = [(k * 10 + i, s, "x") for i, (s, n) in enumerate(sizes.items()) for k in range(n)] + [(None, "a", "x"), (0, "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, mix_slot string").repartition(4)
    mixed = mixing.interleave(docs, weights, block=4)
    assert mixed.columns == ["doc_id", "source", "mix_share", "mix_block", "mix_slot", "mix_position", "mix_complete"]
    got = mixed.collect()
    assert len(got) == len(rows)
    placed = [r for r in got if r.mix_slot is not None]
    assert len({r.mix_position for r in placed}) == len(placed)
    assert {r.source for r in got if r.mix_slot is None} == ({"few"} if weights else set())
    counts = {s or "": n for s, n in Counter(r[1] for r in rows).items()}
    wanted = weights or {s: n**0.7 for s, n in counts.items()}
    share = {s: w / sum(wanted.values()) for s, w in wanted.items()}
    assert {r.source or "": r.mix_share for r in placed} == pytest.approx(share)
    _within_a_block(placed, share)
    full = Counter((r.source, r.mix_block) for r in placed)
    last = {s: max(b for (t, b) in full if t == s) for s, _ in full}
    assert all(n == 4 or b == last[s] for (s, b), n in full.items())


def _within_a_block(placed, share):
    """Deviation from the real weights after each slot; the mixture ends where a source has no block for its slot."""
    every = sorted({(r.mix_slot, r.source or "", r.mix_complete) for r in placed})
    assert [slot for slot, *_ in every] == list(range(len(every)))
    slots = [source for _, source, complete in every if complete]
    taken = Counter()
    for n, source in enumerate(slots, 1):
        taken[source] += 1
        assert all(abs(taken[s] - n * w) < 1 + 1e-6 for s, w in share.items())
    need = Counter(source for _, source, _ in every)
    assert slots and any(taken[s] == need[s] for s in share)


@pytest.mark.parametrize("sources", [20, 300, 1200])
def test_half_the_mixture_from_one_of_many_sources(spark, sources):
    weights = {"hot": 0.5} | {f"s{k:04d}": 0.5 / (sources - 1) for k in range(sources - 1)}
    rows = [(k, "hot") for k in range(1300)] + [(10_000 + k, f"s{k % (sources - 1):04d}") for k in range(1300)]
    placed = mixing.interleave(spark.createDataFrame(rows, "doc_id long, source string"), weights, block=1).collect()
    _within_a_block(placed, weights)
    first = {r.mix_slot: r.source for r in placed if r.mix_complete and r.mix_slot < 1000}
    assert abs(sum(s == "hot" for s in first.values()) - len(first) / 2) < 1 and len(first) == 1000


def test_blocks_grow_with_the_corpus(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    placed = mixing.interleave(docs, slots=50).collect()
    assert max(Counter((r.source, r.mix_block) for r in placed).values()) == 400 and len({r.mix_slot for r in placed}) <= 53
    assert sorted(r.mix_position for r in placed)[-1] < 53 * 400


def test_preference_pairs(spark):
    turn = lambda role, text, n=0: (n, role, text)
    shared = [turn("user", "q"), turn("assistant", "a")]
    pairs = [
        (1, [*shared, turn("assistant", "yes")], [*shared, turn("assistant", "no"), turn("user", "x")]),
        (2, shared, shared), (3, None, shared), (4, [turn("user", None)], [turn("user", "")]), (None, shared[:1], shared),
    ]
    kind = "array<struct<turn: long, role: string, text: string>>"
    done = {r.pair_id: r for r in preferences.format_pairs(spark.createDataFrame(pairs, f"pair_id long, chosen {kind}, rejected {kind}")).collect()}
    prompt = "<|turn|>user\nq<|end|>\n<|turn|>assistant\na<|end|>\n"
    one = done[1]
    assert (one.prompt, one.n_prompt_turns, one.usable) == (prompt, 2, True)
    assert one.chosen_text == "<|turn|>assistant\nyes<|end|>\n" and [tuple(s) for s in one.chosen] == [("<|turn|>assistant\n", 0), ("yes<|end|>\n", 1)]
    assert one.rejected_text == "<|turn|>assistant\nno<|end|>\n<|turn|>user\nx<|end|>\n" and one.n_rejected_trained == len("no<|end|>\n")
    assert (done[2].prompt, done[2].chosen_text, done[2].usable) == (prompt, "", False)
    assert (done[3].n_prompt_turns, done[3].prompt, done[3].chosen_text) == (0, "", "")
    assert done[4].n_prompt_turns == 1 and done[None].n_prompt_turns == 1


def test_pairs_of_conversations_with_text_ids(spark):
    rows = [(c, k, "assistant", f"{c}{k}") for c in ("1", "2", "02", "x", "x-1") for k in range(2)]
    turns = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    found = {r.pair_id: [t.text for t in r.rejected] for r in preferences.pairs_by_next(turns).collect()}
    assert found == {"1": ["10", "21"], "2": ["20"], "02": ["020"], "x": ["x0"], "x-1": ["x-10"]}


def test_conversations_with_gaps(spark):
    rows = [(1, 0, "user", "q"), (1, 0, "user", "q"), (1, 2, None, None), (None, 0, "user", "z"), (1, None, "user", "z"), (2, 0, "user", "q")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: [tuple(t) for t in r.turns] for r in preferences.conversations(turns).collect()}
    assert found == {1: [(0, "user", "q"), (2, None, None)], 2: [(0, "user", "q")]}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for table in "documents conversations".split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    df = queries.QUERIES[name](spark, folder)
    order = ", ".join(sorted(df.columns))
    expected = connection.execute(f"SELECT {order} FROM ({queries.ORACLES[name]})").fetchall()
    assert Counter(map(tuple, df.select(*sorted(df.columns)).collect())) == Counter(expected) and expected


def test_texts_are_read_once_and_stretches_need_no_join(spark, monkeypatch):
    """Words travel in mapped files: a text is shuffled nowhere, and a task holds few matches at once."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = rng.choices(vocabulary, k=80)
    rows = [(k, " ".join([*rng.choices(vocabulary, k=60), *passage, *rng.choices(vocabulary, k=60)])) for k in range(30)]
    docs = spark.createDataFrame([*rows, (None, "x"), (40, None)], "doc_id long, text string")
    words = passages.Words(docs)
    stored = words.rows.collect()
    assert sorted((r.doc_id, r.n) for r in stored) == [*((k, 200) for k in range(30)), (40, 0)]
    texts = passages._Texts(words.stored)
    places = texts.places(pa.array([7, 40, 41, 3]))
    assert [len(p) for p in places] == [1, 1, 0, 1]
    assert (texts.stretch(places[0], 60, 140) == texts.stretch(places[3], 60, 140)).all() and len(texts.stretch(places[1], 0, 9)) == 0
    assert len(texts.stretch(places[0], 180, 300)) == 20
    monkeypatch.setattr(passages, "_MATCHES", 50)
    found = {(r.doc_id, r.source_id) for r in passages.find_passages(docs).collect()}
    assert found >= {(k, 0) for k in range(1, 30)} and all(s < k for k, s in found)


def test_seeds_inside_passages(spark):
    """A seed is held by one passage, not by two that meet in it."""
    often = spark.createDataFrame([(1, "a", pos, 5, after) for pos, after in ((0, False), (6, True), (7, True), (20, False))] + [(1, "b", 6, 5, True)],
                                  "seed long, doc_id string, pos int, prior long, after boolean")
    cuts = spark.createDataFrame([("a", 0, 8), ("a", 5, 6), ("a", 2, 3)], "doc_id string, start int, n_words int")
    found = {(r.doc_id, r.pos): (r["query"], r["head"]) for r in passages._outside(often, cuts).collect()}
    assert found == {("a", 0): (False, True), ("a", 6): (False, True), ("a", 7): (False, True), ("a", 20): (True, True), ("b", 6): (True, False)}
