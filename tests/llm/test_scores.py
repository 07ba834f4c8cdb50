"""Token counts, language model, toxicity and url filter against plain versions of their definitions."""

from __future__ import annotations

import math
import os
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from filingstrata.llm import ngram_lm, tokens, toxicity, urls

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", None, "   ", "'s it's IT'S ''s 'x 're'll rest", "  a  \n\n b\t c ", "x<|endoftext|> y<|endoftext|>", "a'", "' s", "\n's",
    "1's", "!'s", " 's", "a\xa0 b", "can't've", "é ñ ² ½ ٣ 漢字 😀😀  \u3000x", "word " * 3000, "a b " * 40,
]


def _docs(spark, texts):
    """Texts with ids, a repeated row, a null id and columns of clashing names."""
    rows = [(k, t, "x", 1) for k, t in enumerate(texts)]
    rows += [rows[0], (None, texts[-1], None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, hash string, row int").repartition(3)


@pytest.mark.parametrize(("frequent", "chars"), [(1_000_000, 2_000_000), (1, 50)])
def test_token_counts_are_the_librarys(spark, monkeypatch, frequent, chars):
    monkeypatch.setattr(tokens, "_CHARS", chars)
    library = Tokenizer.from_file(PATH)
    counted = tokens.count_tokens(_docs(spark, ODD), PATH, limit=50, frequent=frequent).collect()
    size = lambda t: len(library.encode(t or "", add_special_tokens=False))
    texts = [*enumerate(ODD), (0, ODD[0]), (None, ODD[-1])]
    expected = sorted((-1 if i is None else i, len((t or "").encode()), size(t), size(t) > 50) for i, t in texts)
    assert sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in counted) == expected


def test_all_code_points_are_cut_as_by_the_library():
    library, classes = Tokenizer.from_file(PATH), tokens.char_classes()
    for c in [*range(0x3000), *range(0x3000, 0x110000, 97)]:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}b1{chr(c)} {chr(c)} x"
            assert len(tokens.Cut([(0, text, 0)], classes).start) == len(library.pre_tokenizer.pre_tokenize_str(text)), hex(c)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string")
    assert tokens.count_tokens(empty, PATH).count() == 0
    assert ngram_lm.score_corpus(empty).count() == 0
    assert toxicity.score_documents(empty, labels).count() == 0
    assert urls.judge(pages).count() == 0


def _plain_model(order, texts):
    """Probability function and single-token counts by the definition."""
    ends = lambda t: [*(t or "").encode().lower().split(), "</s>"]
    top, single = Counter(), Counter()
    for t in texts:
        s = ["<s>"] * (order - 1) + ends(t)
        for i in range(order - 1, len(s)):
            top[tuple(s[i - order + 1 : i + 1])] += 1
            single[s[i]] += 1
    counts = {order: top}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discounts = {k: ngram_lm._discounts([sum(v == j for v in c.values()) for j in (1, 2, 3, 4)]) for k, c in counts.items()}
    after = {k: defaultdict(lambda: [0, 0, 0, 0]) for k in counts}
    for k, c in counts.items():
        for g, v in c.items():
            entry = after[k][g[:-1]]
            entry[0] += v
            entry[min(v, 3)] += 1

    def p(g):
        if not g:
            return 1 / (len(single) + 1)
        k, entry = len(g), after[len(g)].get(g[:-1])
        if entry is None:
            return p(g[1:])
        c, d = counts[k].get(g, 0), [0, *discounts[k]]
        left = sum(a * b for a, b in zip(discounts[k], entry[1:])) / entry[0]
        return max(c - d[min(c, 3)], 0) / entry[0] + left * p(g[1:])

    return p, single, ends


@pytest.mark.parametrize(("order", "flush"), [(1, 10), (2, 2_000_000), (3, 10)])
def test_language_model_is_kneser_ney(spark, monkeypatch, order, flush):
    monkeypatch.setattr(ngram_lm, "_FLUSH", flush)
    rng = np.random.default_rng(order)
    texts = [" ".join(f"W{min(rng.geometric(0.2), 30)}" for _ in range(rng.integers(0, 40))) for _ in range(60)] + [None, "", "new words"]
    docs = _docs(spark, texts)
    every = docs.select("doc_id", "text").collect()
    train = [r.text for r in every if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 10]
    p, single, ends = _plain_model(order, train)
    n, v = sum(single.values()), len(single)
    got = defaultdict(list)
    for r in ngram_lm.score_corpus(docs, order).collect():
        got[r.doc_id].append(r)
    for row in every:
        s = ["<s>"] * (order - 1) + ends(row.text)
        own = s[order - 1 :]
        for r in got[row.doc_id]:
            total = sum(math.log10(p(tuple(s[i - order + 1 : i + 1]))) for i in range(order - 1, len(s)))
            assert r.score == pytest.approx(total) and r.train_tokens == n and r.n_tokens == len(own)
            assert r.n_known == sum(single[w] > 0 for w in own)
            assert r.base_score == pytest.approx(sum(math.log10((single[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own))
            assert r.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 10 == 0)
    assert sum(map(len, got.values())) == len(every)


def test_probabilities_add_up(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "a b b"), (3, "c a b a")], "doc_id long, text string")
    model = ngram_lm.train(docs)
    scorer = ngram_lm.Scorer(model)
    hashes = ngram_lm.WordHashes()
    words = np.append(hashes.of([b"a", b"b", b"c", b"unseen"]), ngram_lm.END)
    for context in (*hashes.of([b"a", b"b", b"unseen"]), ngram_lm.BEGIN):
        flat = np.stack([np.full(len(words), context), words], 1).ravel()
        assert scorer.probabilities(flat, np.arange(1, len(flat), 2))[0].sum() == pytest.approx(1)


def test_marginals_are_those_of_forward_backward():
    rng = np.random.default_rng(0)
    n, moves = 400, (0.3, -0.7, 1.1)
    score, first = rng.normal(size=n) * 4, rng.random(n) < 0.05
    first[0] = True
    p, moved = toxicity.marginals(score, first, moves)
    a = np.exp(np.array([[0, moves[0]], [moves[1], moves[2]]]))
    starts, q, total = np.flatnonzero(first), np.zeros(n), np.zeros(3)
    for lo, hi in zip(starts, np.append(starts[1:], n)):
        emit = np.stack([np.ones(hi - lo), np.exp(score[lo:hi])], 1)
        ahead, behind = np.zeros_like(emit), np.ones_like(emit)
        ahead[0] = emit[0]
        for t in range(1, hi - lo):
            ahead[t] = (ahead[t - 1] @ a) * emit[t]
        for t in range(hi - lo - 2, -1, -1):
            behind[t] = a @ (emit[t + 1] * behind[t + 1])
        z = ahead[-1].sum()
        q[lo:hi] = ahead[:, 1] * behind[:, 1] / z
        for t in range(1, hi - lo):
            x = ahead[t - 1][:, None] * a * emit[t] * behind[t] / z
            total += [x[0, 1], x[1, 0], x[1, 1]]
    assert p == pytest.approx(q) and moved == pytest.approx(total)


def test_toxic_documents_of_the_held_out_fold(spark):
    rng = np.random.default_rng(1)
    bad, rows, labels = ["Vile!", "grubby", "(rotten)"], [], []
    for k in range(400):
        words = [f"w{rng.integers(0, 400)}" for _ in range(60)]
        if k % 4 == 0:
            words[int(rng.integers(0, 60))] = bad[k // 4 % 3]
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    docs = _docs(spark, [t for _, t in rows] + [None, "", "vile, not labelled", "w " * 5000 + "grubby"])
    marks = spark.createDataFrame([*labels, (None, 1), (0, None), (401, 0)], "doc_id long, toxic int")
    scored = {r.doc_id: r for r in toxicity.score_documents(docs, marks).collect() if r.doc_id is not None}
    assert all(scored[k].predicted == y for k, y in labels)
    assert any(scored[k].held_out for k, _ in labels)
    assert scored[400].score == scored[401].score == 0 and scored[402].predicted == scored[403].predicted == 1
    for k, text in [*rows, (402, "vile, not labelled"), (403, "w " * 5000 + "grubby")]:
        spans = [text[s.offset : s.offset + s.length] for s in scored[k].spans]
        assert spans == [w for w in text.split() if w.strip(",!()").lower() in ("vile", "grubby", "rotten")]
    assert toxicity.without_toxic(docs, toxicity.learn(docs, marks)).count() == docs.count() - 1 - 100 - 2 - 1


def test_no_toxic_labels_no_toxic_documents(spark):
    docs = _docs(spark, ["a b", "c"])
    labels = spark.createDataFrame([(0, 0), (1, 0)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score_documents(docs, labels).collect()} == {0}


@pytest.mark.parametrize(
    ("url", "host", "path"),
    [
        ("HTTP://A.Net/B/c?d#e", "a.net", "/B/c"), ("a://b://c/d", "b:", "//c/d"), ("x", "", ""), ("", "", ""), (None, "", ""),
        ("h://x#y/z", "x", ""), ("h://x?y/z", "x", ""), ("h://", "", ""), ("h:///p", "", "/p"), ("h://É.NET/", "É.net", "/"),
    ],
)
def test_host_and_path(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "url string").select(urls.host_of(F.col("url")), urls.path_of(F.col("url"))).first()
    assert tuple(row) == (host, path)


def test_urls_by_rule_and_by_model(spark):
    hosts = ["good.example.net", "example.net", "bad.net", "x.example.com", "a.org", "borg", "shop.example.com", "", "net"]
    given = [f"http://{hosts[k % 9]}/{('en', 'de', 'fr')[k % 3]}/{'cheap-pills' if k % 9 in (2, 6) else 'story'}/{k % 40}" for k in range(300)]
    given += [None, "", "nothing", "http://bad.net", "http://BAD.net/x", given[0], "http://plain.example.com/cheap-pills", "http://plain.example.com/story/1"]
    rows = [(k, u, "c") for k, u in enumerate(given)]
    judged = urls.judge(spark.createDataFrame(rows, "page_id long, url string, text string").repartition(3)).collect()
    assert len(judged) == len(rows)
    order, count, seen, letters = 4, [Counter(), Counter()], {}, set()
    for r in judged:
        place = None
        for rule, _ in sorted(urls.RULES, key=lambda x: len(x.place)):
            h, _, p = rule.partition("/")
            if ("." + r.host).endswith("." + h) and r.path.startswith("/" + p):
                place = rule
        assert r.rule == place and (place is None or r.verdict == dict(urls.RULES)[place])
        seen[r.host + r.path] = r.score
        padded = "\x02" * order + r.host + r.path + "\x03"
        letters |= set(padded[order:])
        kept = zlib.crc32((r.host + r.path).encode()) % 10 == 0
        for i in range(order, len(padded)):
            for k in range(order + 1):
                if place and not kept:
                    count[r.verdict == "block"][padded[i - k : i + 1]] += 1
    after = [defaultdict(list), defaultdict(list)]
    for side in (0, 1):
        for gram, n in count[side].items():
            after[side][gram[:-1]].append(n)

    def p(side, gram):
        if not gram:
            return 1 / (len(letters) + 1)
        follow = after[side].get(gram[:-1], [])
        lower = p(side, gram[1:])
        return (count[side][gram] + len(follow) * lower) / (sum(follow) + len(follow)) if follow else lower

    for text, score in seen.items():
        padded = "\x02" * order + text + "\x03"
        ratio = [math.log(p(0, padded[i - order : i + 1]) / p(1, padded[i - order : i + 1])) for i in range(order, len(padded))]
        assert score == pytest.approx(sum(ratio) / len(ratio))
    verdicts = {r.page_id: r.verdict for r in judged}
    assert verdicts[306] == "block" and verdicts[307] == "allow"


def test_a_very_long_url_costs_as_much_as_its_length(spark):
    rng = random.Random(9)
    urls_ = [f"http://example.net/en/{rng.choice('abc')}{k}" for k in range(30)] + [f"http://bad.net/{rng.choice('xyz')}{k}" for k in range(30)]
    long = ["http://example.org/" + "".join(rng.choice("abxyz/") for _ in range(n)) for n in (300_000, 257, 256, 255, 1)]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls_ + long)], "page_id long, url string")
    began = time.monotonic()
    found = {r.page_id: r for r in urls.judge(pages).collect()}
    assert len(found) == 65 and found[60].score is not None and time.monotonic() - began < 60
    texts = spark.createDataFrame([("ab" * 700,), ("",), ("x" * 256,), ("y" * 257,)], "text string")
    grams = sorted(r.gram for r in urls._grams(texts, 3).collect())
    plain = ["\x02\x02\x02" + t.text + "\x03" for t in texts.collect()]
    assert grams == sorted(p[i : i + 4] for p in plain for i in range(len(p) - 3))


def test_a_lost_model_file_is_an_error(spark):
    docs = spark.createDataFrame([(k, f"a b c {k % 7} d e") for k in range(200)], "doc_id long, text string")
    model = ngram_lm.train(docs, order=2)
    held_out = F.lit(False)
    assert ngram_lm.score(docs, model, held_out).count() == 200
    folder = model.folder.removeprefix("file://").removeprefix("file:")
    some = sorted(model.written[2])[0]
    os.remove(f"{folder}/2-{some}")
    with pytest.raises(Exception, match="is gone or cannot be seen"):
        ngram_lm.score(docs, model, held_out).collect()
