"""Toxic spans by a linear-chain conditional random field over words, and document scores from its marginals."""

from __future__ import annotations

import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

_STRIP = ".,;:!?\"'()[]{}<>#*%&$@~^_=+-/\\|`…“”‘’«»¡¿"
_WORD = re.compile(r"\S+")
_STEPS = 128  # tokens in a stretch of the scan
_TOKENS = 400_000  # tokens tagged at once
_CACHE = 300_000  # words whose weights a task remembers


@dataclass(frozen=True)
class Crf:
    """Weights of what a token is, what stands before it and after it; all for label 1 against 0."""

    here: dict[str, float] = field(default_factory=dict)
    before: dict[str, float] = field(default_factory=dict)
    after: dict[str, float] = field(default_factory=dict)
    bias: float = -20.0
    moves: tuple[float, float, float] = (0.0, 0.0, 0.0)  # from 0 to 1, from 1 to 0, from 1 to 1


def tokens(text: str | None) -> list[str]:
    """Words between white space, lower-cased, without signs at their ends."""
    return [w.strip(_STRIP) for w in text.lower().split()] if text else []


def shapes(word: str) -> list[str]:
    """What a token is described by: the word, its first four and five letters, its last three."""
    return [f"w:{word}", f"p:{word[:4]}", f"q:{word[:5]}", f"s:{word[-3:]}"] if word else []


def marginals(score: np.ndarray, first: np.ndarray, moves: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Probability of label 1 at each token, and the expected moves 0-1, 1-0 and 1-1.

    ``score``: label 1 against label 0; ``first`` marks the first token of each sequence. Forward and
    backward run on all sequences end to end: matrices of stretches of tokens first, all stretches at
    once, then the vectors between stretches, then those inside.
    """
    n = len(score)
    if not n:
        return np.zeros(0), np.zeros(3)
    high = np.maximum(score, 0)
    emit = np.stack([np.exp(-high), np.exp(score - high)])  # by label, at most 1
    a = np.exp(np.array([[0.0, moves[0]], [moves[1], moves[2]]]))
    a /= a.max()
    rows = -(-n // _STEPS)
    pad = rows * _STEPS - n
    emit = np.pad(emit, ((0, 0), (0, pad)), constant_values=1.0).reshape(2, rows, _STEPS)
    head = np.pad(first, (0, pad), constant_values=True).reshape(rows, _STEPS)
    # step[i, j]: from label i before to label j here; at a first token what was before says nothing
    step = [[np.where(head, 1.0, a[i, j]) * emit[j] for j in (0, 1)] for i in (0, 1)]

    whole = [[np.full(rows, float(i == j)) for j in (0, 1)] for i in (0, 1)]
    for t in range(_STEPS):
        whole = [[w[0] * step[0][j][:, t] + w[1] * step[1][j][:, t] for j in (0, 1)] for w in whole]
        top = np.maximum(np.maximum(whole[0][0], whole[0][1]), np.maximum(whole[1][0], whole[1][1]))
        whole = [[x / top for x in w] for w in whole]
    flat = np.array([whole[0][0], whole[0][1], whole[1][0], whole[1][1]]).T.tolist()
    left = np.empty((rows, 2))
    x, y = 0.5, 0.5
    for k, (w00, w01, w10, w11) in enumerate(flat):
        left[k] = x, y
        x, y = x * w00 + y * w10, x * w01 + y * w11
        x, y = x / (x + y), y / (x + y)
    right = np.empty((rows, 2))
    x, y = 0.5, 0.5
    for k in range(rows - 1, -1, -1):
        right[k] = x, y
        w00, w01, w10, w11 = flat[k]
        x, y = w00 * x + w01 * y, w10 * x + w11 * y
        x, y = x / (x + y), y / (x + y)

    ahead = np.empty((2, rows, _STEPS))  # forward vectors
    x, y = left.T
    for t in range(_STEPS):
        x, y = x * step[0][0][:, t] + y * step[1][0][:, t], x * step[0][1][:, t] + y * step[1][1][:, t]
        s = x + y
        x, y = x / s, y / s
        ahead[0, :, t], ahead[1, :, t] = x, y
    behind = np.empty((2, rows, _STEPS))  # backward vectors
    x, y = right.T
    for t in range(_STEPS - 1, -1, -1):
        behind[0, :, t], behind[1, :, t] = x, y
        x, y = step[0][0][:, t] * x + step[0][1][:, t] * y, step[1][0][:, t] * x + step[1][1][:, t] * y
        s = x + y
        x, y = x / s, y / s
    ahead, behind, emit = (v.reshape(2, -1)[:, :n] for v in (ahead, behind, emit))
    both = ahead * behind
    p = both[1] / both.sum(0)
    inner = np.flatnonzero(~first)
    pair = [[ahead[i, inner - 1] * a[i, j] * emit[j, inner] * behind[j, inner] for j in (0, 1)] for i in (0, 1)]
    total = pair[0][0] + pair[0][1] + pair[1][0] + pair[1][1]
    return p, np.array([(pair[i][j] / total).sum() for i, j in ((0, 1), (1, 0), (1, 1))])


def _distinct(documents: list[list[str]]) -> list[list[str]]:
    """Leaves out near copies, which prove nothing twice: documents that share one of the four runs of
    three words of least hash with one before."""
    seen: set[int] = set()
    out = []
    for d in documents:
        least = sorted({zlib.crc32(" ".join(d[k : k + 3]).encode("utf-8", "surrogatepass")) for k in range(max(1, len(d) - 2))})[:4]
        if d and seen.isdisjoint(least):
            out.append(d)
        seen.update(least)
    return out


def marked(toxic: list[list[str]], clean: list[list[str]], share: float = 0.02, purity: float = 0.02) -> set[str]:
    """Words and beginnings that at least ``share`` of the toxic documents hold (3 at least), and of the
    clean ones at most ``purity`` times that share."""
    counts = []
    for documents in (toxic, clean):
        found: Counter = Counter()
        for d in documents:
            found.update({s for w in set(d) for s in shapes(w)[:3]})
        counts.append(found)
    least = max(3, share * len(toxic))
    return {s for s, n in counts[0].items() if n >= least and counts[1][s] / max(1, len(clean)) <= purity * n / len(toxic)}


def fit(texts: list[str | None], toxic: list[int], rounds: int = 30, ridge: float = 1.0) -> Crf:
    """Trains on documents: tokens that show a marked word or beginning in a toxic one are labelled 1.

    Gradient of the conditional likelihood by forward-backward, adaptive steps, and a ridge penalty.
    """
    split = [[tokens(t) for t, y in zip(texts, toxic) if y == label] for label in (1, 0)]
    split = [_distinct(d) for d in split]
    if not split[0] or not split[1]:
        return Crf()
    signs = marked(*split)
    documents = split[0] + split[1]
    words = [w for d in documents for w in d]
    first = np.zeros(len(words), bool)
    first[np.cumsum([0] + [len(d) for d in documents[:-1]])] = True
    cut = sum(map(len, split[0]))
    vocabulary = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter((vocabulary[w] for w in words), np.int64, len(words))
    shaped = [shapes(w) for w in vocabulary]
    truth = np.fromiter((any(s in signs for s in f[:3]) for f in shaped), bool, len(shaped))[ids]
    truth[cut:] = False
    names = {s: k for k, s in enumerate(dict.fromkeys(s for f in shaped for s in f))}
    # by word: its shapes' numbers; one number more stands for none
    table = np.full((len(shaped), 4), len(names))
    for k, f in enumerate(shaped):
        table[k, : len(f)] = [names[s] for s in f]
    near = len(vocabulary)
    earlier = np.where(first, near, np.roll(ids, 1))
    later = np.where(np.roll(first, -1), near, np.roll(ids, -1))
    sizes = [len(names) + 1, near + 1, near + 1, 1, 3]
    at = np.cumsum([0, *sizes])
    weight = np.zeros(at[-1])
    weight[at[3]] = -4.0
    speed = np.full(at[-1], 1e-6)
    real = np.array([(~truth[:-1] & truth[1:] & ~first[1:]).sum(), (truth[:-1] & ~truth[1:] & ~first[1:]).sum(), (truth[:-1] & truth[1:] & ~first[1:]).sum()])
    for _ in range(rounds):
        parts = [weight[at[k] : at[k + 1]].copy() for k in range(5)]
        parts[0][-1] = parts[1][-1] = parts[2][-1] = 0
        score = parts[0][table].sum(1)[ids] + parts[1][earlier] + parts[2][later] + parts[3][0]
        p, moved = marginals(score, first, tuple(parts[4]))
        error = truth - p
        by_word = np.bincount(ids, error, near)
        grad = np.concatenate([
            np.bincount(table.ravel(), np.repeat(by_word, 4), sizes[0]), np.bincount(earlier, error, sizes[1]),
            np.bincount(later, error, sizes[2]), [error.sum()], real - moved,
        ])
        grad[: at[3]] -= ridge * weight[: at[3]]
        speed += grad * grad
        weight += 0.5 * grad / np.sqrt(speed)
    kept = lambda part, keys: {s: float(w) for s, w in zip(keys, part) if abs(w) >= 0.05}
    return Crf(kept(weight[: at[1]], names), kept(weight[at[1] : at[2]], vocabulary), kept(weight[at[2] : at[3]], vocabulary), float(weight[at[3]]), tuple(map(float, weight[at[4] :])))


class Tagger:
    """Marginals of the tokens of whole texts."""

    def __init__(self, crf: Crf):
        self.crf, self.rows = crf, {}
        self.weights = np.zeros((4096, 3))

    def _row(self, raw: str) -> int:
        row = len(self.rows)
        if row == len(self.weights):
            self.weights = np.concatenate([self.weights, np.zeros_like(self.weights)])
        word, crf = raw.strip(_STRIP), self.crf
        self.weights[row] = sum(crf.here.get(s, 0.0) for s in shapes(word)), crf.before.get(word, 0.0), crf.after.get(word, 0.0)
        self.rows[raw] = row
        return row

    def tag(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each token of all texts, and where each text's tokens begin (one more at the end)."""
        if len(self.rows) > _CACHE:
            self.rows.clear()
        ids, sizes, get = [], [], self.rows.get
        for text in texts:
            words = text.lower().split() if text else ()
            for w in words:
                row = get(w)
                ids.append(self._row(w) if row is None else row)
            sizes.append(len(words))
        begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        ids = np.array(ids, np.int64)
        first = np.zeros(len(ids) + 1, bool)
        first[begin] = True
        score = self.weights[ids, 0] + self.crf.bias
        score[1:] += np.where(first[1:-1], 0, self.weights[ids[:-1], 1])
        score[:-1] += np.where(first[1:-1], 0, self.weights[ids[1:], 2])
        return marginals(score, first[:-1], self.crf.moves)[0], begin


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 1000, folds: int = 5) -> Crf:
    """Fits on at most ``per_class`` toxic and twice as many clean labelled documents outside the held-out fold.

    They are those of least hash of the id. Null labels and ids are left out; the largest of several
    labels counts. Where one class has no document, nothing is toxic.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~fold(F.col("doc_id"), folds))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    ranked = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, per_class), (0, 2 * per_class))]
    sample = docs.select("doc_id", "text").join(F.broadcast(ranked[0].union(ranked[1])), "doc_id")  # 3 * per_class rows

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"])
        return pd.DataFrame({"model": [pickle.dumps(fit(rows["text"].tolist(), rows["toxic"].tolist()).__dict__)]})

    fitted = sample.groupBy().applyInPandas(run, "model binary").first()
    return Crf(**pickle.loads(fitted.model)) if fitted else Crf()


def _scored(texts: list[str | None], tagger: Tagger) -> Iterator[tuple[str | None, np.ndarray]]:
    """Each text with the probabilities of its tokens; texts are tagged in groups of bounded size."""
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars < 6 * _TOKENS):
            chars += len(texts[end] or "")
            end += 1
        p, begin = tagger.tag(texts[at:end])
        for k in range(end - at):
            yield texts[at + k], p[begin[k] : begin[k + 1]]
        at = end


def without_toxic(docs: DataFrame, crf: Crf) -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(crf)
        for batch in batches:
            scored = _scored(batch.column("text").to_pylist(), tagger)
            yield batch.filter(pa.array([bool(len(p) == 0 or p.max() < 0.5) for _, p in scored], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def tag(docs: DataFrame, crf: Crf) -> DataFrame:
    """doc_id, score and spans (offset, length, words, probability) of each row.

    The score is the largest marginal of the document's tokens; a span is a run of tokens of 0.5 or
    more, its offset in characters. Null and empty texts score 0 and have no spans; long texts are
    tagged whole; null ids, repeated rows and other columns do no harm; no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(crf)
        for batch in batches:
            scores, spans = [], []
            for text, p in _scored(batch.column("text").to_pylist(), tagger):
                scores.append(float(p.max()) if len(p) else 0.0)
                spans.append(_spans(text, p) if scores[-1] >= 0.5 else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, _SPANS)], ["doc_id", "score", "spans"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, spans array<struct<offset: long, length: long, words: int, probability: double>>"
    )


_SPANS = pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64()), ("words", pa.int32()), ("probability", pa.float64())]))


def _spans(text: str, p: np.ndarray) -> list[dict]:
    places = [m.span() for m in _WORD.finditer(text)]
    if len(places) != len(p):  # a letter whose lower case holds white space
        places = [(0, len(text))] * len(p)
    hot = np.flatnonzero(p >= 0.5)
    begin = np.flatnonzero(np.diff(hot, prepend=-2) > 1)
    out = []
    for a, b in zip(begin, np.append(begin[1:], len(hot))):
        i, j = hot[a], hot[b - 1]
        out.append({"offset": places[i][0], "length": places[j][1] - places[i][0], "words": int(j - i + 1), "probability": float(p[i : j + 1].max())})
    return out


def score_documents(docs: DataFrame, labels: DataFrame, per_class: int = 1000, folds: int = 5) -> DataFrame:
    """Spans and scores of all rows by a model of the labelled rows outside the held-out fold."""
    tagged = tag(docs, learn(docs, labels, per_class, folds))
    return tagged.select(
        "doc_id", fold(F.col("doc_id"), folds).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )
