"""Quality classifier: a generalised additive model with pairwise interactions.

Each text feature is cut into bins; boosting goes round the features in turn and
adds a shallow tree's steps (a few cuts of one feature) to that feature's lookup
table.  Then the pairs of features whose joint tables explain most of what is
left are boosted the same way with four-corner trees.  A score is the intercept
plus one table entry per feature and pair, so scoring is a few array additions.

Training is bounded: ``TRAIN_ROWS`` labelled documents (smallest id hash, never
held-out ones); their features are computed by Spark and only those numbers
reach the driver.  Scores read every whole text.

Defined results: null text is empty text and gets a score like any other; a
null quality is not a label; a document labelled twice trains with the mean; no
labels at all, or one value only, give that value's constant score (0.5 without
labels); repeated rows get equal results; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, table

TRAIN_ROWS = 20_000
BINS = 32
ROUNDS, RATE, LEAVES = 120, 0.15, 3
PAIRS, PAIR_BINS, PAIR_ROUNDS = 6, 8, 40
RIDGE = 2.0

FEATURES = ("bytes", "words", "word_length", "distinct_words", "top_word", "same_as_before", "short_words",
            "upper", "digit", "space", "stop_mark", "other_mark", "beyond_ascii", "lines", "line_length",
            "same_lines", "bang", "bar")

_UPPER = bytes(range(65, 91))
_DIGIT = b"0123456789"
_SPACE = b" \t\n\x0b\x0c\r"
_STOP = b".,;:?"
_OTHER = b"\"#$%&'()*+-/<=>@[\\]^_`{|}~!"
_HIGH = bytes(range(128, 256))


def text_features(text: bytes) -> list[float]:
    """The FEATURES of a whole text (all finite; all zero but the logs when empty)."""
    n = len(text)
    words = text.split()
    m = len(words)
    share = lambda chars: (n - len(text.translate(None, chars))) / n if n else 0.0
    lines = [x for x in text.split(b"\n") if x.strip()]
    seen = Counter(words)
    return [
        np.log1p(n), np.log1p(m),
        sum(map(len, words)) / m if m else 0.0,
        len(seen) / m if m else 0.0,
        max(seen.values()) / m if m else 0.0,
        sum(map(eq, words, words[1:])) / m if m else 0.0,
        sum([c for w, c in seen.items() if len(w) <= 3]) / m if m else 0.0,
        share(_UPPER), share(_DIGIT), share(_SPACE), share(_STOP), share(_OTHER), share(_HIGH),
        np.log1p(len(lines)), np.log1p(n / len(lines)) if lines else 0.0,
        1.0 - len(set(lines)) / len(lines) if lines else 0.0,
        text.count(b"!") / m if m else 0.0,
        text.count(b" | ") / m if m else 0.0,
    ]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _steps(grad: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """A tree over ordered bins: greedily chosen cuts, Newton values."""
    cuts = [0, len(grad)]
    g, w = np.concatenate(([0.0], np.cumsum(grad))), np.concatenate(([0.0], np.cumsum(weight)))
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (w[b] - w[a] + RIDGE)
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            for c in range(a + 1, b):
                won = gain(a, c) + gain(c, b) - gain(a, b)
                if won > best[0]:
                    best = (won, c)
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.empty(len(grad))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (g[b] - g[a]) / (w[b] - w[a] + RIDGE)
    return out


def _corners(grad: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree that cuts both features of a pair once: gain, table."""
    g = np.zeros((grad.shape[0] + 1, grad.shape[1] + 1))
    w = np.zeros_like(g)
    g[1:, 1:], w[1:, 1:] = grad.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    i, j = np.arange(1, grad.shape[0])[:, None], np.arange(1, grad.shape[1])[None, :]
    last = (-1, -1)
    gs = [g[i, j], g[i, -1] - g[i, j], g[-1, j] - g[i, j], g[last] - g[i, -1] - g[-1, j] + g[i, j]]
    ws = [w[i, j], w[i, -1] - w[i, j], w[-1, j] - w[i, j], w[last] - w[i, -1] - w[-1, j] + w[i, j]]
    total = sum(a ** 2 / (b + RIDGE) for a, b in zip(gs, ws))
    r, c = np.unravel_index(total.argmax(), total.shape)
    value = [a[r, c] / (b[r, c] + RIDGE) for a, b in zip(gs, ws)]
    out = np.empty_like(grad)
    out[:r + 1, :c + 1], out[:r + 1, c + 1:], out[r + 1:, :c + 1], out[r + 1:, c + 1:] = value
    return float(total[r, c] - g[last] ** 2 / (w[last] + RIDGE)), out


class Gam:
    """``edges`` per feature, ``tables`` per feature, ``pairs`` of
    (feature, feature, edges, edges, table)."""

    def __init__(self, base: float, edges=(), tables=(), pairs=()):
        self.base, self.edges, self.tables, self.pairs = base, list(edges), list(tables), list(pairs)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            out += t[np.searchsorted(e, x[:, j], side="right")]
        for a, b, ea, eb, t in self.pairs:
            out += t[np.searchsorted(ea, x[:, a], side="right"), np.searchsorted(eb, x[:, b], side="right")]
        return _sigmoid(out)

    def parts(self) -> tuple:
        return self.base, self.edges, self.tables, self.pairs


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """``x``: rows x features; ``y``: labels from 0 to 1."""
    if not len(y):
        return Gam(0.0)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return Gam(base)
    k = x.shape[1]
    edges = [_edges(x[:, j], BINS) for j in range(k)]
    at = [np.searchsorted(edges[j], x[:, j], side="right") for j in range(k)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    margin = np.full(len(y), base)
    for _ in range(ROUNDS):
        for j in range(k):
            p = _sigmoid(margin)
            grad = np.bincount(at[j], weights=y - p, minlength=len(tables[j]))
            weight = np.bincount(at[j], weights=p * (1 - p), minlength=len(tables[j]))
            step = RATE * _steps(grad, weight, LEAVES)
            tables[j] += step
            margin += step[at[j]]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(k)]
    cell = [np.searchsorted(coarse[j], x[:, j], side="right") for j in range(k)]

    def joint(a: int, b: int, values: np.ndarray) -> np.ndarray:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        return np.bincount(cell[a] * shape[1] + cell[b], weights=values, minlength=shape[0] * shape[1]).reshape(shape)

    p = _sigmoid(margin)
    able = [(a, b) for a in range(k) for b in range(a + 1, k) if len(coarse[a]) and len(coarse[b])]
    gains = sorted(((_corners(joint(a, b, y - p), joint(a, b, p * (1 - p)))[0], a, b) for a, b in able), reverse=True)
    pairs = [[a, b, coarse[a], coarse[b], np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))] for _, a, b in gains[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for pair in pairs:
            a, b = pair[0], pair[1]
            p = _sigmoid(margin)
            step = RATE * _corners(joint(a, b, y - p), joint(a, b, p * (1 - p)))[1]
            pair[4] += step
            margin += step[cell[a], cell[b]]
    return Gam(base, edges, tables, [tuple(pair) for pair in pairs])


def _feature_rows(batch: pa.RecordBatch, column: int) -> np.ndarray:
    rows = [text_features(t.as_py() or b"") for t in batch.column(column)]
    return np.array(rows, dtype=float).reshape(-1, len(FEATURES))


def training_rows(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  quality: str = "quality", limit: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``limit`` labelled documents."""
    known = (labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).cast("double").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.avg("y").alias("y")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)      # bounded
    rows = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _feature_rows(batch, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))],
                                             names=["doc_id", "y", "x"])

    got = rows.mapInArrow(run, "doc_id long, y double, x array<double>").orderBy("doc_id").toArrow()
    return (np.array(got["x"].to_pylist(), dtype=float).reshape(-1, len(FEATURES)),
            np.array(got["y"].to_pylist(), dtype=float))


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(*training_rows(docs, labels, text, doc_id))
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())          # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gam = Gam(*shared.value)
        for batch in batches:
            s = gam.score(_feature_rows(batch, 2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s),
                                              pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"),
                       F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op9(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
