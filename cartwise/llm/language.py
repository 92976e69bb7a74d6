"""Language identification by a linear-chain conditional random field.

Texts are lower-cased and split at Unicode white space.  A word of more than
``WORD_CHARS`` characters (Chinese, Japanese or Thai text, any unbroken string)
becomes consecutive places of the chain: pieces that cover all of it and overlap by
``OVERLAP`` characters, so that no trigram is lost and languages may change inside.
Every word or piece with a letter is labelled; its features are its affixes (one to
three characters at either end), its character bigrams and trigrams, and the
word itself (a hashed lexicon).  Transition weights are learned too, on training
sequences that are spliced from two languages, so the chain follows
code-switched text.  Labels are scored by forward-backward; a document's
language is the one with the largest sum of posterior marginals, its score that
sum's mean over the words.

Training is bounded: ``TRAIN_DOCS`` documents per language (smallest id hash), whose
whole texts are learned, in windows of ``WINDOW`` words.
Prediction reads every whole text.  Forward-backward is exact: the words of a
batch form one chain that is reset at each document; it is cut into rows that
advance together, and row products carry the state from row to row.

Defined results: null text or text without a letter is ``und`` with score 0;
repeated rows get equal results; a null language label is not learned; ties go
to the alphabetically first language; with no labelled text at all every
document is ``und``; an empty table gives no rows; other columns are ignored
(``predict``) or kept (``confident``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import top_k_per_group
from .common import held_out, table, trim

TRAIN_DOCS = 100
WINDOW = 30
EPOCHS = 30
RATE, RIDGE = 0.5, 1e-4
SLOTS = 1 << 16             # hashed feature weights; slot 0 stays zero
WORD_CHARS, OVERLAP = 24, 3
CACHE_WORDS = 300_000
CHUNK_WORDS = 200_000       # words in one forward-backward batch
MIN_SCORE = 0.5
UNKNOWN = "und"


def units(text: str) -> list[str]:
    """Words in lower case; a long one as pieces that cover it."""
    words = text.lower().split()
    if max(map(len, words), default=0) <= WORD_CHARS:
        return words
    step = WORD_CHARS - OVERLAP
    return [w[i:i + WORD_CHARS] for w in words for i in range(0, max(1, len(w) - OVERLAP), step)]


def _core(word: str) -> str:
    """A word without what stands around its letters; empty when it has none."""
    if word.isalpha():
        return word
    letters = [i for i, ch in enumerate(word) if ch.isalpha()]
    return word[letters[0]:letters[-1] + 1] if letters else ""


def feature_slots(words: list[str]) -> np.ndarray:
    """Slots of each word's features (words of at most ``WORD_CHARS``), one row a
    word, padded with slot 0."""
    n = np.array([len(w) for w in words])
    flat = "".join("\x02" + w + "\x03" + "\x00" * (WORD_CHARS - len(w)) for w in words)
    ch = np.frombuffer(flat.encode("utf-32-le"), dtype=np.uint32).reshape(len(words), WORD_CHARS + 2).astype(np.uint64)
    k1, k2, k3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)

    def slot(x: np.ndarray, kind: int, ok: np.ndarray) -> np.ndarray:
        x = (x + np.uint64(kind)) * k1
        x = (x ^ (x >> np.uint64(29))) * k2
        return np.where(ok, (x >> np.uint64(40)) % np.uint64(SLOTS - 1) + np.uint64(1), 0).astype(np.int32)

    cols = []
    at = np.arange(WORD_CHARS + 2)[None, :]
    end = (n + 1)[:, None]                                      # where the end mark stands
    two = ch[:, :-1] * k2 + ch[:, 1:] * k3
    cols.append(slot(two, 1, at[:, 1:] <= end))
    three = ch[:, :-2] * k1 + ch[:, 1:-1] * k2 + ch[:, 2:] * k3
    cols.append(slot(three, 2, at[:, 2:] <= end))
    row = np.arange(len(words))
    head = np.zeros(len(words), dtype=np.uint64)
    tail = np.zeros(len(words), dtype=np.uint64)
    for size in (1, 2, 3):
        head = head * k3 + ch[:, size]
        tail = tail * k3 + ch[row, np.maximum(n + 1 - size, 0)]
        cols.append(slot(head, 10 + size, n >= size)[:, None])
        cols.append(slot(tail, 20 + size, n >= size)[:, None])
    whole = np.zeros(len(words), dtype=np.uint64)
    for j in range(1, WORD_CHARS + 1):
        whole = np.where(j <= n, whole * k1 + ch[:, j], whole)
    cols.append(slot(whole, 30, n > 0)[:, None])
    return np.concatenate(cols, axis=1)


class Crf:
    """Weights: ``emit`` (slots x labels), ``move`` (labels x labels), ``start``."""

    def __init__(self, labels: list[str], emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.labels, self.emit, self.move, self.start = labels, emit, move, start

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), len(self.labels)))
        for i in range(0, len(words), 4096):
            own = feature_slots(words[i:i + 4096])
            e = self.emit[own].sum(axis=1)
            out[i:i + 4096] = np.exp(e - e.max(axis=1, keepdims=True))
        return out


def posteriors(e: np.ndarray, first: np.ndarray, move: np.ndarray, start: np.ndarray, width: int = 256,
               both_ways: bool = False):
    """Posterior marginals of a chain of words.  ``e``: exp'd emissions
    (words x labels); ``first``: True where a document begins (the chain is
    reset there); ``move``, ``start``: exp'd transition and start weights.
    ``both_ways``: return (forward, backward) states instead."""
    total, labels = e.shape
    rows = -(-total // width)
    pad = rows * width - total
    if pad:
        e = np.concatenate((e, np.ones((pad, labels))))
        first = np.concatenate((first, np.ones(pad, dtype=bool)))
    e, first = e.reshape(rows, width, labels), first.reshape(rows, width)

    def norm(x):
        return x / x.sum(axis=tuple(range(1, x.ndim)), keepdims=True)

    # the product of each row's steps
    prod = np.broadcast_to(np.eye(labels), (rows, labels, labels)).copy()
    for j in range(width):
        step = np.where(first[:, j, None, None], prod.sum(axis=2, keepdims=True) * start, prod @ move)
        prod = norm(step * e[:, j, None, :])
    # state entering each row, and what follows it
    enter, follow = np.empty((rows, labels)), np.empty((rows, labels))
    state = np.full(labels, 1.0 / labels)
    for r in range(rows):
        enter[r] = state
        state = state @ prod[r]
        state = state / state.sum()
    state = np.ones(labels)
    for r in range(rows - 1, -1, -1):
        follow[r] = state
        state = prod[r] @ state
        state = state / state.sum()
    gamma = np.empty_like(e)
    state = enter
    for j in range(width):
        state = norm(np.where(first[:, j, None], start, state @ move) * e[:, j])
        gamma[:, j] = state
    state = follow
    back = np.empty_like(gamma) if both_ways else None
    for j in range(width - 1, -1, -1):
        if both_ways:
            back[:, j] = state
        else:
            gamma[:, j] = norm(gamma[:, j] * state)
        onward = e[:, j] * state
        state = norm(np.where(first[:, j, None], (onward @ start)[:, None] * np.ones(labels), onward @ move.T))
    flat = (rows * width, labels)
    if both_ways:
        return gamma.reshape(flat)[:total], back.reshape(flat)[:total]
    return gamma.reshape(flat)[:total]


def train(samples: list[tuple[str, list[list[str]]]], epochs: int = EPOCHS, seed: int = 7) -> Crf:
    """``samples``: (language, windows of words).  Adagrad on the conditional
    log-likelihood of single-language and spliced sequences."""
    labels = sorted({lang for lang, _ in samples})
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    windows = [(labels.index(lang), [number.setdefault(w, len(number)) for w in win])
               for lang, wins in samples for win in wins if win]
    words = list(number)
    k = len(labels)
    emit, move, start = np.zeros((SLOTS, k)), np.zeros((k, k)), np.zeros(k)
    if k < 2 or not windows:
        return Crf(labels, emit, move, start)
    sequences = []
    for lang, win in windows:
        tags = [lang] * len(win)
        if rng.random() < 0.5:                                   # splice in another window
            other, more = windows[rng.integers(len(windows))]
            cut, cut2 = rng.integers(1, len(win) + 1), rng.integers(1, len(more) + 1)
            win, tags = win[:cut] + more[:cut2], [lang] * cut + [other] * cut2
        sequences.append((win, tags))
    ids = np.array([w for win, _ in sequences for w in win])
    tags = np.array([t for _, own in sequences for t in own])
    first = np.zeros(len(ids), dtype=bool)
    first[np.cumsum([0, *(len(w) for w, _ in sequences[:-1])])] = True
    slots = np.concatenate([feature_slots(words[i:i + 4096]) for i in range(0, len(words), 4096)])
    word_of, flat = np.repeat(np.arange(len(words), dtype=np.int32), slots.shape[1]), slots.ravel()
    used = np.flatnonzero(flat)
    order = used[np.argsort(flat[used], kind="stable")]
    slot_at, slot_start = np.unique(flat[order], return_index=True)
    word_of = word_of[order]
    del flat, used, order
    onehot = np.eye(k)[tags]
    seen = np.zeros((k, k))
    inner = np.flatnonzero(~first)
    np.add.at(seen, (tags[inner - 1], tags[inner]), 1)
    squares = [np.full_like(x, 1e-8) for x in (emit, move, start)]
    for _ in range(epochs):
        e_word = np.concatenate([emit[slots[i:i + 4096]].sum(axis=1) for i in range(0, len(slots), 4096)])
        e = np.exp(e_word - e_word.max(axis=1, keepdims=True))[ids]
        m, s = np.exp(move), np.exp(start)
        ahead, back = posteriors(e, first, m, s, both_ways=True)
        g = ahead * back
        g /= g.sum(axis=1, keepdims=True)
        by_word = np.stack([np.bincount(ids, weights=(onehot - g)[:, j], minlength=len(words)) for j in range(k)], axis=1)
        grad_emit = np.zeros_like(emit)
        grad_emit[slot_at] = np.add.reduceat(by_word[word_of], slot_start)
        pair = ahead[inner - 1][:, :, None] * m[None] * (e[inner] * back[inner])[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        grad_move = seen - pair.sum(axis=0)
        grad_start = (onehot - g)[first].sum(axis=0)
        for w, grad, sq in zip((emit, move, start), (grad_emit, grad_move, grad_start), squares):
            grad = grad / len(sequences) - RIDGE * w
            sq += grad ** 2
            w += RATE * grad / np.sqrt(sq)
    return Crf(labels, emit, move, start)


def training_windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
                     per_language: int = TRAIN_DOCS) -> list[tuple[str, list[list[str]]]]:
    """The bounded training sample: at most ``per_language`` documents a
    language (held-out ones never), their whole texts in windows."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    able = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                      & ~held_out("doc_id"))
    chosen = top_k_per_group(able.select("doc_id", "lang"), "lang", [F.xxhash64("doc_id"), F.col("doc_id")], per_language)
    texts = (able.join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"])
             .select("lang", F.col("text").cast("binary").alias("text")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, wins = [], []
            for own, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = [c for c in map(_core, units(t.as_py().decode("utf-8", "replace"))) if c]
                for at in range(0, len(words), WINDOW):
                    langs.append(own)
                    wins.append(words[at:at + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(wins, pa.list_(pa.string()))],
                                             names=["lang", "words"])

    got = texts.mapInArrow(cut, "lang string, words array<string>").toArrow()
    pairs = sorted(zip(got["lang"].to_pylist(), got["words"].to_pylist()))
    return [(own, [words]) for own, words in pairs]


def classifier(model: Crf):
    """list of texts (bytes or None) -> (label numbers, scores); -1 for no letter."""
    known: dict[str, int] = {}
    emissions = np.empty((0, len(model.labels)))
    move, start = np.exp(model.move), np.exp(model.start)

    def run(texts: list) -> tuple[np.ndarray, np.ndarray]:
        nonlocal emissions
        label, score = np.full(len(texts), -1), np.zeros(len(texts))
        if not model.labels:
            return label, score
        at = 0
        while at < len(texts):
            split, words = [], 0
            while at + len(split) < len(texts) and (not split or words < CHUNK_WORDS):
                split.append(units((texts[at + len(split)] or b"").decode("utf-8", "replace")))
                words += len(split[-1])
            new = set().union(*split).difference(known)
            if new:
                if len(known) + len(new) > CACHE_WORDS:
                    known.clear()
                    emissions = emissions[:0]
                    new = set().union(*split)
                cores = {w: _core(w) for w in new}
                lettered = [w for w in new if cores[w]]
                known.update((w, -1) for w in new if not cores[w])
                known.update(zip(lettered, range(len(emissions), len(emissions) + len(lettered))))
                emissions = np.concatenate((emissions, model.emissions([cores[w] for w in lettered])))
            ids = np.array([known[w] for own in split for w in own], dtype=np.int64)
            doc = np.repeat(np.arange(len(split)), [len(own) for own in split])
            keep = ids >= 0
            ids, doc = ids[keep], doc[keep]
            if len(ids):
                first = np.concatenate(([True], doc[1:] != doc[:-1]))
                starts = np.flatnonzero(first)
                total = np.add.reduceat(posteriors(emissions[ids], first, move, start), starts)
                n = np.diff(np.concatenate((starts, [len(ids)])))
                where = at + doc[starts]
                label[where] = total.argmax(axis=1)
                score[where] = np.clip(total.max(axis=1) / n, 0.0, 1.0)
            at += len(split)
        return label, score

    return run


def _slices(batches, rows: int = 1000):
    """Batches of at most ``rows`` rows, so that few texts are unpacked at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _trained(docs: DataFrame, text: str, doc_id: str, lang: str):
    model = train(training_windows(docs, text, doc_id, lang))
    parts = (model.labels, model.emit, model.move, model.start)  # fixed size: SLOTS x languages
    return docs.sparkSession.sparkContext.broadcast(parts)


def predict(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    shared = _trained(docs, text, doc_id, lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        model = Crf(*shared.value)
        classify = classifier(model)
        names = np.array([*model.labels, UNKNOWN], dtype=object)
        for batch in _slices(batches):
            label, score = classify(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names[label], pa.string()),
                                              pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"),
                       F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def confident(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
              min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``min_score``."""
    shared = _trained(docs, text, doc_id, lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        classify = classifier(Crf(*shared.value))
        for batch in _slices(batches):
            label, score = classify(batch.column(text).cast(pa.binary()).to_pylist())
            yield batch.filter(pa.array((label >= 0) & (score >= min_score)))

    return docs.mapInArrow(run, docs.schema)


def op8(spark, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"))
