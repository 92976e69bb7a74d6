"""Periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period q, at least
max(``MIN_WORDS``, 2q) words long, that no neighbouring word extends keeping that
period (template loops, pasted blocks, stuttering output).

Method.  The words of many documents form one sequence (a unique end mark after
each document).  *Recompression* alternates two steps until the sequence stops
shrinking to any use: block compression replaces a^k by one symbol (a, k), pair
compression splits the alphabet in two by a hash of the symbol and replaces every
pair (left, right).  Equal symbols of a level spell equal words, and whether two
neighbours are joined depends on these two alone, so equal stretches are parsed
alike but for their ends.  That makes the *run-length grammar* answer longest
common extensions: climb while the symbols agree and both stand at the start of
their parents, step (or jump over the rest of a block) on equal symbols, descend on
unequal ones; where only the powers of a block differ, the smaller power is skipped
at once.  All queries of a batch take their steps together, as array operations.

*Harmonic grid.*  A run with period p agrees with itself shifted by p on at least
G = max(p, MIN_WORDS - p) consecutive words, so it holds a multiple i of G with
word i = word i + p.  For every p up to half a document these grid points are
compared, and each agreeing one is extended left and right from (i, i + p) by the
grammar.  Stretches of at least max(MIN_WORDS, 2p) words are runs of period p; for
equal stretches the smallest p is the run's period, as every other period found
there is its multiple.

Texts are read whole, a few hundred thousand words at a time (a longer text is a
batch of its own); no rows are shuffled.  Defined results: null, empty and blank
texts have no words and no runs; ids may be null or repeat, rows are judged one by
one; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, trim

MIN_WORDS = 12
BATCH_WORDS = 400_000       # words of a batch, unless one text is longer
QUERIES_AT_ONCE = 1_000_000

_MARK = -1                  # end marks count down from here


# ---- recompression -------------------------------------------------------------------

class Grammar:
    """Levels of a recompressed sequence.  ``symbols[t]`` are the symbols of level
    t; ``start[t]`` the word number where each begins (and the end); for t > 0
    ``child[t]`` is the index of its first symbol on level t - 1 (and the end) and
    ``parent[t - 1]`` the way back; ``block[t]``: level t was made by blocks."""

    def __init__(self, words: np.ndarray):
        self.symbols, self.start = [words], [np.arange(len(words) + 1, dtype=np.int32)]
        self.child, self.parent, self.block = [None], [], [False]
        step = 0
        while len(self.symbols[-1]) > 1:
            before = len(self.symbols[-1])
            self._blocks()
            self._pairs(step)
            step += 1
            if step > 4 and len(self.symbols[-1]) > 0.97 * before:      # only unique end marks and words are left
                break

    def _close(self, first: np.ndarray, symbols: np.ndarray, block: bool) -> None:
        """Add a level whose symbols begin at the indexes ``first``."""
        below = len(self.symbols[-1])
        child = np.append(first, below).astype(np.int32)
        self.parent.append(np.repeat(np.arange(len(first), dtype=np.int32), np.diff(child)))
        self.child.append(child)
        self.start.append(self.start[-1][child])
        self.symbols.append(symbols)
        self.block.append(block)

    def _blocks(self) -> None:
        s = self.symbols[-1]
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        if len(first) == len(s):
            return
        power = np.diff(np.append(first, len(s)))
        base = s[first]
        fresh = power > 1
        keys = np.stack([base[fresh].astype(np.int64), power[fresh].astype(np.int64)])
        self._close(first, self._named(base, fresh, keys), True)

    def _pairs(self, step: int) -> None:
        s = self.symbols[-1]
        mixed = (s.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (2 * step + 1) & 0xFFFFFFFFFFFFFFFF)) \
            * np.uint64(0xBF58476D1CE4E5B9)
        side = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> np.uint64(40)) & np.uint64(1)
        left = (side == 1) & (s >= 0)           # end marks join no pair
        right = (side == 0) & (s >= 0)
        forward, backward = left[:-1] & right[1:], right[:-1] & left[1:]
        joined = forward if forward.sum() >= backward.sum() else backward
        keep = np.append(True, ~joined)
        first = np.flatnonzero(keep)
        fresh = np.append(joined, False)[first]
        at = first[fresh]
        self._close(first, self._named(s[first], fresh, np.stack([s[at], s[at + 1]]).astype(np.int64)), False)

    def _named(self, symbols: np.ndarray, fresh: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """New numbers for the joined symbols, equal for equal keys."""
        out = symbols.copy()
        if keys.shape[1]:
            _, names = np.unique((keys[0] << 32) | keys[1], return_inverse=True)
            out[fresh] = names.astype(np.int32) + np.int32(self.symbols[-1].max() + 1)
        return out

    def extend(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """Number of agreeing words from (i, j) on to the right, or from
        (i - 1, j - 1) on to the left."""
        n = len(self.symbols[0])
        out = np.zeros(len(i), np.int32)
        live = np.arange(len(i))
        a, b = (i.copy(), j.copy()) if forward else (i - 1, j - 1)
        level = np.zeros(len(i), np.int16)
        falling = np.zeros(len(i), bool)
        while len(live):
            order = np.argsort(level, kind="stable")
            live, a, b, level, falling = live[order], a[order], b[order], level[order], falling[order]
            edges = np.flatnonzero(np.append(True, level[1:] != level[:-1]))
            edges = np.append(edges, len(level))
            over = np.zeros(len(live), bool)
            for lo, hi in zip(edges[:-1], edges[1:]):
                self._step(int(level[lo]), slice(lo, hi), a, b, level, falling, over, n, forward)
            # where a query ended, ``a`` holds the word where it stopped
            out[live[over]] = (a[over] - i[live[over]]) if forward else (i[live[over]] - 1 - a[over])
            rest = ~over
            live, a, b, level, falling = live[rest], a[rest], b[rest], level[rest], falling[rest]
        return out

    def _step(self, t, part, a, b, level, falling, over, n, forward) -> None:
        x, y, fall = a[part].copy(), b[part].copy(), falling[part].copy()
        s, size = self.symbols[t], len(self.symbols[t])
        inside = (x >= 0) & (y >= 0) & (x < size) & (y < size)
        xi, yi = np.where(inside, x, 0), np.where(inside, y, 0)
        same = inside & (s[xi] == s[yi])
        go_level = np.full(len(x), t, np.int16)
        # equal: climb where both begin (end) their parents, else step, over the rest of a block at once
        if t + 1 < len(self.symbols):
            up, child = self.parent[t], self.child[t + 1]
            px, py = up[xi], up[yi]
            if forward:
                at_edge, rest = (child[px] == xi) & (child[py] == yi), np.minimum(child[px + 1] - xi, child[py + 1] - yi)
            else:
                at_edge, rest = ((child[px + 1] - 1 == xi) & (child[py + 1] - 1 == yi),
                                 np.minimum(xi - child[px], yi - child[py]) + 1)
            climb = same & ~fall & at_edge
            jump = rest if self.block[t + 1] else 1
        else:
            climb, jump = np.zeros(len(x), bool), 1
        step = same & ~climb
        move = np.where(step, jump, 0) if forward else -np.where(step, jump, 0)
        if climb.any():
            x, y = np.where(climb, px, x + move), np.where(climb, py, y + move)
            go_level[climb] = t + 1
        else:
            x, y = x + move, y + move
        # unequal: descend; of two blocks of one symbol skip the smaller power
        differ = ~same
        if t == 0:
            over[part] = differ
        elif differ.any():
            child = self.child[t]
            cx, cy = child[np.clip(x, 0, size)], child[np.clip(y, 0, size)]       # first symbols below
            if not forward:
                cx, cy = child[np.clip(x + 1, 0, size)] - 1, child[np.clip(y + 1, 0, size)] - 1
            if self.block[t]:
                below = self.symbols[t - 1]
                k = np.minimum(child[xi + 1] - child[xi], child[yi + 1] - child[yi])
                skip = np.where(inside & (below[child[xi]] == below[child[yi]]), k, 0)
                cx, cy = cx + (skip if forward else -skip), cy + (skip if forward else -skip)
            x, y = np.where(differ, cx, x), np.where(differ, cy, y)
            go_level[differ] = t - 1
            fall |= differ
        a[part], b[part], level[part], falling[part] = x, y, go_level, fall


# ---- runs ----------------------------------------------------------------------------

def batch_runs(words: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Runs of each document: rows (start, length, period) by start, then period.

    ``words``: word numbers (>= 0, equal for equal words) of all documents one
    after another; ``sizes``: their lengths."""
    order = np.argsort(-sizes, kind="stable")           # long documents first: a period concerns a prefix
    begin = np.concatenate([[0], np.cumsum(sizes)])
    big = [k for k in order if sizes[k] >= MIN_WORDS]
    result = [np.zeros((0, 3), np.int64) for _ in sizes]
    if not big:
        return result
    parts, offsets, at = [], [], 0
    for number, k in enumerate(big):
        parts += [words[begin[k]:begin[k + 1]], np.array([_MARK - number], np.int32)]
        offsets.append(at)
        at += sizes[k] + 1
    seq = np.concatenate(parts).astype(np.int32)
    offsets, lengths = np.array(offsets), sizes[big]
    doc = np.repeat(np.arange(len(big), dtype=np.int32), lengths + 1)
    grammar = Grammar(seq)
    kept: list[np.ndarray] = []
    held_i, held_p, held = [], [], 0

    def flush():
        nonlocal held_i, held_p, held
        if held:
            i, p = np.concatenate(held_i), np.concatenate(held_p)
            j = i + p
            right, left = grammar.extend(i, j, True), grammar.extend(i, j, False)
            length = left + right + p
            ok = length >= np.maximum(2 * p, MIN_WORDS)
            if ok.any():
                kept.append(_smallest(np.concatenate([*kept, np.stack([(i - left)[ok], length[ok], p[ok]], axis=1)])))
                del kept[:-1]
        held_i, held_p, held = [], [], 0

    for p in range(1, int(lengths[0]) // 2 + 1):
        reach = int(np.searchsorted(-lengths, -max(2 * p, MIN_WORDS), side="right"))       # documents long enough
        if not reach:
            break
        end = offsets[reach - 1] + lengths[reach - 1] + 1
        grid = max(p, MIN_WORDS - p)
        i = np.arange(0, end - p, grid, dtype=np.int32)
        i = i[(seq[i] == seq[i + p]) & (doc[i] == doc[i + p])]
        if len(i):
            held_i.append(i), held_p.append(np.full(len(i), p, np.int32))
            held += len(i)
            if held >= QUERIES_AT_ONCE:
                flush()
    flush()
    if kept:
        runs = kept[0]
        owner = doc[runs[:, 0]]
        runs = np.stack([runs[:, 0] - offsets[owner], runs[:, 1], runs[:, 2]], axis=1).astype(np.int64)
        by = np.lexsort([runs[:, 2], runs[:, 0], owner])
        runs, owner = runs[by], owner[by]
        cuts = np.searchsorted(owner, np.arange(len(big) + 1))
        for number, k in enumerate(big):
            result[k] = runs[cuts[number]:cuts[number + 1]]
    return result


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of equal stretches the one with the smallest period."""
    runs = runs[np.lexsort([runs[:, 2], runs[:, 1], runs[:, 0]])]
    new = np.append(True, (runs[1:, 0] != runs[:-1, 0]) | (runs[1:, 1] != runs[:-1, 1]))
    return runs[new]


def collapsed(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when every run keeps its first period only."""
    if not len(runs):
        return np.ones(n, bool)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(cover[:n]) == 0


# ---- in tasks --------------------------------------------------------------------------

RUNS = "row long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
OP11 = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
        "collapsed_sha256 string")


def _untouched(doc_id, words):
    return words


def planted(doc_id, words: list) -> list:
    """The contract's loops: for a tenth of the ids the words from a on repeat with
    period p."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    loop = words[a:a + p]
    return words[:a] + (loop * (-(-(n - a) // p)))[:n - a]


def _batches(arrow, change):
    """(ids, word lists) of about ``BATCH_WORDS`` words."""
    ids, texts, held = [], [], 0
    for batch in arrow:
        key, text = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            t, k = text[i].as_py(), key[i].as_py()
            words = change(k, t.encode().split() if t is not None else [])
            ids.append(k), texts.append(words)
            held += len(words) + 1
            if held >= BATCH_WORDS:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _runs_of(texts: list) -> list[np.ndarray]:
    numbers: dict = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int32, int(sizes.sum()))
    return batch_runs(words, sizes)


def _kept_text(words: list, runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    stay = collapsed(len(words), runs)
    return b" ".join([words[i] for i in np.flatnonzero(stay)])


def _run_rows(change):
    def run(arrow):
        import pyarrow as pa
        for ids, texts in _batches(arrow, change):
            every = _runs_of(texts)
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(ids, pa.int64()), "n_words": pa.array([len(t) for t in texts], pa.int64()),
                "runs": pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs.tolist()] for runs in every],
                                 pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                "collapsed": pa.array([_kept_text(t, r).decode() for t, r in zip(texts, every)], pa.string())})
        trim()
    return run


def _digest_rows(change):
    def run(arrow):
        import pyarrow as pa
        names = [c.split()[0] for c in OP11.split(", ")]
        for ids, texts in _batches(arrow, change):
            rows = []
            for k, words, runs in zip(ids, texts, _runs_of(texts)):
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
                best = (None,) * 4
                if len(runs):
                    s, n, q = runs[np.lexsort([runs[:, 2], runs[:, 0], -runs[:, 1]])[0]].tolist()
                    best = (s, n, q, 1000 * n // q)
                rows.append((k, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(),
                             hashlib.sha256(_kept_text(words, runs)).hexdigest()))
            types = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        trim()
    return run


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, its runs and the text in which every
    run keeps its first period only (words joined by a space)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_run_rows(_untouched), RUNS).withColumnRenamed("row", "doc_id")


def op11(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_digest_rows(planted), OP11)
