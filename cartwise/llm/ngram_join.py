"""N-gram Jaccard join: near-duplicate components over five-word shingle sets.

Two documents link when their sets' Jaccard similarity is at least 0.8; the
result is exact (no sampling, no caps, no missed link).  Method:

* *Classes.*  Documents with equal sets are one class (128-bit set digest); all
  later work is between classes, so thousands of copies cost one.  A class goes
  by the first 64 bits; the few different sets that share them (about three
  among 10^10) are told by the other 64 and renumbered.
* *Count vectors.*  Shingles are hashed into groups (more for longer texts, in
  powers of two, so that the finer groups add up to the coarser); a class is the
  point of its group counts.  The summed coordinate minima of two points bound their
  overlap from above.
* *Forest of R-trees.*  One tree over all points would prune nothing: unrelated
  texts differ by about sqrt(n) per coordinate and every leaf box overlaps every
  other.  So the points are dealt into a forest first, without losing a link:
  two linked sets share a shingle among their rarest fifth (rarity: corpus
  counts of 2^17 shingle groups, a fixed-size table over all documents; any fixed
  order keeps the result exact).  Shingles that many documents share sort last
  and do not gather them.  The classes that meet on a rare shingle are put under
  the first of them in one fixed order; all that come under one class are a block,
  bulk-loaded into an R-tree (tiles by size, then by the widest coordinates).  A
  search descends only into boxes whose bound reaches the required overlap.
* *Round 1* pairs points only with the first few leaders whose search finds them
  (one order of points for all trees, so groups share leaders), not with each
  other.  *Round 2* searches again between points that are still in different
  components, so pairs that can add no information are not made and none that
  can is left out.
* *Verification* intersects the full sets of the surviving pairs.

Blocks larger than ``TREE`` points are cut into several trees that share the
block's first point; in round 2 the cut is by pairs of parts, which covers all
pairs at bounded memory.

Defined results: null or white-space-only text has an empty set and links with
nothing (repeated or not); texts under five words are one shingle, the whole
sequence; repeated rows get the same component; rows with a null doc_id are
compared like others but never name a component; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import spare, table, tidied, written
from .components import components

WORDS = 5
SIM = (80, 100)             # similarity at least 80 / 100
VEC = 128                   # coordinates of a count vector, at least
PER_COORDINATE = 8
RARITY_BITS = 17            # corpus counts are kept for 2^17 shingle groups
TREE = 1024                 # points in one R-tree
LEADERS = 6                 # points that a point is first compared with
AGAINST, MEMBERS = 512, 2_000   # leaders in one row, members in one task group
MANY = (1 << 16) - 1        # counts from here on are stored as this
FILTER_BITS = 23
TEXT_BYTES = 1_000_000      # text shingled at a time
KEYS_PER_TASK = 500_000   # that one task of the meeting stage gathers
FLUSH_KEYS = 300_000        # that a task of the key stage holds
CACHE_WORDS = 100_000

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


# ---------------------------------------------------------------- sets

def shingler():
    """list of texts (bytes) -> list of sorted distinct 64-bit shingle hashes."""
    import xxhash
    number: dict[bytes, int] = {}
    hashes = np.empty(0, dtype=np.uint64)

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(31))) * _MIX
        return x ^ (x >> np.uint64(29))

    def rolled(h: np.ndarray, n: int) -> np.ndarray:
        out = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for j in range(n):
            out = out * _MUL + h[j:len(h) - n + 1 + j]
        return mixed(out)

    def distinct(x: np.ndarray) -> np.ndarray:
        x = np.sort(x)
        new = x[1:] != x[:-1]
        return x if new.all() else x[np.concatenate(([True], new))]

    def shingles(texts: list[bytes]) -> list[np.ndarray]:
        nonlocal hashes
        split = [t.lower().split() for t in texts]
        new = set().union(*split).difference(number)
        if new:
            if len(number) + len(new) > CACHE_WORDS:
                number.clear()
                hashes = hashes[:0]
                new = set().union(*split)
            number.update(zip(new, range(len(hashes), len(hashes) + len(new))))
            hashes = np.concatenate((hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))))
        size = np.array([len(w) for w in split], dtype=np.int64)
        ids = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(size.sum()))
        h = hashes[ids]
        every = rolled(h, WORDS) if len(h) >= WORDS else None
        out, at = [], 0
        for n in size.tolist():
            if n >= WORDS:
                out.append(distinct(every[at:at + n - WORDS + 1]))
            else:
                out.append(rolled(h[at:at + n], n) if n else np.empty(0, dtype=np.uint64))
            at += n
        return out

    return shingles


def coordinates(n: int) -> int:
    """Coordinates of a count vector: about eight shingles in each, so that the
    bound tells texts apart alike at every length."""
    v = VEC
    while v * PER_COORDINATE < n:
        v *= 2
    return v


def count_vector(s: np.ndarray) -> bytes:
    v = coordinates(len(s))
    counts = np.bincount(((s >> np.uint64(20)) & np.uint64(v - 1)).astype(np.int64), minlength=v)
    return np.minimum(counts, MANY).astype(np.uint16).tobytes()


def _rarity_group(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def set_digest(s: np.ndarray) -> tuple[int, int]:
    import hashlib
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def class_number(s: np.ndarray, renamed: dict) -> int:
    """The number of a set's class; ``renamed``: those of sets whose first 64
    digest bits another set has, by the whole digest."""
    digest = set_digest(s)
    return renamed.get(digest, digest[0])


def _texts(batches, *cols):
    """Lists of (values of cols..., text bytes), a few megabytes of text at a time."""
    held, size = [], 0
    for batch in batches:
        at = batch.schema.get_field_index("text")
        for *row, t in zip(*[batch.column(c).to_pylist() for c in cols], batch.column(at)):
            held.append((*row, t.as_py() or b""))
            size += len(held[-1][-1])
            if size > TEXT_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _binary_docs(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))


INFO = "kind int, id long, n long, c long, c2 long, vec binary"


def _describe(docs: DataFrame) -> DataFrame:
    """kind 0: one row per document (id, set size n, class c and its check c2,
    count vector); kind 1: per task, shingle group ``id`` occurs in n sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, corpus = shingler(), np.zeros(1 << RARITY_BITS, dtype=np.int64)
        for held in _texts(batches, "doc_id"):
            sets = shingles([t for _, t in held])
            corpus += np.bincount(_rarity_group(np.concatenate(sets)), minlength=len(corpus))
            digests = [set_digest(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(held), dtype=np.int32)), pa.array([i for i, _ in held], pa.int64()),
                 pa.array([len(x) for x in sets], pa.int64()), pa.array([d[0] for d in digests], pa.int64()),
                 pa.array([d[1] for d in digests], pa.int64()), pa.array([count_vector(x) for x in sets], pa.binary())],
                names=["kind", "id", "n", "c", "c2", "vec"])
        used = np.flatnonzero(corpus)
        if len(used):
            none = pa.nulls(len(used), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(used), dtype=np.int32)), pa.array(used), pa.array(corpus[used]), none, none,
                 pa.nulls(len(used), pa.binary())], names=["kind", "id", "n", "c", "c2", "vec"])

    return docs.mapInArrow(tidied(run), INFO)


# ---------------------------------------------------------------- groups of classes that meet on a rare shingle

def prefix_lengths(n: int) -> tuple[int, int]:
    """(index, probe) prefix: of a linked pair the smaller set's index prefix
    meets the larger set's probe prefix."""
    num, den = SIM
    return n - -(-2 * num * n // (num + den)) + 1, n - -(-num * n // den) + 1


def _rare_keys(docs: DataFrame, rarity, buckets: int, renamed: dict) -> DataFrame:
    """Rows (bucket, keys, classes, sizes): for each task and bucket, the rare
    shingles of its classes as flat arrays (size is 2n, plus 1 if probe only)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, order, seen = shingler(), rarity.value, set()
        keys, classes, sizes, held = [], [], [], 0

        def flush():
            k, c, n = (np.concatenate(x) for x in (keys, classes, sizes))
            b = (k % np.uint64(buckets)).astype(np.int64)
            at = np.argsort(b, kind="stable")
            cuts = np.flatnonzero(np.diff(b[at])) + 1
            own = np.split(at, cuts)
            return pa.RecordBatch.from_arrays(
                [pa.array(b[[x[0] for x in own]]), *(pa.array([v[x].tobytes() for x in own], pa.binary()) for v in (k, c, n))],
                names=["bucket", "keys", "classes", "sizes"])

        for texts in _texts(batches):
            for own in shingles([t for (t,) in texts]):
                if not len(own):
                    continue
                c = class_number(own, renamed)
                if c in seen:                           # a copy in this task
                    continue
                if len(seen) < 1_000_000:
                    seen.add(c)
                index, probe = prefix_lengths(len(own))
                rare = own[np.argsort(order[_rarity_group(own)], kind="stable")[:probe]]
                keys.append(rare)
                classes.append(np.full(probe, c, dtype=np.int64))
                size = np.full(probe, 2 * len(own), dtype=np.int64)
                size[index:] += 1
                sizes.append(size)
                held += probe
            if held > FLUSH_KEYS:
                yield flush()
                keys, classes, sizes, held = [], [], [], 0
        if held:
            yield flush()

    return docs.mapInArrow(tidied(run), "bucket long, keys binary, classes binary, sizes binary")


def _priority(c: np.ndarray) -> np.ndarray:
    """One order of classes for all trees."""
    x = (c.astype(np.uint64) ^ (c.astype(np.uint64) >> np.uint64(33))) * _MUL
    return x ^ (x >> np.uint64(29))


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes that meet on a rare shingle, under the first of them: (block, c,
    n), where ``block`` is the class of the group that comes first in priority.
    Groups with one first member are one block, so classes that meet on many
    shingles meet in few blocks."""
    k, c, n = [], [], []
    for batch in batches:
        for col, out, kind in (("keys", k, np.uint64), ("classes", c, np.int64), ("sizes", n, np.int64)):
            out.extend(np.frombuffer(x.as_py(), dtype=kind) for x in batch.column(col))
    if not k:
        return
    k, c, n = np.concatenate(k), np.concatenate(c), np.concatenate(n)
    at = np.lexsort((n, c, k))
    k, c, n = k[at], c[at], n[at]
    one = np.ones(len(k), dtype=bool)                   # a class met twice (copies in two tasks) counts once
    one[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    k, c, n = k[one], c[one], n[one]
    start = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    length = np.diff(np.concatenate((start, [len(k)])))
    good = (length >= 2) & (np.add.reduceat((n & 1) == 0, start) >= 1)
    rank = _priority(c)
    first = np.repeat(np.minimum.reduceat(rank, start), length) == rank
    block = np.repeat(c[first], length)                 # priority is one to one, so each group has one first
    member = np.repeat(good, length)
    block, c, n = block[member], c[member], n[member] >> 1
    at = np.lexsort((c, block))
    block, c, n = block[at], c[at], n[at]
    new = np.ones(len(c), dtype=bool)
    new[1:] = (block[1:] != block[:-1]) | (c[1:] != c[:-1])
    block, c, n = block[new], c[new], n[new]
    for i in range(0, len(c), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 100_000]) for x in (block, c, n)], names=["block", "c", "n"])


# ---------------------------------------------------------------- R-tree

def needed_overlap(a, b):
    """Smallest overlap of two sets of sizes a and b that links them."""
    num, den = SIM
    return -(-num * (a + b) // (num + den))


class RTree:
    """Bulk-loaded R-tree over count vectors (rows of ``points``) with set
    sizes ``n``; a box keeps its upper corner and its smallest set size."""

    FAN = 16

    def __init__(self, points: np.ndarray, n: np.ndarray):
        self.points, self.n = points.astype(np.int64), n.astype(np.int64)
        order = self._tile(np.argsort(self.n, kind="stable"), 0)
        self.levels = []
        groups = [order[i:i + self.FAN] for i in range(0, len(order), self.FAN)]
        upper = np.array([self.points[g].max(axis=0) for g in groups])
        low = np.array([self.n[g].min() for g in groups])
        self.levels.append((groups, upper, low))
        while len(groups) > self.FAN:
            groups = [np.arange(i, min(i + self.FAN, len(groups))) for i in range(0, len(groups), self.FAN)]
            upper = np.array([upper[g].max(axis=0) for g in groups])
            low = np.array([low[g].min() for g in groups])
            self.levels.append((groups, upper, low))

    def _tile(self, rows: np.ndarray, depth: int) -> np.ndarray:
        """Sort-tile: halves by the coordinate with the widest spread."""
        if len(rows) <= self.FAN:
            return rows
        if depth:
            spread = self.points[rows].std(axis=0)
            rows = rows[np.argsort(self.points[rows, int(spread.argmax())], kind="stable")]
        half = (len(rows) // 2 + self.FAN - 1) // self.FAN * self.FAN
        return np.concatenate((self._tile(rows[:half], depth + 1), self._tile(rows[half:], depth + 1)))

    def search(self, q: np.ndarray, size: int) -> np.ndarray:
        """Rows whose summed minima with ``q`` reach the overlap needed."""
        groups, upper, low = self.levels[-1]
        nodes = np.arange(len(groups))
        for level in range(len(self.levels) - 1, -1, -1):
            groups, upper, low = self.levels[level]
            bound = np.minimum(upper[nodes], q).sum(axis=1)
            nodes = nodes[bound >= needed_overlap(low[nodes], size)]
            if not len(nodes):
                return nodes
            nodes = np.concatenate([groups[i] for i in nodes])
        bound = np.minimum(self.points[nodes], q).sum(axis=1)
        return nodes[bound >= needed_overlap(self.n[nodes], size)]


def _runs(batches, keys: list[str]):
    """Rows of each group of a stream sorted by ``keys``, as one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for x in cols:
            change |= x[1:] != x[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(x[a] for x in cols)
            if held and key != last:
                yield held
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield held


def _column(run, name):
    return np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in run])


class Points:
    """Count vectors of a block's members, with an R-tree over their first
    VEC-fold sums; long texts have longer vectors, compared where both have."""

    def __init__(self, c: np.ndarray, n: np.ndarray, vectors: list[np.ndarray]):
        self.c, self.n, self.vectors = c, n, vectors
        self.folds: dict[tuple[int, int], np.ndarray] = {}
        # two members need no tree
        self.tree = RTree(np.stack([self.fold(i, VEC) for i in range(len(c))]), n) if len(c) > 2 else None

    def fold(self, i: int, size: int) -> np.ndarray:
        """Counts over ``size`` coarser groups (a group is a hash's low bits)."""
        if (i, size) not in self.folds:
            v = self.vectors[i]
            self.folds[i, size] = v if len(v) == size else v.reshape(-1, size).sum(axis=0)
        return self.folds[i, size]

    def search(self, i: int) -> np.ndarray:
        """Members whose summed minima with member ``i`` reach the overlap a
        link needs."""
        if self.tree is None:
            return np.array([j for j in range(len(self.c)) if self.bound(i, j) >=
                             needed_overlap(int(self.n[i]), int(self.n[j]))], dtype=np.int64)
        near = self.tree.search(self.tree.points[i], int(self.n[i]))
        own = len(self.vectors[i])
        if own == VEC:
            return near
        return np.array([j for j in near.tolist() if len(self.vectors[j]) == VEC or self.bound(i, j) >=
                         needed_overlap(int(self.n[i]), int(self.n[j]))], dtype=np.int64)

    def bound(self, i: int, j: int) -> int:
        size = min(len(self.vectors[i]), len(self.vectors[j]))
        return int(np.minimum(self.fold(i, size), self.fold(j, size)).sum())


def _vectors(run) -> list[np.ndarray]:
    out = []
    for b in run:
        for x in b.column("vec"):
            v = np.frombuffer(x.as_py(), dtype=np.uint16).astype(np.int64)
            v[v == MANY] = 1 << 40                       # a count cut to MANY bounds nothing
            out.append(v)
    return out


def _points(run) -> tuple[Points, np.ndarray]:
    """The members of a block in order of priority, and that order."""
    c, n, v = _column(run, "c"), _column(run, "n"), _vectors(run)
    at = np.argsort(_priority(c), kind="stable")
    return Points(c[at], n[at], [v[i] for i in at.tolist()]), at


def _pairs_out(pairs: list[np.ndarray]) -> pa.RecordBatch:
    p = np.concatenate(pairs)
    return pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["a", "b"])


def _leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round 1: a point is paired with the first LEADERS points, in one order
    for all trees, whose search finds it."""
    out, held = [], 0
    for run in _runs(batches, ["block", "part"]):
        members, _ = _points(run)
        c = members.c
        led, found = np.zeros(len(c), dtype=np.int64), []
        for i in range(len(c)):
            if led[i] < LEADERS:
                near = members.search(i)
                near = near[(near > i) & (led[near] < LEADERS)]
                led[near] += 1
                if len(near):
                    found.append(np.stack([np.full(len(near), c[i]), c[near]], axis=1))
        out += found
        held += sum(map(len, found))
        if held > 50_000:
            yield _pairs_out(out)
            out, held = [], 0
    if held:
        yield _pairs_out(out)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round 2: pairs a search finds between different components."""
    out, held = [], 0
    for run in _runs(batches, ["block", "x", "y"]):
        comp, part = _column(run, "component"), _column(run, "part")
        if comp.min() == comp.max():
            continue
        members, at = _points(run)
        c, comp, part = members.c, comp[at], part[at]
        x, y = run[0].column("x")[0].as_py(), run[0].column("y")[0].as_py()
        for i in range(len(c)):
            near = members.search(i)
            near = near[(comp[near] != comp[i]) & (near > i) & ((x == y) | (part[near] != part[i]))]
            if len(near):
                pair = np.stack([np.full(len(near), c[i]), c[near]], axis=1)
                out.append(pair)
                held += len(near)
        if held > 50_000:
            yield _pairs_out(out)
            out, held = [], 0
    if held:
        yield _pairs_out(out)


# ---------------------------------------------------------------- verification

def _bits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each id in the fixed-size filter."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _MUL
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return ((x >> np.uint64(64 - FILTER_BITS)).astype(np.int64),
            ((x >> np.uint64(8)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64))


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of FILTER_BITS bits (a fixed 1 MB) over a column
    ``doc_id``; it only spares work, a join decides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, dtype=bool)
        for batch in batches:
            for at in _bits(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)):
                bits[at] = True
        words = np.packbits(bits).view(np.int64)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used])], names=["at", "word"])

    words = ids.mapInArrow(tidied(run), "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    out = np.zeros((1 << FILTER_BITS) // 64, dtype=np.int64)
    out[words["at"].to_numpy()] = words["word"].to_numpy()
    return out


def _sets(docs: DataFrame, wanted: DataFrame, renamed: dict) -> DataFrame:
    """(c, s): the shingle sets of the documents ``wanted`` (doc_id; the class
    where every row of it has a null id) and of few others that the filter lets
    pass."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, shingles, seen = np.unpackbits(shared.value.view(np.uint8)).astype(bool), shingler(), set()

        def passes(ids: np.ndarray) -> np.ndarray:
            one, two = _bits(ids)
            return bits[one] & bits[two]

        def asked():
            for batch in batches:
                known = batch.column("doc_id").is_valid()
                ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(passes(ids) | ~known.to_numpy(zero_copy_only=False)))

        for held in _texts(asked(), "doc_id"):
            sets = shingles([t for _, t in held])
            c = np.array([class_number(x, renamed) for x in sets], dtype=np.int64)
            named, out = passes(c), []
            for k, (i, _) in enumerate(held):               # a row without an id is asked for by its class
                if (i is not None or named[k]) and int(c[k]) not in seen:
                    out.append(k)
                    if len(seen) < 1_000_000:
                        seen.add(int(c[k]))
            yield pa.RecordBatch.from_arrays([pa.array(c[out]), pa.array([sets[k].tobytes() for k in out], pa.binary())],
                                             names=["c", "s"])

    return docs.mapInArrow(tidied(run), "c long, s binary")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    inter = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return SIM[1] * inter >= SIM[0] * (len(a) + len(b) - inter)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task group: first the leaders' sets (role 0), then members with the
    leaders to compare.  Pairs that links of the group already connect are
    skipped, so what comes out is a forest."""
    leaders: dict[int, np.ndarray] = {}
    parent: dict[int, int] = {}
    key, out = None, []

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(p, p)
        return x

    for batch in batches:
        for g, salt, role, c, s, against in zip(*(batch.column(k) for k in ("g", "salt", "role", "c", "s", "against"))):
            now, c, own = (g.as_py(), salt.as_py()), c.as_py(), np.frombuffer(s.as_py(), dtype=np.uint64)
            if now != key:
                leaders, parent, key = {}, {}, now
            if role.as_py() == 0:
                leaders[c] = own
                continue
            for a in against.as_py():
                if root(a) != root(c) and linked(leaders[a], own):
                    parent[root(a)] = root(c)
                    out.append((a, c))
        if out:
            yield _pairs_out([np.array(out, dtype=np.int64)])
            out = []


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, label: str, renamed: dict) -> DataFrame:
    """Links among the pairs (a, b) of classes, up to what other links connect.

    A member b is compared with its leaders a; members with one first leader
    meet in one task (many: dealt over salts), where each leader's set comes
    once and each member's set once.
    """
    pairs = written(pairs.distinct(), f"{label}-pairs")
    per = pairs.groupBy("b").agg(F.min("a").alias("g"), F.ceil(F.count(F.lit(1)) / AGAINST).cast("int").alias("chunks"))
    chunked = pairs.join(per, "b").withColumn("chunk", F.pmod(F.xxhash64("a"), F.col("chunks")).cast("int"))
    lists = chunked.groupBy("b", "g", "chunk").agg(F.collect_list("a").alias("against"))      # about AGAINST each
    salts = per.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("salts"))
    lists = lists.join(salts, "g").withColumn("salt", F.pmod(F.xxhash64("b", "chunk"), F.col("salts")).cast("int"))
    lists = written(lists.select("g", "salt", F.col("b").alias("c"), "against"), f"{label}-lists")
    none = F.array().cast("array<bigint>")
    leaders = lists.select("g", "salt", F.explode("against").alias("c")).distinct()
    asks = written(leaders.select("g", "salt", F.lit(0).alias("role"), "c", none.alias("against"))
                   .unionByName(lists.select("g", "salt", F.lit(1).alias("role"), "c", "against")), f"{label}-asks")
    wanted = asks.select("c").distinct().join(classes.select("c", F.coalesce("rep", "c").alias("doc_id")), "c").select("doc_id")
    rows = asks.join(_sets(docs, wanted, renamed), "c").select("g", "salt", "role", "c", "s", "against")
    rows = rows.repartition("g", "salt").sortWithinPartitions("g", "salt", "role")
    return written(rows.mapInArrow(tidied(_verify), "a long, b long"), f"{label}-links")


# ---------------------------------------------------------------- operator

def _classes(rows: DataFrame, label: str) -> DataFrame:
    """One row per class number: c, rep (smallest doc_id), n, vec, and clash
    (different sets have it)."""
    same = (rows.where("n > 0").groupBy("c")
            .agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), (F.min("c2") != F.max("c2")).alias("clash"),
                 F.min("vec").alias("vec")))
    return written(same, label)


def _renumbered(rows: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame, dict]:
    """``rows`` and ``classes`` with a number of its own for each set, and the
    numbers given, by whole digest.  Different sets that share 64 digest bits
    are about the square of their count in 2^65: three or so among 10^10 sets,
    which is what comes to the driver."""
    import hashlib
    if classes.where("clash").isEmpty():
        return rows, classes, {}
    shared = classes.where("clash").select("c")
    digests = sorted((r.c, r.c2) for r in rows.where("n > 0").join(F.broadcast(shared), "c").select("c", "c2").distinct().collect())
    renamed, last = {}, None
    for c, c2 in digests:
        if c == last:                                   # the first keeps the number
            raw = b"".join(x.to_bytes(8, "little", signed=True) for x in (c, c2))
            renamed[c, c2] = int.from_bytes(hashlib.blake2b(raw, digest_size=8, person=b"renumber").digest(), "little", signed=True)
        last = c
    given = rows.sparkSession.createDataFrame([(c, c2, new) for (c, c2), new in renamed.items()], "c long, c2 long, _new long")
    rows = (rows.join(F.broadcast(given), ["c", "c2"], "left").withColumn("c", F.coalesce("_new", "c"))
            .select("doc_id", "n", "c", "c2", "vec"))
    classes = _classes(rows, "ngram-reclassed")
    if not classes.where("clash").isEmpty():            # 64 bits of two digests met twice
        raise ValueError("two sets share one class number after renumbering")
    return rows, classes, renamed


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id (smallest doc_id with
    an equal set), component_id (smallest doc_id reachable by links)."""
    return _numbered(docs, text, doc_id)[0].select("doc_id", F.col("n").alias("n_shingles"), "class_id", "component_id")


def _numbered(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, dict]:
    """``jaccard_components`` with the numbers of a row's class (c) and of its
    component, which rows without an id have too; null for an empty set.  Also
    the class numbers that were given anew (``_renumbered``)."""
    spark = docs.sparkSession
    base = _binary_docs(docs, text, doc_id)
    info = written(_describe(base), "ngram-info")
    rows = info.where("kind = 0").select(F.col("id").alias("doc_id"), "n", "c", "c2", "vec")
    total = rows.agg(F.sum("n")).first()[0] or 0

    counts = info.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).toArrow()   # at most 2^17 rows
    corpus = np.zeros(1 << RARITY_BITS, dtype=np.int64)
    corpus[counts["id"].to_numpy()] = counts["n"].to_numpy()
    order = np.empty(len(corpus), dtype=np.uint16)                                        # a group's rank, in 16 bits
    order[np.argsort(corpus, kind="stable")] = np.arange(len(corpus)) >> max(0, RARITY_BITS - 16)
    rarity = spark.sparkContext.broadcast(order)                                          # fixed size, 256 KB

    rows, classes, renamed = _renumbered(rows, _classes(rows, "ngram-classes"))

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // 4 // KEYS_PER_TASK))
    keys = _rare_keys(base, rarity, 4 * tasks, renamed).repartition(tasks, "bucket")
    met = written(keys.mapInArrow(tidied(_meeting), "block long, c long, n long").distinct(), "ngram-met")
    parts = met.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / TREE).cast("long").alias("parts"))
    blocks = written(met.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("c"), F.col("parts"))), "ngram-blocks")

    def with_vectors(df: DataFrame, by: list[str]) -> DataFrame:
        df = df.join(classes.select("c", "vec"), "c")
        return df.repartition(*by).sortWithinPartitions(*by)

    # round 1; the first member of a block that is cut joins every part
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    guests = blocks.where("c = block AND parts > 1").withColumn("_p", others).where("_p <> part").withColumn("part", F.col("_p")).drop("_p")
    first = with_vectors(blocks.unionByName(guests), ["block", "part"]).mapInArrow(tidied(_leaders), "a long, b long")
    links = _verified(first, classes, base, "ngram-1", renamed)
    comp = components(links)

    # round 2: blocks that still hold different components, in pairs of parts
    known = blocks.join(comp.withColumnRenamed("id", "c"), "c", "left")
    known = written(known.withColumn("component", F.coalesce("component", "c")), "ngram-known")
    mixed = (known.groupBy("block").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo <> hi").select("block"))
    spread = (known.join(mixed, "block", "left_semi").withColumn("_o", others)
              .withColumn("x", F.least("part", "_o")).withColumn("y", F.greatest("part", "_o")))
    second = with_vectors(spread, ["block", "x", "y"]).mapInArrow(tidied(_across), "a long, b long")
    more = _verified(second, classes, base, "ngram-2", renamed)
    # round 2's links join whole components of round 1, so only those are settled anew
    def within(df: DataFrame, col: str) -> DataFrame:
        of = comp.select(F.col("id").alias(col), "component")
        return df.join(of, col, "left").withColumn(col, F.coalesce("component", col)).drop("component")

    wider = components(written(within(within(more, "a"), "b").distinct(), "ngram-wider"))
    wider = wider.select(F.col("id").alias("component"), F.col("component").alias("_wider"))

    # names: the smallest doc_id of a component and of a class
    named = (within(classes.select("c", "rep", F.col("c").alias("_own")), "_own").withColumnRenamed("_own", "component")
             .join(wider, "component", "left")
             .select("c", "rep", F.coalesce("_wider", "component").alias("component")))
    named = written(named, "ngram-named")
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = written(named.join(smallest, "component").select("c", F.col("rep").alias("class_id"), "component_id", "component"), "ngram-names")
    out = rows.where("n > 0").select("doc_id", "n", "c").join(named, "c")
    none = F.lit(None).cast("long")
    empty = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"),
                                       none.alias("c"), none.alias("component"))
    return out.select(*empty.columns).unionByName(empty), renamed


def one_per_component(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: of the smallest doc_id (null
    last), then the smallest class number, then the smallest row.  Rows with an
    empty set link with nothing and stay."""
    numbered, renamed = _numbered(docs, text, doc_id)
    rows = written(numbered.where("n > 0").select("doc_id", "c", "component", "component_id"), "ngram-rows")
    # a row is told by (doc_id, class): an id may repeat with other texts, or be null
    named = F.col("doc_id").eqNullSafe(F.col("component_id"))
    able = rows.where(named).groupBy("component", "doc_id", "c").agg(F.count(F.lit(1)).alias("copies"))
    best = able.groupBy("component").agg(F.min("c").alias("best"))
    able = able.join(best, "component").withColumn("stays", F.col("c") == F.col("best")).where("NOT stays OR copies > 1")
    told = written(rows.where(~named).select("doc_id", "c", F.lit(False).alias("stays")).distinct()
                   .unionByName(able.select("doc_id", "c", "stays")), "ngram-told")
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(told.where("doc_id IS NOT NULL").select("doc_id")))
    i, c, stays, row = (spare(docs, x) for x in ("_doc", "_class", "_stays", "_row"))

    def maybe(batch: pa.RecordBatch, bits: np.ndarray) -> np.ndarray:
        ids = batch.column(doc_id).cast(pa.int64())
        one, two = _bits(ids.fill_null(0).to_numpy(zero_copy_only=False))
        return (bits[one] & bits[two]) | ids.is_null().to_numpy(zero_copy_only=False)

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value.view(np.uint8)).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(~maybe(batch, bits)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, shingles = np.unpackbits(shared.value.view(np.uint8)).astype(bool), shingler()
        for batch in batches:
            batch = batch.filter(pa.array(maybe(batch, bits)))
            texts = pa.RecordBatch.from_arrays([batch.column(text).cast(pa.binary())], names=["text"])
            classes = [class_number(x, renamed) if len(x) else None for held in _texts([texts])
                       for x in shingles([t for (t,) in held])]
            yield pa.RecordBatch.from_arrays([*batch.columns, batch.column(doc_id).cast(pa.int64()), pa.array(classes, pa.int64())],
                                             names=[*batch.schema.names, i, c])

    # most rows are told apart by the filter and need no shuffle; a join decides the others
    told = told.select(F.col("doc_id").alias(f"{i}2"), F.col("c").alias(f"{c}2"), F.col("stays").alias(stays))
    schema = StructType([*docs.schema.fields, StructField(i, LongType()), StructField(c, LongType())])
    met = docs.mapInArrow(tidied(keyed), schema)
    met = met.join(told, met[i].eqNullSafe(told[f"{i}2"]) & (met[c] == told[f"{c}2"]), "left")
    met = written(met.where(F.col(stays).isNull() | F.col(stays)).select(*docs.columns, i, c, stays), "ngram-met-rows")
    once = (met.where(F.col(stays)).groupBy(i, c).agg(F.min(F.struct(*docs.columns)).alias(row)).select(f"{row}.*"))
    return (docs.mapInArrow(tidied(passing), docs.schema)
            .unionByName(met.where(F.col(stays).isNull()).select(*docs.columns)).unionByName(once))


def op2(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "class_id")
