"""Second-order boosted trees grown level by level on histograms.

Training rows are binned once (at most ``MAX_BINS`` quantile bins a feature),
packed into blocks of ``BLOCK_ROWS`` rows and dealt over the tasks.  A level of a
tree is one pass over the blocks: every task sums gradients and hessians of the
logistic loss by (setting, node, feature, bin), the sums of all tasks are added,
and the split of each node is the bin with the highest second-order gain

    GL^2 / (HL + lambda) + GR^2 / (HR + lambda) - G^2 / (H + lambda),

a loss reduction summed over the node's rows, so ``gamma`` prunes on the same
scale as in the reference's booster; a leaf's value is -rate * G / (H + lambda).
Boosting starts from the training rows' log-odds.

* **No refit.**  The margin is kept with the blocks: a finished tree is added to
  it once, and the first pass of the next tree also gives the validation loss.  A
  fit ends ``patience`` rounds after its best round and is cut to that round.
* **Few rows: a task a setting.**  Rows that fit into ``WHOLE_BYTES`` are not passed
  level by level.  A task takes all blocks and grows its setting to the end by the
  same steps, keeping margins, gradients and nodes; the settings are grown side by side.
* **Many settings in one scan.**  Beyond that all settings of a search grow in the
  same passes (``fit_many``); histograms carry the setting, margins a row per setting.
* **Same result under any partitioning.**  Gradients and hessians are rounded to
  multiples of 2^-24, whose sums are exact in doubles in any order; row samples
  hash the row's key with the tree's number; ties go to the lowest feature, then bin.
* **Half the sums.**  Of two children only the one with the smaller cover is summed;
  the other's sums are the parent's less those, exactly (see above).
* **Scale.**  A pass moves histograms, never rows.  With few tasks their sums are
  added on the driver, else shuffled by node and added in tasks.  The sums of up to
  ``KEPT_SLOTS`` nodes reach the driver; beyond that tasks search them for splits
  and the driver receives one row per node.  A task holds ``TASK_BYTES`` of blocks, passed as
  plain bytes, and two frames of margins are kept at most.  Every ``KEEP_ROUNDS`` rounds they are
  checkpointed, which cuts the lineage: a lost executor repeats at most that many additions of its blocks.
* **Cuts.**  Tasks sort and count the values of their rows; summaries of up to
  ``SUMMARY`` values a feature are merged pairwise.  With fewer distinct values the
  cuts are the exact quantiles, else each merge adds at most 1 / ``SUMMARY`` to a rank's error.

Missing and NaN feature values count as 0, as in the reference's frames.  Without
validation rows the training loss picks the round; without training rows, or with
one label only, the model is its base rate.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import FEATURES
from ..session import ensure_checkpoint_dir
from .dataset import LABEL, with_split

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 256          # the reference booster's default
BLOCK_ROWS = 16_384
KEEP_ROUNDS = 10
DIRECT_TASKS = 32
DIRECT_SUMS = 2048      # sums of (task, slot) that the driver adds, 70 KB each at most
KEPT_SLOTS = 512        # slots of a level whose sums are kept for the next one
TASK_BYTES = 64 << 20   # blocks that one task holds
WHOLE_BYTES = 192 << 20  # rows that one task may hold to grow a setting alone
SUMMARY = 1 << 16       # values that stand for those of a feature
_GRAIN = float(1 << 24)
_TINY = 1e-6            # smallest gain of a split, as in the reference's booster

BLOCKS = ("n_train int, n_val int, known int, positive int, bins binary, y binary, key binary, val_bins binary, val_y binary")


@dataclass(frozen=True)
class Setting:
    """One configuration, in the reference booster's terms and defaults."""
    n_estimators: int = 1000
    learning_rate: float = 0.05
    max_depth: int = 6
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    gamma: float = 0.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0

    @staticmethod
    def of(params: dict) -> "Setting":
        whole = {"n_estimators", "max_depth"}
        return Setting(**{k: int(v) if k in whole else float(v) for k, v in params.items()})


@dataclass
class Tree:
    """Nodes in order of creation (0 is the root).  A leaf has feature -1 and
    points to itself; ``value`` is its share of the margin."""
    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    cover: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def add(self) -> int:
        i = len(self.feature)
        for name, v in (("feature", -1), ("bin", MAX_BINS), ("left", i), ("right", i), ("gain", 0.0),
                        ("cover", 0.0), ("value", 0.0)):
            getattr(self, name).append(v)
        return i

    def arrays(self):
        return (np.maximum(np.array(self.feature, np.int32), 0), np.array(self.bin, np.int32),
                np.array(self.left, np.int32), np.array(self.right, np.int32), np.array(self.value, np.float64))


@dataclass
class Fit:
    """A finished ensemble: the trees up to the best round and the losses after
    0, 1, 2, ... rounds."""
    setting: Setting
    base: float
    trees: list
    losses: list


# ---- in tasks ----------------------------------------------------------------

def _walk(tree, bins, depth, node=None):
    """Nodes of the rows (columns of ``bins``), ``depth`` steps after ``node`` (the root)."""
    feature, cut, left, right, _ = tree
    n = bins.shape[1]
    flat, rows, begin = bins.reshape(-1), np.arange(n), feature.astype(np.int64) * n
    children = np.stack([right, left], axis=1).ravel().astype(np.int64)
    node = np.zeros(n, np.int64) if node is None else node.astype(np.int64)
    for _ in range(depth):
        goes_left = flat.take(begin.take(node) + rows) <= cut.take(node)
        node = children.take(2 * node + goes_left)
    return node


def _mix(key, salt):
    """splitmix64 of key + salt, as a double in [0, 1)."""
    with np.errstate(over="ignore"):
        z = key + np.uint64(salt & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53)


class _Block:
    """Some rows: bins, labels and key digests of the training rows, bins and labels
    of the validation rows, and a margin per setting of both."""

    def __init__(self, fields, n_features):
        n_train, n_val, _, _, bins, y, key, val_bins, val_y = fields[:9]
        self.n_train, self.n_val = n_train, n_val
        self.bins = np.frombuffer(bins, np.uint8).reshape(n_features, n_train)
        self.y, self.key = np.frombuffer(y, np.uint8), np.frombuffer(key, np.uint64)
        self.val_bins = np.frombuffer(val_bins, np.uint8).reshape(n_features, n_val)
        self.val_y = np.frombuffer(val_y, np.uint8)
        self.margin = np.frombuffer(fields[9], np.float64).reshape(-1, n_train)
        self.val_margin = np.frombuffer(fields[10], np.float64).reshape(-1, n_val)
        self.node = self.gh = None      # kept from level to level where a task holds the block


def _packer(cuts, block_rows):
    """Arrow batches of (features..., label, is_validation, key) to blocks."""
    def pack(batches):
        import pyarrow as pa

        def block(parts):
            x = [np.concatenate([p[0][f] for p in parts]) for f in range(len(cuts))]
            y, val, key = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
            bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x)]).astype(np.uint8)
            known, val = val == 0, val == 1     # rows without a key train, but do not count in the base rate
            return pa.RecordBatch.from_pydict({
                "n_train": pa.array([int((~val).sum())], pa.int32()), "n_val": pa.array([int(val.sum())], pa.int32()),
                "known": pa.array([int(known.sum())], pa.int32()), "positive": pa.array([int(y[known].sum())], pa.int32()),
                "bins": [bins[:, ~val].tobytes()], "y": [y[~val].tobytes()], "key": [key[~val].tobytes()],
                "val_bins": [bins[:, val].tobytes()], "val_y": [y[val].tobytes()]})

        held, rows = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                b = batch.slice(start, block_rows)
                x = [np.array(b.column(f)) for f in range(len(cuts))]
                x = [np.where(np.isnan(v), 0.0, v) for v in x]
                held.append((x, np.array(b.column(len(cuts))).astype(np.uint8),
                             np.array(b.column(len(cuts) + 1)).astype(np.uint8),
                             np.array(b.column(len(cuts) + 2)).astype(np.int64).view(np.uint64)))
                rows += b.num_rows
                if rows >= block_rows:
                    yield block(held)
                    held, rows = [], 0
        if held:
            yield block(held)
    return pack


def _starter(n_settings, base, keyed):
    """Blocks with their first margins; key digests go where rows are sampled."""
    def start(f):
        return (*f[:6], f[6] if keyed else b"", *f[7:9], np.full((n_settings, f[0]), base).tobytes(),
                np.full((n_settings, f[1]), base).tobytes())
    return start


def _adder(n_features, trees):
    """Blocks with the finished trees of a round added to their margins;
    ``trees``: (column, arrays, depth)."""
    def add(fields):
        b = _Block(fields, n_features)
        margin, val_margin = b.margin.copy(), b.val_margin.copy()
        for m, tree, depth in trees:
            margin[m] += tree[4][_walk(tree, b.bins, depth)]
            val_margin[m] += tree[4][_walk(tree, b.val_bins, depth)]
        return (*fields[:9], margin.tobytes(), val_margin.tobytes())
    return add


def _losses(margin, y):
    p = 1.0 / (1.0 + np.exp(-margin))
    loss = np.round(-np.log(np.clip(np.where(y == 1, p, 1 - p), 1e-15, 1.0)) * _GRAIN) / _GRAIN
    return loss.sum()


def _gradients(margin, y):
    """Gradient and hessian of rows, as one complex number each."""
    p = 1.0 / (1.0 + np.exp(-margin))
    out = np.empty(len(p), np.complex128)
    out.real = np.round((p - y) * _GRAIN) / _GRAIN
    out.imag = np.round(np.maximum(p * (1 - p), 1e-16) * _GRAIN) / _GRAIN
    return out


def _sum_blocks(blocks, n_features, cells, work, level, train_loss, keep):
    """Sums of one level over blocks: {slot: sums}.

    ``work``: per growing setting (column, tree arrays, slots per node, columns
    of the tree, subsample, salt, first slot, depth).  Slot -1 - m has the losses of
    setting m (level 0 only).  ``cells``: the bins of each feature that can have rows.
    ``keep``: blocks keep nodes and gradients for the next level."""
    n_slots = sum(int(w[2].max()) + 1 for w in work)
    acc = np.zeros((n_features, n_slots * MAX_BINS), np.complex128)
    losses, seen = {w[0]: np.zeros(4) for w in work}, False
    for b in blocks:
        seen = True
        for m, tree, slots, columns, share, salt, first, depth in work:
            if level == 0:
                losses[m] += (_losses(b.val_margin[m], b.val_y), b.n_val,
                              _losses(b.margin[m], b.y) if train_loss else 0.0, b.n_train)
                if keep:    # 24 bits hold both sums of a row
                    b.node, b.gh = np.zeros(b.n_train, np.int32), _gradients(b.margin[m], b.y).astype(np.complex64)
            elif keep:
                b.node = _walk(tree, b.bins, 1, b.node).astype(np.int32)
            if depth:
                slot = slots.take(b.node if keep else _walk(tree, b.bins, depth))
                use = slot >= 0
            else:
                slot, use = None, np.ones(b.n_train, bool)
            if share < 1.0:
                use &= _mix(b.key, salt) < share
            rows = np.flatnonzero(use)
            if not len(rows):
                continue
            gh = b.gh.take(rows).astype(np.complex128) if keep else _gradients(b.margin[m].take(rows), b.y.take(rows))
            at = np.int64(first * MAX_BINS) if slot is None else (slot.take(rows).astype(np.int64) + first) * MAX_BINS
            for f in columns:
                np.add.at(acc[f], b.bins[f].take(rows) + at, gh)
    if not seen:
        return {}
    out, acc = {}, acc.reshape(n_features, n_slots, MAX_BINS)
    for w in work:
        if level == 0:
            out[-1 - w[0]] = losses[w[0]]
        for s in range(w[6], w[6] + int(w[2].max()) + 1):
            whole = acc[w[3], s][cells[w[3]]]
            out[s] = np.stack([whole.real, whole.imag])
    return out


def _summer(n_features, cells, work, level, train_loss):
    """(slot, sums) of one level over a task's blocks."""
    def run(fields):
        blocks = (_Block(f, n_features) for f in fields)
        return list(_sum_blocks(blocks, n_features, cells, work, level, train_loss, False).items())
    return run


def _added(pairs):
    """Sums by slot: {slot: array}."""
    total: dict = {}
    for s, a in pairs:
        total[s] = total[s] + a if s in total else a
    return total


def _best_splits(sums, cut_counts, about):
    """Best split of each slot: feature, gain, bin, GL, HL, G, H (losses for the
    slots below 0).  ``about``: per slot the tree's columns, lambda and the
    minimum hessian of a child."""
    out = []
    bins = np.arange(MAX_BINS)
    for s, a in sums.items():
        if s < 0:
            out.append((s, 0, *a.tolist(), 0.0, 0.0))
            continue
        columns, lam, least = about[s]
        whole = np.zeros((2, len(columns), MAX_BINS))
        whole[:, bins <= cut_counts[columns][:, None]] = a
        gl, hl = np.cumsum(whole, axis=2)
        g, h = gl[0, -1], hl[0, -1]
        fits = (bins < cut_counts[columns][:, None]) & (hl >= least) & (h - hl >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = gl ** 2 / (hl + lam) + (g - gl) ** 2 / (h - hl + lam) - g * g / (h + lam)
        i, b = np.unravel_index(np.argmax(np.where(fits, gains, -np.inf)), gains.shape)
        out.append((s, int(columns[i]), float(gains[i, b]) if fits[i, b] else 0.0, float(b), float(gl[i, b]),
                    float(hl[i, b]), float(g), float(h)))
    return out


def _splitter(cut_counts, about):
    def run(pairs):
        return _best_splits(_added(pairs), cut_counts, about)
    return run


class _Held:
    """All blocks in one task, which grows one setting to the end."""

    def __init__(self, fields, n_features, counts, base, train_loss):
        self.blocks = [_Block(_starter(1, base, True)(f), n_features) for f in fields]
        for b in self.blocks:
            b.margin, b.val_margin = b.margin.copy(), b.val_margin.copy()
        self.n_features, self.counts, self.train_loss = n_features, counts, train_loss
        self.cells = np.arange(MAX_BINS) <= counts[:, None]

    def sums(self, work, level):
        return _sum_blocks(self.blocks, self.n_features, self.cells, work, level, self.train_loss, True)

    def splits(self, work, level, about):
        return {r[0]: r[1:] for r in _best_splits(self.sums(work, level), self.counts, about)}

    def passed(self):
        pass

    def add_trees(self, trees, number):
        _, tree, depth = trees[0]
        for b in self.blocks:
            b.margin[0] += tree[4][_walk(tree, b.bins, 1, b.node)]      # the last level's splits
            b.val_margin[0] += tree[4][_walk(tree, b.val_bins, depth)]


def _fitter(growing, n_features, counts, base, train_loss, patience):
    """A task that grows one setting on all blocks: (number, trees, losses)."""
    def run(fields):
        rows = _Held(fields, n_features, counts, base, train_loss)
        number, growing.column = growing.column, 0
        _grow(rows, [growing], patience, counts)
        yield number, [vars(t) for t in growing.trees[:growing.best()]], growing.losses
    return run


# ---- cuts, in tasks ------------------------------------------------------------

def _counted(values, counts):
    """Rising values and their counts, at most ``SUMMARY``: beyond that a value
    stands for those between it and the one before."""
    order = np.argsort(values, kind="stable")
    values, total = values[order], np.cumsum(counts[order])
    last = np.flatnonzero(np.append(values[1:] != values[:-1], True)) if len(values) else np.arange(0)
    values, total = values[last], total[last]
    if len(values) > SUMMARY:
        keep = np.unique(np.searchsorted(total, np.arange(1, SUMMARY + 1) * (total[-1] / SUMMARY) - 1e-6))
        values, total = values[keep], total[keep]
    return values, np.diff(total, prepend=0)


class _Summary:
    """Counted values of a feature; summaries of equal rank are merged, so that
    a value passes as many merges as the number of parts has digits."""

    def __init__(self):
        self.parts: list[tuple] = []

    def add(self, values, counts, rank=0):
        part = _counted(values, counts)
        while self.parts and self.parts[-1][0] <= rank:
            rank, (_, v, c) = rank + 1, self.parts.pop()
            part = _counted(np.concatenate([v, part[0]]), np.concatenate([c, part[1]]))
        self.parts.append((rank, *part))

    def whole(self):
        while len(self.parts) > 1:
            (_, v, c), (rank, w, d) = self.parts.pop(), self.parts.pop()
            self.parts.append((rank, *_counted(np.concatenate([v, w]), np.concatenate([c, d]))))
        return self.parts[0] if self.parts else (0, np.zeros(0), np.zeros(0, np.int64))


SUMMED = "feature int, rank int, vals binary, counts binary"


def _summary_rows(found):
    import pyarrow as pa
    for f, s in found.items():
        rank, v, c = s.whole()
        yield pa.RecordBatch.from_pydict({"feature": pa.array([f], pa.int32()), "rank": pa.array([rank], pa.int32()),
                                          "vals": [v.tobytes()], "counts": [c.astype(np.int64).tobytes()]})


def _summarise(n_features):
    def run(batches):
        found, held, rows = {f: _Summary() for f in range(n_features)}, [], 0

        def close():
            for f, s in found.items():
                s.add(*np.unique(np.concatenate([np.asarray(b.column(f)) for b in held]), return_counts=True))
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 1 << 17:
                close()
                held, rows = [], 0
        if rows:
            close()
        yield from _summary_rows(found)
    return run


def _merge_summaries(batches):
    found: dict = {}
    for batch in batches:
        for f, rank, v, c in zip(*(x.to_pylist() for x in batch.columns)):
            found.setdefault(f, _Summary()).add(np.frombuffer(v, np.float64), np.frombuffer(c, np.int64), rank)
    yield from _summary_rows(found)


def _cut_values(max_bins):
    def run(batches):
        import pyarrow as pa
        for merged in _merge_summaries(batches):
            v, c = (np.frombuffer(merged.column(i)[0].as_py(), t) for i, t in ((2, np.float64), (3, np.int64)))
            total = np.cumsum(c)
            at = np.ceil(np.arange(1, max_bins + 1) / max_bins * total[-1] - 1e-9) if len(v) else []
            cuts = v[np.minimum(np.searchsorted(total, at), len(v) - 1)] if len(v) else np.zeros(1)
            yield pa.RecordBatch.from_pydict({"feature": merged.column(0), "rank": merged.column(1), "vals": [cuts.tobytes()],
                                              "counts": [b""]})
    return run


# ---- on the driver -----------------------------------------------------------

def quantile_cuts(train: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """At most ``max_bins`` - 1 rising cut values a feature (a row's bin is the
    number of cuts below it); the largest value is no cut."""
    clean = [F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"f{i}") for i, f in enumerate(features)]
    parts = train.select(*clean).mapInArrow(_summarise(len(features)), SUMMED).repartition(len(features), "feature")
    found = {r["feature"]: np.unique(np.frombuffer(r["vals"], np.float64))
             for r in parts.mapInArrow(_cut_values(max_bins), SUMMED).collect()}
    return [found.get(f, np.zeros(1))[:-1] for f in range(len(features))]


class Blocks:
    """The binned training and validation rows of a table, dealt over ``tasks``;
    their shuffled files are read again by every fit."""

    def __init__(self, master: DataFrame, features: list[str] = FEATURES, label: str = LABEL, n_settings: int = 1,
                 cuts: list[np.ndarray] | None = None, partitions: int | None = None, block_rows: int = BLOCK_ROWS):
        self.spark, self.features = master.sparkSession, list(features)
        ensure_checkpoint_dir(self.spark)
        rows = with_split(master).select(
            *[F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f) for f in features],
            F.coalesce(F.col(label).cast("int"), F.lit(0)).alias("_y"), F.coalesce(F.col("is_validation").cast("int"), F.lit(2)).alias("_val"),
            F.xxhash64("user_id", "product_id").alias("_key"))
        self.cuts = quantile_cuts(rows.where("_val = 0"), self.features) if cuts is None else cuts
        self.counts = np.array([len(c) for c in self.cuts])
        n_rows = master.count()
        parallel = self.spark.sparkContext.defaultParallelism
        whole = n_rows * (len(features) + 10 + 8 * n_settings)
        # a task passes its blocks through memory, so more rows or settings make more tasks, as many for each core
        per_core = max(1, -(-whole // (TASK_BYTES * parallel)))
        self.tasks = tasks = partitions or max(1, min(-(-n_rows // block_rows), per_core * parallel))
        # rows are packed where they are; only packed blocks move
        packed = rows.mapInArrow(_packer(self.cuts, block_rows), BLOCKS).rdd
        self.rows = (packed.mapPartitionsWithIndex(lambda p, it: ((p + i, tuple(r)) for i, r in enumerate(it)))
                     .partitionBy(tasks, lambda k: k).values())
        sizes = self.rows.map(lambda f: np.array(f[:4], np.int64)).collect()
        n_held, n_val, self.n_train, positive = (int(x) for x in sum(sizes, np.zeros(4, np.int64)))
        self.n_rows = n_held + n_val
        self.mixed = 0 < positive < self.n_train
        rate = min(max(positive / self.n_train if self.n_train else 0.5, 1e-6), 1 - 1e-6)
        self.base = math.log(rate / (1 - rate))
        # a task's memory where it holds all rows: bins, label, key, margin, node, gradients
        self.fits_a_task = partitions is None and self.n_rows * (len(features) + 29) <= WHOLE_BYTES
        self.train_loss = n_val == 0
        self.held, self.written = [], None

    def start(self, n_settings: int, keyed: bool) -> None:
        self.state = self.rows.map(_starter(n_settings, self.base, keyed)).persist(StorageLevel.MEMORY_AND_DISK)
        self.held = [self.state]

    def add_trees(self, trees, number: int) -> None:
        """Add a round's trees to the margins; every ``KEEP_ROUNDS`` rounds the next
        pass checkpoints them.  At most two frames are kept, the one before until the
        new one is whole (``settle``)."""
        self.state = self.state.map(_adder(len(self.features), trees)).persist(StorageLevel.MEMORY_AND_DISK)
        if number % KEEP_ROUNDS == 0:
            self.state.checkpoint()
        self.held.append(self.state)

    def settle(self, held: list) -> None:
        """After a pass over the newest frame: release those before it, and the
        checkpoint before its own."""
        for old in held[:-1]:
            old.unpersist()
        del held[:-1]
        file = self.state.getCheckpointFile()
        if file and file != self.written:
            self._forget()
            self.written = file

    def passed(self) -> None:
        self.settle(self.held)

    def sums(self, work, level: int) -> dict:
        """One pass over the blocks: {slot: sums}, of at most ``KEPT_SLOTS`` slots."""
        hist, direct = _pass(self, work, level)
        return _added(hist.collect() if direct else hist.reduceByKey(np.add, min(self.tasks, 64)).collect())

    def splits(self, work, level: int, about) -> dict:
        """One pass over the blocks: {slot: best split and totals}."""
        hist, direct = _pass(self, work, level)
        if direct:
            rows = _best_splits(_added(hist.collect()), self.counts, about)
        else:
            rows = hist.reduceByKey(np.add, min(self.tasks, 64)).mapPartitions(_splitter(self.counts, about)).collect()
        return {r[0]: r[1:] for r in rows}

    def _forget(self) -> None:
        if self.written:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.written)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.written = None

    def release(self) -> None:
        for old in self.held:
            old.unpersist()
        self.held = []
        self._forget()


def _pass(blocks: Blocks, work, level: int):
    """Sums of every task at one level, and whether the driver may add them."""
    cells = np.arange(MAX_BINS) <= blocks.counts[:, None]
    hist = blocks.state.mapPartitions(_summer(len(blocks.features), cells, work, level, blocks.train_loss))
    slots = sum(int(w[2].max()) + 1 for w in work)
    return hist, blocks.tasks <= DIRECT_TASKS and blocks.tasks * slots <= DIRECT_SUMS


class _Growing:
    """One setting on its way: trees so far, losses, the tree being grown."""

    def __init__(self, column: int, setting: Setting, n_features: int, seed: int):
        self.column, self.setting, self.n, self.seed = column, setting, n_features, seed
        self.trees: list[Tree] = []
        self.losses: list[float] = []

    def start(self) -> None:
        rng = np.random.default_rng([self.seed, len(self.trees)])
        k = max(1, int(self.setting.colsample_bytree * self.n))
        self.columns = np.sort(rng.permutation(self.n)[:k])
        self.salt = int(rng.integers(1 << 63))
        self.tree = Tree()
        self.open = [self.tree.add()]
        self.depth = 0
        self.pairs: list[tuple] = []    # (parent, left, right) of the last level's splits
        self.sums: dict = {}            # sums of the last level's nodes, if kept

    def choose(self, keep: bool) -> None:
        """The nodes whose rows are summed: with the parent's sums at hand the
        smaller child of a split, whose sums give the other's."""
        self.counted, self.rest = list(self.open), []
        if not keep:
            self.sums = {}
        wanted = set(self.open)
        for parent, left, right in self.pairs:
            if parent in self.sums and (left in wanted or right in wanted):
                small, large = (left, right) if self.tree.cover[left] <= self.tree.cover[right] else (right, left)
                if large in wanted:
                    self.counted.remove(large)
                    self.rest.append((parent, small, large))
                    if small not in wanted:
                        self.counted.append(small)

    def splits(self, sums: dict, first: int, counts) -> dict:
        """Best splits of the open nodes, from the sums of the counted ones."""
        own = {node: sums[first + i] for i, node in enumerate(self.counted)}
        for parent, small, large in self.rest:
            own[large] = self.sums[parent] - own[small]
        self.sums = own
        about = [(self.columns, self.setting.reg_lambda, self.setting.min_child_weight)] * len(self.open)
        return {r[0]: r[1:] for r in _best_splits({i: own[n] for i, n in enumerate(self.open)}, counts, about)}

    def work(self, first: int):
        slots = np.full(len(self.tree.feature), -1, np.int32)
        slots[self.counted] = np.arange(len(self.counted))
        return (self.column, self.tree.arrays(), slots, self.columns, self.setting.subsample, self.salt, first, self.depth)

    def split(self, best: dict, first: int) -> None:
        s, t, nodes = self.setting, self.tree, []
        self.pairs = []
        for i, node in enumerate(self.open):
            f, gain, b, gl, hl, g, h = best[first + i]
            if self.depth == 0:
                t.cover[node], t.value[node] = h, -s.learning_rate * g / (h + s.reg_lambda)
            if not gain > max(s.gamma, _TINY):
                continue
            left, right = t.add(), t.add()
            self.pairs.append((node, left, right))
            t.feature[node], t.bin[node], t.left[node], t.right[node], t.gain[node] = f, int(b), left, right, gain
            for child, cg, ch in ((left, gl, hl), (right, g - gl, h - hl)):
                t.cover[child], t.value[child] = ch, -s.learning_rate * cg / (ch + s.reg_lambda)
                nodes.append(child)
        self.depth += 1
        least = 2 * s.min_child_weight
        self.open = [c for c in nodes if t.cover[c] >= least] if self.depth < s.max_depth else []

    def loss(self, sums) -> None:
        val, n_val, train, n_train = sums[:4]
        self.losses.append(val / n_val if n_val else train / n_train if n_train else 0.0)

    def best(self) -> int:
        """The round with the least loss (the first of several), 0 before any."""
        return min(range(1, len(self.losses)), key=self.losses.__getitem__, default=0)

    def done(self, patience: int) -> bool:
        rounds = len(self.losses) - 1
        return rounds >= self.setting.n_estimators or rounds - self.best() >= patience

    def fit(self, base: float) -> Fit:
        return Fit(self.setting, base, self.trees[:self.best()], self.losses)


def _grow(rows, every: list[_Growing], patience: int, counts) -> None:
    """Grow settings to their end, all in the same passes over ``rows``."""
    active, number = list(every), 0
    while active:
        for g in active:
            g.start()
        level = 0
        while any(g.open for g in active):
            growing = [g for g in active if g.open]
            keep = sum(len(g.open) for g in growing) <= KEPT_SLOTS
            firsts, work, about, first = {}, [], [], 0
            for g in growing:
                g.choose(keep)
                firsts[g.column] = first
                work.append(g.work(first))
                about += [(g.columns, g.setting.reg_lambda, g.setting.min_child_weight)] * len(g.counted)
                first += len(g.counted)
            if keep:
                sums = rows.sums(work, level)
            else:
                best = rows.splits(work, level, about)
            if level == 0:      # losses of the last round are known now: those at their end grow no further
                rows.passed()
                for g in growing:
                    g.loss(sums[-1 - g.column] if keep else best[-1 - g.column][1:])
                active = [g for g in active if not g.done(patience)]
                growing = [g for g in growing if g in active]
            for g in growing:
                if keep:
                    g.split(g.splits(sums, firsts[g.column], counts), 0)
                else:
                    g.split(best, firsts[g.column])
            level += 1
        if not active:
            break
        for g in active:
            g.trees.append(g.tree)
        number += 1
        rows.add_trees([(g.column, g.tree.arrays(), g.depth) for g in active], number)


def fit_many(master: DataFrame, settings: list[dict | Setting], seed: int = 42, patience: int = 50,
             features: list[str] = FEATURES, blocks: Blocks | None = None, **layout) -> tuple[list[Fit], Blocks]:
    """Grow one ensemble per setting: a task a setting where a task may hold all
    rows, else all in the same passes over the data.  ``blocks``: those of an
    earlier call on the same table.

    Each equals its single fit bit for bit (given the same cuts)."""
    todo = [s if isinstance(s, Setting) else Setting.of(s) for s in settings]
    blocks = blocks or Blocks(master, features, n_settings=len(todo), **layout)
    every = [_Growing(i, s, len(blocks.features), seed) for i, s in enumerate(todo)]
    if not blocks.mixed:
        pass
    elif blocks.fits_a_task:
        sc, one = blocks.spark.sparkContext, blocks.rows.coalesce(1)
        longest = sorted(every, key=lambda g: (-g.setting.max_depth, g.setting.learning_rate))
        tasks = [one.mapPartitions(_fitter(g, len(blocks.features), blocks.counts, blocks.base, blocks.train_loss, patience))
                 for g in longest]
        for i, trees, losses in sc.union(tasks).collect():
            every[i].trees, every[i].losses = [Tree(**t) for t in trees], losses
    else:
        try:
            blocks.start(len(todo), any(s.subsample < 1.0 for s in todo))
            _grow(blocks, every, patience, blocks.counts)
        finally:
            blocks.release()
    return [g.fit(blocks.base) for g in every], blocks


def node_rows(fit: Fit, blocks_cuts: list[np.ndarray]) -> list[tuple]:
    """(tree, node, feature, cut, left, right, gain, cover, value), leaves with
    feature -1: the model as a table."""
    rows = []
    for i, t in enumerate(fit.trees):
        for n in range(len(t.feature)):
            f = t.feature[n]
            cut = float(blocks_cuts[f][t.bin[n]]) if f >= 0 else math.inf
            rows.append((i, n, int(f), cut, int(t.left[n]), int(t.right[n]), float(t.gain[n]), float(t.cover[n]),
                         float(t.value[n])))
    return rows
