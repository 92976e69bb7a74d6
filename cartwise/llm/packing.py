"""Best-fit packing of tokenised documents into fixed-length sequences.

Every piece is an item with three sizes: tokens, one document, and attention
cost (tokens squared); a bin (sequence) has a capacity in each.  Vector
best-fit decreasing puts an item into the bin that fits under every
constraint with the smallest weighted residual norm (``rule="norm"``) or the
largest weighted dot product of item and residual (``rule="dot"``).

Pieces of one length are interchangeable, so the choice of bins needs only the
number of pieces of each length: at most ``capacity`` numbers, whatever the
corpus.  Those are packed as classes (all bins with the same residual move
together, described by runs of bin numbers); the result is a bounded table of
runs.  The pieces themselves stay distributed: a piece's rank within its length
is the count of that length in earlier partitions plus its place in its own,
and the rank's run gives sequence and offset.  So the packing is the global one
at any scale, no task holds more than its share, and full-length pieces (the
usual hot length) cost nothing extra.

Defined results: null text is empty and makes one piece of the end id alone;
only documents longer than the capacity are cut, into full pieces and a rest;
repeated rows are packed as rows of their own; ties between bins go to the bin
class opened first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.skew import sized_broadcast
from .common import table, trim, written

MAX_TOKENS = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
CACHE_WORDS = 400_000       # distinct pieces a worker remembers before it starts afresh
CACHE_CHARS = 128           # longer pieces are not remembered
TEXT_BYTES = 2_000_000      # text encoded at a time
BASE_ROWS = 300_000         # counts of (partition, length) that are broadcast, at most
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# Plain text: printable ASCII, white space and Latin letters that NFC leaves alone
# and whose lower case is one letter each.
_PLAIN = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
# The pieces the tokenizer splits (lower-cased) plain text into.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\t-\r a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def word_encoder(path: str):
    """list of texts (bytes) -> list of their ids (little-endian unsigned 32
    bit bytes).

    The tokenizer merges inside pieces only, so a text's ids are the ids of its
    pieces in turn, and a piece's ids are computed once per worker.  Plain text
    is lower-cased and split here by the tokenizer's own pattern; its runs of
    letters go through the tokenizer's merges many at a time.  Other text is
    split at ASCII white space, which the tokenizer drops and never joins
    across, and its words go through the whole tokenizer.
    """
    from tokenizers import Tokenizer, pre_tokenizers
    whole = Tokenizer.from_file(path)
    bare = Tokenizer(whole.model)
    bare.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    vocab = whole.get_vocab()
    ends = np.zeros(max(vocab.values()) + 1, dtype=bool)         # ids that end a piece
    ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
    cache: dict = {}                                             # pieces are str, other words bytes

    def ids_of(words: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in whole.encode_batch_fast(words, add_special_tokens=False)]

    def letters_ids(runs: list[str]) -> list[bytes]:
        joined = [" ".join(runs[i:i + 256]) for i in range(0, len(runs), 256)]
        ids = np.concatenate([np.asarray(e.ids, dtype="<u4") for e in bare.encode_batch_fast(joined, add_special_tokens=False)])
        stop = (np.flatnonzero(ends[ids]) + 1) * 4
        if len(stop) != len(runs):                               # a vocabulary without ends
            return ids_of(runs)
        raw = ids.tobytes()
        return [raw[x:y] for x, y in zip([0, *stop[:-1].tolist()], stop.tolist())]

    def pieces(text: bytes) -> list:
        try:
            t = text.decode()
        except UnicodeDecodeError:
            return text.split()
        if "<|" in t or not _PLAIN.fullmatch(t):                 # "<|": the tokenizer's special strings
            return text.split()
        return _PIECES.findall(t.lower())

    def learn(new) -> dict:
        """Remember the ids of new pieces; returns those too long for it."""
        runs = [x for x in new if type(x) is str and x.isalpha()]
        if runs:
            cache.update(zip(runs, letters_ids(runs)))
        other = [x for x in new if type(x) is bytes or not x.isalpha()]
        if other:
            cache.update(zip(other, ids_of([x.decode("utf-8", "replace") if type(x) is bytes else x for x in other])))
        return {x: cache.pop(x) for x in new if len(x) > CACHE_CHARS}

    def encode(texts: list[bytes]) -> list[bytes]:
        split = [pieces(t) for t in texts]
        new = set().union(*split).difference(cache)
        if new:
            if len(cache) + len(new) > CACHE_WORDS:
                cache.clear()
                new = set().union(*split)
            large = learn(new)
            if large:
                return [b"".join([large[w] if w in large else cache[w] for w in words]) for words in split]
        known = cache.__getitem__
        return [b"".join(map(known, words)) for words in split]

    return encode


def tokenize(docs: DataFrame, path: str | None = None, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
             text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian
    unsigned 32 bit), and its place: partition ``part`` and number ``nth``
    among the partition's pieces of that length."""
    path = path or tokenizer_path()

    def coded(batches, encode):
        """(doc_id, ids) of each row, a few megabytes of text at a time."""
        held, size = [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.append((i, t.as_py() or b""))
                size += len(held[-1][1])
                if size > TEXT_BYTES:
                    yield from zip([x[0] for x in held], encode([x[1] for x in held]))
                    held, size = [], 0
        if held:
            yield from zip([x[0] for x in held], encode([x[1] for x in held]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        trim()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        encode = word_encoder(path)
        seen = [0] * (max_tokens + 1)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        rows: list[tuple] = []
        held = 0

        def flush():
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(),
                                                       pa.int32(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids", "part", "nth"])

        for i, ids in coded(batches, encode):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                own = ids[at:at + 4 * max_tokens]
                n = len(own) // 4
                rows.append((i, piece, at // 4, n, own, part, seen[n]))
                seen[n] += 1
                held += len(own)
            if held > 4_000_000:
                yield flush()
                rows, held = [], 0
        if rows:
            yield flush()

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
            .mapInArrow(run, PIECE_SCHEMA))


def pack_lengths(counts: dict[int, int], capacity: tuple[int, int, int], weights=(1.0, 1.0, 1.0),
                 rule: str = "norm") -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over length classes.

    ``counts``: pieces per length; ``capacity``: tokens, documents, attention
    cost.  Returns runs (length, first_rank, pieces, per_bin, first_bin,
    offset): piece ``first_rank + q`` goes to bin ``first_bin + q // per_bin``
    at ``offset + (q % per_bin) * length``.
    """
    cap = np.asarray(capacity, dtype=np.int64)
    scale = np.asarray(weights, dtype=float) / cap.astype(float) ** 2
    runs: list[tuple[int, int, int, int, int, int]] = []
    residual = np.empty((0, 3), dtype=np.int64)      # of the open bin classes
    bins: list[list[list[int]]] = []                 # their runs of bin numbers: [first, count]
    where: dict[tuple, int] = {}                     # residual -> class
    next_bin = 0
    lengths = sorted((n for n, c in counts.items() if c), reverse=True)
    smallest = lengths[-1] if lengths else 0

    def keep(left: np.ndarray, first: int, count: int) -> None:
        nonlocal residual
        if left[0] < smallest or left[1] < 1 or left[2] < smallest * smallest:
            return                                   # nothing fits any more
        key = tuple(int(x) for x in left)
        if key not in where:
            where[key] = len(bins)
            residual = np.vstack([residual, left])
            bins.append([])
        bins[where[key]].append([first, count])

    def drop(k: int) -> None:
        """Remove an emptied class; the last one takes its number."""
        nonlocal residual
        del where[tuple(int(x) for x in residual[k])]
        last = len(bins) - 1
        if k != last:
            residual[k], bins[k] = residual[last], bins[last]
            where[tuple(int(x) for x in residual[k])] = k
        residual = residual[:last]
        bins.pop()

    for length in lengths:
        item = np.asarray([length, 1, length * length], dtype=np.int64)
        if (item > cap).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacity {tuple(capacity)}")
        rank, left = 0, counts[length]
        while left:
            fits = np.flatnonzero((residual >= item).all(axis=1)) if len(bins) else np.empty(0, dtype=np.int64)
            if not len(fits):
                per = int((cap // item).min())
                for n in ((left // per) * per, left % per):
                    if n:
                        size = min(per, n)
                        runs.append((length, rank, n, size, next_bin, 0))
                        keep(cap - size * item, next_bin, n // size)
                        next_bin += n // size
                        rank += n
                break
            open_now = residual[fits]
            if rule == "dot":
                score = -((open_now * item) * scale).sum(axis=1)
            else:
                score = (((open_now - item).astype(float) ** 2) * scale).sum(axis=1)
            k = int(fits[np.lexsort((fits, score))[0]])
            room = residual[k].copy()
            per = int((room // item).min())
            run = bins[k][-1]
            take = min(run[1], max(1, left // per))
            size = min(per, left)
            first = run[0]
            run[0] += take
            run[1] -= take
            if not run[1]:
                bins[k].pop()
                if not bins[k]:
                    drop(k)
            runs.append((length, rank, take * size, size, first, int(cap[0] - room[0])))
            keep(room - size * item, first, take)
            rank += take * size
            left -= take * size
    return runs


def pack(pieces: DataFrame, capacity: int = MAX_TOKENS, max_documents: int | None = None,
         max_cost: int | None = None, weights=(1.0, 1.0, 1.0), rule: str = "norm") -> DataFrame:
    """``pieces`` (a written table with length, part, nth) plus sequence_id
    and offset.  Without ``max_documents`` or ``max_cost`` that capacity cannot
    bind (as many documents as tokens, the square of the length) and has no
    weight in the choice."""
    weights = tuple(w if given else 0.0 for w, given in zip(weights, (True, max_documents, max_cost)))
    caps = (capacity, max_documents or capacity, max_cost or capacity * capacity)
    per_part = written(pieces.groupBy("part", "length").agg((F.max("nth") + 1).alias("n")), "pack-counts")
    counts = {r["length"]: r["n"] for r in                      # at most `capacity` rows
              per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.asarray(sorted(pack_lengths(counts, caps, weights, rule)), dtype=np.int64).reshape(-1, 6)
    shared = pieces.sparkSession.sparkContext.broadcast(runs)   # bounded: runs of length classes

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # few counts are broadcast, so that the pieces stay where they are; many meet them by a shuffle
    ranked = pieces.join(sized_broadcast(bases, BASE_ROWS), ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth")).drop("base")
    names = [c for c in ranked.columns if c not in ("part", "nth", "rank")]
    schema = ranked.select(*names).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        starts = table[:, 0] * (1 << 48) + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            run = table[np.searchsorted(starts, length * (1 << 48) + rank, side="right") - 1]
            q = rank - run[:, 1]
            out = [batch.column(c) for c in names]
            out += [pa.array(run[:, 4] + q // run[:, 3]), pa.array(run[:, 5] + (q % run[:, 3]) * length)]
            yield pa.RecordBatch.from_arrays(out, names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids (bytes), and the spans (offset,
    length, doc_id, piece, start) that attention must not cross."""
    spans = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "start", "ids")))
    return (packed.groupBy("sequence_id").agg(spans.alias("s"))
            .select("sequence_id",
                    F.aggregate("s", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
                    F.transform("s", lambda x: x.dropFields("ids")).alias("spans")))


# Production capacities of a sequence beside its tokens.  The fewest sequences of
# 2048 tokens are asked for, so these are the largest that such a sequence can
# need; all three residuals count in the choice of the bin.
MAX_DOCUMENTS = MAX_TOKENS
MAX_COST = MAX_TOKENS * MAX_TOKENS


def packed_documents(docs: DataFrame, carry_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` with their places: vector best-fit on tokens, documents
    and attention cost.  With ``carry_ids`` the pieces keep their ids (what
    ``sequences`` needs), else the digest of them."""
    pieces = tokenize(docs)
    if not carry_ids:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(written(pieces, "pack-pieces"), MAX_TOKENS, MAX_DOCUMENTS, MAX_COST)


def op1(spark, sf_dir: str) -> DataFrame:
    packed = packed_documents(table(spark, sf_dir, "documents"), carry_ids=True)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
