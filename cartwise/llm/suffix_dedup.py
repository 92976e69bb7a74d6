"""Repeated passages by a sampled suffix sort.

Every byte covered by a ``SPAN``-byte string (400) that also starts anywhere else,
in any document, is removed; strings are judged on the input.

Sorting a suffix for each byte of a corpus would shuffle hundreds of times its
size, so suffixes start at *anchors*: for a window starting at u, the position with
the least hash of ``GRAM`` bytes among u .. u + ``REACH`` (the first of several).
An anchor depends on the window's own bytes only, so equal windows have the same
anchor at the same offset, and no window is without one.  A suffix carries all
bytes of the windows that chose it: to the right of the anchor at most ``SPAN``, to
the left at most ``REACH``.

1. *Survivors.*  The ``SPAN - REACH`` bytes after an anchor lie in all its windows.
   Their hashes are counted; only anchors whose hash occurs again can hold a
   repeated window.  The repeated hashes become a bitmap of 16 bits a hash (sent to
   tasks up to ``MAX_BITS``; beyond that no filter is used and more is shuffled).
2. *Sampled splitters* on the leading ``LEAD`` bytes range-partition the suffixes
   into buckets.  A lead with more than one splitter (more than a bucket's worth of
   rows) is dealt over its buckets by a hash of the row.
3. *Local sort.*  A bucket sorts right and left parts by multikey quicksort (eight
   bytes a key, rows with equal keys go on to the next); common prefixes of
   neighbours then give, for each offset o, classes of equal left o and right
   ``SPAN - o`` bytes.  Windows that share a class with another are repeated.
4. *Across boundaries.*  Only a lead dealt over several buckets can have equal
   windows apart: its distinct suffixes send 128-bit digests of their windows, which
   are counted over all buckets.
5. Intervals of a document are united and cut from its text.

Contexts repeated within a piece of text (``PIECE`` bytes, of which a long text has
many) are emitted once with their intervals, so monotonous text does not blow up.
Defined results: null text is empty; a text shorter than ``SPAN`` keeps all bytes;
repeated rows are occurrences of their own, all cut alike; null and repeated ids are
kept apart by their text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, text_or_empty, trim, written

SPAN = 400
REACH = 200
GRAM = 8
LEAD = 64
PIECE = 1 << 21
BUCKET_ROWS = 20_000
MAX_BUCKETS = 20_000
SAMPLE = 256            # one anchor of so many is a candidate splitter
PER_BUCKET = 20         # sampled leads per bucket
MAX_BITS = 1 << 29

CONTEXT = "bucket int, key binary, lo long, hi long, at long, left binary, right binary"
FOUND = "key binary, lo long, hi long, digest binary"


# ---- anchors --------------------------------------------------------------------------

def _pieces(arrow):
    """(keys, base offsets, byte strings) of about ``PIECE`` bytes; a long text gives
    pieces whose windows follow one another."""
    held, size = [], 0
    for batch in arrow:
        for key, text in zip(batch.column(0), batch.column(1)):
            data = (text.as_py() or "").encode()
            if len(data) < SPAN:
                continue
            key = key.as_py()
            for base in range(0, len(data) - SPAN + 1, PIECE):
                part = data[base:base + PIECE + SPAN - 1]
                held.append((key, base, part))
                size += len(part)
                if size >= PIECE:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _anchors(parts: list) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined bytes and, per anchor: piece, first window, last window, place
    (all as positions in the joined bytes)."""
    joined = b"".join(p[2] for p in parts)
    data = np.frombuffer(joined, np.uint8)
    n = len(data)
    gram = np.zeros(n, np.uint64)
    for i in range(GRAM):
        gram[:n - i] = (gram[:n - i] << np.uint64(8)) | data[i:]
    gram *= np.uint64(0x9E3779B97F4A7C15)
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(0xBF58476D1CE4E5B9)
    value = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    width = REACH + 1
    padded = np.full(-(-(n + width) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = value
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n], ahead[width - 1:n + width - 1])        # over u .. u + REACH
    sizes = np.array([len(p[2]) for p in parts])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    piece = np.repeat(np.arange(len(parts)), sizes)
    starts = np.flatnonzero(np.arange(n) + SPAN <= begin[piece + 1])
    place = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (piece[starts[1:]] != piece[starts[:-1]])))
    last = np.append(first[1:], len(starts)) - 1
    return joined, piece[starts[first]], starts[first], starts[last], place[first]


def _core(joined: bytes, at) -> np.ndarray:
    import xxhash
    size = SPAN - REACH
    return np.array([xxhash.xxh3_64_intdigest(joined[a:a + size]) for a in at], np.uint64)


def _count_cores(arrow):
    """Hashes of what follows each anchor, with their counts; a sample of leads."""
    import pyarrow as pa
    for parts in _pieces(arrow):
        joined, _, _, _, at = _anchors(parts)
        core = _core(joined, at.tolist())
        picked = at[((core ^ at.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(SAMPLE) == 0]
        cores, counts = np.unique(core, return_counts=True)
        leads = [joined[a:a + LEAD] for a in picked.tolist()]
        yield pa.RecordBatch.from_pydict({
            "core": pa.array(np.concatenate([cores.view(np.int64), np.zeros(len(leads), np.int64)])),
            "n": pa.array([*counts.tolist(), *[0] * len(leads)], pa.int64()),
            "lead": pa.array([*[None] * len(cores), *leads], pa.binary())})
    trim()


def _contexts(filter_bits, splitters):
    """Suffixes of the surviving anchors with their buckets, and (without bytes) the
    windows known to be repeated within a piece."""
    bits = None if filter_bits is None else filter_bits.value
    edges = splitters.value

    def run(arrow):
        import pyarrow as pa
        keys = np.array(edges, dtype=f"S{LEAD + 1}")
        for parts in _pieces(arrow):
            joined, piece, lo, hi, at = _anchors(parts)
            if bits is not None:
                core = _core(joined, at.tolist())
                slot = core & np.uint64(len(bits) * 8 - 1)
                keep = (np.frombuffer(bits, np.uint8)[(slot >> np.uint64(3)).astype(np.int64)]
                        >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                piece, lo, hi, at = piece[keep], lo[keep], hi[keep], at[keep]
            begin = np.concatenate([[0], np.cumsum([len(p[2]) for p in parts])])
            seen: dict = {}
            for i, (a, u, v) in enumerate(zip(at.tolist(), lo.tolist(), hi.tolist())):
                seen.setdefault((joined[u:a], joined[a:v + SPAN], a - v), []).append(i)
            rows, passed = [], []
            for (left, right, _), where in seen.items():
                i = where[0]
                p = int(piece[i])
                shift = parts[p][1] - int(begin[p])
                alone = len(where) == 1
                rows.append((parts[p][0] if alone else None, int(lo[i]) + shift, int(hi[i]) + shift, int(at[i]) + shift, left, right))
                if not alone:
                    passed += where
            passed.sort()
            spans: list = []
            for i in passed:
                p = int(piece[i])
                shift = parts[p][1] - int(begin[p])
                u, v = int(lo[i]) + shift, int(hi[i]) + shift
                if spans and spans[-1][0] == p and spans[-1][2] >= u - SPAN:
                    spans[-1][2] = v
                else:
                    spans.append([p, u, v])
            if rows:
                # a byte 1 after the lead keeps trailing zero bytes in numpy's fixed-width strings
                lead = np.array([r[5][:LEAD] + b"\x01" for r in rows], dtype=f"S{LEAD + 1}")
                first, last = np.searchsorted(keys, lead, "left"), np.searchsorted(keys, lead, "right")
                salt = np.array([r[3] * 7919 + (int.from_bytes(r[0][:4], "big") if r[0] else 0) for r in rows])
                several = last - first > 1          # dealt over the buckets of its splitters
                bucket = first + np.where(several, salt % (last - first + 1), 0)
                order = list(zip(bucket.tolist(), *zip(*rows)))
            else:
                order = []
            # windows already known pass through any bucket
            for p, u, v in spans:
                order.append(((u + p) % (len(edges) + 1), parts[p][0], u, v, -1, None, None))
            if order:
                types = [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*order), types)],
                                                 names=["bucket", "key", "lo", "hi", "at", "left", "right"])
        trim()
    return run


# ---- buckets --------------------------------------------------------------------------

def multikey_sort(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix, and the common prefix of each row with the
    one before it in that order (0 for the first).

    Rows are sorted by eight bytes; only rows whose eight bytes equal a neighbour's
    are sorted on by the next eight."""
    m, width = strings.shape
    words = strings.reshape(m, width // 8, 8).view(">u8")[:, :, 0].astype(np.uint64)
    order = np.argsort(words[:, 0], kind="quicksort")
    col = words[order, 0]
    new = np.append(True, col[1:] != col[:-1])
    lcp = np.zeros(m, np.int64)
    _prefixes(lcp, words[:, 0], order, np.flatnonzero(new[1:]) + 1, 0)
    group = np.cumsum(new) - 1
    for k in range(1, width // 8):
        tied = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(tied):
            break
        key = words[order[tied], k]
        by = np.lexsort([key, group[tied]])
        order[tied] = order[tied][by]
        col, g = key[by], group[tied]
        split = np.append(False, (col[1:] != col[:-1]) & (g[1:] == g[:-1]))
        _prefixes(lcp, words[:, k], order, tied[split], 8 * k)
        new[tied[split]] = True
        group = np.cumsum(new) - 1
    lcp[~new] = width
    lcp[0] = 0
    return order, lcp


def _prefixes(lcp, word, order, where, base) -> None:
    """Common prefixes of rows that first differ within this word."""
    differ = word[order[where]] ^ word[order[where - 1]]
    same = np.zeros(len(where), np.int64)
    for byte in range(1, 8):
        same += differ < (np.uint64(1) << np.uint64(64 - 8 * byte))
    lcp[where] = base + same


def _matrix(strings: list, width: int, backwards: bool = False) -> np.ndarray:
    out = np.zeros((len(strings), width), np.uint8)
    for i, s in enumerate(strings):
        out[i, :len(s)] = np.frombuffer(s[::-1] if backwards else s, np.uint8)
    return out


def repeated_windows(left: list, right: list, low: np.ndarray, high: np.ndarray, double: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes with offsets ``low`` .. ``high``: a table (row, offset) of the
    windows that another row shares (or the row itself twice, where ``double``), and
    a number per distinct suffix."""
    m = len(left)
    by_right, right_lcp = multikey_sort(_matrix(right, SPAN))
    by_left, left_lcp = multikey_sort(_matrix(left, -(-REACH // 8) * 8, True))
    hit = np.zeros((m, REACH + 1), bool)
    right_class, left_class = np.empty(m, np.int64), np.empty(m, np.int64)

    def classes(o):
        right_class[by_right] = np.cumsum(right_lcp < SPAN - o)
        left_class[by_left] = np.cumsum(left_lcp < o) if o else 0
        return right_class * (m + 1) + left_class

    for o in range(REACH + 1):
        rows = np.flatnonzero((low <= o) & (o <= high))
        if not len(rows):
            continue
        key = classes(o)[rows]
        by = np.argsort(key, kind="stable")
        col = key[by]
        same = col[1:] == col[:-1]
        hit[rows[by], o] = np.append(same, False) | np.append(False, same)
        # a suffix that occurs twice in its piece shares its windows with itself
        hit[rows[double[rows]], o] = True
    right_class[by_right] = np.cumsum(right_lcp < SPAN)
    left_class[by_left] = np.cumsum(left_lcp < REACH)
    whole = np.stack([right_class, left_class, low, high], axis=1)
    _, distinct = np.unique(whole, axis=0, return_inverse=True)
    return hit, distinct.ravel()


def _runs(flags: np.ndarray):
    """(row, first, last) of every run of True along the rows of a table."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    return zip(row.tolist(), first.tolist(), (last - 1).tolist())


def _bucket_rows(split_leads):
    """Repeated windows of the bucket in a partition: covered bytes
    lo .. hi of a document, or digests of windows to be compared with
    other buckets (with the window's start where it is still open)."""
    split = split_leads.value

    def flush(rows):
        import pyarrow as pa
        out = []
        own = [r for r in rows if r[6] is not None]
        out += [(r[1], r[2], r[3] + SPAN, None) for r in rows if r[6] is None]
        if own:
            key, lo, hi, at, left, right = (list(c) for c in zip(*[r[1:] for r in own]))
            lo, hi, at = (np.array(c, np.int64) for c in (lo, hi, at))
            double = np.array([k is None for k in key])
            hit, distinct = repeated_windows(left, right, at - hi, at - lo, double)
            for i, a, b in _runs(hit):
                if key[i] is not None:
                    out.append((key[i], int(at[i]) - b, int(at[i]) - a + SPAN, None))
            open_leads = [i for i in range(len(own)) if right[i][:LEAD] in split]
            done = set()
            for i in open_leads:
                if distinct[i] in done:
                    continue
                done.add(distinct[i])
                for o in range(int(at[i] - hi[i]), int(at[i] - lo[i]) + 1):
                    window = left[i][len(left[i]) - o:] + right[i][:SPAN - o]
                    digest = hashlib.blake2b(window, digest_size=16).digest()
                    u = int(at[i]) - o
                    out.append((None if hit[i, o] else key[i], u, u + SPAN, digest))
        for start in range(0, len(out), 50_000):
            cols = list(zip(*out[start:start + 50_000]))
            types = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["key", "lo", "hi", "digest"])

    def run(arrow):
        held: dict = {}
        for batch in arrow:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                held.setdefault(r[0], []).append(r)
        for bucket in sorted(held):
            yield from flush(held.pop(bucket))
        trim()
    return run


# ---- the job --------------------------------------------------------------------------

def _bitmap(hashes: DataFrame, column: str, count: int):
    """Broadcast bitmap of a column of 64-bit hashes, 16 bits a hash; None beyond
    ``MAX_BITS``.  Tasks build a piece of it each."""
    bits = 1 << max(16, (16 * count - 1).bit_length())
    if bits > MAX_BITS:
        return None
    pieces, share = 64, bits // 64

    def build(arrow):
        import pyarrow as pa
        got: dict = {}
        for batch in arrow:
            slot = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(bits - 1)
            for p in np.unique(slot // np.uint64(share)).tolist():
                local = (slot[slot // np.uint64(share) == p] % np.uint64(share)).astype(np.int64)
                got.setdefault(p, np.zeros(share, bool))[local] = True
        for p, flags in got.items():
            yield pa.RecordBatch.from_pydict({"piece": pa.array([p], pa.int32()),
                                              "data": [np.packbits(flags, bitorder="little").tobytes()]})

    slot = F.col(column).bitwiseAND(bits - 1)
    dealt = hashes.select(column).repartition(pieces, F.floor(slot / share))
    out = bytearray(bits // 8)
    for row in dealt.mapInArrow(build, "piece int, data binary").collect():       # at most MAX_BITS bits
        out[row["piece"] * share // 8:(row["piece"] + 1) * share // 8] = row["data"]
    return hashes.sparkSession.sparkContext.broadcast(bytes(out))


def _key(doc_id: str, text: str):
    """Names a row's text; rows of one id and text share it and are cut alike."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.lit("|"), text_or_empty(text)).cast("binary")))


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(key, spans): per row with repeated passages the list of covered byte
    intervals, which may touch; a written table."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(_key(doc_id, text).alias("key"), F.col(text).alias("text"))
    cores = written(rows.mapInArrow(_count_cores, "core long, n long, lead binary"), "suffix-cores")
    again = written(cores.where("n > 0").groupBy("core").agg(F.sum("n").alias("n")).where("n > 1"), "suffix-again")
    size = again.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s")).first()
    survivors = size["s"] or 0
    buckets = int(min(MAX_BUCKETS, max(survivors // BUCKET_ROWS, 2 * sc.defaultParallelism)))
    sampled = cores.where("lead IS NOT NULL").select("lead")
    kept = max(1, -(-sampled.count() // (PER_BUCKET * buckets)))
    leads = sorted(bytes(r["lead"]) + b"\x01" for r in
                   sampled.where(F.pmod(F.monotonically_increasing_id(), F.lit(kept)) == 0).collect())     # bounded by PER_BUCKET x buckets
    edges = [leads[len(leads) * i // buckets] for i in range(1, buckets)] if len(leads) >= buckets else []
    split = {a[:-1] for a, b in zip(edges, edges[1:]) if a == b}
    bits = _bitmap(again, "core", size["k"])
    bounds, open_leads = sc.broadcast(edges), sc.broadcast(split)
    contexts = rows.mapInArrow(_contexts(bits, bounds), CONTEXT)
    found = written(contexts.repartitionById(buckets, F.col("bucket"))
                    .mapInArrow(_bucket_rows(open_leads), FOUND), "suffix-found")
    apart = found.where("digest IS NOT NULL")
    common = apart.groupBy("digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("digest")
    across = apart.where("key IS NOT NULL").join(common, "digest").select("key", "lo", "hi")
    every = found.where("digest IS NULL").select("key", "lo", "hi").unionByName(across)
    spans = written(every.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans")), "suffix-spans")
    for b in (bits, bounds, open_leads):
        if b is not None:
            b.unpersist()
    return spans


def _cut(arrow):
    """(id, text, spans) to the united intervals and the remaining bytes."""
    import pyarrow as pa
    for batch in arrow:
        out = []
        for doc_id, text, spans in zip(*[batch.column(i) for i in range(3)]):
            data, merged = (text.as_py() or "").encode(), []
            for s in spans.as_py():
                if merged and s["lo"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s["hi"])
                else:
                    merged.append([s["lo"], s["hi"]])
            ends = [0, *[x for m in merged for x in m], len(data)]
            kept = b"".join(data[ends[i]:ends[i + 1]] for i in range(0, len(ends), 2))
            out.append((doc_id.as_py(), len(data), len(data) - len(kept), [{"lo": a, "hi": b} for a, b in merged], kept))
        if out:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])
    trim()


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, the removed intervals
    (``spans``: lo, hi in bytes) and the remaining bytes ``kept``."""
    spans = repeated_spans(docs, text, doc_id)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), _key(doc_id, text).alias("key"))
    mark = F.xxhash64("key")
    bits = _bitmap(spans.select(mark.alias("mark")), "mark", spans.count())
    if bits is None:
        touched, clean = rows, rows.limit(0)
    else:
        # texts without a repeated passage need no shuffle
        rows = rows.withColumn("mark", mark).mapInArrow(_marked(bits), "doc_id long, text string, key binary, touched boolean")
        touched, clean = rows.where("touched").drop("touched"), rows.where("NOT touched")
    empty = F.array().cast("array<struct<lo:long,hi:long>>")
    cut = (touched.join(spans, "key", "left").select("doc_id", "text", F.coalesce("spans", empty).alias("spans"))
           .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<lo:long,hi:long>>, kept binary"))
    data = text_or_empty().cast("binary")
    whole = clean.select("doc_id", F.octet_length(data).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                         empty.alias("spans"), data.alias("kept"))
    return cut.unionByName(whole)


def _marked(bits):
    data = bits.value

    def run(arrow):
        import pyarrow as pa
        flags = np.frombuffer(data, np.uint8)
        for batch in arrow:
            slot = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(len(data) * 8 - 1)
            on = (flags[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(on)], names=["doc_id", "text", "key", "touched"])
    return run


def op12(spark, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
