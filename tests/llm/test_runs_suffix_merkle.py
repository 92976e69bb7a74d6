"""Periodic runs, repeated passages and the Merkle manifest against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cartwise.llm import merkle, periodic, suffix_dedup
from small import AWKWARD, CLASHING, SF_SMALL, documents, prose


# ---- periodic runs ---------------------------------------------------------------------

def brute_runs(w):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i - s + p >= max(12, 2 * p):
                found.setdefault((s, i - s + p), p)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def brute_op11(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n, old = h // 10, len(w), list(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [old[i] if i < a else old[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def test_runs_of_random_and_periodic_sequences():
    r = random.Random(5)
    for _ in range(150):
        docs = []
        for _ in range(r.randint(1, 6)):
            n, k = r.choice([0, 1, 11, 12, 13, 30, 60, 120, 300]), r.choice([1, 2, 2, 3, 4, 50])
            w = [r.randrange(k) for _ in range(n)]
            if r.random() < .5 and n > 20:
                a = r.randrange(n)
                p = 1 + (n - a) // r.randint(2, 8)
                w = w[:a] + [w[a + i % p] for i in range(n - a)]
            docs.append(w)
        words = np.array([x for d in docs for x in d], np.int32)
        got = periodic.batch_runs(words, np.array([len(d) for d in docs]))
        assert [[tuple(x) for x in g.tolist()] for g in got] == [brute_runs(d) for d in docs]


def test_fibonacci_words_and_queries_in_parts(monkeypatch):
    a, b = [0], [0, 1]
    while len(b) < 500:
        a, b = b, b + a
    monkeypatch.setattr(periodic, "QUERIES_AT_ONCE", 50)
    got = periodic.batch_runs(np.array(b, np.int32), np.array([len(b)]))[0]
    assert [tuple(x) for x in got.tolist()] == brute_runs(b)


def test_grammar_extensions_both_ways():
    r = np.random.default_rng(3)
    seq = np.concatenate([np.tile(r.integers(0, 3, 7), 30), r.integers(0, 2, 200), np.zeros(80, int), [-1]]).astype(np.int32)
    g = periodic.Grammar(seq)
    i, j = r.integers(0, 480, 400).astype(np.int32), r.integers(0, 480, 400).astype(np.int32)
    i, j = np.minimum(i, j), np.maximum(i, j) + 1
    right, left = g.extend(i, j, True), g.extend(i, j, False)
    for k in range(len(i)):
        n = 0
        while j[k] + n < len(seq) and seq[i[k] + n] == seq[j[k] + n]:
            n += 1
        m = 0
        while i[k] - m > 0 and seq[i[k] - 1 - m] == seq[j[k] - 1 - m]:
            m += 1
        assert (right[k], left[k]) == (n, m)


def run_rows(spark, df, tmp_dir):
    df.write.mode("overwrite").parquet(f"{tmp_dir}/documents.parquet")
    return tmp_dir


def test_op11_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(brute_op11(d.doc_id, d.text) for d in docs if len((d.text or "").split()) < 3000)
    ids = {w[0] for w in want}
    got = sorted(tuple(r) for r in periodic.op11(spark, SF_SMALL).collect() if r.doc_id in ids)
    assert got == want and any(w[1] for w in want)


def test_op11_awkward_rows(spark, tmp_dir):
    rows = [r for r in AWKWARD if r[0] != 9] + [(20 + i, "la " * (11 + i), "en", "a") for i in range(3)]
    sf = run_rows(spark, documents(spark, rows, CLASHING), tmp_dir)
    got = sorted((tuple(r) for r in periodic.op11(spark, sf).collect()), key=str)
    assert got == sorted((brute_op11(r[0], r[1]) for r in rows), key=str)
    empty = run_rows(spark, documents(spark, rows).limit(0), tmp_dir + "/e")
    assert periodic.op11(spark, empty).count() == 0


def test_runs_and_collapsed_text(spark):
    df = documents(spark, [(1, "x " + "a b c " * 5 + "y"), (2, None)])
    one, two = sorted(periodic.periodic_runs(df).collect(), key=lambda r: r.doc_id)
    assert [tuple(r) for r in one.runs] == [(1, 15, 3)] and one.collapsed == "x a b c y"
    assert two.n_words == 0 and two.runs == [] and two.collapsed == ""


# ---- repeated passages --------------------------------------------------------------------

def brute_repeats(texts, span):
    seen = Counter(t[u:u + span] for t in texts for u in range(len(t) - span + 1))
    out = []
    for t in texts:
        keep = bytearray(b"\1" * len(t))
        for u in range(len(t) - span + 1):
            if seen[t[u:u + span]] > 1:
                keep[u:u + span] = bytes(span)
        kept = bytes(b for b, f in zip(t, keep) if f)
        runs = sum(not keep[i] and (i == 0 or keep[i - 1]) for i in range(len(keep)))
        out.append((len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def op12_rows(spark, sf):
    return sorted((tuple(r) for r in suffix_dedup.op12(spark, sf).collect()), key=str)


def test_op12_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = brute_repeats([(d.text or "").encode() for d in docs], 400)
    assert op12_rows(spark, SF_SMALL) == sorted(((d.doc_id, *w) for d, w in zip(docs, want)), key=str)
    assert any(w[1] for w in want)


def small_settings(monkeypatch, **kw):
    for name, value in {"SPAN": 32, "REACH": 16, "LEAD": 16, "PIECE": 700, "BUCKET_ROWS": 40, "SAMPLE": 2, **kw}.items():
        monkeypatch.setattr(suffix_dedup, name, value)


@pytest.mark.parametrize("seed", range(4))
def test_short_spans_small_pieces_and_hot_leads(spark, tmp_dir, monkeypatch, seed):
    """Leads dealt over several buckets, pieces of long texts, monotonous texts,
    zero bytes and overlapping repeats."""
    small_settings(monkeypatch, **({"MAX_BITS": 1} if seed == 3 else {}))
    r = random.Random(seed)
    common = "".join(r.choice("abcdefgh ") for _ in range(60))
    rows = [(1, None), (2, ""), (3, "x" * 900), (4, "ab" * 300), (5, "\0" * 50 + "q"), (6, "é" * 70), (None, common), (None, common)]
    for i in range(120):
        own = lambda n: "".join(r.choice("ab " if i % 3 else "abcdefghijk \0") for _ in range(n))
        rows.append((10 + i, own(r.randrange(40)) + common[r.randrange(4):] + own(r.randrange(60))))
    rows += [(10, rows[8][1]), (500, "".join(r.choice("abc") for _ in range(3000)))]
    sf = run_rows(spark, documents(spark, rows, CLASHING), tmp_dir)
    want = brute_repeats([(t or "").encode() for _, t in rows], 32)
    assert op12_rows(spark, sf) == sorted(((d, *w) for (d, _), w in zip(rows, want)), key=str)


def test_repeats_of_an_empty_table_and_kept_spans(spark, tmp_dir):
    rows = documents(spark, [(1, prose(1, 40)), (2, "head " + prose(1, 40) * 3)])
    assert op12_rows(spark, run_rows(spark, rows.limit(0), tmp_dir)) == []
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(documents(
        spark, [(1, prose(1, 120)), (2, "head " + prose(1, 120) + " tail"), (3, prose(9, 120))])).collect()}
    n = len(prose(1, 120))
    assert got[1].n_removed == n and bytes(got[1].kept) == b""
    assert [tuple(s) for s in got[2].spans] == [(5, 5 + n)] and bytes(got[2].kept) == b"head  tail"
    assert got[3].spans == [] and got[3].n_removed == 0


def test_multikey_sort_orders_and_measures_prefixes():
    r = np.random.default_rng(1)
    m = r.integers(0, 2, (300, 24)).astype(np.uint8)
    m[:, :16] = m[r.integers(0, 4, 300), :16]
    order, lcp = suffix_dedup.multikey_sort(m)
    rows = [bytes(m[i]) for i in order]
    assert rows == sorted(rows)
    for k in range(1, 300):
        assert lcp[k] == next((i for i in range(24) if rows[k][i] != rows[k - 1][i]), 24)


# ---- manifest -------------------------------------------------------------------------------

def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        cur = levels[-1]
        levels.append([_h("".join(cur[i:i + 16])) for i in range(0, len(cur), 16)])
    return levels


def _leaf(row, text):
    parts = (row[0], row[3], row[2], None if row[1] is None else len(row[1]), text)
    return _h("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def brute_manifest(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        trees[s] = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r, r[1])))
    levels = {s: _tree([_leaf(r, r[1]) for r in trees[s]]) for s in names}
    top = _tree([levels[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(trees[s]):
            proof, chosen = "", r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            low = r[1].translate({c: c + 32 for c in range(65, 91)}) if r[1] is not None else None
            cur = _leaf(r, low) if chosen else _leaf(r, r[1])
            for lv, at in ((levels[s], i), (top, k)):
                for nodes in lv[:-1]:
                    a = at - at % 16
                    before, after = "".join(nodes[a:at]), "".join(nodes[at + 1:a + 16])
                    proof, cur, at = proof + before + after, _h(before + cur + after), at // 16
            out.append((r[0], _leaf(r, r[1]), levels[s][-1][0], top[-1][0], _h(proof), cur, cur == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows(spark, sf):
    return sorted((tuple(r) for r in merkle.op13(spark, sf).collect()), key=str)


@pytest.mark.parametrize("superblock", [(1, 16), (2, 256), (3, 4096)])
def test_manifest_matches_brute_force(spark, tmp_dir, monkeypatch, superblock):
    """One, two and three levels a superblock, a source of most rows, many sources."""
    monkeypatch.setattr(merkle, "DEPTH", superblock[0])
    monkeypatch.setattr(merkle, "SUPER", superblock[1])
    full = [(*r, *(None,) * (4 - len(r))) for r in AWKWARD]
    full += [(1000 + i, f"Text {i}", "en", "hot") for i in range(700)] + [(5000 + i, "Ab", None, f"s{i}") for i in range(40)]
    full += [(9000 + i, "Q", "en", "seventeen") for i in range(17)]
    sf = run_rows(spark, documents(spark, full, CLASHING), tmp_dir)
    got = manifest_rows(spark, sf)
    assert got == brute_manifest(full)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_one_row_and_of_none(spark, tmp_dir):
    one = [(7, "Hello", "en", "a")]
    got = manifest_rows(spark, run_rows(spark, documents(spark, one), tmp_dir))
    assert got == brute_manifest(one) and got[0][1] == got[0][2] == got[0][3]
    assert manifest_rows(spark, run_rows(spark, documents(spark, one).limit(0), tmp_dir + "/none")) == []


def test_manifest_matches_sql(spark):
    from oracle_compare import compare, duck
    ok, msg = compare(spark, duck(SF_SMALL), "op13", SF_SMALL, {"op13": merkle.op13}, {"op13": merkle.OP13_SQL})
    assert ok, msg
