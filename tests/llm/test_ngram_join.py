import random
import re

import numpy as np
import pytest
from small import AWKWARD, CLASHING, documents, prose

from cartwise.llm import ngram_join
from cartwise.llm.components import components

LOWER = {i: i + 32 for i in range(65, 91)}


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """(n_shingles, component) per row position, by all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 80 * (len(sets[i]) + len(sets[j]) - inter):
                parent[root(i)] = root(j)
    names = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            names[root(i)] = min(doc, names.get(root(i), doc))
    return [(doc, len(sets[i]), names.get(root(i))) for i, (doc, _) in enumerate(rows)]


def check(spark, rows, extra=()):
    got = ngram_join.jaccard_components(documents(spark, rows, extra)).collect()
    want = brute([(r[0], r[1]) for r in rows])
    assert sorted(map(repr, [(r.doc_id, r.n_shingles, r.component_id) for r in got])) == sorted(map(repr, want))


def test_awkward_rows_and_clashing_columns(spark):
    check(spark, AWKWARD, CLASHING)


def edited(words, share, seed):
    r = random.Random(seed)
    return " ".join(f"new{r.randrange(10 ** 6)}" if r.random() < share else w for w in words)


def test_near_copies_chains_and_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TREE", 16)              # groups are cut into parts
    monkeypatch.setattr(ngram_join, "LEADERS", 2)
    monkeypatch.setattr(ngram_join, "MEMBERS", 8)
    monkeypatch.setattr(ngram_join, "AGAINST", 4)
    rows, base = [], prose(1, 300, 5000).split()
    for i in range(90):                                       # a group around the threshold
        rows.append((len(rows), edited(base, 0.004 + 0.02 * (i % 4) / 3, i)))
    chain = prose(2, 200, 5000).split()                       # a chain: each step near, ends far
    for i in range(25):
        chain = chain[8:] + [f"c{i}x{j}" for j in range(8)]
        rows.append((len(rows), " ".join(chain)))
    passage = prose(3, 60, 5000)                              # a passage that many documents share
    for i in range(60):
        rows.append((len(rows), passage + " " + prose(100 + i, random.Random(i).choice([5, 12, 200]), 5000)))
    for i in range(20):                                       # exact copies
        rows.append((len(rows), passage.upper()))
    check(spark, rows)


def test_empty_table_and_filter(spark):
    assert ngram_join.jaccard_components(documents(spark, [])).count() == 0
    rows = [(5, prose(1, 80)), (3, prose(1, 80) + " x"), (9, prose(2, 80)), (4, None), (6, "")]
    df = documents(spark, rows, CLASHING)
    kept = ngram_join.one_per_component(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6, 9]


def near(seed, *tails):
    return [" ".join((prose(seed, 80), *tail)) for tail in tails]


def test_rows_without_an_id_are_compared(spark):
    big = 2 ** 60 + 1
    rows = []
    for seed in range(40, 52):                                # a near copy without an id: as leader and as member
        one, two = near(seed, ("x",), ("y",))
        rows += [(None, one), (seed if seed % 2 else None, two)]
    for k in range(6):                                        # ids above 2^53 beside a null
        one, two = near(60 + k, ("x",), ("y",))
        rows += [(big + 2 * k, one), (big + 2 * k + 1, two), (None, prose(90 + k, 70))]
    check(spark, rows)


def test_one_row_of_each_component_stays(spark):
    a, b, c, d, e = (near(seed, ("x",), ("y",), ("z",)) for seed in range(70, 75))
    rows = [(1, a[0]), (2, a[1]), (2, prose(80, 70)),         # an id repeats with a text of its own
            (3, b[0]), (3, b[1]), (3, b[1]),                  # near copies and repeated rows under one id
            (None, c[0]), (None, c[1]), (None, c[1]),         # no id at all
            (None, d[0]), (4, d[1]), (5, d[2]),
            (6, e[0]), (6, e[0]), (7, prose(81, 70)), (None, None), (None, None), (2, None)]
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.one_per_component(documents(spark, rows, CLASHING)).collect()),
                  key=repr)
    groups = [rows[:2], rows[2:3], rows[3:6], rows[6:9], rows[9:12], rows[12:14], rows[14:15]]
    for group in groups:
        own = [k for k in kept if k in group]
        assert len(own) == 1 and own[0][0] == min((i for i, _ in group if i is not None), default=None)
    assert [k for k in kept if k[1] is None] == sorted([(None, None), (None, None), (2, None)], key=repr)
    assert len(kept) == len(groups) + 3


def test_tree_search_equals_a_scan():
    rng = np.random.default_rng(0)
    for m in (2, 17, 300):
        n = rng.integers(5, 400, m)
        points = np.stack([np.bincount(rng.integers(0, 128, k), minlength=128) for k in n])
        tree = ngram_join.RTree(points, n)
        for i in range(0, m, 7):
            bound = np.minimum(points, points[i]).sum(axis=1)
            want = np.flatnonzero(bound >= ngram_join.needed_overlap(n, n[i]))
            assert sorted(tree.search(points[i], int(n[i]))) == want.tolist()


def test_prefixes_of_linked_sets_meet():
    rng = random.Random(1)
    for _ in range(3000):
        a = set(rng.sample(range(200), rng.randint(1, 60)))
        b = set(a)
        for _ in range(rng.randint(0, 12)):
            b ^= {rng.randrange(200)}
        if not b:
            continue
        small, large = sorted((a, b), key=len)
        if 100 * len(a & b) >= 80 * len(a | b):
            index, probe = ngram_join.prefix_lengths(len(small))[0], ngram_join.prefix_lengths(len(large))[1]
            assert set(sorted(small)[:index]) & set(sorted(large)[:probe])


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(r.randrange(2000, 2400), r.randrange(2000, 2400)) for _ in range(150)]
    r.shuffle(edges)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {x.id: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_that_share_a_class_number(spark, monkeypatch):
    """64 digest bits cut to a few values: different sets meet in a number."""
    whole = ngram_join.set_digest

    def narrow(s):
        a, b = whole(s)
        return a % 5, b
    rows = [(i, prose(i % 9, 60 + i % 9)) for i in range(30)]
    rows += [(100 + i, prose(i, 60 + i) + " one more word") for i in range(9)] + [(None, prose(3, 63)), (None, prose(77, 40)), (300, " ")]
    monkeypatch.setattr(ngram_join, "set_digest", narrow)
    docs = documents(spark, rows)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()]
    want = brute(rows)
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    kept = [r.doc_id for r in ngram_join.one_per_component(docs).collect()]
    one_each = sorted({c for _, n, c in want if n and c is not None}) + [300]
    assert sorted(x for x in kept if x is not None) == one_each and kept.count(None) == 1
