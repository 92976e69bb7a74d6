import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from small import AWKWARD, CLASHING, SF_SMALL, documents

from cartwise.llm import chat, embedding_dedup, license_scan

# ---------------------------------------------------------------- chat

TALK = "conv_id long, turn long, role string, text string"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("\\#<: a\n>/", max_size=6), st.text("\\#<:/turn>\n ébc", max_size=16)), max_size=4))
def test_template_reads_back(turns):
    turns = [(r, "</turn>\n### x: " + t) for r, t in turns] + [("a\\", "\\")]
    assert chat.read_turns("".join(chat.format_turn(r, t) for r, t in turns)) == turns


def digests(turns):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def check_chat(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, TALK).withColumn("node", F.lit("clash")).withColumn("rank", F.lit(1))
    emitted, paths = chat.prefix_tree(df)
    got = {r.conv_id: r for r in chat.read_back(emitted, paths).collect()}
    talks = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0,
                                                             r[2] or "", r[3] or "")):
        talks.setdefault(c, []).append((role or "", text or ""))
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == {
        c: digests(t) for c, t in talks.items()}
    # every distinct prefix once, gapless, depth first, positions run on from the parent
    prefixes = {tuple(t[:k + 1]) for t in talks.values() for k in range(len(t))}
    nodes = sorted(emitted.collect(), key=lambda n: n.offset)
    assert len(nodes) == len(prefixes) == len({bytes(n.node) for n in nodes})
    at, stack = 0, []
    for n in nodes:
        assert n.offset == at and n.length == len(n.body)
        at += n.length
        assert n.depth <= len(stack)
        del stack[n.depth:]
        assert n.position == sum(x.length for x in stack)
        stack.append(n)
    # the ancestors' intervals are the open nodes of the stream
    spans = {(n.offset, n.length): n for n in nodes}
    for r in got.values():
        assert [spans[i.offset, i.length].depth for i in r.intervals] == list(range(r.n_turns))
        assert r.formatted_chars == sum(i.length for i in r.intervals)


def test_chat_shared_turns_and_awkward_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "more"), (2, 0, "user", "hi"),
            (2, 1, "assistant", "no"), (3, 0, "user", "hi"), (4, 0, "system", None), (4, 1, None, "x"), (5, None, "user", ""),
            (6, 0, "user", "dup"), (6, 0, "user", "dup"), (6, 0, "assistant", "\\### Assistant: </turn> ok"),
            (None, 0, "user", "hi"), (None, 1, "assistant", "é\U0001f600" * 30_000)]
    check_chat(spark, rows)


def test_chat_hot_first_turn_and_copies(spark):
    r = random.Random(4)
    rows = []
    for c in range(400):
        hot = c % 3 == 0
        for t in range(r.randint(1, 5)):
            text = "the same" if hot and t == 0 else f"t{r.randrange(3)}"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    check_chat(spark, rows)


def test_chat_empty_table(spark):
    emitted, paths = chat.prefix_tree(spark.createDataFrame([], TALK))
    assert emitted.count() == 0 and chat.read_back(emitted, paths).count() == 0


def test_chat_query_has_the_hard_conversation(spark):
    rows = {r.conv_id: r for r in chat.op5(spark, SF_SMALL).collect()}
    hard = r"\### Assistant: </turn> ok"
    assert (rows[-7].n_turns, rows[-7].loss_chars) == (2, len(hard))
    assert rows[-7].loss_sha256 == hashlib.sha256(hard.encode()).hexdigest()


# ---------------------------------------------------------------- embeddings

VEC = "vec_id long, embedding array<float>, label int"


def brute_links(rows, threshold=0.93):
    able = [i for i, (v, e, l) in enumerate(rows) if l is not None and e and all(x is not None and np.isfinite(x) for x in e)
            and any(e)]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, i in enumerate(able):
        for j in able[:k]:
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if la == lb and len(a) == len(b):
                a, b = np.float32(a).astype(float), np.float32(b).astype(float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    parent[root(i)] = root(j)
    low = {}
    for i, (v, _, _) in enumerate(rows):
        low[root(i)] = min(v, low.get(root(i), v))
    return [(rows[i][0], links[i], low[root(i)], rows[i][0] == low[root(i)]) for i in range(len(rows))]


def clustered(n, dim=16, groups=12, spread=0.12, seed=0, labels=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return [(i, [float(x) for x in centres[i % groups] + spread * rng.normal(size=dim)], i % groups % labels) for i in range(n)]


def check_vectors(spark, rows, recall=1.0):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, VEC).withColumn("id", F.lit("clash")).withColumn("shard", F.lit("clash"))
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect())
    want = sorted(brute_links(rows))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sum(g[1] for g in got) >= recall * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    if recall == 1.0:
        assert got == want


def test_embeddings_awkward_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.0], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [0.0] * 3, 0),
            (8, [1.0, float("nan"), 1.0], 0), (9, [1.0, None, 2.0], 0), (10, [1.0, 2.0], 0), (11, [], 0),
            (12, [-1.0, -2.0, -3.0], 0), (13, [float("inf"), 1.0, 1.0], 0), (14, [1.0, 2.0], 0)]
    check_vectors(spark, rows)


def test_embeddings_shards_parts_and_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD", 40)
    monkeypatch.setattr(embedding_dedup, "MAX_SHARD", 60)
    monkeypatch.setattr(embedding_dedup, "ASSIGN_ROWS", 100)
    rows = clustered(500)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(80)]          # one vector many times
    check_vectors(spark, rows, recall=0.9)


def test_embeddings_null_and_repeated_ids(spark):
    v, near, far = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1], [-3.0, 1.0, 0.0]
    df = spark.createDataFrame([(None, v, 0), (None, v, 0), (5, near, 0), (5, far, 0), (9, [-3.0, 1.0, 0.1], 0),
                                (None, [0.0, -1.0, 9.0], 0)], VEC)
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 2, 5, False), (None, 2, 5, False), (5, 2, 5, True), (5, 1, 5, True), (9, 1, 5, False),
                          (None, 0, None, False)], key=str)


def test_embeddings_audit_and_empty(spark):
    from cartwise.llm.common import written
    df = spark.createDataFrame(clustered(600, seed=3), VEC)
    result = written(embedding_dedup.near_duplicates(df), "audit")
    assert embedding_dedup.audit_recall(df, result) >= 0.9
    assert embedding_dedup.near_duplicates(df.where("vec_id < 0")).count() == 0


def hot_group(hot, others, dim=64, seed=5):
    """Distinct vectors of one label; the first ``hot`` are all within the threshold."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=dim) + 0.15 * rng.normal(size=(hot, dim)), rng.normal(size=(others, dim))])
    return x.astype(np.float32)


def true_links(x, threshold=0.93):
    u = x.astype(np.float64)
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
    return np.concatenate([(u[i:i + 512] @ u.T >= threshold).sum(axis=1) - 1 for i in range(0, len(u), 512)])


def test_embeddings_search_leaves_its_shards(spark):
    import pandas as pd
    from cartwise.llm.common import written
    x = hot_group(10_000, 10_000)
    want = true_links(x)
    assert want[:10_000].min() == want[:10_000].max() == 9_999
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x), "label": 0}), VEC)
    result = written(embedding_dedup.near_duplicates(df), "hot")
    got = result.orderBy("vec_id").toPandas()
    assert (got["n_links"].to_numpy() <= want).all()
    assert got["n_links"].sum() >= 0.999 * want.sum()
    assert (got["component_id"][:10_000] == 0).all()
    assert embedding_dedup.audit_recall(df, result) >= 0.999


def test_embeddings_visits_count_a_pair_once(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD", 20)
    monkeypatch.setattr(embedding_dedup, "MAX_SHARD", 30)
    x = hot_group(300, 100, dim=16, seed=6)
    rows = [(i, [float(v) for v in e], 0) for i, e in enumerate(x)]
    rows += [(1000 + i, rows[i % 7][1], 0) for i in range(20)]
    check_vectors(spark, rows, recall=0.995)


def test_pruned_graph_keeps_a_diverse_few():
    x = np.array([r[1] for r in clustered(200, seed=1)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = embedding_dedup.pruned_graph(x)
    sim = x @ x.T
    for i in range(0, 200, 11):
        own = g[i][g[i] >= 0]
        assert i not in own and len(set(own)) == len(own) >= 1
        assert own[0] == np.argmax(np.where(np.arange(200) == i, -2, sim[i]))
        for k, b in enumerate(own):
            for a in own[:k]:                                # no kept neighbour hides another
                assert embedding_dedup.ALPHA * np.sqrt(2 - 2 * min(1, sim[a, b])) > np.sqrt(2 - 2 * min(1, sim[i, b]))


# ---------------------------------------------------------------- licenses

def best_windows(text, templates, share=0.8):
    import re
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    w, out = words(text or ""), {}
    for name, body in templates:
        t = words(body)
        k = min(5, len(t))
        own = {tuple(t[i:i + k]) for i in range(len(t) - k + 1)}
        spans, s = len(t) - k + 1, [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
        for start in range(max(0, len(s) - spans) + 1 if s else 0):
            c = len(own & set(s[start:start + spans])) / len(own)
            if c >= share:
                best, n = out.get(name, ((-1, 0), 0))
                out[name] = (max(best, (c, -start)), n + 1)
    return {name: (c, -back, n) for name, ((c, back), n) in out.items()}


def check_licenses(spark, rows, templates):
    df = documents(spark, rows, CLASHING)
    got = {}
    for r in license_scan.scan(df, templates).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.containment, r.first_word, r.n_windows)
    want = {i: m for i, t, *_ in rows if (m := best_windows(t, templates))}
    assert got == want


def test_licenses_exact_partial_and_awkward(spark):
    T = license_scan.TEMPLATES
    long = dict(T)["BSD-text"]
    words = long.split()
    rows = [*AWKWARD, (20, "Intro. " + long.upper() + " outro"), (21, "a b " + " ".join(words[1:])),
            (22, " ".join(words[:10] + ["X"] + words[11:])), (23, "all rights  reserved! All Rights Reserved."),
            (24, "This work is\nlicensed under the GNU General Public License, version 3. Released under the MIT License."),
            (25, "rights reserved all"), (26, "Licensed under the Apache License, Version 2.0"), (26, "All rights reserved.")]
    check_licenses(spark, rows[:-1], T)
    both = license_scan.scan(documents(spark, rows[-2:]), T).collect()
    assert {(r.doc_id, r.license) for r in both} == {(26, "Apache-2.0"), (26, "all-rights-reserved")}


def test_licenses_random_edits_of_a_template(spark):
    r = random.Random(8)
    body = " ".join(f"w{r.randrange(30)}" for _ in range(60))
    rows = []
    for i in range(60):
        w = body.split()
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = f"z{r.randrange(5)}"
        rows.append((i, " ".join([f"p{i}"] * (i % 7) + w + ["q"] * (i % 3))))
    check_licenses(spark, rows, [("own", body), ("short", "w1 w2"), ("one", "zz")])


def test_licenses_empty(spark):
    assert license_scan.scan(documents(spark, [])).count() == 0
    assert license_scan.scan(documents(spark, AWKWARD), []).count() == 0
    assert license_scan.bands_for() == 13 and license_scan.bands_for(1.0 - 1e-12, 0.5) == 1


# ---------------------------------------------------------------- pipeline

def test_pipeline_keeps_columns_and_clean_documents(spark):
    import corpus_pipeline
    from cartwise.llm.common import table, written
    docs = table(spark, SF_SMALL, "documents")
    total = {r.doc_id for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        if k < 4:
            assert out.dtypes == docs.dtypes
            assert {r.doc_id for r in out.collect()} <= total
        if name == "language_id":
            assert out.count() == docs.where(r"text rlike '\\p{L}'").count()
        docs = out
    assert {"doc_id", "piece", "length", "sequence_id", "offset"} <= set(docs.columns)
    direct = corpus_pipeline.run(spark, SF_SMALL)
    assert direct.count() == docs.count()
    assert direct.agg({"length": "sum"}).first()[0] == docs.agg({"length": "sum"}).first()[0]


def test_empty_documents_through_the_pipeline(spark):
    import corpus_pipeline
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "unused")
    assert docs.count() == 0
