import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from small import AWKWARD, CLASHING, documents, prose

from cartwise.llm import packing

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(packing.tokenizer_path())


HARD = ["<|endoftext|> Hello, World!! don't we'll 's ''s x<|ENDOFTEXT|>", "été İstanbul ΣΣ ẞ STRASSE × ÷ a×b",
        "a\u0085b 1,234.5 a'b don’t \U0001f600x Å é 한", "", "   ", "x" * 5000, "\x1c\x1d\x0b\x0c ́x",
        "Word,.!! --a- -b [c] {d} `e` ~f ^g @h _i_ j'k"]


def ids(tokenizer, text):
    return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_word_encoder_equals_the_tokenizer(tokenizer, monkeypatch):
    encode = packing.word_encoder(packing.tokenizer_path())
    texts = HARD + [prose(1, 500), " ".join(HARD)]
    assert encode([t.encode() for t in texts]) == [ids(tokenizer, t) for t in texts]
    monkeypatch.setattr(packing, "CACHE_WORDS", 20)           # the cache starts afresh
    assert encode([t.encode() for t in texts]) == [ids(tokenizer, t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_word_encoder_on_any_text(texts):
    tokenizer = tokenizers.Tokenizer.from_file(packing.tokenizer_path())
    encode = packing.word_encoder(packing.tokenizer_path())
    assert encode([t.encode() for t in texts]) == [ids(tokenizer, t) for t in texts]


def replay(runs, counts):
    """Bins as lists of (offset, length); every rank is used once."""
    bins, used = {}, {n: set() for n in counts}
    for length, first, pieces, per, first_bin, offset in runs:
        for q in range(pieces):
            assert first + q not in used[length]
            used[length].add(first + q)
            bins.setdefault(first_bin + q // per, []).append((offset + (q % per) * length, length))
    assert {n: len(s) for n, s in used.items()} == counts
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
    return bins


def best_fit(lengths, cap):
    room = []
    for n in sorted(lengths, reverse=True):
        able = [i for i, r in enumerate(room) if r >= n]
        if able:
            room[min(able, key=lambda i: room[i])] -= n
        else:
            room.append(cap - n)
    return len(room)


def test_classes_pack_like_best_fit_decreasing_by_item():
    r = random.Random(5)
    for _ in range(40):
        cap = r.choice([10, 50, 100])
        lengths = [r.randint(1, cap) for _ in range(r.randint(1, 200))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        bins = replay(packing.pack_lengths(counts, (cap, cap, cap * cap), (1.0, 0.0, 0.0)), counts)
        assert len(bins) == best_fit(lengths, cap)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    r = random.Random(6)
    for _ in range(20):
        lengths = [r.randint(1, 60) for _ in range(150)]
        counts = {n: lengths.count(n) for n in set(lengths)}
        caps = (100, 4, 5000)
        for own in replay(packing.pack_lengths(counts, caps, (1.0, 0.5, 2.0), rule), counts).values():
            assert sum(n for _, n in own) <= caps[0]
            assert len(own) <= caps[1]
            assert sum(n * n for _, n in own) <= caps[2]
    with pytest.raises(ValueError):
        packing.pack_lengths({80: 1}, (100, 4, 5000))


def test_documents_awkward_rows_and_clashing_columns(spark, tokenizer):
    rows = packing.packed_documents(documents(spark, AWKWARD, CLASHING)).collect()
    want = []
    for i, text, *_ in AWKWARD:
        raw = ids(tokenizer, text or "") + b"\0\0\0\0"
        for piece, at in enumerate(range(0, len(raw), 8192)):
            own = raw[at:at + 8192]
            want.append((i, piece, at // 4, len(own) // 4, zlib.crc32(own)))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(by) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_sequences_hold_the_ids(spark, tokenizer):
    from cartwise.llm.common import written
    docs = documents(spark, [(i, prose(i, 20 + 90 * i)) for i in range(12)])
    packed = packing.pack(written(packing.tokenize(docs, max_tokens=256), "t"), capacity=256)
    texts = {}
    for s in packing.sequences(packed).collect():
        assert len(s.ids) <= 4 * 256
        for p in s.spans:
            texts.setdefault(p.doc_id, []).append((p.start, bytes(s.ids)[4 * p.offset:4 * (p.offset + p.length)]))
    for r in docs.collect():
        assert b"".join(x for _, x in sorted(texts[r.doc_id])) == ids(tokenizer, r.text) + b"\0\0\0\0"


@pytest.mark.parametrize("base_rows", [0, 300_000])
def test_query_carries_ids_and_keeps_every_capacity(spark, tokenizer, tmp_path, monkeypatch, base_rows):
    monkeypatch.setattr(packing, "BASE_ROWS", base_rows)         # 0: counts meet the pieces by a shuffle
    docs = documents(spark, [(i, prose(i, 3 + 37 * i)) for i in range(90)] + [(200 + i, "") for i in range(30)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = packing.op1(spark, str(tmp_path)).collect()
    packed = packing.packed_documents(spark.read.parquet(f"{tmp_path}/documents.parquet"), carry_ids=True)
    crc = {(r.doc_id, r.piece): zlib.crc32(bytes(r.ids)) for r in packed.collect()}
    assert {(r.doc_id, r.piece): r.ids_crc32 for r in rows} == crc
    sequences = packing.sequences(packed).collect()
    for s in sequences:
        lengths = [x.length for x in s.spans]
        assert sum(lengths) <= packing.MAX_TOKENS and len(lengths) <= packing.MAX_DOCUMENTS
        assert sum(n * n for n in lengths) <= packing.MAX_COST
    # counting documents and cost takes no more sequences than tokens alone
    assert len(sequences) == len({r.sequence_id for r in rows}) <= best_fit([r.length for r in rows], packing.MAX_TOKENS)


def test_empty_table(spark):
    assert packing.packed_documents(documents(spark, [])).count() == 0
