"""Suffix-array dedup against brute force over all 50-byte strings."""

import hashlib
import random

import numpy as np
import pytest

from llm_fixtures import docs_of, real_docs  # noqa: F401 - fixtures
from parley.llm import suffix_dedup as S
from parley.llm.suffix_array import kasai, suffix_array


def brute(rows, length=50):
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        doc = S.NONE if doc is None else doc
        for p in range(len(raw) - length + 1):
            w = raw[p: p + length]
            first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p: p + length]] < (S.NONE if doc is None else doc):
                gone[p: p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc if doc is not None else None, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def ours(df):
    return sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in df.collect())


def test_suffix_array_and_kasai_against_sorting():
    rng = random.Random(5)
    for _ in range(150):
        s = bytes(rng.choices(rng.choice([b"ab", b"abc\0", bytes(range(256))]), k=rng.randint(0, 200))) * rng.randint(1, 3)
        depth = rng.choice([9, 20, 50])
        x = np.frombuffer(s, np.uint8)
        sa, rank = suffix_array(x, depth)
        cut = [s[p: p + depth].ljust(depth, b"\0") for p in range(len(s))]
        assert sorted(sa.tolist()) == list(range(len(s)))
        assert [cut[p] for p in sa] == sorted(cut)
        for p, l, q in zip(sa[1:], kasai(x, sa, depth)[1:], sa):
            m = next((i for i in range(depth) if cut[p][i] != cut[q][i]), depth)
            assert l == m
        assert all((rank[p] == rank[q]) == (cut[p] == cut[q]) for p, q in zip(sa[1:], sa))


def test_merge_runs_adds_counts_and_unites_flags():
    a = (np.array([1, 5, 9], np.uint64), np.array([1, 1 + S.FLAGS, 1]))
    b = (np.array([5, 9, 11], np.uint64), np.array([1, 1, 1 + S.FLAGS]))
    c = (np.array([9], np.uint64), np.array([1 + S.FLAGS]))
    key, n = S.merge_runs([a, b, c])
    assert key.tolist() == [1, 5, 9, 11]
    assert (n % S.FLAGS).tolist() == [1, 2, 3, 1] and (n // S.FLAGS).tolist() == [0, 1, 1, 1]


def test_real_documents(spark, real_docs, docs_of, monkeypatch):
    rows = [(d, t) for d, t, _ in real_docs][:200]
    assert ours(S.repeated_passages(docs_of(rows))) == brute(rows)


@pytest.mark.parametrize("small", [True, False])
def test_random_overlaps_hot_passages_many_pieces(spark, docs_of, monkeypatch, small):
    if small:  # many pieces, owners and shards, and anchors that are hot
        for name, value in (("PIECE", 3000), ("CHUNK", 700), ("ANCHOR_BYTES", 400), ("SHARD_BYTES", 9000), ("TEXT_BYTES", 1500),
                            ("HOT_UNITS", 6)):
            monkeypatch.setattr(S, name, value)
        S._TABLES.clear()
    rng = random.Random(11)
    word = lambda n: "".join(rng.choices("abcdé ", k=n))
    passages = [word(rng.choice([45, 50, 51, 60, 120, 300])) for _ in range(12)] + ["a" * 200, "ab" * 90]
    rows = []
    for d in range(120):
        text = "".join(rng.choice(passages) if rng.random() < 0.6 else word(rng.randint(1, 40)) for _ in range(rng.randint(0, 8)))
        rows.append((d * 7 % 120, text))
    rows += [(200 + i, passages[3]) for i in range(30)] + [(None, passages[4]), (3, rows[3][1]), (500, None), (501, "")]
    assert ours(S.repeated_passages(docs_of(rows, extra=("piece", "blob", "kind")))) == brute(rows)
    S._TABLES.clear()


def test_empty_table_and_texts(spark, docs_of):
    assert ours(S.repeated_passages(docs_of([]))) == []
    rows = [(1, None), (2, ""), (3, "x" * 49), (4, "x" * 50), (5, "x" * 50)]
    assert ours(S.repeated_passages(docs_of(rows))) == brute(rows)


def test_kept_bytes_are_returned(spark, docs_of):
    p = "the same sentence of more than fifty bytes stands in both of them"
    got = {r.doc_id: r.kept for r in S.repeated_passages(docs_of([(1, "A " + p), (2, "B! " + p + " end")]), texts=True).collect()}
    assert got[1] == ("A " + p).encode() and bytes(got[2]) == b"B! end"[:2] + b"" + got[2][2:]
    assert p.encode()[5:] not in got[2]


def test_anchor_keys_are_even_over_key_ranges():
    """Owners take equal key ranges; none may get much more than its share."""
    data = np.random.default_rng(3).integers(0, 256, 400_000, np.uint8)
    key = np.unique(S.units(data, np.array([len(data)]))["key"])
    counts = [b - a for _, a, b in S._slices(key, 16)]
    assert len(counts) == 16 and max(counts) < 1.2 * len(key) / 16
