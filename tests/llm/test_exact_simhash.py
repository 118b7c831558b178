"""Exact dedup and SimHash near-dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import xxhash

from llm_fixtures import docs_of, real_docs  # noqa: F401 - fixtures
from parley.llm import exact_dedup, simhash
from parley.llm.components import star_components

ODD = [(900, None), (901, ""), (902, " \t\n"), (903, " "), (904, "a  b"), (905, "a b"), (906, "a b"), (905, "a b"),
       (907, "x" * 200_000), (908, "x" * 200_000), (None, "a b"), (None, "only here"), (909, "A b"), (910, "w " * 50_000)]


def exact(rows):
    groups = defaultdict(list)
    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    for d, t in rows:
        groups[norm(t)].append(d)
    out = []
    for d, t in rows:
        g = groups[norm(t)]
        keep = min((x for x in g if x is not None), default=None)
        out.append((d, keep, len(g), d == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(map(str, out))


def got_exact(df):
    return sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in df.collect())


def test_exact(spark, docs_of, real_docs):
    rows = [(d, t) for d, t, _ in real_docs] + ODD
    df = docs_of(rows, extra=("key", "sha", "norm", "keep", "size", "bucket"))
    assert got_exact(exact_dedup.exact_groups(df)) == exact(rows)
    assert got_exact(exact_dedup.exact_groups(docs_of([]))) == []


def test_exact_hot_text_and_small_buckets(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, "the hot text" if i % 3 == 0 else f"copy {rng.randint(0, 60)}") for i in range(900)]
    assert got_exact(exact_dedup.exact_groups(docs_of(rows), capacity=700)) == exact(rows)


def test_directory_doubling():
    load = {0b000: 5, 0b001: 5, 0b110: 30}
    assert exact_dedup.split_directory(load, 3, 100) == [(0, 0)]
    # bucket 0 holds 10; bucket 1 splits down to the overfull slot
    assert exact_dedup.split_directory(load, 3, 12) == [(0, 1), (0b10, 2), (0b110, 3), (0b111, 3)]


def test_chain_compares_bytes():
    import pandas as pd

    rows = pd.DataFrame({"bucket": 0, "key": [7, 7, 7, 8], "norm": ["a", "b", "a", "a"], "doc": [5, 4, 3, 9], "n": [1, 2, 3, 1]})
    out = exact_dedup._chains(rows)
    assert sorted(zip(out["key"], out["keep"], out["size"])) == [(7, 3, 4), (7, 4, 2), (8, 9, 1)]


def test_exact_drop_copies_keeps_columns(spark, docs_of):
    df = docs_of([(3, "a"), (1, "a"), (2, "b"), (None, "b"), (None, None)], extra=("kept",))
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id is not None) == [(1, "a"), (2, "b")]


def slow_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    sh = [" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(map(str, ((d, f"{fps[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(rows))))


def test_simhash(spark, docs_of, real_docs):
    rows = [(d, t) for d, t, _ in real_docs] + [r for r in ODD if r[1] is None or len(r[1]) < 1000]
    rng = random.Random(4)
    for i in range(60):  # near copies
        d, t, _ = real_docs[rng.randrange(40)]
        w = (t or "").split()
        if len(w) > 5:
            w[rng.randrange(len(w))] = "changed"
        rows.append((2000 + i, " ".join(w)))
    got = simhash.simhash_components(docs_of(rows, extra=("fp", "node", "root", "key")))
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got.collect()) == slow_components(rows)
    assert simhash.simhash_components(docs_of([])).count() == 0


def test_texts_without_id_link_others(spark, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_: docs)
    rows = [(1, 0), (None, 3), (3, 15), (9, 0x7F00FF0000000000), (None, 0x00FF00FF00FF00FF), (7, -1), (8, -1), (None, -2)]
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc long, fp long")).collect()
    assert sorted(str((r.doc_id, r.component_id)) for r in got) == sorted(map(str, [
        (1, 1), (None, 1), (3, 1), (9, 9), (None, None), (7, 7), (8, 7), (None, 7)]))


def test_postings_find_every_link_also_in_wide_ones(monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fp = list(base)
    for b in base:
        for _ in range(12):
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            fp.append(b ^ np.uint64(sum(1 << int(x) for x in flips)))
    fp = np.unique(np.array(fp, np.uint64))
    want = {(i, j) for i in range(len(fp)) for j in range(i) if bin(int(fp[i] ^ fp[j])).count("1") <= 2}
    from itertools import combinations

    for wide in (256, 2):
        monkeypatch.setattr(simhash, "WIDE", wide)
        found = set()
        for a, b in combinations(range(4), 2):
            pair = lambda p: (fp >> np.uint64(16 * p)) & np.uint64(0xFFFF)
            key = (pair(a) << np.uint64(16)) | pair(b)
            order = np.argsort(key, kind="stable")
            i, j = simhash.posting_links(key[order].astype(np.int64), fp[order])
            found |= {(max(x, y), min(x, y)) for x, y in zip(order[i].tolist(), order[j].tolist())}
        assert found == want


def test_star_components(spark):
    edges = [(i + 1, i) for i in range(300)] + [(1000, 1001), (1001, 1002), (2000, 1002)] + [(5000 + i, 5000) for i in range(1, 200)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in star_components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{i: 1000 for i in (1000, 1001, 1002, 2000)},
                   **{5000 + i: 5000 for i in range(200)}}
    assert star_components(spark.createDataFrame([], "u long, v long")).count() == 0
