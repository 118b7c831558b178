"""SimHash near-dedup with a byte-position inverted index and count filtering.

Fingerprints are 64 bits from the XXH64 values of word shingles.  Two
fingerprints within ``max_bits`` = 2 differing bits differ in at most two of
their eight bytes, so they share at least six positional bytes (the guaranteed
minimum).  The inverted index posts each distinct fingerprint under its
positional bytes, four positions to a posting (the six choices of two of the
four byte pairs: two differing bytes touch at most two pairs, so a linked pair
meets in at least one posting).  Inside a posting the shared positional bytes
of pairs are tallied, pairs with at least six are retained and verified by
their differing bits.  Postings of more than ``WIDE`` fingerprints are not
compared pair by pair: the at most ``max_bits`` differing bits lie in the 32
bits that the posting leaves open, so each fingerprint looks up its 528
possible partners by binary search.  A task returns a spanning forest of the
links it found, not all pairs.

Copies (equal fingerprints) are one index row.  Defined results: null or empty
text has fingerprint zero and is linked like any other; repeated rows repeat
their result row; a null doc_id gets a row and the component of its
fingerprint.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import by_id, numbered, release, stash, text_of, without
from parley.llm.components import star_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
WIDE = 256


def fingerprint(text: bytes, k: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one text (see the module's contract)."""
    import xxhash

    words = text.lower().split()  # bytes: lowers A-Z only, splits at [\x20\x09-\x0D]+
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= k:
        spans = [flat]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        end = np.cumsum(size) - 1
        start = (end - size + 1)[: len(words) - k + 1].tolist()
        spans = [flat[a:b] for a, b in zip(start, end[k - 1:].tolist())]
    hashed = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in spans), np.uint64, len(spans))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashed), 1 << 16):
        raw = hashed[at: at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashed), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = np.array([fingerprint(t or b"") for t in b.column(1).cast(pa.binary()).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc, fp)``: fp is the fingerprint's 64 bits as a signed long."""
    return docs.select(F.col(id_col).cast("long").alias("doc"), text_of(text_col).alias("text")).mapInArrow(
        _fingerprints, "doc long, fp long")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, root):
            return root
        root = new


def _verified(fp: np.ndarray, i: np.ndarray, j: np.ndarray, bits: int) -> np.ndarray:
    """Tally the shared positional bytes of pairs; true where the minimum is reached and the bits hold."""
    diff = fp[i] ^ fp[j]
    shared = 8 - np.count_nonzero(diff.view(np.uint8).reshape(-1, 8), axis=1)
    return (shared >= 8 - bits) & (np.bitwise_count(diff) <= bits)


def posting_links(key: np.ndarray, fp: np.ndarray, bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that link, for rows sorted by posting ``key``."""
    left, right = [], []
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    # narrow postings: neighbours at distance s within the posting, all postings at once
    rank = np.arange(len(key)) - np.repeat(starts, sizes)
    room = np.repeat(np.where(sizes <= WIDE, sizes, 0), sizes)
    near = np.flatnonzero(room > 1)
    for s in range(1, WIDE):
        near = near[rank[near] + s < room[near]]
        if not len(near):
            break
        i = near[_verified(fp, near, near + s, bits)]
        left.append(i)
        right.append(i + s)
    for at, size in zip(starts[sizes > WIDE].tolist(), sizes[sizes > WIDE].tolist()):
        own = fp[at: at + size]
        order = np.argsort(own)
        ranked = own[order]
        vary = int(np.bitwise_or.reduce(own ^ own[0]))
        open_bits = [1 << x for x in range(64) if vary >> x & 1]  # at most 32
        for flip in (sum(c) for r in range(1, bits + 1) for c in combinations(open_bits, r)):
            want = ranked ^ np.uint64(flip)
            hit = np.minimum(np.searchsorted(ranked, want), size - 1)
            ok = ranked[hit] == want
            i, j = order[ok] + at, order[hit[ok]] + at
            once = i < j
            i, j = i[once], j[once]
            ok = _verified(fp, i, j, bits)
            left.append(i[ok])
            right.append(j[ok])
    cat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
    return cat(left), cat(right)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's postings → spanning forest edges over fingerprints."""
    parts = list(batches)
    if not parts:
        return
    t = pa.Table.from_batches(parts)
    key, fp = (t.column(c).to_numpy() for c in ("key", "fp"))
    if not len(key):
        return
    order = np.argsort(key, kind="stable")
    key, fp = key[order], fp[order]
    a, b = posting_links(key, fp.view(np.uint64))
    nodes, idx = np.unique(fp, return_inverse=True)
    root = _forest(idx[a], idx[b], len(nodes))
    own = np.flatnonzero(root != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], ["u", "v"])


def posting_keys(fp: str = "fp") -> list:
    """The six postings of a fingerprint: choice of two byte pairs, and their four bytes."""
    pair = lambda p: F.shiftrightunsigned(fp, 16 * p).bitwiseAND(F.lit(0xFFFF).cast("long"))
    return [F.shiftleft(F.lit(n).cast("long"), 32).bitwiseOR(F.shiftleft(pair(a), 16)).bitwiseOR(pair(b))
            for n, (a, b) in enumerate(combinations(range(4), 2))]


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row."""
    spark = docs.sparkSession
    fps = stash(fingerprints(docs, id_col, text_col), "simhash-fps")
    # the index is over fingerprints, so texts without a doc_id link others like any text
    classes = stash(fps.groupBy("fp").agg(F.min("doc").alias("low")), "simhash-classes")
    posts = classes.select("fp", F.explode(F.array(*posting_keys())).alias("key"))
    edges = posts.repartition("key").mapInArrow(_links, "u long, v long")
    roots = star_components(edges)
    release(spark)
    own = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = own.groupBy("root").agg(F.min("low").alias("component"))
    labels = own.join(lowest, "root").select("fp", "component")
    # one row per distinct fingerprint; AQE splits the rows of a hot fingerprint
    return (fps.join(stash(labels, "simhash-labels"), "fp", "left")
            .select(F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("component").alias("component_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with one row of each component: one with the smallest doc_id, null last."""
    rows, key = numbered(docs, by_id(id_col, text_col))
    got = simhash_components(rows, key, text_col)
    gone = got.where("doc_id <> component_id").select(F.col("doc_id").alias(key))
    return without(rows, gone, key).drop(key)
