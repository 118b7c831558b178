"""Suffix-array dedup: repeated passages keep their first document's copy only.

A byte of a document is removed if it lies in a string of ``LENGTH`` (50) bytes that also
starts in a document with a smaller doc_id.  Exact, over whole texts as UTF-8 bytes.

0. *Copies.*  A whole text of 50 bytes or more that a smaller doc_id has too is covered by it
   and needs no search: copies are found by their SHA-256 first, and only one text of each
   group goes on.
1. *Shards.*  Texts are packed into pieces of about ``PIECE`` bytes, written once.  Every
   ``LENGTH``-byte window has an anchor: of the ``LENGTH - K + 1`` ``K``-byte grams in it the one
   with the smallest hash (the leftmost on a tie).  Equal windows have equal anchors at equal
   places, wherever they stand.  Neighbouring windows with one anchor are a unit.
2. *Candidates.*  Each piece sends its sorted distinct anchors (8 bytes each) by key range; an
   owner merges the pieces' sorted runs by binary search and answers which anchors occur in
   two documents.  Other units can hold no repeat.
3. *Suffix arrays.*  Units with a shared anchor go to a shard of their anchor's key range, equal
   units of a piece as one with its smallest doc_id.  The shard merges the runs of the pieces;
   where an anchor has units that differ, their bytes form the shard's text: a suffix array by
   Larsson-Sadakane refinement, Kasai common prefixes, and runs of common prefix >= ``LENGTH``
   are the classes of equal windows, each with its smallest doc_id.
4. *Marks.*  The answers go back to their pieces; a window whose class has a smaller doc_id
   marks its bytes.

No shard holds an unbounded group: a piece sends equal units once, and an anchor with more than
``HOT_UNITS`` units (counted by its owner, over all pieces) is keyed by whole windows instead, so
that each key has one content and each piece one entry for it.  Numbers of owners follow the bytes.

Defined results: null text is empty; texts under 50 bytes keep everything; repeated rows of one
doc_id do not remove each other's bytes; a null doc_id counts as larger than all others; invalid
surrogates are as Spark holds them; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import release, stash, text_of
from parley.llm.suffix_array import kasai, suffix_array

LENGTH = 50
K = 24
PIECE = 2 << 20
CHUNK = 1 << 18
ANCHOR_BYTES = 4 << 20  # of anchors to an owner
SHARD_BYTES = 3 << 20  # of units to a shard
TEXT_BYTES = 1 << 19  # of units in one suffix array; the units of an anchor stay together
HOT_UNITS = 30_000
SALTS = 64  # parts of a group of whole copies
FLAGS = 1 << 60
NONE = np.iinfo(np.int64).max
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_TABLES: dict[str, np.ndarray] = {}


def pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    parts = [a.tobytes() for a in arrays]
    head = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(parts))


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    size = np.frombuffer(raw, np.int64, n, 8).tolist()
    at, out = 8 + 8 * n, []
    for s, kind in zip(size, kinds):
        out.append(np.frombuffer(raw[at: at + s], kind))
        at += s
    return out


def _tables() -> dict[str, np.ndarray]:
    """A 64-bit number for each byte value; powers of BASE and of its inverse modulo 2**64."""
    if not _TABLES:
        x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
        for _ in range(3):
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
        _TABLES["byte"] = x ^ (x >> np.uint64(32))
        n = CHUNK + 4 * LENGTH
        for name, b in (("up", BASE), ("down", np.uint64(pow(int(BASE), -1, 1 << 64)))):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _TABLES[name] = np.cumprod(p, dtype=np.uint64)
    return _TABLES


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


def spans_flat(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all spans in one array."""
    before = np.cumsum(size) - size
    return data[np.repeat(start - before, size) + np.arange(int(size.sum()))]


def units(data: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """The units of a piece: anchor ``key``, content hash ``u``, first window ``pos``, windows ``n``, text ``own``."""
    t = _tables()
    ends = np.cumsum(sizes)
    starts = ends - sizes
    w = LENGTH - K + 1
    parts = []
    for lo in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
        n = min(CHUNK, len(data) - LENGTH + 1 - lo)
        seg = data[lo: lo + n + LENGTH - 1]
        total = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(t["byte"][seg] * t["up"][: len(seg)], dtype=np.uint64, out=total[1:])
        gram = mix((total[K:] - total[: len(total) - K]) * t["down"][: len(seg) - K + 1])
        low = np.uint64((1 << 21) - 1)
        best = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
        span = 1
        while 2 * span <= w:
            best = np.minimum(best[:-span], best[span:])
            span *= 2
        if span < w:
            best = np.minimum(best[: len(best) - (w - span)], best[w - span:])
        anchor = (best[:n] & low).astype(np.int64)
        # windows that reach over a text's end are none
        edge = np.zeros(n + 1, np.int64)
        a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, lo + n, "left")
        np.add.at(edge, np.clip(np.maximum(ends[a:b] - LENGTH + 1, starts[a:b]) - lo, 0, n), 1)
        np.add.at(edge, np.clip(ends[a:b] - lo, 0, n), -1)
        valid = np.cumsum(edge[:n]) == 0
        new = valid & np.r_[True, (anchor[1:] != anchor[:-1]) | ~valid[:-1]]
        first = np.flatnonzero(new)
        stops = np.append(np.flatnonzero(new | ~valid), n)
        count = stops[np.searchsorted(stops, first, "right")] - first
        u = mix((total[first + count + LENGTH - 1] - total[first]) * t["down"][first] + count.astype(np.uint64))
        # mixed again: the smallest hash of a window is a small number, and owners take even key ranges
        parts.append((mix(gram[anchor[first]]), u, first + lo, count))
    if not parts:
        return {"key": np.zeros(0, np.uint64), "u": np.zeros(0, np.uint64), "pos": np.zeros(0, np.int64),
                "n": np.zeros(0, np.int64), "own": np.zeros(0, np.int64)}
    out = dict(zip(("key", "u", "pos", "n"), map(np.concatenate, zip(*parts))))
    out["own"] = np.searchsorted(ends, out["pos"], "right")
    return out


def windows_of(data: np.ndarray, x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Units as single windows, keyed by their whole content."""
    t = _tables()
    n = x["n"]
    total = int(n.sum())
    pos = np.repeat(x["pos"] - (np.cumsum(n) - n), n) + np.arange(total)
    h = np.zeros(total, np.uint64)
    for i in range(LENGTH):
        h += t["byte"][data[pos + i]] * t["up"][i]
    return {"key": mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), "u": mix(h + np.uint64(1)), "pos": pos,
            "n": np.ones(total, np.int64), "own": np.repeat(x["own"], n)}


def shared_units(data: np.ndarray, sizes: np.ndarray, shared: np.ndarray, hot: np.ndarray) -> dict[str, np.ndarray]:
    """Units whose anchor is in ``shared`` (sorted), sorted by (key, u); those in ``hot`` as single windows.

    ``slot`` numbers the distinct (key, u).
    """
    x = units(data, sizes)
    at = np.minimum(np.searchsorted(shared, x["key"]), max(0, len(shared) - 1))
    ok = shared[at] == x["key"] if len(shared) else np.zeros(len(at), bool)
    burning = ok & hot[at] if len(shared) else ok
    plain = {k: v[ok & ~burning] for k, v in x.items()}
    single = windows_of(data, {k: v[burning] for k, v in x.items()})
    x = {k: np.concatenate([plain[k], single[k]]) for k in plain}
    order = np.lexsort((x["u"], x["key"]))
    x = {k: v[order] for k, v in x.items()}
    new = np.r_[True, (x["key"][1:] != x["key"][:-1]) | (x["u"][1:] != x["u"][:-1])][: len(order)]
    x["first"] = np.flatnonzero(new)
    x["slot"] = np.cumsum(new) - 1
    return x


def unit_hashes(flat: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ``u`` of units whose bytes stand one after another in ``flat``."""
    t = _tables()
    size = n + LENGTH - 1
    before = np.cumsum(size) - size
    inner = np.arange(len(flat)) - np.repeat(before, size)
    return mix(np.add.reduceat(t["byte"][flat] * t["up"][inner], before) + n.astype(np.uint64))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: list[int] = []
    texts: list[bytes] = []
    held = 0

    def piece():
        data = b"".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        blob = pack(np.array(ids, np.int64), sizes, np.frombuffer(data, np.uint8))
        number = int.from_bytes(os.urandom(8), "big") >> 1  # kept: pieces are written before they are used
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([len(data)], pa.int64()), pa.array([blob], pa.binary())],
            ["piece", "bytes", "blob"])

    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            if texts and held + len(text) > PIECE:
                yield piece()
                ids, texts, held = [], [], 0
            ids.append(doc)
            texts.append(text)
            held += len(text)
    if texts:
        yield piece()


def _open(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(unpack(blob, np.int64, np.int64, np.uint8))


def _slices(key: np.ndarray, owners: int) -> Iterator[tuple[int, int, int]]:
    """Ranges of a sorted key array by owner (key range)."""
    width = -(-(1 << 64) // owners)
    cuts = np.array([min(o * width, (1 << 64) - 1) for o in range(1, owners)], np.uint64)
    at = [0, *np.searchsorted(key, cuts, "left").tolist(), len(key)]
    for o, (a, b) in enumerate(zip(at, at[1:])):
        if b > a:
            yield o, a, b


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted distinct (keys, counts) runs pairwise by binary search.

    Of equal keys the counts (below ``FLAGS``) are added and the flags above are united.
    """
    while len(runs) > 1:
        merged = []
        for (x, cx), (y, cy) in zip(runs[::2], runs[1::2]):
            if len(x) < len(y):
                x, cx, y, cy = y, cy, x, cx
            at = np.searchsorted(x, y)
            same = x[np.minimum(at, len(x) - 1)] == y
            cx = cx.copy()
            a, c = cx[at[same]], cy[same]
            cx[at[same]] = ((a % FLAGS) + (c % FLAGS)) | ((a | c) & ~(FLAGS - 1))
            merged.append((np.insert(x, at[~same], y[~same]), np.insert(cx, at[~same], cy[~same])))
        runs = merged + ([runs[-1]] if len(runs) % 2 else [])
    return runs[0]


def _anchor_rows(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for piece, blob in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                ids, sizes, data = _open(blob)
                x = units(data, sizes)
                order = np.lexsort((x["u"], x["key"]))
                key, u, doc = x["key"][order], x["u"][order], ids[x["own"][order]]
                if not len(key):
                    continue
                fresh = np.r_[True, key[1:] != key[:-1]]
                first = np.flatnonzero(fresh)
                several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
                differ = np.add.reduceat((fresh | np.r_[True, u[1:] != u[:-1]]).astype(np.int64), first)
                note = (np.minimum(differ, 32_000) * 2 + several).astype(np.uint16)
                key = key[first]
                rows = [(o, piece, pack(key[a:c], note[a:c])) for o, a, c in _slices(key, owners)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))],
                    ["owner", "piece", "anchors"])

    return run


def _shared_anchors(rows: pd.DataFrame) -> pd.DataFrame:
    """One key range: which anchors of each piece occur in two documents, and which are hot."""
    runs = [unpack(a, np.uint64, np.uint16) for a in rows["anchors"]]
    keys = [k for k, _ in runs]
    # pieces in the low 26 bits, units above them; flag: two documents in a piece
    whole, count = merge_runs([(k, 1 + ((n >> 1).astype(np.int64) << 26) + FLAGS * (n & 1).astype(np.int64)) for k, n in runs])
    shared = (count & ((1 << 26) - 1) > 1) | (count >= FLAGS)
    hot = (count % FLAGS) >> 26 > HOT_UNITS
    out = []
    for piece, k in zip(rows["piece"], keys):
        at = np.searchsorted(whole, k)
        got = shared[at]
        if got.any():
            out.append((piece, 0, pack(k[got], hot[at[got]].astype(np.uint8)), int(got.sum())))
    return pd.DataFrame(out, columns=["piece", "kind", "answer", "size"])


def _answers(right: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shared anchors of a piece, sorted, and which are hot."""
    got = [unpack(a, np.uint64, np.uint8) for a in right["answer"]]
    if not got:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    key, hot = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got]).astype(bool)
    order = np.argsort(key)
    return key[order], hot[order]


def _unit_rows(shards: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(right):
            for piece, blob in zip(left["piece"], left["blob"]):
                ids, sizes, data = _open(blob)
                x = shared_units(data, sizes, *_answers(right))
                first = x["first"]
                if not len(first):
                    continue
                doc = ids[x["own"]]
                low, high = np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)
                key, n, pos = (x[c][first] for c in ("key", "n", "pos"))
                for s, a, b in _slices(key, shards):
                    flat = spans_flat(data, pos[a:b], n[a:b] + LENGTH - 1)
                    out.append((s, piece, a, pack(key[a:b], n[a:b].astype(np.uint8), low[a:b],
                                                  (high[a:b] > low[a:b]).astype(np.uint8), flat)))
        return pd.DataFrame(out, columns=["shard", "piece", "slot", "units"])

    return run


def window_minima(flat: np.ndarray, n: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Smallest doc of each window of the units in ``flat``, by suffix array and common prefixes."""
    size = n + LENGTH - 1
    before = np.cumsum(size) - size
    sa, _ = suffix_array(flat, LENGTH)
    same = kasai(flat, sa, LENGTH) >= LENGTH
    own = np.repeat(np.arange(len(n)), size)
    window = np.arange(len(flat)) - before[own] < n[own]
    doc = np.where(window, low[own], NONE)[sa]
    first = np.flatnonzero(~same)
    least = np.minimum.reduceat(doc, first)
    at = np.empty(len(flat), np.int64)
    at[sa] = np.repeat(least, np.diff(np.r_[first, len(sa)]))
    return at[window]


def _shard_answers(rows: pd.DataFrame) -> pd.DataFrame:
    """One shard: merge the pieces' units; smallest doc of every window, for units where it can matter."""
    got = [unpack(b, np.uint64, np.uint8, np.int64, np.uint8, np.uint8) for b in rows["units"]]
    u = np.concatenate([unit_hashes(g[4], g[1].astype(np.int64)) for g in got])
    key, n, low, several, flat = (np.concatenate([g[i] for g in got]) for i in range(5))
    n = n.astype(np.int64)
    at = np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)
    order = np.lexsort((u, key))
    new = np.r_[True, (key[order][1:] != key[order][:-1]) | (u[order][1:] != u[order][:-1])]
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(low[order], first)
    entry = np.empty(len(order), np.int64)  # distinct unit of each entry
    entry[order] = np.cumsum(new) - 1
    one = order[first]
    k1, n1 = key[one], n[one]
    alike = np.r_[False, k1[1:] == k1[:-1]] | np.r_[k1[1:] == k1[:-1], False]
    offset = np.cumsum(n1) - n1
    minima = np.repeat(least, n1)
    # blocks of whole anchors with about TEXT_BYTES of units that differ
    differ = np.flatnonzero(alike)
    size = np.cumsum(n1[differ] + LENGTH - 1)
    start = np.flatnonzero(np.r_[True, k1[differ][1:] != k1[differ][:-1]][: len(differ)])
    block = (size[start] // TEXT_BYTES) if len(differ) else start
    for cut in np.split(differ, start[1:][block[1:] != block[:-1]]) if len(differ) else ():
        pick, m = one[cut], n1[cut]
        text = spans_flat(flat, at[pick], m + LENGTH - 1)
        where = np.repeat(offset[cut] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
        minima[where] = window_minima(text, m, least[cut])
    best = np.minimum.reduceat(minima, offset)
    out, done = [], 0
    for piece, slot, g in zip(rows["piece"], rows["slot"], got):
        own = slice(done, done + len(g[0]))
        done += len(g[0])
        e = entry[own]
        tell = np.flatnonzero((best[e] < low[own]) | (several[own] > 0))
        if len(tell):
            e = e[tell]
            idx = np.repeat(offset[e] - (np.cumsum(n1[e]) - n1[e]), n1[e]) + np.arange(int(n1[e].sum()))
            out.append((piece, 1, pack((slot + tell).astype(np.int64), minima[idx]), len(tell)))
    return pd.DataFrame(out, columns=["piece", "kind", "answer", "size"])


def covered(data: np.ndarray, sizes: np.ndarray, ids: np.ndarray, right: pd.DataFrame) -> np.ndarray:
    """Which bytes of a piece lie in a window that also starts in a smaller document."""
    edge = np.zeros(len(data) + 1, np.int64)
    marks = right[right["kind"] == 1]
    if len(marks):
        x = shared_units(data, sizes, *_answers(right[right["kind"] == 0]))
        n1 = x["n"][x["first"]]
        offset = np.cumsum(n1) - n1
        minima = np.full(int(n1.sum()), NONE)
        for a in marks["answer"]:
            slot, least = unpack(a, np.int64, np.int64)
            n = n1[slot]
            minima[np.repeat(offset[slot] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] = least
        n, slot = x["n"], x["slot"]
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        hit = minima[np.repeat(offset[slot], n) + inner] < np.repeat(ids[x["own"]], n)
        pos = (np.repeat(x["pos"], n) + inner)[hit]
        edge[: len(data) + 1] += np.bincount(pos, minlength=len(data) + 1)
        edge -= np.bincount(pos + LENGTH, minlength=len(data) + 1)[: len(data) + 1]
    return np.cumsum(edge[:-1]) > 0


def _finish(texts: bool):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for blob in left["blob"]:
            ids, sizes, data = _open(blob)
            gone = covered(data, sizes, ids, right)
            starts = np.cumsum(sizes) - sizes
            for doc, a, size in zip(ids.tolist(), starts.tolist(), sizes.tolist()):
                own = gone[a: a + size]
                kept = data[a: a + size][~own].tobytes()
                spans = int(np.count_nonzero(own[1:] & ~own[:-1]) + (size > 0 and bool(own[0])))
                row = (None if doc == NONE else doc, size, int(np.count_nonzero(own)), spans, hashlib.sha256(kept).hexdigest())
                out.append((*row, kept) if texts else row)
        got = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * texts])
        got["doc_id"] = got["doc_id"].astype("Int64")
        return got

    return run


ANSWER = "piece long, kind int, answer binary, size long"


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row; with ``texts`` also ``kept`` (bytes)."""
    spark = docs.sparkSession
    text = text_of(text_col)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NONE)).alias("doc"), text.alias("text"),
                       F.sha2(text, 256).alias("sha"))
    whole = stash(rows.where(F.octet_length("text") >= LENGTH).select(
        "doc", F.unhex("sha").alias("sha"), F.octet_length("text").cast("long").alias("bytes"),
        (F.rand(0) * SALTS).cast("int").alias("salt")), "suffix-whole")  # written: every pass reads the same salts
    # a group of copies may hold a third of all rows: a key is a text in one of SALTS parts
    parts = whole.groupBy("sha", "salt").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    group = Window.partitionBy("sha")  # at most SALTS rows
    first = parts.select("sha", "salt", F.min("low").over(group).alias("first"),
                         F.max("high").over(group).alias("last")).where("first < last").drop("last")
    copies = stash(whole.join(first, ["sha", "salt"]).where("doc > first").select("doc", F.lower(F.hex("sha")).alias("sha"), "bytes"),
                   "suffix-copies")
    one = rows.join(copies.select("doc", "sha").distinct().hint("shuffle_hash"), ["doc", "sha"], "left_anti")
    pieces = stash(one.select("doc", "text").mapInArrow(_pieces, "piece long, bytes long, blob binary"), "suffix-pieces")
    release(spark)
    total = pieces.agg(F.sum("bytes")).first()[0] or 0
    owners = int(max(1, -(-total // (ANCHOR_BYTES * 2))))  # about 0.07 anchors a byte
    anchors = pieces.mapInArrow(_anchor_rows(owners), "owner int, piece long, anchors binary")
    shared = stash(anchors.groupBy("owner").applyInPandas(_shared_anchors, ANSWER), "suffix-anchors")
    release(spark)
    units_total = shared.agg(F.sum("size")).first()[0] or 0
    shards = int(max(1, -(-units_total * 64 // SHARD_BYTES)))
    rows = pieces.groupBy("piece").cogroup(shared.groupBy("piece")).applyInPandas(
        _unit_rows(shards), "shard int, piece long, slot long, units binary")
    marks = stash(rows.groupBy("shard").applyInPandas(_shard_answers, ANSWER), "suffix-marks")
    release(spark)
    answers = shared.unionByName(marks)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    out = pieces.groupBy("piece").cogroup(answers.groupBy("piece")).applyInPandas(_finish(texts), schema)
    gone = copies.select(F.nullif("doc", F.lit(NONE)).alias("doc_id"), F.col("bytes").alias("n_bytes"),
                         F.col("bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                         F.sha2(F.lit(""), 256).alias("kept_sha256"), *[F.lit(b"").alias("kept")] * texts)
    return out.unionByName(gone)
