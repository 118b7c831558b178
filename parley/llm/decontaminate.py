"""Benchmark decontamination by spaced-seed hashing.

Texts are tokens: maximal runs of letters and digits, lower-cased.  A fixed mask
reads some positions of a token window and ignores the others, so a changed
token at an ignored position keeps the hash.  The masks in ``MASKS`` are chosen
so that any ``WINDOW`` tokens with up to two substitutions are hit by at least
one mask at one place (covered by a test).  Shorter items use blocks: cut in one
more block than the substitutions allowed, one block is always unchanged.

Hashes of the items' seeds and of the texts' seeds meet in a shuffle join, at
every size of either side.  Each side carries the tokens around its seed: the
``WINDOW - 1`` before and after it, or for a shorter item the whole item's
place.  Joined places are aligned on their diagonal and each window of
``min(WINDOW, item)`` tokens around the hit is verified: an overlap needs
``SHARE`` of its tokens equal, position by position.

Before the join, a text's seeds that no item can have are left out by a Bloom
filter of the items' hashes, of at most ``BLOCK_BYTES`` whatever the benchmark's
size: with more items more seeds pass it, and the join decides.  Equal places of
a text are one.  The texts take no part in the join, and ``drop_contaminated``
moves those only that hold a place.

Defined results: null and empty texts and items match nothing; item ids are of any type, and an item without one
counts like any other (a null in ``items``, once and last); items below
``LEAST`` tokens must be equal throughout; every row has a verdict of its own,
also with a null or repeated doc_id; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import stash, text_of, without

WINDOW = 13
SHARE = 0.8
LEAST = 5
#: Token positions that a seed reads (fixed values).
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
BLOCK_BYTES = 8 * 1024 * 1024
PIECE_CHARS = 1 << 20
CHUNK = 50_000  # places whose windows are made at once
RECORD_PLACES = 1 << 16
PROBES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93)  # multipliers of the filter's places
BASE = np.uint64(0x100000001B3 | 1)

_FOLD: list = []
_POWERS: dict[str, np.ndarray] = {}


def fold_table() -> np.ndarray:
    """Code point (16 bits) → lower-case code of a letter or digit, 0 for a separator."""
    if not _FOLD:
        t = np.zeros(1 << 16, np.uint32)
        for c in range(1 << 16):
            s = chr(c)
            if s.isalnum():
                low = s.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(t)
    return _FOLD[0]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, b in (("up", BASE), ("down", inverse)):
            p = np.full(max(n, PIECE_CHARS + (1 << 17)), b, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every token of all texts, and the text of each."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    flat = " ".join(texts)
    codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
    code = fold_table()[np.minimum(codes, 0xFFFF)]
    for at in np.flatnonzero(codes > 0xFFFF).tolist():
        s = chr(int(codes[at]))
        code[at] = ord(s.lower()[0]) if s.isalnum() else 0
    word = code != 0
    edge = np.diff(np.r_[False, word, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(code) + 1)
    total = np.r_[np.uint64(0), np.cumsum(code.astype(np.uint64) * up[: len(code)], dtype=np.uint64)]
    h = (total[end] - total[start]) * down[start]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first = np.cumsum(size) - size
    return h ^ (h >> np.uint64(29)), np.searchsorted(first, start, "right") - 1


def seed_hashes(tok: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hash of the masked tokens from each start at which the mask fits."""
    n = max(0, len(tok) - mask[-1])
    h = np.full(n, np.uint64(len(mask)))
    for at in mask:
        h = (h ^ tok[at: at + n]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


def allowed(n: int) -> tuple[int, int]:
    """Verified window and substitutions allowed for an item of ``n`` tokens."""
    w = min(n, WINDOW)
    return w, 0 if n < LEAST else w - int(np.ceil(w * SHARE - 1e-9))


def item_masks(n: int) -> list[tuple[int, tuple[int, ...]]]:
    """For an item of ``n`` tokens: (only start, or -1 for every start; mask)."""
    if n >= WINDOW:
        return [(-1, m) for m in MASKS]
    w, subs = allowed(n)
    cuts = [w * i // (subs + 1) for i in range(subs + 2)]
    return [(a, tuple(range(b - a))) for a, b in zip(cuts, cuts[1:]) if b > a]


#: Kinds of seeds: tokens of the item (``WINDOW``: that many or more), the seed's place in it (-1: any) and its mask.
KINDS = [(n, at, mask) for n in range(1, WINDOW + 1) for at, mask in item_masks(n)]


def seed_places(tok: np.ndarray, own: np.ndarray, first: np.ndarray, size: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the seeds of a kind in all texts, and their hashes (which differ by kind)."""
    n, at, mask = KINDS[kind]
    h = seed_hashes(tok, mask)
    p = np.arange(len(h))
    start = p - max(at, 0)
    fits = start >= first[own[: len(h)]]
    if at < 0:
        fits &= own[: len(h)] == own[mask[-1]:][: len(h)]
        fits &= size[own[: len(h)]] >= n
    else:
        fits &= start + n <= (first + size)[own[: len(h)]]
    p = p[fits]
    h = (h[fits] ^ np.uint64((kind + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
    return p, h ^ (h >> np.uint64(33))


def windows(tok: np.ndarray, first: np.ndarray, end: np.ndarray, p: np.ndarray, kind: int) -> np.ndarray:
    """Bytes of the tokens around each place (of the text from ``first`` to ``end``): the place of a short item, or
    ``WINDOW - 1`` tokens on either side and how many of them are the text's."""
    n, at, _ = KINDS[kind]
    if at >= 0:
        return tok[(p - at)[:, None] + np.arange(n)].view(np.uint8).reshape(len(p), 8 * n)
    reach = p[:, None] + np.arange(1 - WINDOW, WINDOW)
    ok = (reach >= first[:, None]) & (reach < end[:, None])
    near = np.where(ok, tok[np.where(ok, reach, 0)], np.uint64(0))
    sides = np.stack([np.minimum(p - first, WINDOW - 1), np.minimum(end - 1 - p, WINDOW - 1)], 1).astype(np.uint8)
    return np.concatenate([near.view(np.uint8).reshape(len(p), -1), sides], 1)


def shares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of ``windows`` of one kind, the largest share of equal tokens in an overlap, 0 if there is none."""
    if a.shape[1] % 8 == 0:
        n = a.shape[1] // 8
        equal = (np.ascontiguousarray(a).view(np.uint64) == np.ascontiguousarray(b).view(np.uint64)).sum(1)
        return np.where(equal >= n - allowed(n)[1], equal / n, 0.0)
    width, subs = allowed(WINDOW)
    reach = np.arange(1 - WINDOW, WINDOW)
    sides = np.minimum(a[:, -2:], b[:, -2:]).astype(np.int64)
    ok = (reach >= -sides[:, :1]) & (reach <= sides[:, 1:])
    same = ok & (np.ascontiguousarray(a[:, :-2]).view(np.uint64) == np.ascontiguousarray(b[:, :-2]).view(np.uint64))
    oks, sums = (np.concatenate([np.zeros((len(a), 1), int), np.cumsum(x, 1)], 1) for x in (ok, same))
    best = np.zeros(len(a))
    for s in range(WINDOW):  # windows that start s places from the left end and hold the hit
        equal = sums[:, s + width] - sums[:, s]
        full = oks[:, s + width] - oks[:, s] == width
        best = np.maximum(best, np.where(full & (equal >= width - subs), equal / width, 0.0))
    return best


def _binary(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _distinct(rows: np.ndarray) -> np.ndarray:
    rows = np.ascontiguousarray(rows)
    return np.unique(rows.view(np.dtype((np.void, rows.shape[1])))).view(np.uint8).reshape(-1, rows.shape[1])


def found_seeds(texts: list[str], kinds: list[int], known: Callable[[np.ndarray], np.ndarray] | None = None,
                items: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per kind: kind, texts, hashes and windows of the different seeds of which ``known`` returns the places, by text.

    ``items``: the texts are items, whose kinds are those of their own size.
    """
    tok, own = tokens(texts)
    size = np.bincount(own, minlength=len(texts))
    first = np.cumsum(size) - size
    for k in kinds if len(tok) else ():
        p, h = seed_places(tok, own, first, size, k)
        ok = np.flatnonzero(np.minimum(size, WINDOW)[own[p]] == KINDS[k][0]) if items else known(h)
        p, h = p[ok], h[ok]
        rows = []
        for at in range(0, len(p), CHUNK):
            q = p[at: at + CHUNK]
            text = own[q]
            win = windows(tok, first[text], (first + size)[text], q, k)
            key = np.stack([text.astype(">i8").view(np.int64), h[at: at + CHUNK].view(np.int64)], 1)
            rows.append(_distinct(np.concatenate([key.view(np.uint8).reshape(len(q), 16), win], 1)))
        if rows:
            rows = _distinct(np.concatenate(rows)) if len(rows) > 1 else rows[0]
            key = np.ascontiguousarray(rows[:, :16]).view(np.int64)
            yield k, key[:, 0].view(">i8").astype(np.int64), key[:, 1].copy(), rows[:, 16:]


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = n = 0
    for i, t in enumerate(texts):
        n += len(t) + 1
        if n >= PIECE_CHARS:
            yield at, i + 1
            at, n = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def item_seeds(benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(k, h, near, i)``: kind, hash and window of every seed of the items, and the item's id (of any type, null too)."""
    bench = benchmark.select(F.col(item_col).alias("i"), text_of(item_text_col).alias("t")).where("t <> ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(1).to_pylist()
            for lo, hi in _pieces(own):
                for k, item, h, win in found_seeds(own[lo:hi], list(range(len(KINDS))), items=True):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(h), k, np.int32)), pa.array(h), _binary(win), b.column(0).take(pa.array(item + lo))],
                        ["k", "h", "near", "i"])

    schema = T.StructType().add("k", T.IntegerType()).add("h", T.LongType()).add("near", T.BinaryType()).add("i", bench.schema["i"].dataType)
    return stash(bench.mapInArrow(run, schema), "item-seeds")


def probe(h: np.ndarray, j: int, places: int) -> np.ndarray:
    return (h * np.uint64(PROBES[j])) >> np.uint64(64 - places)


def bit_table(seeds: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Bloom filter of the hashes, of 64 or more bits a seed up to ``BLOCK_BYTES``, and the bits of a place in it."""
    places = max(6, min((8 * BLOCK_BYTES).bit_length() - 1, (64 * n).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(0).to_numpy().view(np.uint64)
            bits = np.unique(np.concatenate([probe(h, j, places) for j in range(len(PROBES))]))
            x = np.uint64(1) << (bits & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((bits >> np.uint64(6)).view(np.int64)), pa.array(x.view(np.int64))], ["w", "x"])

    got = seeds.select("h").mapInArrow(run, "w long, x long").groupBy("w").agg(F.bit_or("x").alias("x")).toArrow()
    table = np.zeros(1 << (places - 6), np.uint64)
    table[got["w"].to_numpy()] = got["x"].to_numpy().view(np.uint64)
    return table, places


def text_seeds(docs: DataFrame, text_col: str, seeds: DataFrame, to: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the seeds that an item may have: ``{to}h``, ``{to}near``, and for a row of very many in several
    records, of which one is ``{to}first``; ``{to}row`` is the row's key once this is written."""
    sizes = {r["k"]: r["n"] for r in seeds.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}  # a number a kind
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(seeds, sum(sizes.values())))  # at most BLOCK_BYTES
    kept = docs.select(*keep)
    width, names = len(keep), [*keep, f"{to}row", f"{to}first", f"{to}h", f"{to}near"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, places = shared.value
        row = TaskContext.get().partitionId() << 40

        def known(h: np.ndarray) -> np.ndarray:
            left = np.arange(len(h))
            for j in range(len(PROBES)):
                bit = probe(h[left] if j else h, j, places)
                left = left[(table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)]
            return left

        for b in batches:
            texts = b.column(width).to_pylist()
            for lo, hi in _pieces(texts):
                own, h, near = [], [], []
                for _, text, hashes, win in found_seeds(texts[lo:hi], sorted(sizes), known):
                    own.append(text)
                    h.append(hashes)
                    near.append(_binary(win))
                own = np.concatenate(own) if own else np.zeros(0, np.int64)
                order = np.argsort(own, kind="stable")
                n = np.bincount(own, minlength=hi - lo)
                h = pa.array(np.concatenate(h)[order] if h else np.zeros(0, np.int64))
                near = pa.concat_arrays(near).take(pa.array(order)) if near else pa.array([], pa.binary())
                records = np.maximum(1, -(-n // RECORD_PLACES))
                of = np.repeat(np.arange(hi - lo), records)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(records) - records, records)
                ends = np.r_[0, np.cumsum(np.minimum(n[of] - nth * RECORD_PLACES, RECORD_PLACES))].astype(np.int32)
                at = pa.array(of + lo)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).take(at) for c in range(width)), pa.array(row + of), pa.array(nth == 0),
                     pa.ListArray.from_arrays(pa.array(ends), h), pa.ListArray.from_arrays(pa.array(ends), near)], names)
                row += hi - lo

    schema = T.StructType([*kept.schema.fields, T.StructField(f"{to}row", T.LongType()), T.StructField(f"{to}first", T.BooleanType()),
                           T.StructField(f"{to}h", T.ArrayType(T.LongType())), T.StructField(f"{to}near", T.ArrayType(T.BinaryType()))])
    return docs.select(*keep, text_of(text_col).alias(f"{to}text")).mapInArrow(run, schema)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        size = pc.binary_length(b.column("near")).to_numpy(zero_copy_only=False)
        fair = size == pc.binary_length(b.column("theirs")).to_numpy(zero_copy_only=False)
        share = np.zeros(len(size))
        for n in np.unique(size[fair]).tolist():
            at = np.flatnonzero(fair & (size == n))
            for to in range(0, len(at), CHUNK):
                some = at[to: to + CHUNK]
                sides = (np.frombuffer(b"".join(b.column(c).take(pa.array(some)).to_pylist()), np.uint8).reshape(-1, n)
                         for c in ("near", "theirs"))
                share[some] = shares(*sides)
        hit = pa.array(share > 0)
        yield pa.RecordBatch.from_arrays([b.column("row").filter(hit), b.column("i").filter(hit), pa.array(share).filter(hit)],
                                         ["row", "i", "share"])


def overlaps(held: DataFrame, seeds: DataFrame, to: str) -> DataFrame:
    """``({to}row, items, best)`` of the rows of written ``text_seeds`` that overlap an item: the join of seed hashes."""
    places = held.select(F.col(f"{to}row").alias("row"), F.explode(F.arrays_zip(F.col(f"{to}h").alias("h"), F.col(f"{to}near").alias("near"))).alias("s"))
    places = places.select("row", F.col("s.h").alias("h"), F.col("s.near").alias("near"))
    met = places.hint("merge").join(seeds.select("h", F.col("near").alias("theirs"), "i"), "h").select("row", "near", "theirs", "i")
    schema = T.StructType().add("row", T.LongType()).add("i", seeds.schema["i"].dataType).add("share", T.DoubleType())
    return met.mapInArrow(_verify, schema).groupBy(F.col("row").alias(f"{to}row")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array("i"))))).alias("items"), F.max("share").alias("best"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, contaminated, n_items, items, best_share)``, one row per input row; ``items`` are item ids."""
    seeds = item_seeds(benchmark, item_col, item_text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    held = stash(text_seeds(rows, "text", seeds, "_", ["doc_id"]), "text-seeds")
    out = held.where("_first").select("_row", "doc_id").join(overlaps(held, seeds, "_"), "_row", "left")
    items = F.coalesce("items", F.array().cast(T.ArrayType(seeds.schema["i"].dataType)))
    return out.select("doc_id", (F.size(items) > 0).alias("contaminated"), F.size(items).cast("long").alias("n_items"),
                      items.alias("items"), F.coalesce("best", F.lit(0.0)).alias("best_share"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the rows whose text overlaps a benchmark item."""
    seeds, to = item_seeds(benchmark), "_"
    while any(c.lower().startswith(to) for c in docs.columns):
        to += "_"
    placed = text_seeds(docs, text_col, seeds, to, docs.columns)
    held = stash(placed.where(F.size(f"{to}h") > 0), "text-seeds")
    gone = overlaps(held, seeds, to).select(f"{to}row")
    left = without(held.where(f"{to}first"), gone, f"{to}row")
    return placed.where(F.size(f"{to}h") == 0).select(*docs.columns).union(left.select(*docs.columns))
