"""Language identification with bit-sliced Bloom filters of character n-grams.

Fitting counts the letter n-grams of all training texts per language in
Spark.  An n-gram belongs to a language if its share of that language's
n-grams is at least ``MIN_SHARE`` (so a language has at most ``1/MIN_SHARE``
n-grams) and at least ``MIN_RATIO`` of its largest share in any language.

The filter is a table of ``2**LOG_SLOTS`` slots, each a bit mask of languages:
slice l of the table is the Bloom filter of language l.  An n-gram is hashed
to ``HASHES`` slots; the AND of their masks returns all languages that contain
it in one lookup.  Predicting counts, per text and language, the n-grams whose
mask has the language's bit, and takes out the expected false positives:
with fill f of slice l and k hashes, ``(hits - n f^k) / (1 - f^k)``.  The
highest corrected count decides (ties: the language first in order); the score
is its share of all corrected counts.

A mask has ``WORD`` bits: every ``WORD`` languages have a table of their own with
the same slots, so any number of languages is served; what is broadcast is a
fixed size for each ``WORD`` languages.

Defined results: null text or text without a letter is ``und`` with score 0;
letters without any known n-gram give the language with most training n-grams
and score 0; without training rows everything is ``und``; repeated rows repeat
their result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stash, text_of

N = 3
LOG_SLOTS = 20
HASHES = 4
MIN_SHARE = 2e-5
MIN_RATIO = 0.1
WORD = 64  # languages in a mask
PIECE_CHARS = 1 << 20

_FOLD: list = []


def fold_table() -> np.ndarray:
    """Code point (16 bits; others share one slot) → lower-case letter code, 0 for no letter."""
    if not _FOLD:
        t = np.zeros(1 << 16, np.uint16)
        for c in range(1 << 16):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                t[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
        _FOLD.append(t)
    return _FOLD[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``N``-grams of all texts (words padded by a blank; runs of non-letters are one blank), the text of each,
    and whether each text has a letter."""
    flat = " ".join(texts)
    codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = fold_table()[np.minimum(codes, 0xFFFF)]
    high = codes > 0xFFFF
    if high.any():  # letters beyond the basic plane: folded by their low bits
        for at in np.flatnonzero(high).tolist():
            letter[at] = (int(codes[at]) & 0xFFFF) | 1 if chr(int(codes[at])).isalpha() else 0
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.repeat(np.arange(len(texts)), size)[: len(codes)]
    keep = (letter != 0) | np.r_[False, letter[:-1] != 0]  # a blank after each word
    letter, owner = letter[keep].astype(np.uint64), owner[keep]
    has = np.bincount(owner[letter != 0], minlength=len(texts)) > 0
    if not len(letter):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has
    pad = np.r_[np.uint64(0), letter, np.uint64(0)]
    own = np.r_[owner[:1], owner, owner[-1:]]
    key = np.zeros(len(pad) - N + 1, np.uint64)
    for n in range(N):
        key = (key << np.uint64(16)) | pad[n: len(pad) - N + 1 + n]
    own_key = own[N // 2: len(pad) - N + 1 + N // 2]
    # centred on a letter, so an n-gram of three never holds letters of two words
    mid = pad[N // 2: len(pad) - N + 1 + N // 2] != 0
    return key[mid], own_key[mid], has


def slots(key: np.ndarray) -> list[np.ndarray]:
    """The ``HASHES`` slots of each n-gram."""
    h = key * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    step = (h >> np.uint64(40)) | np.uint64(1)
    mask = np.uint64((1 << LOG_SLOTS) - 1)
    return [((h + np.uint64(i) * step) & mask).astype(np.int64) for i in range(HASHES)]


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = n = 0
    for i, t in enumerate(texts):
        n += len(t) + 1
        if n >= PIECE_CHARS:
            yield at, i + 1
            at, n = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts per language of one task."""
    seen: dict[str, list] = {}

    def merged(parts):
        keys = np.concatenate([p[0] for p in parts])
        uniq, inv = np.unique(keys, return_inverse=True)
        return uniq, np.bincount(inv, np.concatenate([p[1] for p in parts])).astype(np.int64)

    for b in batches:
        by: dict[str, list[str]] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            by.setdefault(lang, []).append(text)
        for lang, texts in by.items():
            for lo, hi in _pieces(texts):
                parts = seen.setdefault(lang, [])
                parts.append(np.unique(grams(texts[lo:hi])[0], return_counts=True))
                if len(parts) >= 8:
                    seen[lang] = [merged(parts)]
    for lang, parts in seen.items():
        key, n = merged(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(key), pa.string()), pa.array(key.view(np.int64)), pa.array(n)],
            ["lang", "gram", "n"])


def _slots_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        key = b.column(0).to_numpy().view(np.uint64)
        for s in slots(key):
            yield pa.RecordBatch.from_arrays([pa.array(s), b.column(1), b.column(2)], ["slot", "mask", "word"])


class Model:
    """Languages in bit order, the bit-sliced table of the first ``WORD``, the language with most training n-grams,
    and the tables of the further languages."""

    def __init__(self, langs: list[str], table: np.ndarray, default: int, more: tuple[np.ndarray, ...] = ()):
        self.langs, self.table, self.default = langs, table, default
        self.tables = (table, *more)
        self.false = [float(((self.tables[i // WORD] >> np.uint64(i % WORD)) & np.uint64(1)).mean()) ** HASHES
                      for i in range(len(langs))]

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        key, own, has = grams(texts)
        total = np.bincount(own, minlength=len(texts))
        at = slots(key)
        est = np.zeros((len(self.langs), len(texts)))
        for i in range(len(self.langs)):
            if i % WORD == 0:
                mask = np.full(len(key), np.uint64(0xFFFFFFFFFFFFFFFF))
                for s in at:
                    mask &= self.tables[i // WORD][s]
            bit = ((mask >> np.uint64(i % WORD)) & np.uint64(1)).astype(np.float64)
            hits = np.bincount(own, bit, len(texts))
            est[i] = np.maximum(0, (hits - total * self.false[i]) / max(1e-9, 1 - self.false[i]))
        if not self.langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        best, whole = est.argmax(0), est.sum(0)
        names, scores = [], []
        for d in range(len(texts)):
            if not has[d]:
                names.append("und")
                scores.append(0.0)
            elif whole[d] <= 0:
                names.append(self.langs[self.default])
                scores.append(0.0)
            else:
                names.append(self.langs[best[d]])
                scores.append(float(est[best[d], d] / whole[d]))
        return names, scores


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model from all rows of ``train`` whose language is not null."""
    rows = train.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), text_of(text_col).alias("text"))
    counts = rows.mapInArrow(_count, "lang string, gram long, n long")
    counts = stash(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    known = sorted((r["lang"], r["total"]) for r in totals.collect())  # one row per language
    tables = [np.zeros(1 << LOG_SLOTS, np.uint64) for _ in range(max(1, -(-len(known) // WORD)))]
    if not known:
        return Model([], tables[0], 0)
    bits = train.sparkSession.createDataFrame([(lang, i, n) for i, (lang, n) in enumerate(known)],
                                              "lang string, bit int, total long")
    shares = counts.join(F.broadcast(bits), "lang").select("gram", "bit", (F.col("n") / F.col("total")).alias("share"))
    shares = shares.where(F.col("share") >= MIN_SHARE)
    tops = shares.groupBy("gram").agg(F.max("share").alias("top"))
    own = shares.join(tops, "gram").where(F.col("share") >= F.col("top") * MIN_RATIO)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bit", F.lit(WORD)))
    masks = own.groupBy("gram", F.floor(F.col("bit") / WORD).cast("int").alias("word")).agg(F.bit_or(bit).alias("mask"))
    filled = masks.select("gram", "mask", "word").mapInArrow(_slots_of, "slot long, mask long, word int")
    filled = filled.groupBy("word", "slot").agg(F.bit_or("mask").alias("mask"))
    for r in filled.toLocalIterator(prefetchPartitions=True):  # at most 2**LOG_SLOTS rows per WORD languages
        tables[r["word"]][r["slot"]] = np.uint64(r["mask"] & 0xFFFFFFFFFFFFFFFF)
    default = max(range(len(known)), key=lambda i: (known[i][1], -i))
    return Model([lang for lang, _ in known], tables[0], default, tuple(tables[1:]))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            extra: dict[str, Column] | None = None) -> DataFrame:
    """``(id, *extra, lang_pred, score)``, one row per input row; ``extra`` columns pass through."""
    # 2**LOG_SLOTS masks for each WORD languages; plain values, so that executors need not import this package
    shared = df.sparkSession.sparkContext.broadcast((model.langs, model.table, model.default, model.tables[1:]))
    extra = extra or {}
    cols = [F.col(id_col).alias(id_col), *[c.alias(k) for k, c in extra.items()]]
    head = df.select(*cols)
    width = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for b in batches:
            texts = b.column(width).to_pylist()
            for lo, hi in _pieces(texts):
                names, scores = m.predict(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c).slice(lo, hi - lo) for c in range(width)], pa.array(names, pa.string()),
                     pa.array(scores, pa.float64())],
                    [*b.schema.names[:width], "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in head.schema)
    return df.select(*cols, text_of(text_col).alias("_text")).mapInArrow(run, f"{schema}, lang_pred string, score double")
