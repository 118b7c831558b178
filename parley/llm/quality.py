"""Quality classifier: interpolated modified Kneser-Ney n-gram model of trusted text.

Texts are read as symbols of an alphabet of 64 (base letters, one symbol for an
upper-case mark, digit, blank, line break, each ASCII sign, two escapes).  Any
other character is an escape and its code point in base 64, so the alphabet is
open: no two characters outside a-z share their symbols (accents are folded).
n-grams are whole numbers of ``6 * ORDER`` bits.

* Training counts the ``ORDER``-grams of all trusted texts in tasks and sums them
  by shard (hash of the n-gram).  Lower orders use continuation counts: the
  number of different symbols before an n-gram.  Per order, the counts of
  counts give the modified Kneser-Ney discounts D1, D2, D3+.
* Sharded count joins put together each n-gram's count, its context's total
  and numbers of one-, two- and more-counted continuations, and the lower
  order's probability: p = max(c - D, 0) / total + gamma * p_lower.
* Scoring is a sharded join as well.  Texts are dealt to blocks; a block asks for
  each of its n-grams, their suffixes and contexts once (so frequent n-grams are
  one row a block, however often they occur), the requests meet the model's
  probabilities and context weights by shard, and the answers return to the
  block, which fills in unseen n-grams from gamma * p_lower and sums each whole
  text's perplexity.  No task and no driver holds the model.  Symbols are not
  sorted or searched: a task marks, counts and looks up n-grams by their number
  in arrays of 64^ORDER places, and sorts and searches different n-grams only.
* A text is rejected if its perplexity is above its language's threshold: the
  ``QUANTILE`` of the trusted texts' perplexities in that language, times
  ``MARGIN``.  Languages with fewer than ``MIN_TRUSTED`` trusted texts use the
  quantile over all trusted texts.

Defined results: null, empty and blank texts have no perplexity and are
rejected; without trusted text every other text is kept; a null language is a
language of its own; repeated rows repeat their result; extra columns pass
through ``keep_quality`` and are not read by the model.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import numbered, only, release, stash, text_of, without

ORDER = 4
BITS = 6
QUANTILE = 0.995
MARGIN = 1.25
MIN_TRUSTED = 50
PIECE_CHARS = 1 << 20
BLOCK_BYTES = 4 << 20
PRIME = 1_000_003
UPPER, DIGIT, BLANK, BREAK, LETTER, OTHER = 27, 28, 29, 30, 62, 63
#: Code points below the first are LETTER and two base-64 digits (no first digit is OTHER), below the second OTHER and three.
SHORT, LONG = OTHER << BITS, 1 << (3 * BITS)

_FOLD: list = []


def symbol_table() -> tuple[np.ndarray, np.ndarray]:
    """Code point (16 bits, one more place for all above) → symbol: 1-26 base letters, 27 upper-case mark, 28 digit,
    29 blank, 30 line break, 31-61 ASCII signs, 62 or 63 for what is written by its code point; plus 64 where the letter
    is upper case. And code point → code point of the lower-case letter."""
    if not _FOLD:
        signs = [c for c in map(chr, range(33, 127)) if not c.isalnum()]
        signs = {ord(c): 31 + n for n, c in enumerate(signs[:31])}
        t, low = np.full((1 << 16) + 1, OTHER, np.uint8), np.arange(1 << 16, dtype=np.uint32)
        for c in range(1 << 16):
            s = chr(c)
            base = unicodedata.normalize("NFD", s)[:1].lower() if s.isalpha() else ""
            if s == "\n":
                t[c] = BREAK
            elif s.isspace():
                t[c] = BLANK
            elif c in signs:
                t[c] = signs[c]
            elif "a" <= base <= "z":
                t[c] = ord(base) - 96
            elif s.isdigit():
                t[c] = DIGIT
            elif s.isupper() and len(s.lower()) == 1:
                low[c] = ord(s.lower())
            if base and s.isupper() and (t[c] < UPPER or low[c] != c):
                t[c] += 64
        _FOLD.extend((t, low))
    return _FOLD[0], _FOLD[1]


def _spelt(texts: list[str], breaks: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each with ``breaks`` line breaks before it, and each text's number of symbols, breaks included."""
    lead = "\n" * breaks
    codes = np.frombuffer((lead + lead.join(texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    table, low = symbol_table()
    sym = table.take(codes, mode="clip")
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + breaks
    wide = np.flatnonzero(sym >= LETTER)  # upper-case letters and what is written by its code point
    if not len(wide):
        return sym, size
    upper, spelt = sym[wide] >= 64, (sym[wide] & 63) >= LETTER
    extra = upper.astype(np.int64)
    code = codes[wide[spelt]].astype(np.int64)
    code = np.where(code <= 0xFFFF, low[np.minimum(code, 0xFFFF)], code).astype(np.int64)
    more = np.where(code < SHORT, 2, np.where(code < LONG, 3, 5))
    extra[spelt] += more
    sum_extra = np.r_[0, np.cumsum(extra)]
    size += np.diff(sum_extra[np.searchsorted(wide, np.cumsum(size))], prepend=0)
    first = wide + sum_extra[:-1]
    own = np.ones(len(sym) + int(sum_extra[-1]), bool)  # the places that are not put in
    own[first[upper]] = False  # an upper-case letter is the mark and the letter
    at = (first + upper)[spelt]
    for d in range(1, 6):
        own[at[more >= d] + d] = False
    out = np.full(len(own), UPPER, np.uint8)
    out[own] = sym & 63
    out[at] = np.where(more == 3, OTHER, LETTER)
    for n, digits in ((2, 2), (3, 3), (5, 4)):  # LETTER OTHER begins the four digits of the rarest
        of = more == n
        if n == 5:
            out[at[of] + 1] = OTHER
        for d in range(digits):
            out[at[of] + n - d] = (code[of] >> (BITS * d)) & 63
    return out, size


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each with a line break before it, and the text each belongs to."""
    sym, size = _spelt(texts, 1)
    return sym, np.repeat(np.arange(len(texts)), size)


def ngram_keys(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """n-gram of each symbol with the ``order - 1`` before it (line breaks before the first), and its text.

    The line breaks put before each text are context only.
    """
    sym, size = _spelt(texts, order - 1)
    sym = sym.astype(np.int32 if BITS * order < 32 else np.int64)
    key = sym.copy()
    for n in range(1, order):
        key[n:] |= sym[:-n] << (BITS * n)
    own = np.ones(len(key), bool)
    first = np.cumsum(size) - size
    for n in range(order - 1):
        own[first + n] = False
    return key[own], np.repeat(np.arange(len(texts)), size - (order - 1))


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
    size = 1 << (BITS * ORDER)
    total = None
    for b in batches:
        texts = b.column(0).to_pylist()
        for lo, hi in _pieces(texts):
            if total is None:
                total = np.zeros(size, np.int64)
            np.add.at(total, ngram_keys(texts[lo:hi])[0], 1)
    if total is not None:
        key = np.flatnonzero(total)
        for at in range(0, len(key), 1 << 17):
            k = key[at: at + (1 << 17)]
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], ["g", "c"])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the counts of counts; fixed fallbacks where a count is zero."""
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    d1 = 1 - 2 * y * n2 / n1 if n1 else 0.5
    d2 = 2 - 3 * y * n3 / n2 if n2 else 1.0
    d3 = 3 - 4 * y * n4 / n3 if n3 else 1.5
    return min(max(d1, 0.05), 0.95), min(max(d2, 0.1), 1.9), min(max(d3, 0.15), 2.85)


def train(trusted: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``probs(k, g, p)`` of the seen n-grams and ``gammas(k, h, w)`` of the seen contexts, for orders 1 to ORDER."""
    counts = trusted.select(text_of(text_col).alias("text")).where("text <> ''").mapInArrow(_count, "g long, c long")
    tables = {ORDER: stash(counts.groupBy("g").agg(F.sum("c").alias("c")), "kn-counts")}
    for k in range(ORDER - 1, 0, -1):  # continuation counts
        low = tables[k + 1].select(F.col("g").bitwiseAND(F.lit((1 << (BITS * k)) - 1)).alias("g"))
        tables[k] = low.groupBy("g").agg(F.count(F.lit(1)).alias("c"))
    probs, gammas, lower = [], [], None
    for k in range(1, ORDER + 1):
        t = tables[k]
        n = t.agg(*[F.sum(F.when(F.col("c") == i, 1).otherwise(0)).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
        d1, d2, d3 = discounts(*[int(x or 0) for x in n])
        disc = F.when(F.col("c") == 1, F.lit(d1)).when(F.col("c") == 2, F.lit(d2)).otherwise(F.lit(d3))
        t = t.withColumn("h", F.shiftright("g", BITS))
        context = t.groupBy("h").agg(F.sum("c").alias("total"), F.sum(disc).alias("mass")).select(
            "h", "total", (F.col("mass") / F.col("total")).alias("w"))
        joined = t.join(context, "h")
        if lower is None:
            below = F.lit(1.0 / (1 << BITS))
        else:
            joined = joined.withColumn("s", F.col("g").bitwiseAND(F.lit((1 << (BITS * (k - 1))) - 1)))
            joined = joined.join(lower.select(F.col("g").alias("s"), F.col("p").alias("below")), "s")
            below = F.col("below")
        p = (F.col("c") - disc) / F.col("total") + F.col("w") * below
        lower = stash(joined.select("g", p.alias("p")), "kn-probs")
        probs.append(lower.select(F.lit(k).alias("k"), "g", "p"))
        gammas.append(context.select(F.lit(k).alias("k"), "h", "w"))
    both = lambda xs: xs[0] if len(xs) == 1 else both([xs[0].unionByName(xs[1]), *xs[2:]])
    return both(probs), both(gammas)


Tables = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def gather(probs: DataFrame, gammas: DataFrame) -> Tables:
    """The tables of a small model as arrays, to look at it as a whole; scoring does not."""
    out: Tables = {}
    p = probs.select("k", "g", F.col("p").cast("float").alias("x")).toArrow()
    w = gammas.select("k", "h", F.col("w").cast("float").alias("x")).toArrow()
    pk, wk = p["k"].to_numpy(), w["k"].to_numpy()
    for k in range(1, ORDER + 1):
        out[k] = (p["g"].to_numpy()[pk == k].astype(np.int32), p["x"].to_numpy()[pk == k],
                  w["h"].to_numpy()[wk == k].astype(np.int32), w["x"].to_numpy()[wk == k])
    return out


def dense(tables: Tables) -> np.ndarray:
    """Negative log probability (nats) of every possible n-gram of a small model; scoring does not use it."""
    below = np.full(1, 1.0 / (1 << BITS), np.float32)
    for k in range(1, ORDER + 1):
        g, p, h, w = tables[k]
        weight = np.ones(1 << (BITS * (k - 1)), np.float32)
        weight[h] = w
        lower = np.full(1 << BITS, below[0], np.float32) if k == 1 else below
        # n-gram = (first symbol, rest): the context is (first, rest without its last symbol)
        full = np.tile(lower, (1 << BITS) if k > 1 else 1)
        full *= np.repeat(weight, 1 << BITS)
        full[g] = p
        below = full
    return -np.log(np.maximum(below, 1e-12))


def key_type() -> type:
    return np.int32 if BITS * ORDER + 4 < 32 else np.int64


def wanted(top: np.ndarray) -> np.ndarray:
    """Ascending keys ``order, n-gram`` of all that the probabilities of the ``ORDER``-grams ``top`` may need:
    themselves, and the suffixes (lower orders) and contexts of what is needed one order above."""
    out = []
    for k in range(ORDER, -1, -1):
        out.append(top + (k << (BITS * ORDER)))
        if k:
            held = np.zeros(1 << (BITS * (k - 1)), bool)
            held[top & (len(held) - 1)] = held[top >> BITS] = True
            top = np.flatnonzero(held)
    return np.concatenate(out[::-1]).astype(key_type())


def costs(keys: np.ndarray, p: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDER``-grams among ``keys`` (of ``wanted``) and their negative log probabilities (nats); ``p`` is NaN for
    unseen n-grams, ``w`` the weight of the n-gram as a context (1 if unseen)."""
    keys = keys.astype(np.int64)
    ends = np.searchsorted(keys, np.arange(ORDER + 2) << (BITS * ORDER))
    own = [keys[ends[k]: ends[k + 1]] & ((1 << (BITS * ORDER)) - 1) for k in range(ORDER + 1)]
    below = np.full(len(own[0]), 1.0 / (1 << BITS), np.float32)
    for k in range(1, ORDER + 1):
        seen = p[ends[k]: ends[k + 1]]
        lower = below[np.searchsorted(own[k - 1], own[k] & ((1 << (BITS * (k - 1))) - 1))]
        weight = w[ends[k - 1]: ends[k]][np.searchsorted(own[k - 1], own[k] >> BITS)]
        below = np.where(np.isnan(seen), lower * weight, seen)
    return own[ORDER], -np.log(np.maximum(below, 1e-12))


def _wanted_by(texts: list[str]) -> np.ndarray:
    held = np.zeros(1 << (BITS * ORDER), bool)  # marks instead of sorting every symbol's n-gram
    for lo, hi in _pieces(texts):
        held[ngram_keys(texts[lo:hi])[0]] = True
    return wanted(np.flatnonzero(held))


def _asking(shards: int) -> Callable[[pa.Table], pa.Table]:
    def ask(rows: pa.Table) -> pa.Table:
        keys = _wanted_by(rows["_text"].to_pylist())
        shard = keys % PRIME % shards
        keys = keys[np.argsort(shard, kind="stable")]
        held, size = np.unique(shard, return_counts=True)
        parts = np.split(keys, np.cumsum(size)[:-1]) if len(held) else []
        block = rows["_block"][0].as_py()
        return pa.table({"block": pa.array([block] * len(held), pa.int64()), "shard": pa.array(held, pa.int64()),
                         "keys": pa.array([k.tobytes() for k in parts], pa.binary())})

    return ask


def _answer(model: pa.Table, asked: pa.Table) -> pa.Table:
    """For each request its probabilities, and its context weights (below the highest order)."""
    context = model["context"].to_numpy()
    tables = []
    for of in (context == 0, context == 1):
        key, x = model["key"].to_numpy()[of], model["x"].to_numpy()[of]
        order = np.argsort(key)
        tables.append((key[order], x[order]))

    def look(keys: np.ndarray, of: int, unseen: float) -> bytes:
        key, x = tables[of]
        out = np.full(len(keys), unseen, np.float32)
        if len(key):
            at = np.minimum(np.searchsorted(key, keys), len(key) - 1)
            out = np.where(key[at] == keys, x[at], out)
        return out.astype(np.float32).tobytes()

    p, w = [], []
    for b in asked["keys"].to_pylist():
        keys = np.frombuffer(b, key_type()).astype(np.int64)
        p.append(look(keys, 0, math.nan))
        w.append(look(keys[keys < (ORDER << (BITS * ORDER))], 1, 1.0))
    return pa.table({"block": asked["block"], "shard": asked["shard"], "p": pa.array(p, pa.binary()),
                     "w": pa.array(w, pa.binary())})


def _scoring(shards: int, width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        texts = rows["_text"].to_pylist()
        keys = _wanted_by(texts)
        shard = keys % PRIME % shards
        p, w = np.full(len(keys), math.nan, np.float32), np.ones(len(keys), np.float32)
        by = np.argsort(shard, kind="stable")
        first = np.searchsorted(shard[by], np.arange(shards + 1))
        for s, ps, ws in zip(*(answers[c].to_pylist() for c in ("shard", "p", "w"))):
            own = by[first[s]: first[s + 1]]
            p[own] = np.frombuffer(ps, np.float32)
            ws = np.frombuffer(ws, np.float32)
            w[own[:len(ws)]] = ws  # the highest order, which is no context, comes last
        top, cost = costs(keys, p, w)
        cost_of = np.empty(1 << (BITS * ORDER), np.float32)  # filled and read at the block's own n-grams only
        cost_of[top] = cost
        x, none = np.zeros(len(texts)), np.ones(len(texts), bool)
        for lo, hi in _pieces(texts):
            own = texts[lo:hi]
            key, owner = ngram_keys(own)
            n = np.bincount(owner, minlength=len(own))
            nats = np.bincount(owner, cost_of[key], len(own))
            blank = np.array([not t or t.isspace() for t in own], bool)
            none[lo:hi] = (n == 0) | blank
            x[lo:hi] = np.exp(np.minimum(nats / np.maximum(n, 1), 50))
        return rows.select(list(range(width))).append_column("perplexity", pa.array(x, mask=none))

    return score


def perplexities(df: DataFrame, probs: DataFrame, gammas: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, *keep, perplexity)``; null perplexity for a text without symbols."""
    texts = df.select(F.col(id_col), *keep, text_of(text_col).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema[:-1])
    size = texts.agg(F.sum(F.octet_length("_text").cast("long") + 64).alias("n")).first()["n"] or 0
    blocks = 1 + size // BLOCK_BYTES
    shards = math.ceil(8 * math.sqrt(blocks))
    texts = texts.withColumn("_block", F.pmod(F.xxhash64(id_col, "_text"), F.lit(blocks)))
    base = F.lit(1 << (BITS * ORDER))
    model = probs.select((F.col("k") * base + F.col("g")).alias("key"), F.lit(0).alias("context"), F.col("p").cast("float").alias("x"))
    model = model.unionByName(gammas.select(((F.col("k") - 1) * base + F.col("h")).alias("key"), F.lit(1).alias("context"),
                                            F.col("w").cast("float").alias("x")))
    model = model.withColumn("shard", F.pmod(F.pmod("key", F.lit(PRIME)), F.lit(shards)).cast("long"))
    asked = texts.groupBy("_block").applyInArrow(_asking(shards), "block long, shard long, keys binary")
    answers = model.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(
        _answer, "block long, shard long, p binary, w binary")
    return texts.groupBy("_block").cogroup(answers.groupBy("block")).applyInArrow(
        _scoring(shards, 1 + len(keep)), f"{schema}, perplexity double")


def quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang", quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """``(doc_id, lang, perplexity, threshold, kept)``, one row per row of ``docs``.

    ``trusted(doc_id)``: the rows of ``docs`` that the model and the thresholds are made of.
    """
    spark = docs.sparkSession
    good = trusted.select(F.col(id_col).alias("doc_id")).distinct()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).alias("text"))
    probs, gammas = train(only(rows.select("doc_id", "text"), good, "doc_id"))
    release(spark)
    scored = stash(perplexities(rows, probs, gammas, "doc_id", "text", ("lang",)), "kn-scored")
    seen = scored.where("perplexity is not null").join(good, "doc_id", "left_semi")
    at = F.percentile_approx("perplexity", quantile, 10_000)
    overall = seen.agg(at.alias("q")).first()["q"]
    by = seen.groupBy("lang").agg(at.alias("q"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_TRUSTED)
    whole = F.lit(float(overall) * margin if overall is not None else math.inf)
    by = by.select(F.col("lang").alias("_l"), (F.col("q") * margin).alias("_t"))  # one row per language
    out = scored.join(by, F.col("lang").eqNullSafe(F.col("_l")), "left")
    limit = F.coalesce("_t", whole)
    return out.select("doc_id", "lang", "perplexity", limit.alias("threshold"),
                      F.coalesce(F.col("perplexity") <= limit, F.lit(False)).alias("kept"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The doc_ids with a label of good quality."""
    return labels.where("quality = 1").select("doc_id")


def keep_quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """``docs`` (all columns) without the rejected rows, each by its own verdict."""
    rows, key = numbered(docs)
    good = only(rows.select(key, id_col), trusted.select(id_col).distinct(), id_col).select(key)
    gone = quality(rows, good, key, **how).where(~F.col("kept")).select(F.col("doc_id").alias(key))
    return without(rows, gone, key).drop(key)
