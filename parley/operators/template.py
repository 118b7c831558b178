"""Chat template, tokens, response marker and completion-only mask.

Everything is an array/string expression so it stays in the JVM.  The default
tokenizer is a regex (``tokenize_simple``); a real tokenizer can be plugged in
with ``tokenize_with`` (Arrow-batched iterator UDF, loaded once per task).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators.segments import SLICE_ROWS, before_slice, slice_window, with_slices

# --- fixed values -----------------------------------------------------------
# ChatML delimiters (the public convention the reference's tokenizer uses).
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
ASSISTANT_MARKER = "<|im_start|>assistant\n"
# Default tokens: special markers, ASCII word runs, or any single other
# non-space character.  Same meaning in Java regex and RE2 (DuckDB).
TOKEN_PATTERN = "<\\|[a-z_]+\\|>|[A-Za-z0-9_]+|[^A-Za-z0-9_ \\t\\n\\r\\f\\x0B]"
IGNORE_INDEX = -100
# A Python worker holds the results of about so many characters (or ids) at a time,
# whatever the number of rows in an Arrow batch.
PIECE_CHARS = 1 << 18
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def render_chat(messages, add_generation_prompt: bool = False,
                start: str = IM_START, end: str = IM_END) -> Column:
    """``<start>role\\ncontent<end>\\n`` per message; optional open assistant turn.

    A null role or content counts as empty: the message stays in the text.
    """
    body = F.array_join(F.transform(_col(messages), lambda m: F.concat(
        F.lit(start), F.coalesce(m["role"], F.lit("")), F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit(end), F.lit("\n"))), "")
    if add_generation_prompt:
        body = F.concat(body, F.lit(start), F.lit("assistant\n"))
    return body


def marker_missing(text, marker: str = ASSISTANT_MARKER) -> Column:
    """True when the rendered text lacks the marker."""
    return ~_col(text).contains(F.lit(marker))


def tokenize_simple(text, pattern: str = TOKEN_PATTERN) -> Column:
    """T9 default: ``array<string>`` of regex tokens (whitespace dropped)."""
    return F.regexp_extract_all(_col(text), F.lit(pattern), 0)


def tokenize_with(text, make_tokenizer: Callable[[], Callable[[str], list[int]]]) -> Column:
    """T9 pluggable: ``array<int>`` ids from a caller tokenizer.

    ``make_tokenizer()`` runs once per task (not per row); the UDF is an
    Arrow-batched iterator ``pandas_udf``.
    """
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _enc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = make_tokenizer()
        for s in batches:
            yield s.map(lambda x: None if x is None else list(enc(x)))

    return _enc(_col(text))


def decode_with(ids, make_decoder: Callable[[], Callable[[list[int]], str]]) -> Column:
    """T9 decode: text of ``array<int>`` ids by a caller tokenizer, Arrow-batched like ``tokenize_with``."""
    @F.pandas_udf(T.StringType())
    def _dec(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dec = make_decoder()
        for s in batches:
            for lo, hi in _pieces(s, PIECE_CHARS):
                yield s.iloc[lo:hi].map(lambda x: None if x is None else dec(x.tolist() if isinstance(x, np.ndarray) else list(x)))

    return _dec(_col(ids))


def _pieces(values: Sequence, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that cover ``values`` (texts or arrays), each of about ``most`` elements or one row."""
    at = n = 0
    for i, x in enumerate(values):
        n += 1 if x is None else len(x) + 1
        if n >= most:
            yield at, i + 1
            at, n = i + 1, 0
    if at < len(values):
        yield at, len(values)


def find_subseq(haystack, needle, last: bool = False) -> Column:
    """T4: 0-based index of the first (or last) occurrence of ``needle`` in ``haystack``.

    −1 if absent, 0 for an empty needle.  Positions are only generated when the
    haystack is at least as long as the needle (D19), and a slice is compared
    only where the first element already matches.
    """
    h, n = _col(haystack), _col(needle)
    sh, sn = F.size(h), F.size(n)
    hits = F.filter(F.sequence(F.lit(0), sh - sn),
                    lambda i: (F.element_at(h, i + 1) == F.element_at(n, 1)) & (F.slice(h, i + 1, sn) == n))
    pick = F.array_max(hits) if last else F.array_min(hits)
    return (F.when(sn == 0, F.lit(0))
            .when(sh < sn, F.lit(-1))
            .otherwise(F.coalesce(pick, F.lit(-1))))


def count_subseq(haystack, needle) -> Column:
    """Number of (possibly overlapping) occurrences of ``needle`` in ``haystack``."""
    h, n = _col(haystack), _col(needle)
    sh, sn = F.size(h), F.size(n)
    hits = F.filter(F.sequence(F.lit(0), sh - sn),
                    lambda i: (F.element_at(h, i + 1) == F.element_at(n, 1)) & (F.slice(h, i + 1, sn) == n))
    return F.when((sn == 0) | (sh < sn), F.lit(0)).otherwise(F.size(hits))


def tail(arr, k: int) -> Column:
    """Last ``k`` elements; the whole array when shorter."""
    a = _col(arr)
    return F.slice(a, F.greatest(F.size(a) - F.lit(k), F.lit(0)) + 1, F.lit(k))


def marker_tail(text, response, k: int, pattern: str = TOKEN_PATTERN) -> Column:
    """Last ``k`` tokens of the text before the first occurrence of ``response``."""
    pre = F.call_function("substring_index", _col(text), _col(response), F.lit(1))
    return tail(tokenize_simple(pre, pattern), k)


def marker_choice(tokens, marker_tokens, text, response, k: int = 5) -> Column:
    """The marker's tokens where they occur in ``tokens``, else the last ``k`` tokens before ``response``."""
    return F.when(find_subseq(tokens, marker_tokens) >= 0, _col(marker_tokens)).otherwise(
        marker_tail(text, response, k))


def mask_start(tokens, marker_tokens) -> Column:
    """First trained position = end of the *last* marker match; NULL if none."""
    last = find_subseq(tokens, marker_tokens, last=True)
    return F.when(last >= 0, last + F.size(_col(marker_tokens)))


def masked_labels(tokens, start, ignore=None) -> Column:
    """Tokens at positions ≥ ``start`` kept, the rest replaced by ``ignore``.

    A row without a marker (``start`` NULL) is ignored entirely.
    """
    t = _col(tokens)
    # No lambda: ``start`` is read a fixed number of times per row (not once
    # per token), so the cost stays linear even if Catalyst inlines it.
    n = F.size(t)
    st = F.least(F.coalesce(_col(start), n), n)
    head = F.array_repeat(F.lit(ignore), st)
    rest = F.slice(t, st + 1, F.greatest(n - st, F.lit(0)))
    return F.concat(head, rest)


def _barrier(df: DataFrame, *cols: Column) -> DataFrame:
    """Add columns through a one-element generator so later expressions read them
    as columns (Catalyst cannot inline them into per-element lambdas)."""
    return df.select("*", F.inline(F.array(F.struct(*cols))))


def with_assistant_labels(df: DataFrame, tokens: str, marker_tokens: Column, out: str = "labels",
                          end_token: str = IM_END, ignore=None) -> DataFrame:
    """T7, ``mode='all_assistant'``: keep every assistant turn, mask the rest.

    A turn runs from the end of an assistant marker to the next end token
    (inclusive; to the last token when unclosed).  Positions are found once,
    turns are built from them, and labels are assembled turn by turn: work per
    row is tokens + turns², never tokens².
    """
    t = F.col(tokens)
    n, k = F.size(t), F.size(marker_tokens)
    starts = F.filter(F.sequence(F.lit(0), n - k),
                      lambda i: (F.element_at(t, i + 1) == F.element_at(marker_tokens, 1))
                      & (F.slice(t, i + 1, k) == marker_tokens))
    empty = F.array().cast("array<int>")
    ends = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                    lambda i: F.element_at(t, i + 1) == end_token)
    d = _barrier(df, F.when(n >= k, F.transform(starts, lambda s: s + k)).otherwise(empty).alias("_me"),
                 F.when(n > 0, ends).otherwise(empty).alias("_ee"))
    segs = F.transform("_me", lambda e: F.struct(
        e.alias("s"), F.coalesce(F.array_min(F.filter("_ee", lambda x: x >= e)), n - 1).alias("f")))
    d = _barrier(d, segs.alias("_sg"))

    def piece(sg, j):
        prev_f = F.when(j == 0, F.lit(-1)).otherwise(F.element_at(F.col("_sg"), j)["f"])
        st = F.greatest(sg["s"], prev_f + 1)
        return F.concat(F.array_repeat(F.lit(ignore), F.greatest(st - prev_f - 1, F.lit(0))),
                        F.slice(t, st + 1, F.greatest(sg["f"] - st + 1, F.lit(0))))

    last_f = F.coalesce(F.array_max(F.transform("_sg", lambda x: x["f"])), F.lit(-1))
    labels = F.concat(F.flatten(F.transform("_sg", piece)),
                      F.array_repeat(F.lit(ignore), F.greatest(n - 1 - last_f, F.lit(0))))
    return d.withColumn(out, F.when(F.size("_sg") > 0, labels).otherwise(
        F.array_repeat(F.lit(ignore), n))).drop("_me", "_ee", "_sg")


def truncate_tokens(tokens, max_len: int) -> Column:
    """Keep the first ``max_len`` tokens (no packing)."""
    return F.slice(_col(tokens), 1, max_len)


# ---- T7 / T8 for any tokenizer: labels from character spans -------------------------------------------------------------

#: A tokenizer for offsets: text to ids and ``(start, end)`` character offsets, both ascending.
OffsetEncoder = Callable[[str], tuple[Sequence[int], Sequence[tuple[int, int]]]]


def ship_file(spark: SparkSession, path: str) -> str:
    """Send a driver's file (a tokenizer's) to every executor; returns the name that ``shipped`` finds it by."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def shipped(name: str) -> str:
    """Place of a shipped file, on the driver or in a task."""
    from pyspark import SparkFiles

    return SparkFiles.get(name)


def tokenizers_file(name: str) -> Callable[[], OffsetEncoder]:
    """``make_encoder`` for a shipped file of the tokenizers library (its special tokens are ordinary text)."""
    def make() -> OffsetEncoder:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(shipped(name))
        tok.no_truncation()
        tok.no_padding()
        tok.encode_special_tokens = True

        def encode(text: str):
            got = tok.encode(text, add_special_tokens=False)
            return got.ids, got.offsets

        return encode

    return make


def trained_spans(header: np.ndarray, body: np.ndarray, tail: np.ndarray, assistant: np.ndarray, mode: str,
                  n_end: int) -> np.ndarray:
    """``(n, 2)`` character spans of the rendered text that are trained, ascending and disjoint.

    Per message the lengths of its header, body and end; ``all``: every assistant body with its end token;
    ``last``: all text after the last assistant header, nothing without one.
    """
    ends = np.cumsum(header + body + tail)
    starts = ends - tail - body
    own = np.flatnonzero(assistant)
    if mode == "last":
        return np.array([[starts[own[-1]], ends[-1]]]) if len(own) else np.zeros((0, 2), np.int64)
    return np.stack([starts[own], starts[own] + body[own] + n_end], axis=1)


def inside_spans(token_start: np.ndarray, token_end: np.ndarray, spans: np.ndarray, border: str) -> tuple[np.ndarray, np.ndarray]:
    """For each token span whether it is trained, and whether it lies over a border of ``spans``: an interval join.

    ``border``: what holds for a token with characters on both sides: ``inside`` (trained only if all its
    characters are), ``any`` (if one is) or ``first`` (as its first character).
    """
    if not len(spans):
        none = np.zeros(len(token_start), bool)
        return none, none
    def span_of(place):
        at = np.searchsorted(spans[:, 0], place, "right") - 1
        return np.where((at >= 0) & (place < spans[np.maximum(at, 0), 1]), at, -1)
    last = np.maximum(token_end - 1, token_start)
    first_in, last_in = span_of(token_start), span_of(last)
    # a whole span may lie inside one token
    held = np.searchsorted(spans[:, 0], last, "right") > np.searchsorted(spans[:, 0], token_start, "left")
    whole = (first_in >= 0) & (first_in == last_in)
    some = (first_in >= 0) | (last_in >= 0) | held
    return {"inside": whole, "any": some, "first": first_in >= 0}[border], some & ~whole


def label_tokens(df: DataFrame, make_encoder: Callable[[], OffsetEncoder], messages_col: str = "messages", mode: str = "all",
                 border: str = "inside", max_len: int | None = None, ignore: int = IGNORE_INDEX) -> DataFrame:
    """T7/T8 for any tokenizer: ``df`` with ``ids, labels, n_tokens, n_crossing`` of the rendered messages.

    The chat text is encoded once; a token's label is its id where its characters lie in a trained span of the messages
    (``trained_spans``, ``inside_spans``), else ``ignore``.  No marker is searched, so a marker inside a message changes
    nothing and tokens of any vocabulary get labels.  ``n_tokens`` counts all tokens, ``ids`` and ``labels`` end at
    ``max_len``; ``n_crossing``: tokens over a border.  Null messages have no tokens.
    """
    if mode not in ("all", "last") or border not in ("inside", "any", "first"):
        raise ValueError(f"unknown mode {mode!r} or border {border!r}")
    schema = T.StructType([T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("ids", "labels")]
                          + [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_crossing")])

    @F.pandas_udf(schema)
    def label(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        encode = make_encoder()
        for batch in batches:
            for lo, hi in _pieces(batch[0], PIECE_CHARS):
                rows = []
                for t, h, b, a in zip(*(c.iloc[lo:hi] for c in batch)):
                    if t is None or h is None:
                        rows.append(([], [], 0, 0))
                        continue
                    ids, offsets = encode(t)
                    ids, at = np.asarray(ids, np.int32), np.asarray(offsets, np.int64).reshape(-1, 2)
                    spans = trained_spans(np.asarray(h, np.int64), np.asarray(b, np.int64), np.full(len(h), len(IM_END) + 1),
                                          np.asarray(a, bool), mode, len(IM_END))
                    trained, crossing = inside_spans(at[:, 0], at[:, 1], spans, border)
                    labels = np.where(trained, ids, np.int32(ignore))
                    rows.append((ids[:max_len], labels[:max_len], len(ids), int(crossing.sum())))
                yield pd.DataFrame(rows, columns=["ids", "labels", "n_tokens", "n_crossing"])

    m = F.col(messages_col)
    chars = lambda c: F.length(F.coalesce(c, F.lit("")))
    made = df.withColumn("_made", label(
        render_chat(m), F.transform(m, lambda x: chars(x["role"]) + F.lit(len(IM_START) + 1)),
        F.transform(m, lambda x: chars(x["content"])), F.transform(m, lambda x: F.coalesce(x["role"] == "assistant", F.lit(False)))))
    return made.select(*df.columns, "_made.ids", "_made.labels", "_made.n_tokens", "_made.n_crossing")


# ---- T10 ---------------------------------------------------------------------------------------------------------------


def strip_prompts(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  tokenize: Callable[[Column], Column] = tokenize_simple, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """T10 for every assistant turn: ``(conv, turn, n_prompt, generated)``, every message tokenised once.

    The prompt of a turn is all messages before it and the open assistant header, so its length is a running sum of
    message lengths, and what remains of prompt + reply after ``n_prompt`` tokens is the reply message without its
    header.  Border rule: a message ends with a line break and begins with the start marker, so this holds for tokenizers
    without tokens over a line break (the regex tokens have none).  Large conversations are summed in slices.
    """
    tokens = tokenize(render_chat(F.array(F.struct(F.col(role).alias("role"), F.col(text).alias("content")))))
    n_header = F.size(tokenize(F.lit(f"{IM_START}assistant\n")))
    is_reply = F.coalesce(F.col(role) == "assistant", F.lit(False))
    rows = _barrier(with_slices(turns, conv, turn, slice_rows).select(
        F.col(conv).alias(conv), F.col(turn).alias(turn), "_key", "_slice", "_large", is_reply.alias("_reply"), role, text),
        tokens.alias("_tokens"))
    rows = rows.select(conv, turn, "_key", "_slice", "_large", "_reply", F.size("_tokens").cast("long").alias("_n"),
                       F.when(F.col("_reply"), F.slice("_tokens", n_header + 1, F.size("_tokens"))).alias("generated"))
    before = F.sum("_n").over(slice_window(turn).rowsBetween(Window.unboundedPreceding, -1))
    sums = before_slice(rows.where("_large").groupBy("_key", "_slice").agg(F.sum("_n").alias("n")), {"_n0": "n"})
    out = rows.withColumn("_before", F.coalesce(before, F.lit(0))).where("_reply").join(
        F.broadcast(sums), ["_key", "_slice"], "left")
    return out.select(conv, turn, (F.col("_before") + F.coalesce("_n0", F.lit(0)) + n_header).alias("n_prompt"), "generated")


def strip_prompt(out_tokens, n_prompt) -> Column:
    """Drop the first ``n_prompt`` generated ids (the echoed prompt)."""
    o = _col(out_tokens)
    n = _col(n_prompt) if not isinstance(n_prompt, int) else F.lit(n_prompt)
    return F.slice(o, n + 1, F.greatest(F.size(o) - n, F.lit(0)))
