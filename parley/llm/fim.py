"""Fill-in-the-middle examples by displacement scatter, and their exact inverse.

A text is cut at two of its line borders into prefix, middle and suffix, and written with
sentinels as prefix-suffix-middle (``psm``) or suffix-prefix-middle (``spm``).  A batch of texts
is one flat byte array.  Line ends are scanned once to place the cuts; a difference array holds, at
the first byte of every piece, by how much the piece's shift in the output differs from the piece
before; its cumulative sum is every byte's shift, and one scatter builds all outputs.  Restoring
scans an output for its sentinels, builds the same difference array in text order and gathers.

Which cuts and form a row takes depends on the seed and the row's id alone (``draws``), so the result
does not change with the partitioning, and a retried task writes the same rows.

Bounds: a chunk of rows of about ``CHUNK_BYTES`` (or one longer text) is held with its output; shifts
are summed in windows of ``WINDOW`` bytes, whatever the length of a text.

Defined results: a null text is empty; an empty text and a text that holds a sentinel are ``plain`` (the
output is the text, ``prefix_chars`` and ``middle_chars`` are null); a null id draws as the empty string;
rows that repeat an id draw alike; bytes that are no UTF-8 are moved as they are.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import text_of

CHUNK_BYTES = 4 << 20
WINDOW = 1 << 20
NEWLINE = 10
SENTINELS = ("<P>", "<S>", "<M>")


def draws(id_col: str, seed: int) -> list[Column]:
    """Four 32-bit numbers of a row: the first 8-digit groups of the hex sha256 of ``seed:id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * n + 1, 8), 16, 10).cast("long") for n in range(4)]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and the n + 1 borders of its rows."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]: at[-1]], at - at[0]


def _column(raw: np.ndarray, borders: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.utf8(), len(borders) - 1,
                                 [None, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(raw)])


def _chunks(borders: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``CHUNK_BYTES``."""
    lo, n = 0, len(borders) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(borders, borders[lo] + CHUNK_BYTES, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def _shifted(size: int, at: np.ndarray, shift: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """For windows of the positions 0..size: the window, and where each of its positions lies on the other side.

    Piece ``i`` starts at ``at[i]`` (ascending) and its bytes lie ``shift[i]`` further on there.
    """
    step = np.diff(shift, prepend=0)
    carry = 0
    for lo in range(0, size, WINDOW):
        hi = min(lo + WINDOW, size)
        own = slice(*np.searchsorted(at, (lo, hi)))
        change = np.zeros(hi - lo, np.int64)
        np.add.at(change, at[own] - lo, step[own])
        change[0] += carry
        moved = np.cumsum(change)
        carry = int(moved[-1])
        yield slice(lo, hi), moved + np.arange(lo, hi)


def cut(raw: np.ndarray, borders: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lines of each text, and the byte positions where its prefix and its middle end."""
    ends = np.flatnonzero(raw == NEWLINE) + 1
    first, after = np.searchsorted(ends, borders[:-1], "right"), np.searchsorted(ends, borders[1:], "right")
    size = np.diff(borders)
    last = np.zeros(len(size), np.uint8)
    last[size > 0] = raw[borders[1:][size > 0] - 1]
    lines = after - first + ((size > 0) & (last != NEWLINE))
    cuts = np.sort(np.stack([h1 % (lines + 1), h2 % (lines + 1)]), axis=0)
    ends = np.append(ends, 0)
    a, b = (np.where(c == 0, borders[:-1], np.where(c == lines, borders[1:], ends[np.minimum(first + c - 1, len(ends) - 1)]))
            for c in cuts)
    return lines, a, b


def scatter(raw: np.ndarray, borders: np.ndarray, a: np.ndarray, b: np.ndarray, plain: np.ndarray, spm: np.ndarray,
            marks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and borders of the outputs of all texts; the pieces of text ``i`` end at ``a[i]``, ``b[i]`` and its end."""
    p, s, m = (len(x) for x in marks)
    size = np.diff(borders)
    out_borders = np.r_[0, np.cumsum(size + np.where(plain, 0, p + s + m))]
    out = np.empty(int(out_borders[-1]), np.uint8)
    to, start, end = out_borders[:-1], borders[:-1], borders[1:]
    n_prefix, n_suffix = a - start, end - b
    prefix_at = to + np.where(spm, s + n_suffix + p, p)
    suffix_at = to + np.where(spm, s, p + n_prefix + s)
    middle_at = to + p + s + m + n_prefix + n_suffix
    shift = np.stack([np.where(plain, to, prefix_at) - start, np.where(plain, to - start, middle_at - a),
                      np.where(plain, to - start, suffix_at - b)], axis=1).ravel()
    for own, there in _shifted(len(raw), np.stack([start, a, b], axis=1).ravel(), shift):
        out[there] = raw[own]
    for mark, before in zip(marks, (prefix_at, suffix_at, middle_at)):
        places = before[~plain] - len(mark)
        out[places[:, None] + np.arange(len(mark))] = mark
    return out, out_borders


def gather(raw: np.ndarray, borders: np.ndarray, forms: list[str], marks: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and borders of the texts whose outputs are given: pieces found by their sentinels, then one gather."""
    p, s, m = marks
    whole = raw.tobytes()
    at, pieces = np.zeros((len(forms), 3), np.int64), np.zeros((len(forms), 3), np.int64)
    for n, form in enumerate(forms):
        lo, hi = int(borders[n]), int(borders[n + 1])
        if form == "plain":
            at[n], pieces[n] = lo, (hi - lo, 0, 0)
            continue
        one, two = (p, s) if form == "psm" else (s, p)
        first = lo + len(one)
        second = whole.find(two, first, hi)
        third = whole.find(m, second, hi)
        if not whole.startswith(one, lo) or second < 0 or third < 0:
            raise ValueError(f"no {form} output: a sentinel is missing")
        one_at, two_at, middle = (first, second - first), (second + len(two), third - second - len(two)), \
            (third + len(m), hi - third - len(m))
        in_order = (one_at, middle, two_at) if form == "psm" else (two_at, middle, one_at)
        at[n], pieces[n] = zip(*in_order)
    ends = np.cumsum(pieces.ravel())
    starts = ends - pieces.ravel()
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for own, there in _shifted(len(out), starts, at.ravel() - starts):
        out[own] = raw[there]
    return out, np.r_[0, ends[2::3]]


def _points(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points of each byte range; ranges ascend and do not overlap."""
    if not len(raw):
        return np.zeros(len(start), np.int64)
    lead = ((raw & 0xC0) != 0x80).view(np.uint8)
    lead = np.append(lead, np.uint8(0))
    sums = np.add.reduceat(lead, np.stack([start, end], axis=1).ravel(), dtype=np.int64)[::2]
    return np.where(end > start, sums, 0)


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100,
              spm_rate: int = 50, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output)`` of every row: ``n`` lines, the form, the pieces, the text.

    ``rate``: percent of rows that are transformed; ``spm_rate``: percent of those that are ``spm``;
    ``sentinels``: before prefix, suffix and middle (no one may be part of another, or begin as one ends).
    """
    marks = [np.frombuffer(x.encode(), np.uint8) for x in sentinels]
    h1, h2, h3, h4 = draws("id", seed)
    text = F.col("text")
    plain = (F.length(text) == 0) | (h3 % 100 >= rate)
    for x in sentinels:
        plain = plain | F.contains(text, F.lit(x))
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).select(
        "id", "text", h1.alias("h1"), h2.alias("h2"), plain.alias("plain"), (h4 % 100 < spm_rate).alias("spm"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _chunks(_flat(batch.column(1))[1]):
                part = batch.slice(lo, hi - lo)
                raw, borders = _flat(part.column(1))
                h1, h2 = (part.column(n).to_numpy() for n in (2, 3))
                plain, spm = (part.column(n).to_numpy(zero_copy_only=False) for n in (4, 5))
                n, a, b = cut(raw, borders, h1, h2)
                out, out_borders = scatter(raw, borders, a, b, plain, spm, marks)
                form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(form.tolist(), pa.utf8()),
                     pa.array(_points(raw, borders[:-1], a), pa.int64(), mask=plain),
                     pa.array(_points(raw, a, b), pa.int64(), mask=plain), _column(out, out_borders)],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)])
    for name, kind in (("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def restore(df: DataFrame, output_col: str = "output", form_col: str = "form", restored_col: str = "restored",
            sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``df`` with the text that each output was made of, from output and form alone (null output: empty)."""
    marks = tuple(x.encode() for x in sentinels)
    kept = [f.name for f in df.schema.fields]
    rows = df.select("*", text_of(output_col).alias("_output"),
                     F.coalesce(F.col(form_col), F.lit("plain")).alias("_form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _chunks(_flat(batch.column(len(kept)))[1]):
                part = batch.slice(lo, hi - lo)
                raw, borders = _flat(part.column(len(kept)))
                got = _column(*gather(raw, borders, part.column(len(kept) + 1).to_pylist(), marks))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], got], [*kept, restored_col])

    return rows.mapInArrow(run, T.StructType([*df.schema.fields]).add(restored_col, "string"))
