"""Token counts by section, by offset-mapped attribution.

The fields of a row are joined by line breaks and encoded once, as one whole
text.  Byte-level BPE tokens are exact slices of the text's bytes, so running
sums of token lengths give every token's byte span, and a count of the bytes
that begin a character turns it into a character span.  The spans are
interval-joined (binary search on sorted bounds) to sections: maximal runs of
text up to and including a line break (``sections='line'``) or whole fields.
Tokens whose characters lie in several sections go to one by an explicit rule:

* ``majority``: the section with most of the token's characters, the earliest on a tie;
* ``first``: the section of the token's first character.

A token that is only part of one character has that character as its span.

Defined results: null and empty texts have one empty section without tokens;
a text that ends in a line break has no empty section after it; repeated rows
repeat their result; extra columns are not read.  Counts of a text's sections
add up to the tokens of the whole text under every rule.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = ("majority", "first")
#: The pattern that cuts a text into words for the byte-level vocabularies (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space of the pattern in runs that are encoded by ``encode`` itself.
LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{5000,}")

_LOADED: dict = {}


def encoder(path: str):
    """The tiktoken encoder of a rank file and its token lengths in bytes (loaded once per worker)."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            size[i] = len(token)
        _LOADED[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), size
    return _LOADED[path]


def encode(enc, text: str) -> np.ndarray:
    """The ids of a text, long white space included.

    The pattern's white space looks ahead, which takes stack for every character.  By the pattern a run of white space
    is one word, without its last character where a text goes on, so a long run is encoded as that
    word, and what lies around it on its own: the words are the same.
    """
    parts, at = [], 0
    for run in LONG_SPACE.finditer(text):
        end = run.end() - (run.end() < len(text))
        if run.start() > at:
            parts.append(enc.encode_to_numpy(text[at: run.start()], disallowed_special=()))
        parts.append(np.array(enc._encode_single_piece(text[run.start(): end]), np.int64))
        at = end
    if at < len(text):
        parts.append(enc.encode_to_numpy(text[at:], disallowed_special=()))
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def token_spans(raw: bytes, size: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Character spans ``[start, end)`` of the tokens, and the character index of each byte."""
    char = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
    ends = np.cumsum(size[ids])
    starts = ends - size[ids]
    return char[starts], char[ends - 1] + 1, char


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token span, and whether it crosses a bound.  ``bounds``: section starts, first is 0."""
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    owner = first.copy()
    cross = np.flatnonzero(last > first)
    if rule == "majority":
        edges = np.append(bounds, np.iinfo(np.int64).max)
        for t in cross.tolist():  # few: tokens over a bound
            s = np.arange(first[t], last[t] + 1)
            owner[t] = s[np.argmax(np.minimum(edges[s + 1], ends[t]) - np.maximum(edges[s], starts[t]))]
    return owner, last > first


def section_counts(fields: Sequence[str], path: str, sections: str = "line", rule: str = "majority") -> list[tuple]:
    """``(section, field, char_start, char_end, n_tokens, n_crossing)`` for the sections of one row."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    enc, size = encoder(path)
    text = "\n".join(fields)
    length = np.array([len(f) for f in fields]) + 1
    field_at = np.cumsum(length) - length
    if sections == "line":
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        breaks = np.flatnonzero(codes == 10) + 1
        bounds = np.unique(np.r_[field_at, breaks[breaks < len(text)]])
    else:
        bounds = field_at
    field = np.searchsorted(field_at, bounds, "right") - 1
    n = len(bounds)
    count = cross = np.zeros(n, np.int64)
    raw = text.encode("utf-8", "replace")
    if raw:
        ids = encode(enc, raw.decode("utf-8"))
        starts, ends, _ = token_spans(raw, size, ids)
        owner, over = attribute(starts, ends, bounds, rule)
        count = np.bincount(owner, minlength=n)
        cross = np.bincount(owner[over], minlength=n)
    stops = np.append(bounds[1:], len(text))
    return list(zip(range(n), field.tolist(), bounds.tolist(), stops.tolist(), count.tolist(), cross.tolist()))


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", fields: Sequence[str] = ("text",),
                 sections: str = "line", rule: str = "majority") -> DataFrame:
    """One row per section: id, section, field, char_start, char_end (in the joined text), n_tokens, n_crossing."""
    names = list(fields)
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [c.to_pylist() for c in b.columns[1:]]
            pos, rows = [], []
            for r, own in enumerate(zip(*texts)):
                got = section_counts(own, path, sections, rule)
                pos += [r] * len(got)
                rows += got
            if rows:
                cols = [pa.array(c) for c in zip(*rows)]
                cols[1] = pa.array([names[f] for f in cols[1].to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(pos)), *cols],
                    ["id", "section", "field", "char_start", "char_end", "n_tokens", "n_crossing"])

    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"f{n}") for n, c in enumerate(names)]
    out = df.select(F.col(id_col).alias("id"), *cols).mapInArrow(
        run, f"id {kind}, section long, field string, char_start long, char_end long, n_tokens long, n_crossing long")
    return out.withColumnRenamed("id", id_col)
