"""SentencePiece BPE of the merge type, exact, by backtracking, and decoding.

The library merges, again and again, the adjacent pair of symbols whose joined string is the piece of the
highest score (leftmost on ties), from single characters on.  A sequence of pieces is the
result of that exactly if every two neighbours, merged alone from their characters, give the same two
pieces back: a merge across a border of the sequence would, before, be a merge across the border of those two.  So
the one such sequence is searched from left to right: an Aho-Corasick automaton over the reversed pieces, run on
the reversed text, gives the longest piece that starts at each place; it is taken if it agrees with
the piece before (``agrees``: re-merging the two, remembered), else its next shorter prefix is tried; where
no prefix is left, the place is marked in a bitfield of failed positions and the piece before is shortened. Only one
sequence can reach a place, so a failed place is never entered again and the search is linear in the text.

No piece has a blank after another character (checked when the file is loaded), so blanks begin units that do not
affect each other, and so do any two neighbours that no piece holds side by side; a worker remembers the units it has
met, and new units of a chunk are searched once.  The file's own rules: one blank is put before a text that is not empty, blanks become U+2581, a character that is
no piece becomes its UTF-8 bytes (files with other rules are refused).  Decoding drops one leading blank, joins
byte pieces into UTF-8 (a byte that is none is U+FFFD), control pieces are nothing.

Defined results: null or empty text has no ids and decodes to the empty text; a text of any length is encoded
whole; rows are independent.  Extra columns are not read.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import text_of

BLANK = "▁"  # how the file writes a blank
CHUNK_CHARS = 2_000_000
TABLE_CHARS = 8_000_000  # characters of the units that a worker remembers, twice
PAIRS = 1_000_000  # and its tested neighbours at this number

codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceBpe:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            data = f.read()
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(data)
        rules, trainer = spec.normalizer_spec, spec.trainer_spec
        if (trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix
                or rules.precompiled_charsmap or not rules.add_dummy_prefix or rules.remove_extra_whitespaces):
            raise ValueError(f"{path}: not a BPE file of the supported kind")
        file = sentencepiece.SentencePieceProcessor(model_proto=data)
        kind = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte: dict[int, int] = {}  # the byte of an id
        self.shown: list[str | None] = []  # the text of an id; None for a byte
        for n, p in enumerate(spec.pieces):
            if p.type == kind.NORMAL:
                self.score[p.piece], self.id[p.piece] = p.score, n
                self.shown.append(p.piece.replace(BLANK, " "))
            elif p.type == kind.BYTE:
                self.byte[n] = int(p.piece[3:5], 16)
                self.shown.append(None)
            elif p.type == kind.CONTROL:
                self.shown.append("")
            elif p.type == kind.UNKNOWN:
                self.shown.append(file.decode([n]))
            else:
                raise ValueError(f"{path}: piece {n} is of a kind that is not supported")
        if any(BLANK in p.lstrip(BLANK) for p in self.id):
            raise ValueError(f"{path}: a piece has a blank after another character")
        self.of_byte = {b: n for n, b in self.byte.items()}
        self.blank_first = {n for p, n in self.id.items() if p.startswith(BLANK)}
        raw = [bytes([self.byte[n]]) if t is None else t.encode() for n, t in enumerate(self.shown)]
        self.shown_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.shown_size = np.array([len(r) for r in raw])
        self.shown_at = np.cumsum(self.shown_size) - self.shown_size
        self.blank_ids = np.isin(np.arange(len(raw)), list(self.blank_first))
        self.odd_ids = ~np.isin(np.arange(len(raw)), [*self.byte, *self.id.values()])
        # a piece that its own characters do not merge to is never a result
        made = [p for p in self.id if self.merge(p) == [p]]
        self.automaton = ahocorasick.Automaton()
        for p in made:
            self.automaton.add_word(p[::-1], p)
        self.automaton.make_automaton()
        own = set(made)
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in own or k == 1), None) for p in made}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.units: dict[str, tuple[int, ...]] = {}
        self.runs: dict[str, tuple[int, ...]] = {}
        self.units_before: dict[str, tuple[int, ...]] = {}
        self.runs_before: dict[str, tuple[int, ...]] = {}
        self.together = {pair for p in self.id for pair in zip(p, p[1:])}
        self.held = 0

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by merging, one pair at a time."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for n in range(len(parts) - 1):
                s = score.get(parts[n] + parts[n + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, n
            if at < 0:
                break
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agrees(self, left: str, right: str) -> bool:
        """Whether the two pieces, merged alone from their characters, stay as they are."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def search(self, text: str) -> list[str]:
        """The pieces (and characters that are none) of a text, by backtracking over the longest matches."""
        size, pairs, shorter = len(text), self.pairs, self.shorter
        longest: list[str] = list(text)
        seen = -1
        for end, piece in self.automaton.iter(text[::-1]):
            if end != seen:      # of the pieces that end here in the reversed text the longest comes first
                longest[size - 1 - end] = piece
                seen = end
        failed: bytearray | None = None
        found: list[str] = []
        at, before, piece = 0, None, longest[0]
        while True:
            while piece is not None:
                end = at + len(piece)
                if ((before is None or pairs.get((before, piece)) or self.agrees(before, piece))
                        and (failed is None or not failed[end >> 3] >> (end & 7) & 1)):
                    break
                piece = shorter.get(piece)
            if piece is not None:
                found.append(piece)
                if end == size:
                    return found
                at, before, piece = end, piece, longest[end]
                continue
            failed = bytearray(size // 8 + 1) if failed is None else failed
            while piece is None:      # nothing goes on from here: mark the place, shorten the piece before
                failed[at >> 3] |= 1 << (at & 7)
                last = found.pop()
                at -= len(last)
                piece = shorter.get(last)
            before = found[-1] if found else None

    def ids_of(self, pieces: list[str]) -> tuple[int, ...]:
        out: list[int] = []
        for p in pieces:
            n = self.id.get(p)
            if n is None:
                out += [self.of_byte[b] for b in p.encode("utf-8", "surrogatepass")]
            else:
                out.append(n)
        return tuple(out)

    def ids_of_unit(self, text: str) -> tuple[int, ...]:
        """Ids of a unit: two neighbours that no piece holds side by side never merge, so it is cut there."""
        side_by_side = list(map(self.together.__contains__, zip(text, text[1:])))
        if False not in side_by_side:
            return self.ids_of(self.search(text))
        side_by_side.append(False)
        out: list[int] = []
        start, size = 0, len(text)
        while start < size:
            end = side_by_side.index(False, start) + 1
            run = text[start:end]
            known = self.runs.get(run)
            if known is None:
                known = self.runs_before.get(run)
                if known is None:
                    known = self.ids_of(self.search(run))
                self.runs[run] = known
                self.held += end - start + 8
            out += known
            start = end
        return tuple(out)

    def known(self, units: list[str]) -> list[tuple[int, ...]]:
        """Ids of distinct units; what was not met in the last ``TABLE_CHARS`` characters or two is forgotten."""
        if self.held > TABLE_CHARS:
            self.units_before, self.units = self.units, {}
            self.runs_before, self.runs = self.runs, {}
            self.held = 0
        table, before = self.units, self.units_before
        for unit in units:
            if unit not in table:
                ids = before.get(unit)
                table[unit] = self.ids_of_unit(BLANK + unit.replace(" ", BLANK)) if ids is None else ids
                self.held += len(unit) + 8
        return list(map(table.__getitem__, units))

    def split(self, text: str) -> list[str]:
        """The units of a text, each without the blank that begins it."""
        if not text:
            return []
        text = text.replace(BLANK, " ")
        if "  " not in text and not text.startswith(" "):
            return text.split(" ")
        return [u[1:] for u in re.findall(" +[^ ]*", " " + text)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        ids, borders = self.encode_column(pa.array(texts, pa.utf8()))
        return [own.tolist() for own in np.split(ids, borders[1:-1])] if len(texts) else []

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column without nulls in one array, and the n + 1 borders of the texts."""
        texts = pc.replace_substring(texts, BLANK, " ")
        odd = pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.equal(texts, "")))
        plain = np.flatnonzero(~odd.to_numpy(zero_copy_only=False))
        other = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        # every text's units: by Arrow where single blanks part them, else by ``split``
        parted = pc.split_pattern(texts.take(pa.array(plain)), " ")
        own = [self.split(t) for t in texts.take(pa.array(other)).to_pylist()]
        units = pa.concat_arrays([parted.flatten(), pa.array(list(chain.from_iterable(own)), pa.utf8())]).dictionary_encode()
        size = np.zeros(len(texts), np.int64)
        size[plain], size[other] = pc.list_value_length(parted).to_numpy(), [len(u) for u in own]
        at = np.zeros(len(texts), np.int64)
        order = np.r_[plain, other]
        at[order] = np.cumsum(size[order]) - size[order]
        code = units.indices.to_numpy()[_spread(at, size)]
        ids = self.known(units.dictionary.to_pylist())
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(length.sum()))
        per = length[code]
        borders = np.r_[0, np.cumsum(per)][np.r_[0, np.cumsum(size)]]
        return flat[_spread((np.cumsum(length) - length)[code], per)], borders

    def decode_column(self, ids: np.ndarray, borders: np.ndarray) -> pa.Array:
        """The text of each range of ids."""
        if self.odd_ids[ids].any():      # pieces without a text of their own
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(borders, borders[1:])], pa.utf8())
        size = self.shown_size[ids]
        raw = self.shown_bytes[_spread(self.shown_at[ids], size)]
        ends = np.r_[0, np.cumsum(size)][borders]
        first = ids[borders[:-1][borders[:-1] < borders[1:]]]
        drop = ends[:-1][borders[:-1] < borders[1:]][self.blank_ids[first]]
        keep = np.ones(len(raw), bool)
        keep[drop] = False
        ends = ends - np.searchsorted(drop, ends)
        raw = raw[keep]
        got = pa.Array.from_buffers(pa.utf8(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])
        try:
            got.validate(full=True)
        except pa.ArrowInvalid:      # bytes that are no UTF-8
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(borders, borders[1:])], pa.utf8())
        return got

    def decode(self, ids: list[int]) -> str:
        """The text of the ids."""
        shown = [self.shown[n] for n in ids]
        if None in shown:
            parts = []
            for raw, run in groupby(ids, self.byte.__contains__):
                parts.append(bytes(self.byte[n] for n in run).decode("utf-8", "each-byte") if raw
                             else "".join(self.shown[n] for n in run))
            text = "".join(parts)
        else:
            text = "".join(shown)
        first = next((n for n in ids if self.shown[n] != ""), None)  # control pieces do not count
        return text[1:] if first in self.blank_first else text


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``start[i] .. start[i] + size[i] - 1`` of all ``i``, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


_LOADED: dict[str, PieceBpe] = {}


def load(path: str) -> PieceBpe:
    if path not in _LOADED:
        _LOADED[path] = PieceBpe(path)
    return _LOADED[path]


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_CHARS`` characters."""
    ends = np.cumsum(pc.utf8_length(texts).to_numpy())
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK_CHARS)) + 1
        yield lo, min(hi, len(texts))
        lo = hi


def encode_table(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>, decoded)`` per row: the ids of the whole text, and the text decoded from them.

    ``path``: the tokenizer file, at the same place on every executor.
    """
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for lo, hi in _parts(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                ids, borders = bpe.encode_column(part.column(1))
                lists = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, bpe.decode_column(ids, borders)], ["id", "ids", "decoded"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
