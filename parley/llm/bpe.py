"""BPE encoding and decoding with batched numpy merge rounds.

Texts are cut at special tokens, normalised, cut at white space and
pre-tokenised into words by the tokenizer file's own rules; the distinct words
that a batch adds to the worker's table are merged together: the symbols of all words lie in
one flat array, each round looks up the rank of every adjacent pair by binary
search over the sorted pair keys ``left * V + right``, each word takes its
lowest rank, all places of that pair in the word are merged from left to
right, and words without a known pair leave the array.  (Merging all places at
once equals one at a time because a pair made by a merge always ranks after
it; this is checked when the file is loaded.)

Decoding is the file's: it has no decoder, so the token strings are joined by
one space, special tokens included.

Defined results: null or empty text has no tokens and decodes to empty text;
a text of any length is encoded whole.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import text_of

TABLE_WORDS = 400_000  # a worker's table of encoded chunks is emptied at this size
#: Unicode White_Space, as a character class.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    at = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}
    return [at[b] for b in range(256)]


class WordBpe:
    """A tokenizers-library BPE file: NFC, white space to one space, lower case; Split by a pattern; byte level."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if (kinds != ["NFC", "Replace", "Lowercase"] or not split["invert"] or level["add_prefix_space"]
                or spec["decoder"] or model["unk_token"]):
            raise ValueError(f"{path}: not a word BPE file of the supported kind")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.odd = regex.compile("[\\x1c-\\x1f]|<\\|").search
        self.words = regex.compile(split["pattern"]["Regex"].replace("\\s", SPACE)).findall
        vocab = model["vocab"]
        self.token = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = t
        end = model["end_of_word_suffix"] or ""
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = len(self.token)
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        rank = np.arange(len(pairs))
        born = np.full(self.size, -1)
        np.maximum.at(born, made, rank)
        if (born[left] >= rank).any() or (born[right] >= rank).any():
            raise ValueError(f"{path}: a merge ranks before the merge that makes its parts")
        order = np.argsort(left * self.size + right)
        self.keys, self.rank, self.made = (left * self.size + right)[order], rank[order], made[order]
        self.table: dict[str, tuple[int, str, str]] = {}
        for t, i in self.special.items():
            self.table[t] = (1, str(i), t)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words in one array, and the number of ids of each word."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[raw]
        ends = np.cumsum(size) - 1
        sym[ends] = self.last[raw[ends]]
        word = np.repeat(np.arange(len(words)), size)
        out_sym, out_word = [], []
        none = len(self.keys)
        while len(sym):
            key = sym[:-1] * self.size + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), none - 1)
            known = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.rank[at], none), none)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(rank, starts)
            count = np.diff(np.r_[starts, len(sym)])
            low = np.repeat(low, count)
            done = low == none
            if done.any():
                out_sym.append(sym[done])
                out_word.append(word[done])
                sym, word, rank, low = sym[~done], word[~done], rank[~done], low[~done]
                at = np.append(at, 0)[~done]
                if not len(sym):
                    break
            take = rank == low
            # places that overlap the one before (a run of one symbol): every second one
            place = np.flatnonzero(take)
            run = np.r_[True, np.diff(place) > 1]
            first = np.maximum.accumulate(np.where(run, np.arange(len(place)), 0))
            place = place[(np.arange(len(place)) - first) % 2 == 0]
            sym[place] = self.made[at[place]]
            stay = np.ones(len(sym), bool)
            stay[place + 1] = False
            sym, word = sym[stay], word[stay]
        if not out_sym:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        sym, word = np.concatenate(out_sym), np.concatenate(out_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words))

    def learn(self, chunks: set[str]) -> None:
        """Encode the white-space-free chunks that the table lacks; distinct words are merged together."""
        new = [c for c in chunks if c not in self.table]
        if not new:
            return
        split = [self.words(c) for c in new]
        words = list(set().union(*split))
        ids, count = self.merge([w.encode("utf-8", "surrogatepass") for w in words])
        ids = ids.tolist()
        a, known = 0, {}
        for w, n in zip(words, count.tolist()):
            known[w] = ids[a: a + n]
            a += n
        for c, own in zip(new, split):
            got = known[own[0]] if len(own) == 1 else [i for w in own for i in known[w]]
            self.table[c] = (len(got), " ".join(map(str, got)), " ".join([self.token[i] for i in got]))

    def split(self, text: str) -> list[str]:
        """The chunks of a text between white space (no word holds any); special tokens are chunks of their own."""
        if not self.cut or "<|" not in text:
            return self._chunks(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out += [part] if part in self.special else self._chunks(part)
        return out

    def _chunks(self, text: str) -> list[str]:
        # one character at a time: no rule for a sigma that ends a word
        flat = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # the pattern's own words where str.split() would cut at a separator that is no white space here, or
        # where lower case makes the string of a special token (no word of the pattern can be one)
        return self.words(flat) if self.odd(flat) else flat.split()

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text: number of tokens, ids joined by one space, decoded text."""
        split = [self.split(t) for t in texts]
        if len(self.table) > TABLE_WORDS:
            self.table = {t: (1, str(i), t) for t, i in self.special.items()}
        self.learn(set().union(*split))
        out = []
        for chunks in split:
            if not chunks:
                out.append((0, "", ""))
                continue
            n, ids, tokens = zip(*map(self.table.__getitem__, chunks))
            out.append((sum(n), " ".join(ids), " ".join(tokens)))
        return out


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


BATCH_CHARS = 2_000_000


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BATCH_CHARS`` characters."""
    at = chars = 0
    for n, t in enumerate(texts):
        chars += len(t)
        if chars >= BATCH_CHARS:
            yield at, n + 1
            at, chars = n + 1, 0
    if at < len(texts):
        yield at, len(texts)


def encode_table(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 texts: bool = False) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` per row; with ``texts`` also ``ids`` and ``decoded``.

    ``path``: the tokenizer file, at the same place on every executor.
    """
    kind = dict(df.dtypes)[id_col]
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids string, decoded string" * texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for b in batches:
            own = b.column(1).to_pylist()
            for lo, hi in _parts(own):
                got = bpe.encode(own[lo:hi])
                cols = [b.column(0).slice(lo, hi - lo), pa.array([g[0] for g in got], pa.int64()),
                        pa.array([sha(g[1]) for g in got]), pa.array([sha(g[2]) for g in got])]
                if texts:
                    cols += [pa.array([g[1] for g in got]), pa.array([g[2] for g in got])]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(cols)]
                yield pa.RecordBatch.from_arrays(cols, names)

    out = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, schema)
    return out.withColumnRenamed("id", id_col)
