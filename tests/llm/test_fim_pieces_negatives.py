"""Fill-in-the-middle, SentencePiece BPE and hard negatives, each against brute force or the library."""

import hashlib
import random
import re

import numpy as np
import pytest
import sentencepiece

from llm_fixtures import docs_of, real_docs  # noqa: F401 - fixtures
from parley.llm import fim, hard_negatives, piece_bpe, queries

ODD = [(900, None), (901, ""), (902, "\n"), (903, "\n\n\n"), (904, "no line end"), (905, "a\n" * 300_000), (905, "a\n" * 300_000),
       (None, "one\ntwo\nthree"), (906, "x<P>y\nz"), (907, "<M"), (908, "日本\né<\n>S>\n"), (909, "long " * 400_000),
       (910, "<S\n>\n<\nP>\n<M"), (911, "\r\n \n\x85")]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- fill in the middle ----------------------------------------------------------------------------------------------
def fim_of(doc_id, text, rate=100, spm=50, marks=("<P>", "<S>", "<M>"), seed=7):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * n: 8 * n + 8], 16) for n in range(4)]
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in marks) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (lines[:lo], lines[lo:hi], lines[hi:]))
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), marks[1] + s + marks[0] + p + marks[2] + m
    return n, "psm", len(p), len(m), marks[0] + p + marks[1] + s + marks[2] + m


@pytest.mark.parametrize("window, chunk", [(fim.WINDOW, fim.CHUNK_BYTES), (7, 50)])
def test_fim_against_slices(spark, docs_of, real_docs, monkeypatch, window, chunk):
    monkeypatch.setattr(fim, "WINDOW", window)  # in this process: the numpy part is called here
    monkeypatch.setattr(fim, "CHUNK_BYTES", chunk)
    rnd = random.Random(3)
    rows = [(n, "".join(rnd.choice("ab\n\né<PSM>") for _ in range(rnd.randint(0, 25)))) for n in range(400)]
    marks = [np.frombuffer(m.encode(), np.uint8) for m in fim.SENTINELS]
    raw = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    borders = np.r_[0, np.cumsum([len(t.encode()) for _, t in rows])]
    want = [fim_of(*r) for r in rows]
    digests = [hashlib.sha256(f"7:{n}".encode()).hexdigest() for n, _ in rows]
    h1, h2 = (np.array([int(d[k: k + 8], 16) for d in digests]) for k in (0, 8))
    plain, spm = (np.array([w[1] == f for w in want]) for f in ("plain", "spm"))
    n, a, b = fim.cut(raw, borders, h1, h2)
    out, at = fim.scatter(raw, borders, a, b, plain, spm, marks)
    assert n.tolist() == [w[0] for w in want]
    assert [out[x:y].tobytes().decode() for x, y in zip(at, at[1:])] == [w[4] for w in want]
    back, at = fim.gather(out, at, [w[1] for w in want], tuple(m.encode() for m in fim.SENTINELS))
    assert back.tobytes() == raw.tobytes() and at.tolist() == borders.tolist()
    lengths = np.diff([lo for lo, _ in fim._chunks(borders)] + [len(rows)])
    assert lengths.sum() == len(rows) and (lengths > 0).all()


@pytest.mark.parametrize("options", [{}, {"rate": 60, "spm_rate": 20, "seed": 11, "sentinels": ("<|pre|>", "<|suf|>", "<|mid|>")}])
def test_fim_table(spark, docs_of, real_docs, options):
    rows = [(d, t) for d, t, _ in real_docs] + ODD
    got = fim.restore(fim.transform(docs_of(rows, extra=("output", "form", "n", "h1", "id")), **options),
                      **({"sentinels": options["sentinels"]} if options else {}))
    marks = options.get("sentinels", fim.SENTINELS)
    want = sorted([(d if d is not None else -1, *fim_of(d, t, options.get("rate", 100), options.get("spm_rate", 50), marks,
                                                          options.get("seed", 7)), t or "") for d, t in rows], key=str)
    assert sorted([(r.doc_id if r.doc_id is not None else -1, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored)
                   for r in got.collect()], key=str) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_fim_query_and_empty_table(spark, docs_of):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op11_fim(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        n, form, p, m, out = fim_of(d.doc_id, d.text)
        r = got[d.doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == \
            (n, form, p, m, sha(out), sha(d.text or ""))
    assert fim.restore(fim.transform(docs_of([]))).count() == 0


def test_fim_restore_refuses_other_outputs():
    raw = np.frombuffer(b"<P>a<M>b", np.uint8)
    with pytest.raises(ValueError, match="sentinel"):
        fim.gather(raw, np.array([0, 8]), ["psm"], (b"<P>", b"<S>", b"<M>"))


# --- SentencePiece ---------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def pieces():
    path = queries.tokenizer_path("piece_bpe_32k.model")
    return piece_bpe.load(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_pieces_equal_the_library_on_every_code_point(pieces):
    own, library = pieces
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for texts in (points, [f"a{c}b {c}{c}" for c in points]):
        ids = own.encode(texts)
        assert ids == library.encode(texts)
        assert [own.decode(i) for i in ids] == library.decode(ids)


def test_pieces_equal_the_library_on_random_and_long_texts(pieces):
    own, library = pieces
    rnd = random.Random(5)
    names = [p.replace("▁", " ") for p in own.id]
    texts = ["".join(rnd.choice(names).replace(" ", rnd.choice(["", " "])) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(rnd.choice("aaab ▁\n.eitn  é日本語 <>01") for _ in range(rnd.randint(0, 50))) for _ in range(4000)]
    texts += [" " * 3_000_000, "\n" * 300_000, " " * 70_001 + "x", "a" * 200_000, "aaab" * 50_000, "日本" * 50_000, "=" * 99_999,
              "▁ " * 1000, "\t \n" * 100_000]
    ids = own.encode(texts)
    assert ids == library.encode(texts)
    assert [own.decode(i) for i in ids] == library.decode(ids)


def test_pieces_decode_any_ids(pieces):
    own, library = pieces
    rnd = random.Random(6)
    ids = [[rnd.choice([rnd.randrange(32000), rnd.randrange(262), 28705, 259]) for _ in range(rnd.randint(0, 8))] for _ in range(20_000)]
    assert [own.decode(i) for i in ids] == [library.decode(i) for i in ids]


def test_piece_search_marks_failed_places(pieces):
    """Every neighbour pair of a result agrees, and no greedy longest match is taken where it does not."""
    own, _ = pieces
    shorter = 0
    for p in list(own.shorter)[::7]:
        for q in ("s", "ing", "er"):
            found = own.search(p + q)
            assert found == own.merge(p + q)
            assert all(own.agrees(a, b) for a, b in zip(found, found[1:]))
            longest = next((p + q)[:k] for k in range(len(p + q), 0, -1) if (p + q)[:k] in own.shorter or k == 1)
            shorter += found[0] != longest
    assert shorter > 0  # backtracking was needed


def test_pieces_table(spark, docs_of, real_docs, pieces):
    _, library = pieces
    rows = [(d, t) for d, t, _ in real_docs[:60]] + ODD
    got = piece_bpe.encode_table(docs_of(rows, extra=("ids", "id", "decoded")), queries.tokenizer_path("piece_bpe_32k.model"))
    want = sorted((str(d), library.encode(t or ""), library.decode(library.encode(t or ""))) for d, t in rows)
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in got.collect()) == want
    assert piece_bpe.encode_table(docs_of([]), queries.tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_pieces_query(spark, pieces):
    _, library = pieces
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op12_piece_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


# --- hard negatives --------------------------------------------------------------------------------------------------
def negatives_of(rows, every=100, k=5, low=80, scale=256):
    """Brute force over (vec_id, vector, label)."""
    taken = {}
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = [int(np.floor(scale * float(np.float32(x)))) for x in v]
        taken[i] = min(taken.get(i, (lab, v)), (lab, v))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (lab, v) in taken.items():
        if a % every:
            continue
        scores = sorted((-dot(v, w), i) for i, (_, w) in taken.items() if i != a)
        own = [(-s, i) for s, i in scores if taken[i][0] == lab][:k]
        for p, name in own:
            found = [(-s, i) for s, i in scores if taken[i][0] != lab and low * p <= -100 * s <= 100 * p][:k]
            out += [(a, name, r, i, p, s) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, every=100, extra=()):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    for c in extra:
        df = df.selectExpr("*", f"'x' as `{c}`")
    return sorted(tuple(r) for r in hard_negatives.mine(df, lambda i: i % every == 0).collect())


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_against_brute_force(spark, monkeypatch, small):
    if small:  # many blocks and tiles
        monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 64)
        monkeypatch.setattr(hard_negatives, "ROW_BYTES", 256)
    rnd = random.Random(9)
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.25, 0.3, 0.5]) for _ in range(4)], rnd.randrange(3)) for i in range(-20, 180)]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.25], i % 2) for i in range(60)]  # one common vector: ties everywhere
    rows += [(300, None, 1), (301, [0.1, None], 1), (302, [float("nan")], 1), (303, [float("inf"), 1.0], 1), (304, [1.0] * 4, None),
             (None, [1.0] * 4, 1), (305, [], 1), (306, [0.9], 2), (307, [0.5] * 7, 2), (0, [0.9] * 4, 1), (20, [0.1] * 4, 0)]
    want = negatives_of(rows, every=10)
    assert want and mined(spark, rows, every=10, extra=("anchor_id", "id", "v", "a", "r", "slot", "low")) == want


def test_hard_negative_tiles(monkeypatch):
    """The numpy part over many tiles gives what one tile gives, and what sorting gives."""
    rnd = np.random.default_rng(2)
    ids, labels = np.arange(500), rnd.integers(0, 4, 500)
    vec = rnd.integers(-3, 4, (500, 6)).astype(np.int16)
    got = []
    for tile in (hard_negatives.TILE, 64):
        monkeypatch.setattr(hard_negatives, "TILE", tile)
        parts = hard_negatives.positives_of(ids[::50], labels[::50], vec[::50], ids, labels, vec, 5, np.dtype(np.float32))
        at, score, name = map(np.concatenate, zip(*parts))
        got.append(sorted(zip(at.tolist(), score.tolist(), name.tolist())))
    assert got[0] == got[1] and len(got[0]) == 50
    limits = np.tile(np.array([[30, 20, 20]]), (10, 1))
    slots = []
    for tile in (hard_negatives.TILE, 64, 1 << 22):
        monkeypatch.setattr(hard_negatives, "TILE", tile)
        slots.append(sorted(zip(*(x.tolist() for x in hard_negatives.slots_of(
            labels[::50], vec[::50], limits, np.full(10, 5), ids, labels, vec, 3, np.dtype(np.float64))))))
    assert slots[0] == slots[1] == slots[2]
    full = vec[::50].astype(int) @ vec.T.astype(int)
    want = []
    for a in range(10):
        for s, (lo, hi) in ((0, (21, 30)), (2, (5, 20))):
            own = sorted((-full[a, r], r) for r in range(500) if labels[r] != labels[50 * a] and lo <= full[a, r] <= hi)[:3]
            want += [(a, s, -x, r) for x, r in own]
    assert slots[0] == sorted(want)


@pytest.mark.parametrize("largest", [1.0, 300.0, 9e6, 1e12])
def test_hard_negatives_exact_at_any_size_of_components(spark, largest):
    rnd = random.Random(int(largest))
    rows = [(i, [rnd.uniform(-largest, largest) for _ in range(3)], i % 2) for i in range(60)]
    want = [w for w in negatives_of(rows, every=10) if w[4] < 2**63]
    got = mined(spark, rows, every=10)
    assert got == want if largest < 1e12 else len(got) > 0  # scores beyond a long are held at its limits


def test_hard_negatives_query_and_empty(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 and r.label is not None else r.label)
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = negatives_of(rows)
    got = queries.op13_hard_negatives(spark, sf)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == want
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []  # no row of another label
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []  # no positive
