"""Labels from character spans, prompt lengths, file listings, publishing."""

import json
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.operators import curate, runlog, template
from parley.sources import jsonl, manifest

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
IM, END = template.IM_START, template.IM_END


def render(messages):
    return "".join(f"{IM}{r or ''}\n{c or ''}{END}\n" for r, c in messages)


def char_labels(messages, mode):
    """For each character of the rendered text whether it is trained, by walking the messages."""
    out = []
    for r, c in messages:
        head, body, tail = f"{IM}{r or ''}\n", (c or "") + END, "\n"
        on = r == "assistant"
        out += [False] * len(head) + [on] * len(body) + [False] * len(tail)
    if mode == "last":
        text, marker = render(messages), template.ASSISTANT_MARKER
        starts, at = [], 0
        for r, c in messages:
            if r == "assistant":
                starts.append(at + len(marker))
            at += len(f"{IM}{r or ''}\n{c or ''}{END}\n")
        out = [bool(starts) and n >= starts[-1] for n in range(len(text))]
    return out


CHATS = [
    [("system", "be kind"), ("user", "hi there"), ("assistant", "hello, you"), ("user", "more?"), ("assistant", "  \n\n\nyes é日本 🎉")],
    [("user", "no answer")],
    [("assistant", ""), ("assistant", None), (None, "x"), ("assistant", "\n\n\n")],
    [("user", f"a marker {template.ASSISTANT_MARKER}inside"), ("assistant", "real")],
    [],
    None,
    [("user", "long " * 3000), ("assistant", "word " * 3000)],
]


def encoders():
    """Tokenizers for the tests, made inside a function so that tasks need no import of this file."""
    def every_char(text):
        return [ord(c) for c in text], [(n, n + 1) for n in range(len(text))]

    def in_threes(text):   # these tokens cross borders
        spans = [(n, min(n + 3, len(text))) for n in range(0, len(text), 3)]
        return [n + 1 for n, _ in spans], spans

    return {"every_char": every_char, "in_threes": in_threes}


@pytest.fixture(scope="module")
def chats(spark):
    rows = [(n, None if m is None else [{"role": r, "content": c} for r, c in m]) for n, m in enumerate(CHATS)]
    return spark.createDataFrame(rows, "conv_id long, messages array<struct<role:string,content:string>>")


@pytest.mark.parametrize("mode", ["all", "last"])
@pytest.mark.parametrize("border", ["inside", "any", "first"])
@pytest.mark.parametrize("encoder", ["every_char", "in_threes"])
def test_labels_are_those_of_the_characters(chats, mode, border, encoder):
    encoder = encoders()[encoder]
    got = template.label_tokens(chats, lambda: encoder, mode=mode, border=border).collect()
    for r in got:
        messages = CHATS[r.conv_id]
        if messages is None:
            assert r.ids == [] and r.labels == [] and r.n_tokens == 0
            continue
        chars = char_labels(messages, mode)
        ids, spans = encoder(render(messages))
        take = {"inside": all, "any": any, "first": lambda x: x[0]}[border]
        want = [i if take(chars[a:b]) else template.IGNORE_INDEX for i, (a, b) in zip(ids, spans)]
        assert r.ids == ids and r.labels == want and r.n_tokens == len(ids)
        assert r.n_crossing == sum(any(chars[a:b]) and not all(chars[a:b]) for a, b in spans)


def test_labels_of_a_real_subword_file(spark, chats):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTE_BPE)
    tok.encode_special_tokens = True
    name = template.ship_file(spark, BYTE_BPE)
    whole = template.label_tokens(chats, template.tokenizers_file(name)).collect()
    cut = {r.conv_id: r for r in template.label_tokens(chats, template.tokenizers_file(name), max_len=16).collect()}
    for r in whole:
        messages = CHATS[r.conv_id] or []
        enc = tok.encode(render(messages), add_special_tokens=False)
        chars = char_labels(messages, "all")
        assert r.ids == enc.ids and len(r.labels) == len(r.ids)
        for i, label, (a, b) in zip(enc.ids, r.labels, enc.offsets):
            if b > a:
                assert label == (i if all(chars[a:b]) else template.IGNORE_INDEX)
        assert cut[r.conv_id].ids == r.ids[:16] and cut[r.conv_id].labels == r.labels[:16]      # T8
        assert cut[r.conv_id].n_tokens == len(r.ids)
    assert any(r.n_crossing for r in whole)      # breaks at the head of an answer are one token with the header's


def test_span_inside_a_token():
    spans = np.array([[4, 6], [9, 12]])
    start, end = np.array([0, 3, 5, 9, 12]), np.array([3, 8, 10, 12, 15])
    inside, crossing = template.inside_spans(start, end, spans, "inside")
    assert inside.tolist() == [False, False, False, True, False] and crossing.tolist() == [False, True, True, False, False]
    assert template.inside_spans(start, end, spans, "any")[0].tolist() == [False, True, True, True, False]
    assert template.inside_spans(start, end, spans, "first")[0].tolist() == [False, False, True, True, False]


@pytest.mark.parametrize("slice_rows", [3, 1000])
def test_prompt_lengths_are_running_sums(spark, slice_rows):
    import random
    import re

    rnd = random.Random(4)
    rows = [(c, t, rnd.choice(["user", "assistant", "assistant", "system", None]), rnd.choice(["", None, "a b", "x, y\nz <|im_end|>", "é 日本"]))
            for c, n in ((1, 40), (2, 3), (None, 9)) for t in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    pattern = re.compile(template.TOKEN_PATTERN)
    want = []
    for c, t, r, x in rows:
        if r == "assistant":
            before = render([(a, b) for cc, tt, a, b in rows if cc == c and tt < t]) + f"{IM}assistant\n"
            whole = pattern.findall(before + f"{x or ''}{END}\n")
            n = len(pattern.findall(before))
            want.append((c, t, n, whole[n:]))
    got = template.strip_prompts(df, slice_rows=slice_rows).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want)) and want


def test_listing_has_every_file(spark):
    root = tempfile.mkdtemp(prefix="parley-list-")
    want = {}
    for n in range(130):
        d = f"{root}/{n % 5}/{n % 30}"
        os.makedirs(d, exist_ok=True)
        for name, size in ((f"f{n}.jsonl", n), ("_under.jsonl", 3), (".dot.jsonl", 0), ("x.md", 1)):
            with open(f"{d}/{name}", "w") as f:
                f.write("x" * size)
            want[f"{d}/{name}"] = size
    with open(f"{root}/top.jsonl", "w"):
        want[f"{root}/top.jsonl"] = 0
    files = manifest.list_files(spark, root, glob=None).collect()
    assert {r.path.removeprefix("file:"): r.length for r in files} == want and len(files) == len(want)
    assert all(r.modificationTime is not None for r in files)
    some = manifest.list_files(spark, "file://" + root)
    assert {r.path.removeprefix("file://").removeprefix("file:") for r in some.collect()} == {p for p in want if p.endswith(".jsonl")}
    assert manifest.list_files(spark, root, recursive=False).count() == 1
    assert manifest.list_files(spark, [f"{root}/0", f"{root}/top.jsonl"]).count() > 1
    with pytest.raises(manifest.EmptySourceError):
        manifest.list_files(spark, root, glob="*.nothing")
    assert manifest.list_files(spark, root, glob="*.nothing", allow_empty=True).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        manifest.list_files(spark, root + "/nowhere")


def test_line_numbers_over_many_splits(spark):
    """Files cut in many places and packed together: numbers are those of the files; the text is in no exchange."""
    root = tempfile.mkdtemp(prefix="parley-lines-")
    for f in range(5):
        with open(f"{root}/f{f}.jsonl", "w") as out:
            out.writelines(f"{f}:{n}{'.' * (n * 37 % 91)}\r\n" if n % 7 else "\n" for n in range(1, 700 * f + 2))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        numbered = jsonl.with_line_numbers(jsonl.read_jsonl_lines(spark, root))
        rows = numbered.select(F.regexp_extract("file", r"f(\d)\.jsonl", 1).cast("int").alias("f"), "line_no", "value", "block_start").collect()
        plan = numbered.select("value", "line_no")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len({(r.f, r.block_start) for r in rows}) > 20
    assert len(rows) == sum(700 * f + 1 for f in range(5))
    for r in rows:
        assert r.value == "" if r.line_no % 7 == 0 else r.value.startswith(f"{r.f}:{r.line_no}")
    assert plan.count("value") and "Repartition" not in plan and "LogicalRDD" not in plan


def test_publish_or_nothing(spark):
    rows = spark.range(100).select("id", (F.col("id") < 12).alias("flag"))
    path = tempfile.mkdtemp(prefix="parley-pub-") + "/out"
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    def write(df, where):
        df.write.json(where)
        return where

    def crash(df, where):
        df.limit(5).write.json(where)
        raise RuntimeError("gone")

    counted = rows.mapInArrow(count, "id long, flag boolean")
    first = curate.guarded_write(counted, path, write, 42, ["id"])
    assert made.value == 100      # one evaluation
    assert curate.published(spark, path) == first and spark.read.json(first).count() == 100
    assert json.load(open(f"{path}/{curate.MANIFEST}"))["n_key"] == 12
    with pytest.raises(RuntimeError):
        curate.guarded_write(rows, path, crash, 42, ["id"])
    with pytest.raises(curate.GuardError):
        curate.guarded_write(rows, path, write, 42, ["id"], band=(20.0, 30.0))
    assert curate.published(spark, path) == first and spark.read.json(first).count() == 100      # the earlier version
    second = curate.guarded_write(rows.where("id < 99"), path, write, 42, ["id"])
    assert curate.published(spark, path) == second and spark.read.json(second).count() == 99
    with pytest.raises(curate.GuardError):
        curate.guarded_write(rows.where("id < 0"), path + "2", write, 42, ["id"])
    assert not os.path.exists(path + "2")
    with pytest.raises(FileNotFoundError):
        curate.published(spark, path + "2")


@pytest.mark.parametrize("block", [4, 65_536])
def test_retained_checkpoints(spark, block):
    import random

    rnd = random.Random(8)
    rows = [(run, f"run-{run}/checkpoint-{s}", rnd.choice([None, 0.1, 0.2, 0.3, 0.4])) for run in range(6) for s in rnd.sample(range(60), 20 if run else 1)]
    rows += [(0, "run-0/final", 0.0), (9, "checkpoint-x", 0.5), (7, "checkpoint-3", None), (None, "checkpoint-1", 0.5), (None, "checkpoint-2", 0.1)]
    want = set()
    for run in {r[0] for r in rows}:
        own = sorted((int(p.rsplit("-", 1)[1]), v, p) for r, p, v in rows if r == run and p.rsplit("-", 1)[-1].isdigit())
        want |= {(run, p) for _, _, p in own[-2:]}
        scored = [(v, s, p) for s, v, p in own if v is not None]
        want |= {(run, min(scored)[2])} if scored else set()
    df = spark.createDataFrame(rows, "run_id long, path string, eval_loss double").repartition(4)
    got = runlog.retain_checkpoints(df, block=block).collect()
    assert {(r.run_id, r.path) for r in got} == want and len(got) == len(want)


def test_labels_and_texts_are_made_in_pieces_of_bounded_size(spark, monkeypatch):
    """A worker holds the results of a few rows, not of a whole Arrow batch; rows keep their number and order."""
    import pandas as pd

    made, real = [], F.pandas_udf
    monkeypatch.setattr(template.F, "pandas_udf", lambda kind: lambda f: made.append(f) or real(kind)(f))
    chats = spark.range(1).select(F.array(F.struct(F.lit("assistant").alias("role"), F.lit("x").alias("content"))).alias("messages"))
    template.label_tokens(chats, lambda: lambda t: ([ord(c) for c in t], [(n, n + 1) for n in range(len(t))]), max_len=5_000)
    template.decode_with(F.array(F.lit(1)), lambda: lambda ids: "".join(map(chr, ids)))
    texts = pd.Series([None if n % 50 == 7 else "ab" * (n % 40) + "c" * 2_000 for n in range(1_000)])
    texts.iloc[500] = "d" * 600_000  # one row above the bound
    of = lambda value: pd.Series([value] * len(texts))
    frames = list(made[0](iter([(texts, of([1]), of([1]), of([False]))])))
    assert len(frames) > 4 and sum(map(len, frames)) == len(texts)
    assert max(len(f) for f in frames) * 2_000 < 2 * template.PIECE_CHARS
    rows = pd.concat(frames, ignore_index=True)
    assert rows.n_tokens.tolist() == [len(t or "") for t in texts] and len(rows.ids[500]) == 5_000
    ids = pd.Series([None if t is None else np.array([ord(c) for c in t[:50]], np.int32) for t in texts.tolist() * 20])
    parts = list(made[1](iter([ids])))
    assert len(parts) > 1 and [x for p in parts for x in p] == [None if t is None else t[:50] for t in texts.tolist() * 20]
