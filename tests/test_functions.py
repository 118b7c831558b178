"""Array, string and scalar edges (FIXTURES.md §3, last paragraph)."""

import fnmatch

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parley.functions.text import PY_WS, any_keyword, strip_ws
from parley.operators import curate, split, template
from parley.sources.manifest import glob_to_regex


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def arr(xs, t="int"):
    return F.array(*[F.lit(x) for x in xs]).cast(f"array<{t}>")


def test_find_subseq(spark):
    assert one(spark, template.find_subseq(arr([1, 2, 3, 2, 3]), arr([2, 3]))) == 1
    assert one(spark, template.find_subseq(arr([1, 2, 3, 2, 3]), arr([2, 3]), last=True)) == 3
    assert one(spark, template.find_subseq(arr([1]), arr([2, 3]))) == -1
    assert one(spark, template.find_subseq(arr([1, 2]), arr([]))) == 0
    assert one(spark, template.find_subseq(arr([]), arr([1]))) == -1


def test_tail(spark):
    assert one(spark, template.tail(arr([1, 2]), 3)) == [1, 2]
    assert one(spark, template.tail(arr([1, 2, 3, 4]), 3)) == [2, 3, 4]
    assert one(spark, template.tail(arr([]), 3)) == []


def test_mask_and_strip_prompt(spark):
    toks = arr(["a", "<|im_start|>", "assistant", "x", "<|im_start|>", "assistant", "y", "z"], "string")
    marker = arr(["<|im_start|>", "assistant"], "string")
    start = one(spark, template.mask_start(toks, marker))
    assert start == 6
    labels = one(spark, template.masked_labels(toks, template.mask_start(toks, marker)))
    assert labels == [None] * 6 + ["y", "z"] and len(labels) == 8
    none = one(spark, template.masked_labels(arr(["a", "b"], "string"),
                                             template.mask_start(arr(["a", "b"], "string"), marker)))
    assert none == [None, None]
    assert one(spark, template.strip_prompt(arr([1, 2, 3, 4]), 2)) == [3, 4]
    assert one(spark, template.strip_prompt(arr([1, 2]), 5)) == []
    assert one(spark, template.truncate_tokens(arr([1, 2, 3]), 2)) == [1, 2]


def test_keywords(spark):
    assert one(spark, any_keyword(F.lit("providing"), ["ovid"], case_sensitive=False)) is True
    assert one(spark, any_keyword(F.lit("providing"), ["ovid"], case_sensitive=False, word_boundary=True)) is False
    assert one(spark, any_keyword(F.lit("hi Ovid!"), ["ovid"], case_sensitive=False, word_boundary=True)) is True
    msgs = F.array(F.struct(F.lit("user").alias("role"), F.lit("ab").alias("content")),
                   F.struct(F.lit("assistant").alias("role"), F.lit("cd").alias("content")))
    df = spark.range(1).select(msgs.alias("messages"))
    assert curate.keyword_flag(df, ["b c"]).first()["flag"] is True
    many = [f"kw{i}" for i in range(150)] + ["zz"]
    assert one(spark, any_keyword(F.lit("a zz b"), many)) is True


def test_strip_ws_matches_python(spark):
    s = PY_WS + "x y" + PY_WS
    assert one(spark, strip_ws(F.lit(s))) == s.strip()
    assert one(spark, strip_ws(F.lit("​ x"))) == "​ x".strip()


def test_coverage_zero_rows(spark):
    empty = spark.range(0).select(F.lit(True).alias("flag"))
    row = curate.keyword_coverage(empty).first()
    assert (row["n_key"], row["n_total"], row["pct"]) == (0, 0, 0.0)


def test_band_guard_edges_and_enforce(spark):
    import pytest

    for pct, verdict in [(10.0, "ok"), (18.0, "ok"), (9.99, "raise"), (18.01, "lower")]:
        cov = spark.range(1).select(F.lit(pct).alias("pct"))
        assert curate.band_guard(cov).first()["verdict"] == verdict
    with pytest.raises(curate.GuardError):
        curate.band_guard(spark.range(1).select(F.lit(5.0).alias("pct")), enforce=True)


def test_quotas():
    assert split.quota_profile_a(14, 86) == (5, 4)
    assert split.quota_profile_a(3, 2000) == (5, 100)      # all 3 identity rows go to eval, budget still 295
    assert split.quota_profile_a(1000, 100000) == (30, 270)
    assert split.quota_profile_b(100, 1000) == (30, 270)


def test_profile_a_few_identity(spark):
    df = spark.range(200).select(F.col("id").alias("conv_id"), (F.col("id") < 3).alias("flag"))
    s = split.stratified_split(df, "flag", ["conv_id"], quota="A")
    got = {(r["flag"], r["split"]): r["n"] for r in split.split_summary(s, "flag").collect()}
    assert got[(True, "eval")] == 3 and (True, "train") not in got
    assert got[(False, "eval")] == min(295, 197 // 20)


def test_step_plan(spark):
    df = spark.createDataFrame([(0,), (1,), (17,), (4800,)], "n long")
    rows = df.select("n", *curate.step_plan("n", 2, 8, 2, 100)).collect()
    assert [(r["steps_per_epoch"], r["total_steps"], r["eval_every"]) for r in rows] == [
        (1, 2, 100), (1, 2, 100), (2, 4, 100), (300, 600, 100)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab*?/._c[]!^&|", min_size=0, max_size=7), st.text(alphabet="ab/._c!^&|[]", min_size=0, max_size=8))
def test_glob_matches_fnmatch(pattern, name):
    import re

    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore", FutureWarning)   # fnmatch's own regex for '[[' sets
        expected = fnmatch.fnmatchcase(name, pattern)
    assert (re.fullmatch(glob_to_regex(pattern), name) is not None) == expected


def test_glob_in_spark(spark):
    from parley.sources.manifest import match_any_glob

    names = ["checkpoint-1/a.bin", "x/y.pyc", "optimizer.pt", "a.tmp", "keep.jsonl", "runs/x/y"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    pats = ["checkpoint-*", "*.pyc", "runs/*", "optimizer.pt", "*.tmp"]
    kept = {r["path"] for r in df.where(~match_any_glob(F.col("path"), pats)).collect()}
    assert kept == {n for n in names if not any(fnmatch.fnmatchcase(n, p) for p in pats)}


def test_pluggable_tokenizer(spark):
    def _toy_tokenizer():  # nested: shipped to workers by value
        vocab = {}

        def enc(s):
            return [vocab.setdefault(w, len(vocab)) for w in s.split()]

        return enc

    df = spark.createDataFrame([("a b a",), ("c",), (None,)], "text string")
    rows = df.select(template.tokenize_with("text", _toy_tokenizer).alias("ids")).collect()
    ids = [r["ids"] for r in rows]
    assert ids[2] is None and len(ids[0]) == 3 and ids[0][0] == ids[0][2] and len(ids[1]) == 1


def test_range_partitions_floor(spark):
    from parley.operators.numbering import range_partitions

    assert range_partitions(spark.range(10)) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_file_multiplier_long_rule_list(spark):
    rules = [(f"zz{i}", 5) for i in range(120)] + [("Identity", 2), ("team", 3)]
    files = spark.createDataFrame([("a/team_identity.jsonl",), ("b/general.jsonl",), ("c/x.JSONL",)], "file string")
    got = {r["file"]: r["mult"] for r in curate.file_multiplier(files, rules).collect()}
    assert got == {"a/team_identity.jsonl": 2, "b/general.jsonl": 1, "c/x.JSONL": 1}
    inline = {r["file"]: r["mult"] for r in curate.file_multiplier(files, rules[-2:]).collect()}
    assert inline == got


def test_assistant_mask(spark):
    toks = ["<|im_start|>", "user", "q", "<|im_end|>", "<|im_start|>", "assistant", "a1", "a2", "<|im_end|>",
            "<|im_start|>", "user", "r", "<|im_end|>", "<|im_start|>", "assistant", "b", "<|im_end|>"]
    rows = [(1, toks), (2, []), (3, ["x"]), (4, ["<|im_start|>", "assistant", "c", "d"])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    marker = arr(["<|im_start|>", "assistant"], "string")
    got = {r["id"]: r["labels"] for r in template.with_assistant_labels(df, "tokens", marker).collect()}
    assert [x for x in got[1] if x is not None] == ["a1", "a2", "<|im_end|>", "b", "<|im_end|>"]
    assert len(got[1]) == 17 and got[2] == [] and got[3] == [None]
    assert got[4] == [None, None, "c", "d"]


def test_glob_sets_in_spark(spark):
    from parley.sources.manifest import match_any_glob

    names = ["[x", "ax", "&x", "^x", "bx", "]x", "!x"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    for pat in ["[[]x", "[!a&]x", "[a^]x", "[]a]x", "[!]]x", "[^]x"]:
        got = {r["path"] for r in df.where(match_any_glob(F.col("path"), [pat])).collect()}
        assert got == {n for n in names if fnmatch.fnmatchcase(n, pat)}, pat


def test_count_subseq(spark):
    assert one(spark, template.count_subseq(arr([1, 2, 1, 2, 1]), arr([1, 2]))) == 2
    assert one(spark, template.count_subseq(arr([1, 1, 1]), arr([1, 1]))) == 2
    assert one(spark, template.count_subseq(arr([1]), arr([1, 2]))) == 0
