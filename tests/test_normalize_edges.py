"""Edge lines with hand-written expected outcomes (FIXTURES.md §3)."""

import json

import pytest

from parley.operators.normalize import normalize_rows

TAB, NBSP, BOM = "\t", "\u00a0", "\ufeff"

CASES = [
    # (line, outcome, expected messages as (role, content) pairs or None)
    (json.dumps({"messages": [{"role": " user ", "content": NBSP + "hi" + TAB},
                              {"role": "assistant", "content": "yo"}]}), "ok", [("user", "hi"), ("assistant", "yo")]),
    ('{"messages":[{"role":"User","content":"a"},{"role":"assistant","content":"b"}]}', "too_few_messages", None),
    ('{"messages":[{"role":"user","content":"a"},5,{"role":"tool","content":"x"},{"role":"user","content":"b"}]}',
     "ok", [("user", "a"), ("user", "b")]),
    ('{"messages":[{"role":"user","content":"a"}],"instruction":"q","response":"r"}', "too_few_messages", None),
    ('{"messages":null,"instruction":"q","response":"r"}', "ok", [("user", "q"), ("assistant", "r")]),
    ('{"messages":"x","conversation":[{"from":"Human","value":"a"},{"from":"GPT","value":"b"}]}', "ok",
     [("user", "a"), ("assistant", "b")]),
    ('{"conversation":[{"role":"","from":"human","value":"a"},{"role":"bot","content":"","value":"b"}]}', "ok",
     [("user", "a"), ("assistant", "b")]),
    ('{"conversation":[{"role":"  ","from":"human","value":"a"},{"from":"gpt","value":"b"}]}', "too_few_messages", None),
    ('{"conversation":[{"role":null,"from":"human","value":"a"},{"from":"gpt","value":"b"}]}', "ok",
     [("user", "a"), ("assistant", "b")]),
    ('{"messages":[{"role":null,"content":"a"},{"role":"user","content":"b"},{"role":"assistant","content":"c"}]}',
     "bad_type", None),
    ('{"messages":[{"content":"a"},{"role":"user","content":"b"},{"role":"assistant","content":"c"}]}', "ok",
     [("user", "b"), ("assistant", "c")]),
    ('{"messages":[{"role":1,"content":"a"}]}', "bad_type", None),
    ('{"instruction":" q ","input":" i ","response":"r"}', "ok", [("user", "q\n\ni"), ("assistant", "r")]),
    ('{"instruction":"q","input":null,"system":null,"response":"r"}', "ok", [("user", "q"), ("assistant", "r")]),
    ('{"instruction":null,"response":"r"}', "empty_instruction", None),
    ('{"instruction":3,"response":1.50}', "ok", [("user", "3"), ("assistant", "1.5")]),
    ('{"instruction":"q","output":"r"}', "unknown_shape", None),
    ('{"instruction":"q","response":"  "}', "empty_instruction", None),
    ("5", "not_object", None),
    ("null", "not_object", None),
    ('["messages"]', "not_object", None),
    ("[]", "not_object", None),
    ("{bad", "json_error", None),
    ("", "blank", None),
    ("   ", "blank", None),
    ('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]} x', "json_error", None),
    ('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]}}', "json_error", None),
    ('{"instruction":"a","instruction":"b","response":"r"}', "ok", [("user", "b"), ("assistant", "r")]),
    ('{"instruction":"q","response":NaN}', "json_error", None),
    (BOM + '{"instruction":"q","response":"r"}', "ok", [("user", "q"), ("assistant", "r")]),
    ('{"instruction":"q","system":" sys ","response":"r"}', "ok", [("system", "sys"), ("user", "q"), ("assistant", "r")]),
    ('{"conversation":[{"role":"System","content":"s"},{"role":"HUMAN","content":"a"},{"role":"x","content":5}]}',
     "ok", [("system", "s"), ("user", "a")]),
    ('{"conversation":[{"from":"human","value":5},{"from":"gpt","value":"b"}]}', "bad_type", None),
    ('{"conversation":[{"role":"", "from":null,"value":"a"},{"from":"gpt","value":"b"}]}', "bad_type", None),
]


@pytest.fixture(scope="module")
def result(spark):
    df = spark.createDataFrame([(i, line) for i, (line, _, _) in enumerate(CASES)], "n int, value string")
    return {r["n"]: r for r in normalize_rows(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_edge_line(result, i):
    line, outcome, msgs = CASES[i]
    r = result[i]
    assert r["outcome"] == outcome, line
    if msgs is None:
        assert r["messages"] is None
    else:
        assert [(m["role"], m["content"]) for m in r["messages"]] == msgs


def test_whole_line_json_and_py_null(spark):
    ok = '{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]}'
    lines = [ok + "}", ok + ok, ok + "]{}", ok + "," + ok, '"abc" x', "5 x", ok + " ",
             '{"instruction":"q","input":null,"response":"r"}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, value string")
    got = {r["n"]: r["outcome"] for r in normalize_rows(df).collect()}
    assert got == {**dict.fromkeys(range(6), "json_error"), 6: "ok", 7: "ok"}
    py = {r["n"]: r for r in normalize_rows(df, py_str_null=True).collect()}
    assert [m["content"] for m in py[7]["messages"]] == ["q\n\nNone", "r"]


def test_lines_too_large_for_one_parse(spark):
    """A 21 MiB message is read value by value; without a readable shape too_large; broken stays json_error."""
    from pyspark.sql import functions as F

    long_text = F.repeat(F.lit("x"), (F.col("id") + (21 << 20)).cast("int"))   # not a constant: no folding
    tail = '"},{"role":"assistant","content":"y"}]}'
    cases = [('{"messages":[{"role":"user","content":"', tail, "ok"), ('{"other":"', '"}', "too_large"),
             ('{"messages":[{"role":"user","content":"', tail + "{}", "json_error")]
    for head, end, outcome in cases:
        value = F.concat(F.lit(head), long_text, F.lit(end))
        r = normalize_rows(spark.range(1).select(value.alias("value"))).select(
            "outcome", F.transform("messages", lambda m: F.length(m["content"])).alias("n")).first()
        assert r["outcome"] == outcome
        assert r["n"] == ([21 << 20, 1] if outcome == "ok" else None)


def test_messages_only_profile(spark):
    lines = ['{"instruction":"q","response":"r"}',
             '{"messages":[{"role":"tool","content":5},{"role":"user","content":"a"},{"role":"assistant","content":"b"}]}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, value string")
    out = {r["n"]: r["outcome"] for r in normalize_rows(df, shapes=("messages",), lazy_content_check=True).collect()}
    assert out == {0: "unknown_shape", 1: "ok"}
    eager = {r["n"]: r["outcome"] for r in normalize_rows(df).collect()}
    assert eager[1] == "bad_type"


def test_fixture_totals(spark):
    """FIXTURES §2.1 expected totals, computed independently in DuckDB by the survey."""
    from parley.operators.normalize import outcome_counts
    from parley.sources import fixtures as fx

    for sf, expect in [("0.001", {"ok": 15, "json_error": 2, "too_few_messages": 2, "empty_instruction": 1}),
                       ("0.01", {"ok": 82, "json_error": 9, "too_few_messages": 6, "empty_instruction": 3})]:
        n = normalize_rows(fx.raw_lines(spark, f"/root/testdata/sf{sf}"))
        got = {r["outcome"]: r["n"] for r in outcome_counts(n).collect()}
        assert got == expect
