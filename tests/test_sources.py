"""File sources and sinks on small hand-made files."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from parley.sources import jsonl, manifest


@pytest.fixture(scope="module")
def folder():
    d = tempfile.mkdtemp(prefix="parley-src-")
    os.makedirs(f"{d}/team/sub")
    with open(f"{d}/team/a.jsonl", "w", encoding="utf-8") as f:
        f.write('{"messages":[{"role":"user","content":"é"},{"role":"assistant","content":"b"}]}\n')
        f.write("\n")
        f.write("{bad\n")
        f.write('{"instruction":"q","response":"r"}\n')
    with open(f"{d}/team/sub/b.jsonl", "w", encoding="utf-8") as f:
        f.write('{"instruction":"x","response":"y"}\n')
    with open(f"{d}/team/notes.md", "w") as f:
        f.write("# notes\n")
    return d


def test_scan_and_line_numbers(spark, folder):
    lines = jsonl.read_jsonl_lines(spark, folder)
    numbered = jsonl.with_line_numbers(lines).select(
        F.regexp_extract("file", "([^/]+)$", 1).alias("name"), "line_no", "value").collect()
    got = sorted((r["name"], r["line_no"], r["value"][:5]) for r in numbered)
    assert got == [("a.jsonl", 1, '{"mes'), ("a.jsonl", 2, ""), ("a.jsonl", 3, "{bad"), ("a.jsonl", 4, '{"ins'),
                   ("b.jsonl", 1, '{"ins')]


def test_list_files_and_empty_source(spark, folder):
    files = manifest.list_files(spark, folder)
    names = sorted(os.path.basename(r["path"]) for r in files.collect())
    assert names == ["a.jsonl", "b.jsonl"]
    assert set(files.columns) == {"path", "length", "modificationTime"}
    with pytest.raises(manifest.EmptySourceError):
        manifest.require_nonempty(files.where("length < 0"))
    exts = {r["ext"]: r["n"] for r in manifest.ext_counts(manifest.list_files(spark, folder, glob=None)).collect()}
    assert exts == {"jsonl": 2, "md": 1}


def test_sink_and_strict_reload(spark, folder):
    from parley.operators.normalize import accepted, normalize_rows

    rows = accepted(normalize_rows(jsonl.read_jsonl_lines(spark, folder)))
    out = tempfile.mkdtemp(prefix="parley-sink-")
    jsonl.write_training_jsonl(rows, out)
    text = spark.read.text(out).collect()
    assert len(text) == 3 and any("é" in r["value"] for r in text)     # non-ASCII kept as is
    back = jsonl.read_prepared(spark, out)
    assert back.count() == 3
    bad = tempfile.mkdtemp(prefix="parley-bad-")
    with open(f"{bad}/x.json", "w") as f:
        f.write('{"messages":[]}\n{oops\n')
    with pytest.raises(Exception):
        jsonl.read_prepared(spark, bad).collect()


def test_reader_raises_without_files(spark, folder):
    with pytest.raises(manifest.EmptySourceError):
        jsonl.read_jsonl_lines(spark, folder, glob="*.nothing")
    empty = tempfile.mkdtemp(prefix="parley-empty-")
    open(f"{empty}/e.jsonl", "w").close()
    assert jsonl.read_jsonl_lines(spark, empty).count() == 0   # a file without lines is a file


def test_guarded_write_stops_before_writing(spark):
    from parley.operators import curate

    rows = spark.range(100).select("id", (F.col("id") < 12).alias("flag"))
    out = tempfile.mkdtemp(prefix="parley-guard-") + "/out"

    def write(df, path):
        df.write.json(path)
        return path

    with pytest.raises(curate.GuardError):
        curate.guarded_write(rows, out, write, 42, ["id"], band=(20.0, 30.0))
    assert not os.path.exists(out)
    assert spark.read.json(curate.guarded_write(rows, out, write, 42, ["id"])).count() == 100


def test_marker_choice(spark):
    from parley.operators import template

    df = spark.createDataFrame([(["a", "<m>", "b"], "a <m> b", "b"), (["a", "c", "b"], "a c b", "b")],
                               "tokens array<string>, text string, reply string")
    got = df.select(template.marker_choice("tokens", F.array(F.lit("<m>")), "text", "reply", k=1)).collect()
    assert [r[0] for r in got] == [["<m>"], ["c"]]
