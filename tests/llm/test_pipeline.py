"""The pipeline stage by stage."""

from llm_fixtures import docs_of, real_docs  # noqa: F401 - fixtures
import corpus_pipeline
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(E.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names}


def test_stages_keep_columns_and_take_effect(spark, docs_of):
    line = "and the reth with onion thing that was in of the re and it is on"
    rows = [(d, t, lang) for d, t, lang in ((r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows += [(5001, line, "en"), (5002, line, "en"), (5003, f"{line}. {item}", "en"), (5004, "$$$ ### !!! %%% " * 20, "en"), (5005, None, None)]
    docs = docs_of(rows, extra=("kept", "keep_id", "items"))
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "tokens":
            assert sorted(out.columns) == sorted(docs.columns)
            docs = out.cache()
        left[name] = {r.doc_id for r in out.select("doc_id").collect()}
    assert not {5004, 5005} & left["quality"] and {5001, 5002, 5003} <= left["quality"]
    assert 5002 not in left["exact"] and 5001 in left["exact"]
    assert 5003 not in left["benchmark"] and 5001 in left["tokens"] and left["tokens"] == left["benchmark"]


def test_stages_drop_rows_not_ids(spark, docs_of):
    from parley.llm import decontaminate, exact_dedup, quality, simhash

    texts = lambda df: sorted((str(r.doc_id), r.text) for r in df.collect())
    rows = [(7, "one two three"), (7, "one two three"), (7, "other words in here"), (3, "other words in here"), (None, "one two three"),
            (None, "only without an id"), (None, "only without an id")]
    want = [("3", "other words in here"), ("7", "one two three"), ("None", "only without an id")]
    assert texts(exact_dedup.drop_copies(docs_of(rows, extra=("_row",)))) == want
    assert texts(simhash.drop_near_copies(docs_of(rows, extra=("_row",)))) == want
    bench = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    bad = "x one two three four five six, seven y"
    assert texts(decontaminate.drop_contaminated(docs_of([(1, bad), (1, "clean"), (None, bad), (None, "clean")]), bench)) == [
        ("1", "clean"), ("None", "clean")]
    good = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").limit(60).collect()
    line, junk = good[0].text, "$$$ ### !!! %%% " * 20
    docs = docs_of([(r.doc_id, r.text) for r in good] + [(8001, line), (8001, junk), (None, line), (None, junk)])
    kept = texts(quality.keep_quality(docs, docs_of([(r.doc_id, "") for r in good]).select("doc_id")))
    assert {("8001", line), ("None", line)} <= set(kept) and all(t != junk for _, t in kept)


def test_empty_documents(spark, docs_of):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF) if "text" in docs.columns else docs
    assert docs.count() == 0


def test_quality_stage_scores_by_joins(spark, docs_of, monkeypatch):
    """The stage neither gathers nor broadcasts the model, keeps each row's own verdict and rejects what it should."""
    from parley.llm import quality

    def no_gather(*_):
        raise AssertionError("the model is gathered")

    monkeypatch.setattr(quality, "gather", no_gather)
    monkeypatch.setattr(quality, "BLOCK_BYTES", 20_000)
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    line, junk = next(t for _, t, lang in rows if t and lang == "en"), "$$$ ### !!! %%% " * 20
    docs = docs_of(rows + [(7001, line, "en"), (7001, junk, "en"), (None, line, "en"), (None, junk, "en")])
    left = [(r.doc_id, r.text) for r in corpus_pipeline.quality_stage(spark, docs, SF).collect()]
    assert (7001, line) in left and (None, line) in left and all(t != junk for _, t in left)
