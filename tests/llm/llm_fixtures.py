import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """documents from (doc_id, text[, lang]) rows, over several partitions, with clashing extra columns."""

    def make(rows, extra=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3) if full else spark.createDataFrame([], DOCS)
        for c in extra:
            df = df.selectExpr("*", f"'x' as `{c}`")
        return df

    return make


@pytest.fixture(scope="session")
def real_docs():
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"], t["lang"]))
