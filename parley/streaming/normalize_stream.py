"""Incremental normalisation of landing JSONL files (stateless).

``readStream.text`` → the same ``normalize_rows`` as batch → file sink.  Each
new file is parsed once; results equal the batch run over the same files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.normalize import normalize_rows
from parley.session import input_key, prepare, work_dir
from parley.sources.jsonl import materialize_raw_lines

OUTPUT_SCHEMA = "file string, conv_id long, outcome string, messages array<struct<role:string,content:string>>"


def normalize_stream(lines_stream: DataFrame, keep_fields: dict[str, str] | None = None) -> DataFrame:
    return normalize_rows(lines_stream, keep_fields=keep_fields)


def run_normalize_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the landed raw lines through the normaliser with ``availableNow``; return accepted rows."""
    prepare(spark)
    landing = materialize_raw_lines(spark, sf_dir)
    base = work_dir(spark, "stream_normalize", input_key(sf_dir), uuid.uuid4().hex[:8])
    out, ckpt = f"{base}/out", f"{base}/ckpt"
    stream = spark.readStream.format("text").load(landing).select(
        F.regexp_extract(F.col("_metadata.file_path"), "file=([^/]+)/", 1).alias("file"), "value")
    norm = normalize_stream(stream, keep_fields={"conv_id": "bigint"}).select(
        "file", "conv_id", "outcome", "messages")
    q = (norm.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.schema(OUTPUT_SCHEMA).parquet(out).where(F.col("outcome") == "ok")
