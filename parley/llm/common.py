"""Helpers shared by the operators: table access, lineage cuts, session settings."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files) and lets several passes
    share one computation.
    """
    spark = df.sparkSession
    path = work_dir(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished, unreferenced steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def only(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose id is in ``ids``, by a shuffle on the id at every size."""
    return df.join(ids.hint("shuffle_hash"), id_col, "left_semi")


def numbered(df: DataFrame, order: list[Column] | None = None) -> tuple[DataFrame, str]:
    """``df``, written once with a row key of its own, and the key's name; keys ascend by ``order``."""
    key = "_row"
    while key in df.columns:
        key += "_"
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stash(df.withColumn(key, F.monotonically_increasing_id()), "rows"), key


def by_id(id_col: str, text_col: str) -> list[Column]:
    """Order of rows by id, null last; the text parts a common id."""
    return [F.col(id_col).cast("long").asc_nulls_last(), F.xxhash64(text_of(text_col)).asc()]


def without(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose id is not in ``ids`` (a null id stays), by a shuffle on the id at every size."""
    return df.join(ids.hint("shuffle_hash"), id_col, "left_anti")
