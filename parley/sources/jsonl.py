"""JSONL sources and sinks.

``read_jsonl_lines`` is a plain ``spark.read.text`` scan: files are split by
the reader, every split is parsed in parallel, and the file path comes from the
hidden ``_metadata`` column.  True 1-based line numbers are optional
(``with_line_numbers``) because they need a counting pass over whole files.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.operators.normalize import MESSAGES
from parley.session import input_key, work_dir
from parley.sources import fixtures
from parley.sources.manifest import EmptySourceError


def read_jsonl_lines(spark: SparkSession, path: str | list[str], *, glob: str | None = "*.jsonl",
                     recursive: bool = True, file_col: str | None = None) -> DataFrame:
    """``(file, block_start, row_pos, value)`` — one row per physical line (blanks included).

    ``file`` is the full path (D20: stats are keyed by full path, so equal
    base names in two folders stay apart).  For hive-partitioned input pass
    ``file_col`` to use a partition column as the file identity instead
    (``recursive`` must then be False so partition discovery runs).
    Raises ``EmptySourceError`` where no file matches (S4); files without
    lines are no error.
    """
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    paths = [path] if isinstance(path, str) else list(path)
    if file_col:
        r = r.option("basePath", paths[0])
    df = r.text(paths)
    if df.isEmpty() and not df.inputFiles():   # one-row probe; names are asked for only when there is no line
        raise EmptySourceError(f"no input files found under {paths}")
    file = F.col(file_col) if file_col else F.col("_metadata.file_path")
    cols = [file.alias("file"), F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("row_pos"), "value"]
    if file_col:
        cols.insert(1, F.col("_metadata.file_path").alias("part_path"))
    return df.select(*cols)


SPLITS_CONF = "spark.sql.files.minPartitionNum"


def pin_splits(spark: SparkSession) -> None:
    """Cut files by their lengths and a fixed number from now on, not by the cores that are there when a scan is planned.

    Spark aims at as many splits as cores; the number at hand now is pinned, unless one is set, so that
    several scans of the same files have the same splits also after executors come or go.
    """
    if not spark.conf.get(SPLITS_CONF, None):
        spark.conf.set(SPLITS_CONF, str(spark.sparkContext.defaultParallelism))


def number_lines(lines: DataFrame, file: str, parts: Sequence[str], name: str = "line_no") -> DataFrame:
    """1-based ``name`` of each line in its ``file``: its place in its split, and the lines of the splits before.

    ``lines``: all lines of ``read_jsonl_lines``, nothing filtered; ``parts``: columns that order the splits of a file
    (the last is ``block_start``).  The text is neither shuffled nor written: a first pass counts the lines of every
    (file, split), a prefix sum over this table (one row per split, three numbers each: its size is bounded by the
    number of splits) is broadcast to the second.  Both passes must cut the files alike (``pin_splits``); a split that the first pass has
    not seen at that place stops the query rather than giving a wrong number.
    """
    pin_splits(lines.sparkSession)
    # the path as two hashes: a row of the broadcast table has a few numbers, whatever the paths' length
    key = [F.xxhash64(file, *parts).alias("_k1"), F.xxhash64(F.lit(1), *[F.col(c) for c in reversed([file, *parts])]).alias("_k2")]
    splits = lines.groupBy(file, *parts).agg(F.count(F.lit(1)).alias("_n"), F.min("row_pos").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(file).orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1))
    places = splits.select(*key, (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"),
                           F.shiftright("_first", 33).alias("_task"))
    out = lines.select("*", *key).join(F.broadcast(places), ["_k1", "_k2"], "left")
    same = F.col("_task") == F.shiftright("row_pos", 33)
    number = F.when(same, F.col("row_pos") + F.col("_shift")).otherwise(
        F.raise_error(F.concat(F.lit("files were cut differently by two passes: "), F.col(file))))
    return out.withColumn(name, number.cast("long")).drop("_k1", "_k2", "_shift", "_task")


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """1-based ``line_no`` per file, counting blank lines."""
    return number_lines(lines, "file", ["block_start"])


def write_training_jsonl(df: DataFrame, path: str, messages_col: str = "messages") -> str:
    """One ``{"messages":[...]}`` object per line, non-ASCII kept as is."""
    df.select(F.col(messages_col).alias("messages")).write.mode("overwrite").json(path)
    return path


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    """Strict re-read of the prepared JSONL: any malformed line fails the job."""
    return (spark.read.schema(f"messages {MESSAGES.simpleString()}")
            .option("mode", "FAILFAST").json(path))


def write_json_arrays(df: DataFrame, path: str) -> str:
    """Write rows holding small JSON arrays (e.g. marker ids) as JSON lines."""
    df.write.mode("overwrite").json(path)
    return path


def read_json_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read them back with an explicit schema."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def materialize_raw_lines(spark: SparkSession, sf_dir: str) -> str:
    """Write the derived raw lines as JSONL text files, one folder per logical file.

    Layout ``<work>/raw_lines/<key>/file=<name>/part-*``; read back with
    ``read_jsonl_lines(..., glob=None, recursive=False, file_col="file")``.
    """
    out = work_dir(spark, "raw_lines", input_key(sf_dir), uuid.uuid4().hex[:12])  # always of the folder's present files
    raw = fixtures.raw_lines(spark, sf_dir).withColumn("_id", fixtures.line_conv_id(F.col("value")))
    # Range-partitioned on (file, id): every logical file is written as ordered
    # part files (task order = id order), so "line n of a logical file" is
    # well defined without funnelling a file through one task.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (raw.repartitionByRange(n, "file", "_id").sortWithinPartitions("file", "_id").drop("_id")
     .write.mode("overwrite").partitionBy("file").text(out))
    return out


def logical_line_numbers(lines: DataFrame) -> DataFrame:
    """1-based ``line_no`` within a logical file stored as ordered part files.

    ``lines`` comes from ``read_jsonl_lines(..., file_col=...)`` (it carries ``part_path``).
    """
    return number_lines(lines, "file", ["part_path", "block_start"])
