"""Exact dedup with an extendible-hash index kept in shared files.

* Every text gets a 64-bit key (xxhash64 of the normalised text).  A directory
  maps key prefixes to buckets: it starts with one bucket, and a bucket whose
  load is above its capacity is split in two by one more prefix bit, doubling
  the directory when a bucket becomes deeper than it.  Loads are histograms of
  key prefixes (at most ``2**MAX_DEPTH`` numbers reach the driver).
* Only keys held by two or more rows need their bytes compared, so only those
  texts are indexed.  Copies are collapsed before the exchange, in ``SALTS``
  slices per key: one text held by a third of all rows reaches its owner as at
  most ``SALTS`` entries.  Keys with over 1/``HOT_SHARE`` of all rows (fewer than
  ``HOT_SHARE`` of them) are also joined in slices.
* Index entries are written to shared files by bucket.  An owner task takes a
  bucket (a key range), chains the entries that share a key, and compares the
  bytes of each new entry with those in the chain: equal bytes join a group,
  others extend the chain.

Defined results: null text is empty text; empty texts are equal to each other;
white-space runs count as one space; a repeated row (same doc_id) is a member of
its group like any other and shares its flag; a null doc_id never becomes the
keeper unless its whole group has none.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import by_id, numbered, release, stash, text_of, without

WHITESPACE = "[\\x20\\x09-\\x0D]+"
BUCKET_BYTES = 16 * 1024 * 1024
SALTS = 64
HOT_SHARE = 512
MAX_DEPTH = 18
STEP = 6  # prefix bits added per histogram round


def _prefix(depth: int):
    """The top ``depth`` bits of the unsigned key."""
    return F.shiftrightunsigned("key", 64 - depth).cast("long") if depth else F.lit(0).cast("long")


def split_directory(load: dict[int, int], depth: int, capacity: int) -> list[tuple[int, int]]:
    """Buckets ``(prefix, local depth)`` after splitting overfull ones; ``load`` is by ``depth``-bit prefix.

    Starts with one bucket (directory depth 0).  Splitting adds one bit.
    """
    totals = {depth: load}
    for d in range(depth - 1, -1, -1):
        up: dict[int, int] = {}
        for p, x in totals[d + 1].items():
            up[p >> 1] = up.get(p >> 1, 0) + x
        totals[d] = up
    done, todo = [], [(0, 0)]
    while todo:
        p, d = todo.pop()
        if d < depth and totals[d].get(p, 0) > capacity:
            todo += [(2 * p, d + 1), (2 * p + 1, d + 1)]
        else:
            done.append((p, d))
    return sorted(done, key=lambda b: b[0] << (depth - b[1]))


def build_directory(keys: DataFrame, capacity: int = BUCKET_BYTES) -> tuple[list[tuple[int, int]], int]:
    """Buckets and directory depth for ``keys(key, load)``: histogram, split, look deeper while a bucket is overfull."""
    total = keys.agg(F.sum("load")).first()[0] or 0
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, total / capacity)))) + 2)
    while True:
        load = {r["p"]: r["x"] for r in keys.groupBy(_prefix(depth).alias("p")).agg(F.sum("load").alias("x")).collect()}
        buckets = split_directory(load, depth, capacity)
        overfull = any(d == depth and load.get(p, 0) > capacity for p, d in buckets)
        if not overfull or depth >= MAX_DEPTH:
            return buckets, depth
        depth = min(MAX_DEPTH, depth + STEP)


def _directory_table(spark, buckets: list[tuple[int, int]], depth: int) -> DataFrame:
    """One row per directory slot (at most ``2**MAX_DEPTH``): slot → bucket."""
    rows = [(slot, b) for b, (p, d) in enumerate(buckets)
            for slot in range(p << (depth - d), (p + 1) << (depth - d))]
    return spark.createDataFrame(rows, "slot long, bucket int")


def _chains(bucket: pd.DataFrame) -> pd.DataFrame:
    """One bucket: chain the entries of each key and compare bytes."""
    chains: dict[int, list[list]] = {}
    for key, norm, doc, n in zip(bucket["key"], bucket["norm"], bucket["doc"], bucket["n"]):
        raw = norm.encode("utf-8", "surrogatepass")
        doc = None if pd.isna(doc) else int(doc)
        chain = chains.setdefault(key, [])
        for slot in chain:
            if slot[0] == raw:
                slot[1] = doc if slot[1] is None else slot[1] if doc is None else min(slot[1], doc)
                slot[2] += n
                break
        else:
            chain.append([raw, doc, n])
    out = [(key, hashlib.sha256(raw).digest(), doc, int(n))
           for key, chain in chains.items() for raw, doc, n in chain]
    got = pd.DataFrame(out, columns=["key", "sha", "keep", "size"])
    got["keep"] = got["keep"].astype("Int64")
    return got


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = BUCKET_BYTES) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per input row."""
    spark = docs.sparkSession
    norm = F.regexp_replace(text_of(text_col), WHITESPACE, " ")
    base = docs.select(F.col(id_col).cast("long").alias("doc"), norm.alias("norm"))
    base = base.select("doc", "norm", F.xxhash64("norm").alias("key"))
    meta = stash(base.select("doc", "key", F.unhex(F.sha2("norm", 256)).alias("sha"),
                             F.octet_length("norm").cast("long").alias("bytes")), "exact-meta")
    # keys of two or more rows; load: bytes that reach the owner after salted collapsing
    dup = meta.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("b")).where("n > 1")
    dup = stash(dup.select("key", "n", (F.least("n", F.lit(SALTS)) * (F.col("b") + 64)).alias("load")), "exact-keys")
    buckets, depth = build_directory(dup, capacity)
    slots = _directory_table(spark, buckets, depth)
    hot = [r["key"] for r in dup.where(F.col("n") > max(SALTS, meta.count() // HOT_SHARE)).select("key").collect()]
    salt = F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")
    slice_of = F.when(F.col("key").isin(hot), salt).otherwise(0) if hot else F.lit(0)
    slices = F.explode(F.when(F.col("key").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0)))) if hot else F.lit(0)
    owned = dup.select("key", _prefix(depth).alias("slot")).join(F.broadcast(slots), "slot").select(
        "key", "bucket", slices.alias("slice"))
    entries = (base.withColumn("slice", slice_of).join(owned, ["key", "slice"])
               .groupBy("bucket", "key", salt.alias("salt"), "norm")
               .agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("n")))
    index = stash(entries.select("bucket", "key", "norm", "doc", "n"), "exact-index")
    groups = stash(index.groupBy("bucket").applyInPandas(_chains, "key long, sha binary, keep long, size long")
                   .where("size > 1"), "exact-groups")
    release(spark)
    out = meta.withColumn("slice", slice_of).join(groups.withColumn("slice", slices), ["key", "sha", "slice"], "left")
    keep = F.when(F.col("size").isNull(), F.col("doc")).otherwise(F.col("keep"))
    return out.select(F.col("doc").alias("doc_id"), keep.alias("keep_id"),
                      F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
                      F.col("doc").eqNullSafe(keep).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with one row of each group of copies: one with the smallest doc_id, null last."""
    rows, key = numbered(docs, by_id(id_col, text_col))
    gone = exact_groups(rows, key, text_col).where(~F.col("kept")).select(F.col("doc_id").alias(key))
    return without(rows, gone, key).drop(key)
