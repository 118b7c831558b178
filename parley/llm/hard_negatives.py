"""Hard negatives by slot-decomposed selection.

Per anchor, the scores of its positives are upper limits of windows: the negatives of a positive of score ``p`` have
scores from ``low/100 * p`` to ``p``.  The windows overlap; their distinct upper limits cut the scores into disjoint
slots, and every window is a run of slots from its own downwards.  So each row is looked at once for all windows:

1. rows that take part are written once, vectors as integers of the smallest type that holds them;
2. anchors and rows are dealt into blocks of bounded bytes, every pair of an anchor block and a row block is one group;
   a group scores its pairs by matrix products and keeps each anchor's first positives (a combiner); a window over
   the anchor merges the groups;
3. the same groups again with each anchor's limits: the first ``k`` negatives of every slot are kept in the group, and
   merged per anchor and slot;
4. the slots of an anchor, joined end to end, descend; a window's answer is the first ``k`` rows of its
   suffix that reach its lower limit.

The blocks hold all rows for a stated set of queries (the anchors); ids are unique there, so hashed blocks are even
whatever the labels or vectors: rows of one label or equal vectors lie in all blocks.  A group holds one anchor
block and one row block (``ANCHOR_BYTES``, ``ROW_BYTES``) and a scores tile of ``TILE`` pairs; each group emits
at most ``k`` rows per anchor and slot.  The work grows as anchors times rows, as the task does.

Defined results: rows with a null id, label or vector or with a null or non-finite component take no part; of rows that
share an id the one with the smallest label, then vector, stays; a shorter vector counts as filled up with
zeros; ties go to the smaller id; a positive of a score below zero has an empty window; scores beyond a long are
held at its limits.  An anchor without positives or negatives has no rows.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import shuffle_partitions, stash

ANCHOR_BYTES = 32 << 20
ROW_BYTES = 64 << 20
LEAST_ROWS = 1024  # a row block is not made smaller than this to feed more tasks
TILE = 1 << 22  # pairs scored at once
LONG = np.iinfo(np.int64)


# --- numpy: one block of anchors against one block of rows ----------------------------------------------------------
def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of a matrix, shorter lists filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), width), flat.dtype)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def exact_type(width: int, largest: int) -> np.dtype:
    """The fastest number type in which every inner product of the data is exact."""
    bound = width * largest * largest
    return np.dtype(np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object)


def scored(a: np.ndarray, b: np.ndarray, kind: np.dtype) -> np.ndarray:
    got = a.astype(kind) @ b.astype(kind).T
    return np.clip(got, -LONG.max, LONG.max).astype(np.int64) if kind == object else got


def first_k(owner: np.ndarray, score: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` entries of each owner, by falling score, then rising name."""
    order = np.lexsort((name, -score, owner))
    own = owner[order]
    start = np.maximum.accumulate(np.where(np.r_[True, own[1:] != own[:-1]], np.arange(len(own)), 0))
    return order[np.arange(len(own)) - start < k]


class Best:
    """The first ``k`` entries of every key met so far, and the score of the last one."""

    def __init__(self, keys: int, k: int):
        self.k, self.entries = k, [np.zeros(0, np.int64)] * 3
        self.least = np.full(keys, LONG.min)  # an entry that comes later must be above; LONG.min: any

    def add(self, key: np.ndarray, score: np.ndarray, name: np.ndarray) -> None:
        key, score, name = (np.concatenate([old, new]) for old, new in zip(self.entries, (key, score, name)))
        keep = first_k(key, score, name, self.k)
        key, score, name = self.entries = [x[keep] for x in (key, score, name)]
        count = np.bincount(key, minlength=len(self.least))
        lowest = np.full(len(self.least), LONG.max)
        np.minimum.at(lowest, key, score)
        self.least = np.where(count >= self.k, lowest, LONG.min)


def tiles(n: int, m: int) -> Iterator[tuple[slice, slice]]:
    rows = max(1, min(m, TILE // max(1, min(n, 2048))))
    step = max(1, TILE // rows)
    for lo in range(0, n, step):
        for at in range(0, m, rows):
            yield slice(lo, min(lo + step, n)), slice(at, min(at + rows, m))


def positives_of(a_id, a_label, a_vec, r_id, r_label, r_vec, k: int, kind) -> Iterator[tuple]:
    """``(anchor place, score, row id)``: the first ``k`` other rows of the anchor's label. Rows ascend by id."""
    for label in np.intersect1d(a_label, r_label):
        own, rows = np.flatnonzero(a_label == label), np.flatnonzero(r_label == label)
        best = Best(len(own), k)
        for x, y in tiles(len(own), len(rows)):
            score = scored(a_vec[own[x]], r_vec[rows[y]], kind)
            there = (score > best.least[x, None]) | (best.least[x, None] == LONG.min)
            there &= a_id[own[x], None] != r_id[None, rows[y]]
            i, j = np.nonzero(there)
            if len(i):
                best.add(i + x.start, score[i, j].astype(np.int64), r_id[rows[y]][j])
        key, score, name = best.entries
        yield own[key], score, name


def slots_of(a_label, a_vec, limits: np.ndarray, low: np.ndarray, r_id, r_label, r_vec, k: int, kind) -> tuple:
    """``(anchor place, slot, score, row id)``: the first ``k`` rows of another label in every slot.

    ``limits``: per anchor its upper limits, falling, repeated at the end where there are fewer; slot ``s`` lies
    above limit ``s + 1`` up to limit ``s``, the last goes down to ``low``. Rows ascend by id.
    """
    depth = limits.shape[1]
    best = Best(len(limits) * depth, k)
    for x, y in tiles(len(limits), len(r_id)):
        score = scored(a_vec[x], r_vec[y], kind)
        other = a_label[x, None] != r_label[None, y]
        found = []
        for s in range(depth):
            key = np.arange(x.start, x.stop) * depth + s
            under = limits[x, s + 1] if s + 1 < depth else low[x] - 1
            # rows come by rising id: one that only equals the k-th of its slot so far can never enter
            i, j = np.nonzero(other & (score <= limits[x, s, None]) & (score > np.maximum(under, best.least[key])[:, None]))
            if len(i):
                found.append((key[i], score[i, j].astype(np.int64), r_id[y][j]))
        if found:
            best.add(*map(np.concatenate, zip(*found)))
    key, score, name = best.entries
    return key // depth, key % depth, score, name


# --- Spark ----------------------------------------------------------------------------------------------------------
def participants(df: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """``(id, label, v)`` of the rows that take part, one per id; ``v``: floor(scale * component) as long."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.alias("label"),
                     F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))))
    return rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def _read(table: pa.Table, width: int) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """A block by rising id: the table, ids, labels, vectors."""
    table = table.sort_by("id")
    return (table, table["id"].to_numpy(), table["label"].to_numpy(), matrix(table["v"], width))


def mine(df: DataFrame, anchors: Callable[[Column], Column], id_col: str = "vec_id", vector_col: str = "embedding",
         label: Column | None = None, positives: int = 5, negatives: int = 5, low: int = 80, scale: int = 256) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors``: from an id to whether it is an anchor's; ``label``: the label, the column ``label`` unless given;
    ``positives``, ``negatives``: how many of each at most; ``low``: a window's lower limit in percent of its positive.
    """
    spark = df.sparkSession
    rows = stash(participants(df, id_col, vector_col, F.col("label") if label is None else label, scale), "vectors")
    sizes = rows.agg(F.count("*"), F.count_if(anchors(F.col("id"))), F.max(F.size("v")),
                     F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))))).first()
    n, n_anchors, width, largest = (int(x or 0) for x in sizes)
    bits = 16 if largest < 2**15 else 32 if largest < 2**31 else 64
    kind = exact_type(max(width, 1), largest)
    a_blocks = max(1, -(-n_anchors * width * 4 // ANCHOR_BYTES))
    r_blocks = max(1, -(-n * width * bits // 8 // ROW_BYTES), min(shuffle_partitions(spark), n // LEAST_ROWS))
    rows = rows.withColumn("v", F.col("v").cast({16: "array<smallint>", 32: "array<int>", 64: "array<bigint>"}[bits]))

    def block(salt: int, count: int) -> Column:
        return F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    # columns of its own: both sides of a group come from one table
    row_side = rows.select(*(F.col(c).alias(c) for c in rows.columns), block(1, r_blocks).alias("r"), every(a_blocks).alias("a"))
    anchor_side = rows.where(anchors(F.col("id"))).withColumn("a", block(2, a_blocks))

    def grid(own: DataFrame, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        own = own.withColumn("r", every(r_blocks))
        return own.groupBy("a", "r").cogroup(row_side.groupBy("a", "r")).applyInArrow(function, schema)

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        _, a_id, a_label, a_vec = _read(left, width)
        _, r_id, r_label, r_vec = _read(right, width)
        got = list(positives_of(a_id, a_label, a_vec, r_id, r_label, r_vec, positives, kind))
        at, score, name = map(np.concatenate, zip(*got)) if got else [np.zeros(0, np.int64)] * 3
        return pa.table({"anchor_id": a_id[at], "positive_score": score, "positive_id": name})

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        table, a_id, a_label, a_vec = _read(left, width)
        _, r_id, r_label, r_vec = _read(right, width)
        limits = matrix(table["limits"], positives)
        count = np.diff(table["limits"].combine_chunks().offsets.to_numpy())
        # where there are fewer, the last one again: no score lies above it and up to it
        limits = limits[np.arange(len(limits))[:, None], np.minimum(np.arange(positives), count[:, None] - 1)]
        at, slot, score, name = slots_of(a_label, a_vec, limits, table["low"].to_numpy(), r_id, r_label, r_vec,
                                         negatives, kind)
        return pa.table({"anchor_id": a_id[at], "slot": limits[at, slot], "score": score, "negative_id": name})

    def first_of(df: DataFrame, by: list[str], score: str, name: str, count: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(name))
        return df.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= count).drop("_n")

    found = grid(anchor_side, find_positives, "anchor_id long, positive_score long, positive_id long")
    pairs = first_of(found, ["anchor_id"], "positive_score", "positive_id", positives).where("positive_score >= 0")
    # low/100 of the score, rounded up, without leaving whole numbers
    pairs = stash(pairs.withColumn("low", F.expr(
        f"(positive_score div 100) * {low} + ((positive_score % 100) * {low} + 99) div 100")), "positives")

    limits = pairs.groupBy(F.col("anchor_id").alias("id")).agg(
        F.sort_array(F.collect_set("positive_score"), asc=False).alias("limits"), F.min("low").alias("low"))
    found = grid(anchor_side.join(limits, "id"), find_negatives, "anchor_id long, slot long, score long, negative_id long")
    slots = first_of(found, ["anchor_id", "slot"], "score", "negative_id", negatives)
    falling = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("fall"), "negative_id", "slot", "score")))
    slots = slots.groupBy("anchor_id").agg(falling.alias("rows"))  # at most positives * negatives rows

    suffix = F.filter("rows", lambda x: (x["slot"] <= F.col("positive_score")) & (x["score"] >= F.col("low")))
    return pairs.join(slots, "anchor_id").select(
        "anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(suffix, 1, negatives)).alias("at", "own")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("own.negative_id").alias("negative_id"),
        "positive_score", F.col("own.score").alias("negative_score"))
