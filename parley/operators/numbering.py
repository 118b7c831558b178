"""Row numbering without a single-task window.

``row_number() over (order by k)`` runs in one task, and ``over (partition by
g order by k)`` puts a whole group in one task; with a group holding a third of
all rows that task is the job.  Here rows are range-partitioned on
``(partition_by, order_by)`` — the sampled range bounds split a hot group over
many tasks — and numbered from each partition's position plus a prefix sum of
per-partition counts (one row per partition, a bounded broadcast).

The ``order_by`` columns together with ``partition_by`` must identify a row
(add a unique tie-breaker).  The tagged rows are checkpointed once (eager),
so every consumer sees one consistent numbering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.session import work_dir


TARGET_SLICE_BYTES = 128 * 1024 * 1024
MAX_SLICES = 200_000


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def range_partitions(df: DataFrame) -> int:
    """Slice count for a range exchange: ~128 MiB of input per slice, never fewer
    than ``spark.sql.shuffle.partitions``.

    The range exchanges here use an explicit count (so AQE leaves them alone);
    sizing it from the input keeps slices bounded from 1 GB to 100 TB.
    """
    spark = df.sparkSession
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        # Sum of the leaf (scan / checkpoint / local) sizes: real input bytes.
        # The root estimate multiplies through joins and can be absurd.
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        # a leaf without statistics reports the default (huge) size: leave it out
        size = sum(x for x in sizes if x < (1 << 62))
    except Exception:  # noqa: BLE001 - estimate unavailable
        return base
    return int(min(MAX_SLICES, max(base, -(-size // TARGET_SLICE_BYTES))))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where null equals null (as in a window's partitions)."""
    renamed = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})   # keeps a broadcast hint
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_k_{k}" for k in keys])


def number_rows(df: DataFrame, order_by: Sequence, partition_by: Sequence[str] = (),
                name: str = "rn", num_partitions: int | None = None,
                first_of: Sequence[str] = ()) -> DataFrame:
    """Add a 1-based ``name`` column: row number within ``partition_by`` by ``order_by``.

    ``first_of`` columns are also returned as ``first_<col>``: their value on
    the group's first row (e.g. a run's start time).
    """
    n = num_partitions or range_partitions(df)
    keys = [*_cols(partition_by), *_cols(order_by)]
    ided = _tag_ranges(df, keys, n)
    counts = ided.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # Prefix sum over the per-partition count table: at most ``n`` rows, so
    # this small un-partitioned window is bounded by the partition count.
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    numbered = ided.join(F.broadcast(offsets), "_pid").withColumn(
        "_g", F.col("_off") + F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33) + 1)
    if not partition_by:
        out = numbered.withColumnRenamed("_g", name)
        if first_of:
            # first row overall, found per slice then over the slice table (≤ n rows, broadcast)
            sl = numbered.groupBy("_pid").agg(F.min_by(F.struct("_g", *first_of), "_g").alias("_f"))
            sl = sl.select("_pid", F.min("_f").over(Window.partitionBy()).alias("_f"))
            out = out.join(F.broadcast(sl), "_pid")
            for c in first_of:
                out = out.withColumn(f"first_{c}", F.col(f"_f.{c}"))
            out = out.drop("_f")
        return out.drop("_pid", "_mid", "_off")
    # Within-group number = global number minus the group's first global number.  A group that begins
    # in a slice has its first row there, which a window over (slice, group) finds; one that goes on
    # from the slice before takes it from a table of at most one row per slice (bounded broadcast).
    pk = list(partition_by)
    w_local = Window.partitionBy("_pid", *pk).orderBy("_mid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.first(F.struct("_g", *first_of)).over(w_local).alias("_f")
    out = null_safe_join(numbered.select("*", first), F.broadcast(_border_firsts(numbered, pk, first_of)),
                         ["_pid", *pk], how="left")
    out = out.withColumn("_f", F.coalesce("_b", "_f")).withColumn(name, F.col("_g") - F.col("_f._g") + 1)
    for c in first_of:
        out = out.withColumn(f"first_{c}", F.col(f"_f.{c}"))
    return out.drop("_pid", "_mid", "_off", "_g", "_f", "_b")


def _border_firsts(numbered: DataFrame, pk: list[str], first_of: Sequence[str]) -> DataFrame:
    """``(_pid, *pk, _b)``: the first row of a group that goes on from an earlier slice; at most one row per slice."""
    edge = _edge_groups(numbered, pk, [F.struct("_g", *first_of).alias("_r")])
    per = edge.groupBy("_pid", *pk).agg(F.min_by("_r", "_r._g").alias("_first"))
    w = Window.partitionBy(*pk).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("_pid", *pk, F.first("_first").over(w).alias("_b")).where(F.col("_b").isNotNull())


def _tag_ranges(df: DataFrame, keys: list[Column], n: int) -> DataFrame:
    """Rows in ``n`` ranges of ``keys``, tagged with range (``_pid``) and place (``_mid``), checkpointed.

    An explicit partition count keeps AQE from coalescing or splitting the exchange.  Tags are read by
    several branches, and Spark may sample range bounds anew per branch with another seed: the tagged
    rows are therefore written once to the shared checkpoint folder (a lost executor re-reads them).
    """
    work_dir(df.sparkSession)  # make sure a checkpoint dir is set
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return ranged.select("*", F.spark_partition_id().alias("_pid"),
                         F.monotonically_increasing_id().alias("_mid")).checkpoint(eager=True)


def _edge_groups(tagged: DataFrame, pk: list[str], cols: list[Column]) -> DataFrame:
    """``(_pid, *pk, *cols)`` of the rows in the first and the last group of their slice.

    Slices are ranges, so only these groups can go on in another slice.
    """
    keys = F.struct(F.lit(0).alias("_"), *[F.col(c) for c in pk])
    ends = tagged.groupBy("_pid").agg(F.min_by(keys, "_mid").alias("_lo"), F.max_by(keys, "_mid").alias("_hi"))
    return tagged.select("_pid", *pk, *cols).join(F.broadcast(ends), "_pid").where(
        keys.eqNullSafe(F.col("_lo")) | keys.eqNullSafe(F.col("_hi")))


def _border_offsets(ided: DataFrame, values: dict[str, str], pk: list[str]) -> DataFrame:
    """``(_pid, *pk, _o_<name>...)``: sums over a group's earlier slices, only where a group goes on in a slice.

    The table has at most one row per slice, whatever the number of groups.
    """
    edge = _edge_groups(ided, pk, [F.col(c).alias(f"_v_{o}") for o, c in values.items()])
    sums = edge.groupBy("_pid", *pk).agg(*[F.sum(f"_v_{o}").alias(f"_t_{o}") for o in values])
    w = Window.partitionBy(*pk).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_pid", *pk, F.count(F.lit(1)).over(w).alias("_earlier"),
                       *[F.sum(f"_t_{o}").over(w).alias(f"_o_{o}") for o in values]).where("_earlier > 0").drop("_earlier")


def running_total(df: DataFrame, values: dict[str, str], order_by: Sequence, partition_by: Sequence[str] = (),
                  num_partitions: int | None = None) -> DataFrame:
    """Running sums (``current row`` inclusive) within ``partition_by`` by ``order_by``.

    ``values`` maps output name → numeric column.  Skew-safe: rows are range
    partitioned (a hot group spans many tasks); each task sums its own slice
    of a group (``Window`` over ``(_pid, group)``, at most one range partition
    per window partition), and a slice that goes on with a group of the slice
    before is shifted by that group's earlier sums (at most one row per slice,
    a bounded broadcast).
    """
    n = num_partitions or range_partitions(df)
    keys = [*_cols(partition_by), *_cols(order_by)]
    ided = _tag_ranges(df, keys, n)
    pk = list(partition_by)
    w_local = Window.partitionBy("_pid", *pk).orderBy("_mid").rowsBetween(Window.unboundedPreceding,
                                                                         Window.currentRow)
    local = ided.select("*", *[F.sum(F.col(c)).over(w_local).alias(f"_l_{o}") for o, c in values.items()])
    out = null_safe_join(local, F.broadcast(_border_offsets(ided, values, pk)), ["_pid", *pk], how="left")
    out = out.select("*", *[(F.col(f"_l_{o}") + F.coalesce(F.col(f"_o_{o}"), F.lit(0))).alias(o) for o in values])
    return out.drop("_pid", "_mid", *[f"_l_{o}" for o in values], *[f"_o_{o}" for o in values])


def sliding_collect(df: DataFrame, items: Column, frame: int, order_by: Sequence, partition_by: Sequence[str],
                    name: str, chunk_rows: int = 100_000, num_partitions: int | None = None,
                    ordinal_col: str | None = None) -> DataFrame:
    """``collect_list(items)`` over the ``frame`` rows before each row (``rows between frame
    preceding and 1 preceding``) within ``partition_by`` ordered by ``order_by``.

    Skew-safe: rows get a group-local number (``number_rows``), groups are cut
    into chunks of ``chunk_rows`` and the last ``frame`` rows of each chunk are
    copied into the next chunk as look-back halo.  A window then runs per
    (group, chunk) — never more than ``chunk_rows + frame`` rows per window
    partition however large the group — and halo copies are dropped.
    ``ordinal_col`` skips the numbering pass when the rows already carry one.
    """
    if frame > chunk_rows:
        raise ValueError(f"frame {frame} does not fit in chunks of {chunk_rows} rows")
    if ordinal_col:
        # caller already has a 1-based, gap-free ordinal within the group
        numbered = df.withColumn("_item", items).withColumn("_rn", F.col(ordinal_col))
    else:
        numbered = number_rows(df.withColumn("_item", items), order_by, partition_by, name="_rn",
                               num_partitions=num_partitions)
    pos = F.col("_rn") - 1
    # one branch: every row in its chunk, the last ``frame`` rows of a chunk in the next one too
    own = F.floor(pos / F.lit(chunk_rows)).cast("long")
    places = F.when((pos % F.lit(chunk_rows)) >= F.lit(chunk_rows - frame), F.array(own, own + 1)).otherwise(F.array(own))
    both = numbered.select("*", F.posexplode(places).alias("_copy", "_chunk")).withColumn("_halo", F.col("_copy") > 0)
    w = Window.partitionBy(*partition_by, "_chunk").orderBy("_rn").rowsBetween(-frame, -1)
    out = both.select("*", F.collect_list("_item").over(w).alias(name)).where(~F.col("_halo"))
    return out.drop("_item", "_rn", "_copy", "_chunk", "_halo")
