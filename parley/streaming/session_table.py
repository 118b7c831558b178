"""W1, native variant: chat-history state as a bucketed table, one ``foreachBatch`` per micro-batch.

Per conversation the state row holds ``epoch, exited, last_turn`` and the
last ``cap`` messages of the current epoch.  Each micro-batch is joined to the
state of the buckets it touches, processed with the same scan as ``session_history``, and the touched
conversations' rows are written.  No Python runs per key, so throughput grows with the
cluster rather than with per-key calls.

``StateTable``: a conversation's bucket is a hash of its id.  A batch writes ``b=<batch>/full=<0|1>/bucket=<k>``: a
delta with its touched conversations only, or, where a bucket has ``MAX_DELTAS`` deltas, the bucket compacted
(touched and untouched rows).  A bucket is read from its newest compacted folder on, by path, so untouched buckets are neither
read nor written.  Batch ``b`` reads folders of earlier batches only and overwrites its own: a replayed batch gives
the same.  Two compacted versions of a bucket stay, older folders go.

Semantics equal ``session_state``: a turn is held for ``hold`` after its
arrival and released in turn order; a turn at or below a released one goes to
the ``late`` table; nothing after ``/exit`` is processed; idle conversations
expire.  Arrivals are an append-only table, a folder per batch: what is held are its rows above the
last released turn of their conversation, so nothing is rewritten to hold it.  A folder whose newest
turn was released in an earlier batch is no longer read, and goes one batch later.
Batches in which no turn is due write no state.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.operators.chat_session import HISTORY_CAP, session_epochs
from parley.operators.segments import SLICE_ROWS, carried_rows
from parley.session import input_key, work_dir
from parley.sources import fixtures as fx
from parley.streaming.session_state import EXPIRE_MS, HOLD_MS, INPUT_SCHEMA, read_turns

HIST = "array<struct<turn:long,role:string,text:string>>"
STATE_SCHEMA = f"conv_id long, epoch long, exited boolean, last_turn long, hist {HIST}, seen timestamp"
OUTPUT_SCHEMA = "conv_id long, turn long, n_history long, history_turns string"
BUCKETS = 32       # fixed for the life of a state table; a batch lists at most as many folders times MAX_DELTAS
MAX_DELTAS = 8


def bucket_of(conv: str = "conv_id", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(conv)), F.lit(buckets)).cast("int")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class StateTable:
    """The state of all conversations under ``root``, in ``buckets`` buckets."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, max_deltas: int = MAX_DELTAS):
        self.spark, self.buckets, self.max_deltas = spark, buckets, max_deltas
        self.root = f"{root}/of-{buckets}"      # the number of buckets is part of the place
        self.segments: dict[int, dict[int, bool]] = {}      # bucket: batch: compacted
        fs, path = _fs(spark, f"{self.root}/b=*/full=*/bucket=*")
        for status in fs.globStatus(path) or []:
            b, full, bucket = map(int, re.search(r"b=(\d+)/full=(\d)/bucket=(\d+)$", status.getPath().toString()).groups())
            self.segments.setdefault(bucket, {})[b] = full == 1

    def live(self, bucket: int, before: int) -> list[int]:
        """Batches whose folders make up a bucket for batch ``before``: the newest compacted one and those after it."""
        own = sorted((b for b in self.segments.get(bucket, {}) if b < before), reverse=True)
        whole = next((n for n, b in enumerate(own) if self.segments[bucket][b]), len(own) - 1)
        return own[: whole + 1]

    def _path(self, b: int, full: bool, bucket: int) -> str:
        return f"{self.root}/b={b}/full={int(full)}/bucket={bucket}"

    def read(self, buckets: Iterable[int], before: int, newer_ms: int | None = None) -> DataFrame:
        """State rows of the buckets as batch ``before`` finds them, without those idle since ``newer_ms``."""
        live = {k: self.live(k, before) for k in buckets}
        paths = [self._path(b, self.segments[k][b], k) for k, own in live.items() for b in own]
        if not paths:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        rows = self.spark.read.option("basePath", self.root).schema(
            STATE_SCHEMA + ", b long, full int, bucket int").parquet(*paths)
        names = [c for c in rows.columns if c not in ("b", "full", "bucket")]
        if max(map(len, live.values())) > 1:      # the newest row of a conversation
            rows = rows.groupBy("conv_id").agg(F.max_by(F.struct(*names), "b").alias("r")).select("r.*")
        else:
            rows = rows.select(*names)
        return rows if newer_ms is None else rows.where(F.col("seen") > F.timestamp_millis(F.lit(newer_ms)))

    def write(self, batch: int, touched: DataFrame, buckets: list[int], newer_ms: int) -> None:
        """Writes the touched conversations, all of these buckets; compacts buckets with enough deltas."""
        for own in self.segments.values():      # a replayed batch writes anew
            own.pop(batch, None)
        compact = [k for k in buckets if len(self.live(k, batch)) > self.max_deltas]
        full = F.col("bucket").isin(compact) if compact else F.lit(False)
        rows = touched.withColumn("bucket", bucket_of(buckets=self.buckets))
        if compact:
            old = self.read(compact, batch, newer_ms)
            ids = touched.select(F.col("conv_id").alias("_t_conv"))
            rest = old.join(ids, F.col("conv_id").eqNullSafe(F.col("_t_conv")), "left_anti")
            rows = rows.unionByName(rest.withColumn("bucket", bucket_of(buckets=self.buckets)))
        rows = rows.withColumn("full", full.cast("int"))
        rows.repartition("bucket").write.mode("overwrite").partitionBy("full", "bucket").parquet(f"{self.root}/b={batch}")
        for k in buckets:
            self.segments.setdefault(k, {})[batch] = k in compact
        self._clean(compact)

    def _clean(self, buckets: list[int]) -> None:
        """Of each bucket two compacted versions stay, with the deltas after the older one."""
        for k in buckets:
            whole = sorted(b for b, full in self.segments[k].items() if full)
            for b in [b for b in self.segments[k] if len(whole) > 1 and b < whole[-2]]:
                fs, path = _fs(self.spark, self._path(b, self.segments[k].pop(b), k))
                fs.delete(path, True)


def process_batch(batch: DataFrame, state: DataFrame, cap: int, large: bool = True,
                  slice_rows: int = SLICE_ROWS) -> tuple[DataFrame, DataFrame]:
    """One micro-batch: returns (output rows, state rows of the touched conversations).

    One scan gives each row its epoch, whether ``/exit`` was seen, and the messages before it; output rows are
    those of typed messages, a conversation's state is what its last row sees.  ``large``: whether a conversation can have
    more rows here than a slice takes; else none is asked for.
    """
    s = state.select(F.col("conv_id").alias("_s_conv"), F.col("epoch").alias("_s_epoch"), F.col("exited").alias("_s_exited"),
                     F.col("last_turn").alias("_s_last"))
    hists = state.select(F.col("conv_id").alias("_h_conv"), F.col("hist").alias("_s_hist"))
    # of a repeated turn the first arrival
    once = batch.groupBy("conv_id", "turn").agg(F.min(F.struct("arrived", "role", "text")).alias("_f")).select(
        "conv_id", "turn", "_f.arrived", "_f.role", "_f.text")
    b = (once.join(s, F.col("conv_id").eqNullSafe(F.col("_s_conv")), "left").drop("_s_conv")
         .where(F.col("turn") > F.coalesce(F.col("_s_last"), F.lit(-1))).drop("_s_last"))
    rows = session_epochs(b, skew_safe=large, slice_rows=slice_rows, keep_exited=True)      # epochs of the batch begin with 0
    live = (F.col("_exits") == 0) & ~F.coalesce("_s_exited", F.lit(False))
    said = live & F.col("kind").isin("message", "response")
    item = F.struct("turn", "role", "text", "epoch", "msg_ord")
    seen = Window.partitionBy("_key", "_slice").orderBy("msg_ord").rangeBetween(-cap, 0)
    rows = rows.withColumn("_live", live).withColumn("_item", F.when(said, item))
    rows = rows.withColumn("_seen", F.collect_list("_item").over(seen))      # the row itself and at least ``cap`` before it
    if large:
        carried = carried_rows(rows.where(F.col("_large") & F.col("_item").isNotNull()), "turn", "_item", cap, "_carried")
        rows = rows.join(carried, ["_key", "_slice"], "left").withColumn("_seen", F.when(
            F.col("_carried").isNull(), F.col("_seen")).otherwise(F.concat("_carried", "_seen")))

    def history(hist: Column, epoch: Column) -> Column:
        """The last ``cap`` messages of an epoch: the state's, where no ``/clear`` has come since, and the batch's."""
        own = F.transform(F.filter(hist, lambda x: x["epoch"] == epoch), lambda x: F.struct(
            x["turn"].alias("turn"), x["role"].alias("role"), x["text"].alias("text"))).cast(HIST)
        held = F.when(epoch == 0, F.coalesce("_s_hist", F.array())).otherwise(F.array()).cast(HIST)
        both = F.concat(held, own)
        return F.slice(both, F.greatest(F.size(both) - F.lit(cap), F.lit(0)) + 1, F.lit(cap))

    out = rows.where(F.col("_live") & (F.col("kind") == "message")).join(
        hists, F.col("conv_id").eqNullSafe(F.col("_h_conv")), "left")
    out = out.withColumn("history", history(F.filter("_seen", lambda x: x["msg_ord"] < F.col("msg_ord")), F.col("epoch")))
    out = out.select("conv_id", "turn", F.size("history").cast("long").alias("n_history"),
                     F.array_join(F.transform("history", lambda x: x["turn"].cast("string")), ",").alias("history_turns"))

    # per slice, which needs no exchange, then per conversation where it can have several
    per = rows.groupBy("_key", "_slice").agg(
        F.max("turn").alias("last_turn"), F.max("arrived").alias("seen"), F.max(F.when(F.col("_live"), F.col("epoch"))).alias("_e"),
        F.max("_exits").alias("_exits"), F.max("_s_epoch").alias("_s_epoch"), F.max("_s_exited").alias("_s_exited"),
        F.max_by("_seen", "turn").alias("_seen"))
    if large:
        per = per.groupBy("_key").agg(
            F.max("last_turn").alias("last_turn"), F.max("seen").alias("seen"), F.max("_e").alias("_e"),
            F.max("_exits").alias("_exits"), F.max("_s_epoch").alias("_s_epoch"), F.max("_s_exited").alias("_s_exited"),
            F.max_by("_seen", "last_turn").alias("_seen"))
    per = per.withColumn("conv_id", F.col("_key.g")).join(hists, F.col("conv_id").eqNullSafe(F.col("_h_conv")), "left")
    epoch = F.coalesce("_e", F.lit(0))
    return out, per.select(
        "conv_id", (F.coalesce("_s_epoch", F.lit(0)) + epoch).cast("long").alias("epoch"),
        (F.coalesce("_s_exited", F.lit(False)) | (F.col("_exits") > 0)).alias("exited"),
        F.col("last_turn").cast("long").alias("last_turn"), history(F.col("_seen"), epoch).alias("hist"), "seen")


def _after(rows: DataFrame, state: DataFrame) -> DataFrame:
    """``rows`` with ``_last``, the last released turn of their conversation (-1 if none)."""
    last = state.select(F.col("conv_id").alias("_conv"), "last_turn")
    j = rows.join(last, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return j.withColumn("_last", F.coalesce("last_turn", F.lit(-1))).drop("last_turn")


class SessionTable:
    """The tables of one stream under ``base``: arrivals, late turns, marks, state, output."""

    def __init__(self, spark: SparkSession, base: str, cap: int = HISTORY_CAP, hold_ms: int = HOLD_MS,
                 expire_ms: int = EXPIRE_MS, buckets: int = BUCKETS, max_deltas: int = MAX_DELTAS):
        self.spark, self.base, self.cap, self.hold_ms, self.expire_ms = spark, base, cap, hold_ms, expire_ms
        self.state = StateTable(spark, f"{base}/state", buckets, max_deltas)
        #: per batch still of use: newest arrival and what was due, one row each
        self.newest: dict[int, int] = {}
        self.due: dict[int, int] = {}
        if self.there("marks"):
            for r in spark.read.schema("newest_ms long, due_ms long, b long").parquet(f"{base}/marks").collect():
                self.newest[r.b], self.due[r.b] = r.newest_ms, r.due_ms

    def there(self, name: str) -> bool:
        fs, path = _fs(self.spark, f"{self.base}/{name}")
        return fs.exists(path)

    def on_batch(self, batch_df: DataFrame, batch: int) -> None:
        spark = batch_df.sparkSession
        arrivals = f"{self.base}/arrivals/b={batch}"
        batch_df.withColumn("bucket", bucket_of(buckets=self.state.buckets)).write.mode("overwrite").parquet(arrivals)
        mine = spark.read.schema(INPUT_SCHEMA + ", arrived timestamp, bucket int").parquet(arrivals)
        newest, buckets = mine.agg(F.unix_millis(F.max("arrived")), F.collect_set("bucket")).first()   # at most all buckets
        before = max((d for b, d in self.due.items() if b < batch), default=0)
        state = self.state.read(buckets, batch, before - self.expire_ms)
        _after(mine, state).where(F.col("turn").isNull() | (F.col("turn") <= F.col("_last"))).select("conv_id", "turn").write.mode(
            "overwrite").parquet(f"{self.base}/late/b={batch}")
        self.newest[batch] = newest or 0
        due = max(before, self.newest[batch] - self.hold_ms)
        self.release(batch, due, before)
        spark.range(1).select(F.lit(self.newest[batch]).cast("bigint").alias("newest_ms"), F.lit(due).cast("bigint").alias(
            "due_ms")).write.mode("overwrite").parquet(f"{self.base}/marks/b={batch}")
        self.due[batch] = due
        self._clean(batch, before)

    def release(self, batch: int, due_ms: int, before_ms: int) -> None:
        """Releases what arrived by ``due_ms`` and the held turns before it."""
        of = [b for b, newest in self.newest.items() if b <= batch and newest > before_ms]
        if not of:
            return
        held = self.spark.read.schema(INPUT_SCHEMA + ", arrived timestamp, bucket int").parquet(
            *[f"{self.base}/arrivals/b={b}" for b in of]).where(
            F.col("turn").isNotNull() & (F.col("arrived") > F.timestamp_millis(F.lit(before_ms))))
        is_due = F.col("arrived") <= F.timestamp_millis(F.lit(due_ms))
        buckets, n = held.agg(F.collect_set(F.when(is_due, F.col("bucket"))), F.count(F.lit(1))).first()
        if not buckets:
            return
        state = self.state.read(buckets, batch, before_ms - self.expire_ms)
        held = _after(held.where(F.col("bucket").isin(buckets)), state).where(F.col("turn") > F.col("_last")).drop("_last")
        upto = held.where(is_due).groupBy(F.col("conv_id").alias("_conv")).agg(F.max("turn").alias("_upto"))
        ready = held.join(upto, F.col("conv_id").eqNullSafe(F.col("_conv"))).where(
            F.col("turn") <= F.col("_upto")).drop("_conv", "_upto", "bucket")
        out, touched = process_batch(ready, state, self.cap, large=n > SLICE_ROWS)
        self.state.write(batch, touched, buckets, before_ms - self.expire_ms)
        out.write.mode("overwrite").parquet(f"{self.base}/out/batch={batch}")

    def _clean(self, batch: int, before_ms: int) -> None:
        """Removes arrivals that neither this batch, were it replayed, nor a later one reads, and their marks."""
        for b in [b for b, newest in self.newest.items() if newest <= before_ms and b < batch - 1]:
            for name in ("arrivals", "marks"):
                fs, path = _fs(self.spark, f"{self.base}/{name}/b={b}")
                fs.delete(path, True)
            del self.newest[b], self.due[b]


def run_session_table_stream(spark: SparkSession, sf_dir: str, cap: int = HISTORY_CAP,
                             max_files_per_trigger: int = 256, landing: str | None = None,
                             hold_ms: int = HOLD_MS, expire_ms: int = EXPIRE_MS, late: bool = False,
                             base: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Run W1 (native variant) over landed session turns with ``availableNow``; return the output rows.

    What is still held at the end of the input is released then.  ``late=True``
    returns the late turns instead.  ``base``: where the tables lie (a new folder unless given).
    """
    base = base or work_dir(spark, "stream_session_table", input_key(sf_dir), uuid.uuid4().hex[:8])
    if landing is None:
        landing = f"{base}/landing"
        fx.session_turns(spark, sf_dir).write.mode("overwrite").parquet(landing)
    tables = SessionTable(spark, base, cap, hold_ms, expire_ms, buckets)
    q = read_turns(spark, landing, max_files_per_trigger, hold_ms).writeStream.foreachBatch(tables.on_batch).option(
        "checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start()
    q.awaitTermination()
    if tables.due:
        tables.release(max(tables.due) + 1, 7_258_118_400_000, max(tables.due.values()))     # end of input: all is due
    if late:
        return spark.read.schema("conv_id long, turn long").parquet(f"{base}/late").select("conv_id", "turn")
    if not tables.there("out"):      # no turn at all
        return spark.createDataFrame([], OUTPUT_SCHEMA)
    return spark.read.schema(OUTPUT_SCHEMA + ", batch long").parquet(f"{base}/out").drop("batch")
