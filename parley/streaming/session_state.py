"""Keyed chat-history state in Structured Streaming.

Turns arrive as files; ``groupBy(conv_id).transformWithState`` keeps typed state per conversation:

* ``head`` (value): epoch, whether ``/exit`` was seen, the last turn released, the highest turn held, the newest
  arrival with its turns, the turn numbers of the history, and counts of the other states;
* ``hist`` (list): the messages of the history, appended in place; cut to the last ``cap`` when ``2 * cap`` are there;
* ``held`` (map): the turns of earlier arrivals that wait, under the time at which they are released;
* ``fronts`` (list): for turns that come out of order, the release time of the turns before them.

A turn is held for ``hold`` after its arrival (its file's modification time,
which the file source reads in order), so turns that arrive out of order
within that time are still processed in turn order.  Released are the turns
whose time is up and every held turn before them.  So a turn's release time is known when it comes: the earliest
arrival among the turns held from it on, itself included.  It is put under that time, an event-time timer
releases the whole entry, and no call reads what others hold: what a call reads and writes is the head, the entries
of its own turns, and the history it adds to.  Only a turn that comes after a higher one reads ``fronts``
(two numbers per waiting release time).

A turn that arrives at or below a released one is late: it leaves as a row with ``late`` set and no
history, never silently; so does a row without a turn.  Of a repeated held turn the first arrival stays.
Conversations without a new turn for ``expire`` lose their state, by a timer that is set again only when it
fires (Spark's own time to live counts processing time, and a result would depend on when a batch runs).  At the end
of a bounded input ``finish`` releases what is still held; the stream then
equals the batch ``session_history``, however turns lie in files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from parley.operators.chat_session import COMMANDS, HISTORY_CAP
from parley.session import input_key, work_dir
from parley.sources import fixtures as fx

OUTPUT_SCHEMA = ("conv_id long, turn long, n_history long, history_turns string, "
                 "history array<struct<turn:long,role:string,text:string>>, late boolean")
HEAD_SCHEMA = ("epoch long, exited boolean, last_turn long, top long, top_due long, seen long, wake long, waiting long, "
               "n_hist long, n_fronts long, recent array<long>, new_due long, "
               "new array<struct<turn:long,role:string,text:string>>")
MESSAGE_SCHEMA = "turn long, role string, text string"
MESSAGE_FIELDS = "turn:long,role:string,text:string"
INPUT_SCHEMA = "conv_id long, turn long, role string, text string"
HOLD_MS = 3_600_000                # how long a turn waits for earlier ones
EXPIRE_MS = 30 * 24 * 3_600_000    # idle time after which a conversation's state goes
END_ROLE = "_end"                  # role of the row that ends a bounded input
SPARE_FRONTS = 64                  # fronts of released turns that may lie in the list


def _kind(role: str | None, text: str | None) -> str:
    if role == "assistant":
        return "response"
    if role != "user":
        return "skip"
    t = (text or "").strip().lower()
    if t == "":
        return "skip"
    return COMMANDS.get(t, "message")


class _Head:
    """The head as attributes; ``None`` starts one."""

    FIELDS = ("epoch", "exited", "last_turn", "top", "top_due", "seen", "wake", "waiting", "n_hist", "n_fronts", "recent",
              "new_due", "new")

    def __init__(self, value: tuple | None):
        for name, x in zip(self.FIELDS, value or (0, False, -1, -1, -1, -1, -1, 0, 0, 0, [], -1, [])):
            setattr(self, name, x)
        self.recent, self.new = list(self.recent or []), [tuple(m) for m in self.new or []]

    def values(self) -> tuple:
        return tuple(getattr(self, name) for name in self.FIELDS)


class HistoryState(StatefulProcessor):
    """Rows ``(conv_id, turn, role, text, arrived_ms)`` to ``OUTPUT_SCHEMA``; event-time timers.

    ``texts``: whether the rows carry the messages of the history, not only their turn numbers.
    """

    def __init__(self, cap: int = HISTORY_CAP, expire_ms: int = EXPIRE_MS, texts: bool = False):
        self.cap, self.expire_ms, self.texts = cap, expire_ms, texts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", HEAD_SCHEMA)
        self.hist = handle.getListState("hist", MESSAGE_SCHEMA)
        self.held = handle.getMapState("held", "due long", f"turns array<struct<{MESSAGE_FIELDS}>>")
        self.fronts = handle.getListState("fronts", "turn long, due long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        """Puts each turn under its release time; returns the late ones."""
        head = _Head(self.head.get())
        seen_before = head.seen
        came = sorted(((r.arrived_ms, -1 if r.turn is None else r.turn, r.role, r.text) for r in rows),
                      key=lambda r: (r[0], r[1], r[2] or "", r[3] or ""))
        fresh: dict[int, list] = {}      # release time: turns
        fronts: list[tuple] = []         # (turn, release time) of tops that are no longer the highest
        known: list[tuple] | None = None
        late = []
        for arrived, turn, role, text in came:
            head.seen = max(head.seen, arrived)
            if turn <= head.last_turn:
                late.append(Row(conv_id=key[0], turn=None if turn < 0 else turn, n_history=None, history_turns=None,
                                history=None, late=True))
                continue
            due = head.seen                # arrivals do not go back
            if turn > head.top:
                if head.top > head.last_turn and due != head.top_due:
                    fronts.append((head.top, head.top_due))
                head.top, head.top_due = turn, due
            else:
                if known is None:
                    known = [tuple(f) for f in self.fronts.get()] if head.n_fronts else []
                due = min([due, head.top_due, *(d for t, d in [*known, *fronts] if t >= turn)])
            fresh.setdefault(due, []).append((turn, role, text))
        for due, turns in sorted(fresh.items()):
            if due == head.new_due:
                head.new += turns
                continue
            there = self.held.getValue((due,)) if due <= seen_before else None
            if there is None:
                self.handle.registerTimer(due)
                head.waiting += 1
            if due > head.new_due:
                if head.new:
                    self.held.updateValue((head.new_due,), (head.new,))
                head.new_due, head.new = due, turns
            else:
                self.held.updateValue((due,), ([*map(tuple, there[0]), *turns] if there else turns,))
        if fronts:
            self._add_fronts(head, fronts, known)
        if head.wake < 0:
            head.wake = head.seen + self.expire_ms
            self.handle.registerTimer(head.wake)
        self.head.update(head.values())
        return iter(late)

    def _add_fronts(self, head: _Head, fronts: list[tuple], known: list[tuple] | None) -> None:
        if head.n_fronts + len(fronts) > SPARE_FRONTS + 2 * head.waiting:   # most are of released turns
            known = [tuple(f) for f in self.fronts.get()] if known is None else known
            fronts = [f for f in [*known, *fronts] if f[0] > head.last_turn]
            self.fronts.put(fronts) if fronts else self.fronts.clear()
            head.n_fronts = len(fronts)
        else:
            self.fronts.appendList(fronts)
            head.n_fronts += len(fronts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Releases the turns of this time, in turn order; drops the state of an idle conversation."""
        now = expiredTimerInfo.getExpiryTimeInMs()
        value = self.head.get()
        if value is None:
            return iter(())
        head = _Head(value)
        due = None
        if now == head.new_due and head.new:
            due, head.new = head.new, []
        elif head.waiting and (entry := self.held.getValue((now,))) is not None:
            due = [tuple(m) for m in entry[0]]
            self.held.removeKey((now,))
        out = []
        if due is not None:
            out = self._release(key[0], head, sorted(due, key=lambda m: m[0]))      # equal turns as they came
            head.waiting -= 1
        if now == head.wake:
            if not head.waiting and head.seen + self.expire_ms <= now:
                for state in (self.head, self.hist, self.held, self.fronts):
                    state.clear()
                return iter(out)
            head.wake = max(head.seen, now - self.expire_ms + 1) + self.expire_ms
            self.handle.registerTimer(head.wake)
        self.head.update(head.values())
        return iter(out)

    def _release(self, conv, head: _Head, turns: list[tuple]) -> list[Row]:
        out, added, stored, cleared = [], [], None, False
        for turn, role, text in turns:
            if turn <= head.last_turn:      # repeated
                continue
            head.last_turn = turn
            if head.exited:
                continue
            text = (text or "").strip()
            kind = _kind(role, text)
            if kind == "exit":
                head.exited = True
            elif kind == "clear":
                head.epoch += 1
                head.recent, added, cleared = [], [], True
            elif kind in ("message", "response"):
                if kind == "message":
                    history = None
                    if self.texts:
                        if stored is None:
                            stored = [tuple(m) for m in self.hist.get()] if head.n_hist else []
                        own = ([] if cleared else stored) + added
                        history = own[len(own) - len(head.recent):]
                    out.append(Row(conv_id=conv, turn=turn, n_history=len(head.recent),
                                   history_turns=",".join(map(str, head.recent)), history=history, late=False))
                added.append((turn, role, text))
                head.recent = [*head.recent, turn][-self.cap:]
        self._keep(head, added, cleared)
        return out

    def _keep(self, head: _Head, added: list[tuple], cleared: bool) -> None:
        """Appends to the stored history; writes it anew after ``/clear`` or when it is twice as long as needed."""
        if cleared and head.n_hist:
            self.hist.clear()
            head.n_hist = 0
        if head.n_hist + len(added) > 2 * self.cap:
            stored = [tuple(m) for m in self.hist.get()] if head.n_hist and len(added) < self.cap else []
            added = [*stored, *added][-self.cap:]
            self.hist.put(added)
            head.n_hist = len(added)
        elif added:
            self.hist.appendList(added)
            head.n_hist += len(added)

    def close(self) -> None:
        pass


def session_stream(turns_stream: DataFrame, cap: int = HISTORY_CAP, hold_ms: int = HOLD_MS,
                   expire_ms: int = EXPIRE_MS, texts: bool = False) -> DataFrame:
    """Streaming ``OUTPUT_SCHEMA`` from a stream of turns with their arrival (``arrived``, in source order)."""
    # One more millisecond, so that a file with the last file's time is not behind the watermark.
    held = turns_stream.withWatermark("arrived", f"{hold_ms + 1} milliseconds")
    # The condition reads the event time, so it stays above the watermark and the end row still moves that.
    rows = held.where((F.coalesce(F.col("role"), F.lit("")) != END_ROLE) | F.col("arrived").isNull())
    rows = rows.select("conv_id", "turn", "role", "text", "arrived", F.unix_millis("arrived").alias("arrived_ms"))
    return rows.groupBy("conv_id").transformWithState(
        HistoryState(cap, expire_ms, texts), OUTPUT_SCHEMA, "append", "EventTime")


def read_turns(spark: SparkSession, landing: str, max_files_per_trigger: int, hold_ms: int = HOLD_MS) -> DataFrame:
    """Stream of the landed turns with their file's modification time as ``arrived``.

    The end row comes as much later as turns are held, so that the watermark passes all that came before it.
    """
    stream = (spark.readStream.schema(INPUT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(landing))
    time = F.col("_metadata.file_modification_time")
    past = F.make_dt_interval(secs=F.lit((hold_ms + 2) / 1000).cast("decimal(18,6)"))
    return stream.select("*", F.when(F.col("role") == END_ROLE, time + past).otherwise(time).alias("arrived"))


#: Settings of the keyed state while a stream of it runs: off the JVM heap, only changes are uploaded per batch.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def run_session_stream(spark: SparkSession, sf_dir: str, cap: int = HISTORY_CAP, max_files_per_trigger: int = 256,
                       landing: str | None = None, hold_ms: int = HOLD_MS, late: bool = False,
                       texts: bool = False) -> DataFrame:
    """Land the session turns as files, run the stream with ``availableNow``, read the result.

    ``max_files_per_trigger`` bounds each micro-batch (and so the rows one key
    can bring to one call); ``availableNow`` still drains all
    files, in several batches.  An end row, landed last, releases what is held: the landing folder is complete from
    there on.  Where not all files fit one batch it is read by a second run, so that it cannot pass a file of its own time.
    The session's own settings are put back.  ``late=True`` returns the late turns instead of the histories; ``texts=True`` adds the
    histories' messages (``history``).
    """
    base = work_dir(spark, "stream_session", input_key(sf_dir), uuid.uuid4().hex[:8])
    out, ckpt = f"{base}/out", f"{base}/ckpt"
    if landing is None:
        landing = f"{base}/landing"
        fx.session_turns(spark, sf_dir).write.mode("overwrite").parquet(landing)

    def drain():
        stream = session_stream(read_turns(spark, landing, max_files_per_trigger, hold_ms), cap, hold_ms, texts=texts)
        (stream.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
         .trigger(availableNow=True).start(out).awaitTermination())

    def end():
        spark.range(1).selectExpr("cast(null as bigint) as conv_id", "cast(null as bigint) as turn",
                                  f"'{END_ROLE}' as role", "cast(null as string) as text").write.mode(
            "append").parquet(landing)

    path = spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/*.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    try:
        for k, v in STATE_CONF.items():
            spark.conf.set(k, v)
        if len(files) >= max_files_per_trigger:
            drain()
        end()
        drain()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    rows = spark.read.schema(OUTPUT_SCHEMA).parquet(out)
    if late:
        return rows.where("late").select("conv_id", "turn")
    rows = rows.where("not late").drop("late")
    return rows if texts else rows.drop("history")
