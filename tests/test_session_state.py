"""The keyed state on its own, and the bucketed state table."""

import random
import tempfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from parley.streaming import session_state as ss
from parley.streaming import session_table as st


class Value:
    def __init__(self, log):
        self.log, self.value = log, None

    def get(self):
        self.log.append(("read", 1))
        return self.value

    def update(self, value):
        self.log.append(("write", 1))
        self.value = value

    def clear(self):
        self.value = None


class List_(Value):
    def get(self):
        self.log.append(("read", len(self.value or [])))
        return iter(self.value or [])

    def put(self, rows):
        self.log.append(("write", len(rows)))
        self.value = list(rows)

    def appendList(self, rows):
        self.log.append(("write", len(rows)))
        self.value = [*(self.value or []), *rows]


class Map_(Value):
    def getValue(self, key):
        got = (self.value or {}).get(key)
        self.log.append(("read", len(got[0]) if got else 0))
        return got

    def updateValue(self, key, value):
        self.log.append(("write", len(value[0])))
        self.value = {**(self.value or {}), key: value}

    def removeKey(self, key):
        self.value.pop(key)


class Handle:
    """State and timers of one key, as the engine holds them; ``log`` has the rows of every call."""

    def __init__(self, **kw):
        self.log, self.timers = [], set()
        self.proc = ss.HistoryState(**kw)
        self.proc.init(self)

    def getValueState(self, *_):
        return Value(self.log)

    def getListState(self, *_):
        return List_(self.log)

    def getMapState(self, *_):
        return Map_(self.log)

    def registerTimer(self, at):
        self.timers.add(at)

    def rows(self, arrived, *turns):
        made = [Row(conv_id=1, turn=t, role=role, text=text, arrived_ms=arrived) for t, role, text in turns]
        return [r.asDict() for r in self.proc.handleInputRows((1,), iter(made), None)]

    def mark(self, watermark):
        out = []
        while due := sorted(t for t in self.timers if t <= watermark):
            self.timers.remove(due[0])
            info = type("I", (), {"getExpiryTimeInMs": lambda self, at=due[0]: at})()
            out += [r.asDict() for r in self.proc.handleExpiredTimer((1,), None, info)]
        return out


def test_turns_are_held_released_in_order_and_late_ones_reported():
    h = Handle(cap=3, expire_ms=1000, texts=True)
    assert h.rows(10, (2, "user", "c"), (0, "user", "a")) == []
    assert h.rows(20, (1, "assistant", "b"), (5, "user", "z")) == []
    out = h.mark(10)      # the turns of time 10 are due, and turn 1 before them
    assert [(o["turn"], o["n_history"]) for o in out] == [(0, 0), (2, 2)]
    assert [m[2] for m in out[1]["history"]] == ["a", "b"]
    late = h.rows(30, (1, "user", "late"), (3, "assistant", "d"), (None, "user", "no turn"))
    assert [(o["turn"], o["late"]) for o in late] == [(None, True), (1, True)]
    out = h.mark(40)
    assert [(o["turn"], o["history_turns"]) for o in out] == [(5, "1,2,3")]
    assert h.proc.head.value is not None
    h.mark(5000)
    assert h.proc.head.value is None and not h.proc.held.value and not h.timers      # idle: state gone


def test_idle_timer_waits_for_the_last_turn():
    h = Handle(cap=3, expire_ms=100)
    h.rows(10, (0, "user", "a"))
    h.rows(90, (1, "user", "b"))
    assert len(h.mark(150)) == 2 and h.proc.head.value is not None      # set at 110, moved to 190
    h.mark(189)
    assert h.proc.head.value is not None
    h.mark(190)
    assert h.proc.head.value is None


def release_order(came, marks):
    """Brute force: ``came`` (arrival, turn); at each mark all due turns and the held ones before them."""
    out, held, last, n = [], [], -1, 0
    for mark in marks:
        while n < len(came) and came[n][0] <= mark[0]:
            if came[n][1] > last:
                held.append(came[n])
            else:
                out.append(("late", came[n][1]))
            n += 1
        due = [t for a, t in held if a <= mark[1]]
        if due:
            ready = sorted({t for _, t in held if t <= max(due)})
            held = [h for h in held if h[1] > max(due)]
            out += [("turn", t) for t in ready]
            last = max(last, max(due))
    return out


@pytest.mark.parametrize("seed", range(60))
def test_release_times_equal_looking_at_all_held_turns(seed):
    rnd = random.Random(seed)
    turns = list(range(40)) + [rnd.randrange(40) for _ in range(4)]
    order = sorted(range(len(turns)), key=lambda n: turns[n] + rnd.uniform(0, rnd.choice([1, 8, 30])))
    at, came = 0, []
    for n in order:
        at += rnd.choice([0, 0, 1, 5])
        came.append((at, turns[n]))
    hold = rnd.choice([0, 3, 12])
    h = Handle(cap=5, expire_ms=10**9)
    got, marks, k = [], [], 0
    times = sorted({a for a, _ in came})
    for now in times:
        own = [c for c in came if c[0] == now]
        late = h.rows(now, *[(t, "user", f"m{t}") for _, t in own])
        got += [("late", o["turn"]) for o in late]
        got += [("turn", o["turn"]) for o in h.mark(now - hold)]
        marks.append((now, now - hold))
    got += [("turn", o["turn"]) for o in h.mark(10**6)]
    marks.append((10**6, 10**6))
    came.sort(key=lambda c: (c[0], c[1]))
    want = release_order(came, marks)
    assert [x for x in got if x[0] == "turn"] == [x for x in want if x[0] == "turn"]
    assert sorted(x for x in got if x[0] == "late") == sorted(x for x in want if x[0] == "late")


@pytest.mark.parametrize("cap", [1, 3, 20])
def test_history_is_kept_in_place(cap):
    """Appended, cut now and then, cleared: the stored messages always end with the history."""
    rnd = random.Random(cap)
    h = Handle(cap=cap, expire_ms=10**9, texts=True)
    want, hist = [], []
    for n in range(300):
        kind = rnd.choice(["user"] * 5 + ["assistant"] * 4 + ["clear"])
        text = "/clear" if kind == "clear" else f"m{n}"
        h.rows(n, (n, "assistant" if kind == "assistant" else "user", text))
        got = h.mark(n)
        if kind == "clear":
            hist = []
        else:
            if kind == "user":
                want = [(m, f"m{m}") for m in hist]
                assert [(m[0], m[2]) for m in got[0]["history"]] == want and got[0]["n_history"] == len(hist)
            hist = [*hist, n][-cap:]
        assert len(h.proc.hist.value or []) <= 2 * cap


def test_a_call_touches_its_own_turns_whatever_is_held():
    """Rows read and written by one call, with few and with many turns held."""
    sizes = []
    for held in (10, 5000):
        h = Handle(cap=20, expire_ms=10**9)
        for n in range(held):
            h.rows(n, (n, "user", "text"))
        h.log.clear()
        h.rows(held, (held, "user", "next"))
        h.mark(0)      # releases the first turn only
        sizes.append(sum(n for _, n in h.log))
    assert sizes[0] == sizes[1] < 15


def test_fronts_of_released_turns_go(monkeypatch):
    monkeypatch.setattr(ss, "SPARE_FRONTS", 8)
    h = Handle(cap=3, expire_ms=10**9)
    for n in range(500):
        h.rows(n, (n, "user", "x"))
        h.mark(n - 3)
    assert len(h.proc.fronts.value) <= 8 + 2 * 6


# --- the table form ----------------------------------------------------------------------------------------------------
def _tables(spark, **kw):
    return st.SessionTable(spark, tempfile.mkdtemp(prefix="parley-table-"), **kw)


def _batch(spark, rows, arrived):
    return spark.createDataFrame([(*r, arrived / 1000) for r in rows], "conv_id long, turn long, role string, text string, a double").select(
        "conv_id", "turn", "role", "text", F.timestamp_seconds("a").alias("arrived"))


def test_state_table_reads_touched_buckets_and_keeps_two_versions(spark):
    t = _tables(spark, cap=2, hold_ms=0, expire_ms=10**9, buckets=4, max_deltas=2)
    read = []
    real = t.state.read
    t.state.read = lambda buckets, before, newer_ms=None: (read.append(sorted(buckets)), real(buckets, before, newer_ms))[1]
    t.on_batch(_batch(spark, [(c, 0, "user", f"m{c}") for c in range(40)], 1000), 0)
    own = spark.range(7, 8).select(st.bucket_of("id", 4)).first()[0]
    read.clear()
    for b in range(1, 8):
        t.on_batch(_batch(spark, [(7, b, "user", f"m{b}")], 1000 + b * 1000), b)
    assert all(r == [own] for r in read)      # only the bucket of conversation 7
    rows = spark.read.parquet(t.state.root)
    assert rows.where(f"bucket <> {own}").select("b").distinct().collect() == [Row(b=0)]
    deltas = rows.where(f"bucket = {own} and full = 0 and b > 0").groupBy("b").count().collect()
    assert deltas and all(r["count"] == 1 for r in deltas)      # a delta has the touched conversation only
    whole = rows.where(f"bucket = {own} and full = 1").select("b").distinct().count()
    assert 1 <= whole <= 2 and 0 not in t.state.segments[own]
    state = {r.conv_id: r for r in t.state.read(range(4), 99).collect()}
    assert len(state) == 40 and state[7].last_turn == 7 and [m.text for m in state[7].hist] == ["m6", "m7"]
    assert state[8].last_turn == 0 and [m.text for m in state[8].hist] == ["m8"]
    again = st.StateTable(spark, t.state.root.rsplit("/", 1)[0], 4, 2)
    assert again.segments == t.state.segments      # found again from the folders


def test_state_writes_follow_touched_conversations_not_idle_ones(spark):
    """Ten times the idle conversations: the same rows are written, and the same share of buckets is read."""
    written = []
    for idle in (30, 300):
        t = _tables(spark, hold_ms=0, expire_ms=10**9, buckets=16)
        t.on_batch(_batch(spark, [(c, 0, "user", "x") for c in range(idle)], 1000), 0)
        read = []
        real = t.state.read
        t.state.read = lambda buckets, before, newer_ms=None, real=real, read=read: (read.append(len(buckets)), real(buckets, before, newer_ms))[1]
        t.on_batch(_batch(spark, [(c, 1, "user", "y") for c in (1, 2)], 2000), 1)
        written.append((spark.read.parquet(f"{t.state.root}/b=1").count(), max(read)))
    buckets = spark.range(1, 3).select(st.bucket_of("id", 16).alias("b")).distinct().count()
    assert written[0] == written[1] == (2, buckets)


def test_replayed_batch_gives_the_same(spark):
    t = _tables(spark, cap=3, hold_ms=0, expire_ms=10**9, buckets=2, max_deltas=1)
    batches = [[(c, b, "user", f"m{b}") for c in range(5)] for b in range(4)]
    for b, rows in enumerate(batches):
        t.on_batch(_batch(spark, rows, 1000 * (b + 1)), b)
        before = sorted(map(str, t.state.read(range(2), 99).collect()))
        t.on_batch(_batch(spark, rows, 1000 * (b + 1)), b)
        assert sorted(map(str, t.state.read(range(2), 99).collect())) == before
    out = spark.read.parquet(f"{t.base}/out").where("batch = 3")
    assert {(r.n_history, r.history_turns) for r in out.collect()} == {(3, "0,1,2")} and out.count() == 5


def test_arrivals_go_when_released(spark):
    t = _tables(spark, hold_ms=1500, expire_ms=10**9, buckets=2)
    for b in range(6):
        t.on_batch(_batch(spark, [(1, b, "user", "x")], 1000 * (b + 1)), b)
    folders = {r.b for r in spark.read.parquet(f"{t.base}/arrivals").select("b").distinct().collect()}
    assert 5 in folders and 0 not in folders and len(folders) <= 4


def test_exit_and_clear_cross_batches_in_the_table(spark):
    t = _tables(spark, cap=5, hold_ms=0, expire_ms=10**9, buckets=2)
    rows = [[(1, 0, "user", "a"), (2, 0, "user", "a"), (None, 0, "user", "n")], [(1, 1, "user", " /CLEAR "), (2, 1, "user", "/exit"), (2, 2, "user", "gone")],
            [(1, 2, "user", "b"), (2, 3, "user", "gone too"), (None, 1, "user", "m")]]
    for b, r in enumerate(rows):
        t.on_batch(_batch(spark, r, 1000 * (b + 1)), b)
    got = {(r.conv_id, r.turn): r.history_turns for r in spark.read.parquet(f"{t.base}/out").collect()}
    assert got == {(1, 0): "", (2, 0): "", (None, 0): "", (1, 2): "", (None, 1): "0"}
    state = {r.conv_id: r for r in t.state.read(range(2), 99).collect()}
    assert state[1].epoch == 1 and not state[1].exited and state[2].exited and state[2].last_turn == 3


def test_a_large_conversation_in_a_batch_is_cut_into_slices(spark):
    """The same output and state rows with one conversation in many slices and with all in one."""
    rnd = random.Random(2)
    kinds = ["user"] * 5 + ["assistant"] * 3 + ["/clear"] * 1 + ["/exit"] * 0 + [" "]
    rows = []
    for conv, n in ((1, 160), (2, 5), (None, 30), (3, 12), (4, 3)):
        for t in range(n):
            k = rnd.choice(kinds) if not (conv == 3 and t == 8) else "/exit"
            rows.append((conv, t, "assistant" if k == "assistant" else "user", k if k.strip() in ("/clear", "/exit", "") else f"m{t}"))
    state = spark.createDataFrame(
        [(1, 2, False, -1, [(-5, "user", "old"), (-4, "assistant", "older")], 1.0), (4, 0, True, -1, [(-3, "user", "x")], 1.0),
         (None, 1, False, 3, [(1, "user", "y")], 1.0)],
        "conv_id long, epoch long, exited boolean, last_turn long, hist array<struct<turn:long,role:string,text:string>>, s double").select(
        "conv_id", "epoch", "exited", "last_turn", "hist", F.timestamp_seconds("s").alias("seen"))
    batch = _batch(spark, rows, 5000)
    got = []
    for large in (True, False):
        out, touched = st.process_batch(batch, state, 4, large=large, slice_rows=9)
        got.append((sorted(map(str, out.collect())), sorted(map(str, touched.collect()))))
    assert got[0] == got[1] and len(got[0][0]) > 60 and len(got[0][1]) == 5
    by = {r.conv_id: r for r in touched.collect()}
    assert by[3].exited and by[4].exited and by[1].epoch > 2 and len(by[1].hist) <= 4 and by[None].last_turn == 29
    assert not any("conv_id=4," in r for r in got[0][0])
