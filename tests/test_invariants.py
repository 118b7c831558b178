"""Invariants and scale checks on plans (SURVEY §5.4)."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from parley.operators import curate, split
from parley.operators.numbering import number_rows, running_total, sliding_collect
from parley.plans import queries as Q


def test_split_is_partition_of_input(spark):
    f = Q._flagged_convs(spark, SF_MID)
    s = split.stratified_split(f, "flag", ["conv_id"], quota="A")
    ids = {r["conv_id"] for r in f.select("conv_id").collect()}
    rows = s.select("conv_id", "split").collect()
    assert len(rows) == len(ids) and {r["conv_id"] for r in rows} == ids
    counts = {(r["split"], r["flag"]): r["n"] for r in split.split_summary(s, "flag").collect()}
    assert counts[("eval", True)] == 5 and counts[("eval", False)] == 4 and \
        counts[("train", True)] + counts[("train", False)] == 91


def test_leak_safe_split_shares_no_content(spark):
    rows = Q._prep_rows(spark, SF_MID).withColumn("_group", split.content_key())
    safe = split.leak_safe_split(rows, "flag", order_col="conv_id")
    assert split.leak_report(safe, "_group").first()["n_leaked"] == 0
    compat = split.stratified_split(rows, "flag", ["conv_id", "replica"])
    assert compat.count() == rows.count()


def test_same_seed_same_result_any_partitioning(spark):
    base = Q._flagged_convs(spark, SF_MID)
    results = []
    for n in (1, 7, 64):
        s = split.stratified_split(base.repartition(n), "flag", ["conv_id"], quota="B")
        results.append(sorted((r["conv_id"], r["split"]) for r in s.collect()))
    assert results[0] == results[1] == results[2]
    ranks = []
    for n in (1, 7):
        r = curate.seeded_shuffle(base.select("conv_id").repartition(n), 42, ["conv_id"], rank_col="rank")
        ranks.append(sorted((x["conv_id"], x["rank"]) for x in r.collect()))
    assert ranks[0] == ranks[1]


def test_oversample_count_is_sum_of_multipliers(spark):
    n = Q._normalized(spark, SF_MID).where("outcome = 'ok'").withColumn(
        "mult", curate.multiplier_expr("file", Q.MULT_RULES))
    assert curate.oversample(n).count() == n.agg(F.sum("mult")).first()[0]


def test_mask_length_equals_token_length(spark):
    m = Q._masked(spark, SF_MID)
    assert m.where(F.size("labels") != F.size("tokens")).count() == 0


def test_number_rows_hot_key(spark):
    """One key holding most rows is still numbered exactly, across several partitions."""
    df = spark.range(20000).select(F.when(F.col("id") % 10 < 8, F.lit(0)).otherwise(F.col("id") % 7).alias("k"),
                                   F.col("id"))
    out = number_rows(df, ["id"], ["k"], name="rn", num_partitions=16)
    bad = out.groupBy("k").agg(F.count("*").alias("n"), F.min("rn").alias("lo"), F.max("rn").alias("hi"),
                               F.countDistinct("rn").alias("d")).where("lo != 1 OR hi != n OR d != n")
    assert bad.count() == 0
    # the hot key's rows are dealt to several slices of the range exchange
    ranged = df.repartitionByRange(16, "k", "id")
    assert ranged.where("k = 0").select(F.spark_partition_id().alias("p")).distinct().count() >= 8


def test_null_group_keys_are_numbered(spark):
    df = spark.range(100).select(F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("k"), F.col("id"))
    out = number_rows(df, ["id"], ["k"], name="rn")
    assert out.count() == 100 and out.where("k is null").agg(F.max("rn")).first()[0] == 25
    total = running_total(df.withColumn("x", F.lit(1)), {"t": "x"}, ["id"], ["k"])
    assert total.where("k is null").agg(F.max("t")).first()[0] == 25


def test_frame_must_fit_in_a_chunk(spark):
    df = spark.range(10).withColumn("k", F.lit(1))
    with pytest.raises(ValueError):
        sliding_collect(df, F.col("id"), 20, ["id"], ["k"], "h", chunk_rows=13)


def test_large_split_quota_equals_small_path(spark, monkeypatch):
    """Beyond the limit the same rows are taken by numbered ranges and a shuffle join."""
    df = spark.range(400).select(F.col("id"), (F.col("id") % 4 == 0).alias("flag"))
    small = split.stratified_split(df, "flag", ["id"], quota=lambda a, b: (a // 2, b // 2))
    want = sorted(r.id for r in small.where("split = 'eval'").collect())
    monkeypatch.setattr(split, "BROADCAST_EVAL_LIMIT", 20)
    large = split.stratified_split(df, "flag", ["id"], quota=lambda a, b: (a // 2, b // 2))
    assert sorted(r.id for r in large.where("split = 'eval'").collect()) == want and len(want) == 200
    assert large.count() == 400


def test_split_plan_is_bounded(spark):
    s = split.stratified_split(Q._flagged_convs(spark, SF_MID), "flag", ["conv_id"], quota="A")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    eval_keys = split._eval_keys(Q._flagged_convs(spark, SF_MID), "flag", [F.col("conv_id")], ["conv_id"], 5, 4)
    assert "TakeOrderedAndProject" in eval_keys._jdf.queryExecution().executedPlan().toString()


def test_normalize_parses_each_line_once(spark):
    df = Q.q_normalize_rows(spark, SF_MID)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the generator barrier keeps the 'ok' filter from inlining the parse into a Filter
    filters = [ln for ln in plan.splitlines() if "Filter" in ln and "parseJson" in ln]
    assert not filters


def test_retain_reduces_blocks_of_steps_first(spark):
    from parley.operators import runlog
    from parley.sources import fixtures as fx

    df = runlog.retain_checkpoints(fx.checkpoints(spark, SF_MID))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[run_id#\d+L?, _block#\d+L?\]", plan) and plan.count("row_number") == 1     # that of the log


def test_stream_equals_batch(spark):
    from parley.streaming.session_state import run_session_stream

    batch = sorted(tuple(r) for r in Q._history_q(20)(spark, SF_MID).collect())
    stream = sorted(tuple(r) for r in run_session_stream(spark, SF_MID).select(
        "conv_id", "turn", "n_history", "history_turns").collect())
    assert batch == stream


def test_running_total_and_sliding_collect_hot_key(spark):
    """Skew-safe primitives equal plain windows, with a hot group cut into many slices/chunks."""
    from pyspark.sql import Window

    from parley.operators.numbering import running_total, sliding_collect

    df = spark.range(3000).select(F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 3).alias("k"),
                                  F.col("id").alias("t"), (F.col("id") % 5 == 0).cast("long").alias("v"))
    rt = running_total(df, {"s": "v"}, ["t"], ["k"], num_partitions=13)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ref = df.withColumn("r", F.sum("v").over(w))
    assert rt.join(ref, ["k", "t"]).where("s != r").count() == 0 and rt.count() == 3000

    sc = sliding_collect(df, F.col("t"), 4, ["t"], ["k"], name="h", chunk_rows=7, num_partitions=11)
    w2 = Window.partitionBy("k").orderBy("t").rowsBetween(-4, -1)
    ref2 = df.withColumn("r", F.collect_list("t").over(w2))
    j = sc.join(ref2, ["k", "t"])
    assert sc.count() == 3000 and j.where("h != r").count() == 0


def test_number_rows_first_of(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id"), (F.col("id") * 10).alias("v"))
    keyed = number_rows(df, ["id"], ["k"], name="rn", num_partitions=7, first_of=["v"])
    assert keyed.where("first_v != k * 10").count() == 0
    glob = number_rows(df, ["id"], name="rn", num_partitions=7, first_of=["v"])
    assert glob.where("first_v != 0").count() == 0 and glob.agg(F.max("rn")).first()[0] == 500


def test_skew_safe_sessions_equal_plain_windows(spark):
    """One hot conversation with many /clear epochs and an /exit; tiny chunks force halos."""
    from parley.operators import chat_session as cs

    n = 2000
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 4 + 2).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.when(F.col("id") % 97 == 0, F.lit(" /clear")).when(F.col("id") == 1900, F.lit("/EXIT"))
        .when(F.col("id") % 89 == 0, F.lit("/history")).otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    safe_e = cs.session_epochs(rows, slice_rows=50)
    plain_e = cs.session_epochs(rows, skew_safe=False)
    key = ["conv_id", "turn", "kind", "epoch"]
    assert sorted(map(tuple, safe_e.select(*key).collect())) == sorted(map(tuple, plain_e.select(*key).collect()))
    cols = ["conv_id", "turn", "n_history", "history_turns"]
    assert safe_e.select("conv_id", "_slice").distinct().where("conv_id = 1").count() > 10
    safe_h = cs.session_history(safe_e, cap=5).select(*cols).collect()
    plain_h = cs.session_history(plain_e, cap=5, skew_safe=False).select(*cols).collect()
    assert sorted(map(tuple, safe_h)) == sorted(map(tuple, plain_h)) and len(safe_h) > 500
    hc = sorted(map(tuple, cs.history_count(safe_e).collect()))
    assert hc == sorted(map(tuple, cs.history_count(plain_e).collect())) and hc


COLS = ["conv_id", "turn", "n_history", "history_turns"]


def _both_streams(spark, landing, **kw):
    from parley.streaming.session_state import run_session_stream
    from parley.streaming.session_table import run_session_table_stream

    b = sorted(map(tuple, run_session_table_stream(spark, SF_MID, max_files_per_trigger=1, landing=landing,
                                                   **kw).collect()))
    # second: it lands the end row in the folder
    a = sorted(map(tuple, run_session_stream(spark, SF_MID, max_files_per_trigger=1, landing=landing, **kw).collect()))
    return a, b


def test_streams_carry_state_across_batches(spark):
    """Turns arrive in order, nothing is held: state must carry over from file to file."""
    import tempfile

    from parley.sources import fixtures as fx

    turns = fx.session_turns(spark, SF_MID)
    landing = tempfile.mkdtemp(prefix="parley-landing-")
    last = turns.agg(F.max("turn")).first()[0]
    cuts = [0, 2, 3, 5, last + 1]
    for lo, hi in zip(cuts, cuts[1:]):   # sequential writes: file order = turn order
        turns.where(F.col("turn").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(landing)
    batch = sorted(tuple(r) for r in Q._history_q(20)(spark, SF_MID).select(*COLS).collect())
    a, b = _both_streams(spark, landing, hold_ms=0)
    assert batch == a == b


def test_streams_equal_batch_on_shuffled_landing(spark):
    """Turns scattered over files, one file per micro-batch: held turns lose none."""
    import tempfile

    from parley.sources import fixtures as fx

    landing = tempfile.mkdtemp(prefix="parley-landing-") + "/turns"
    fx.session_turns(spark, SF_MID).repartition(5, F.xxhash64("conv_id", "turn")).write.parquet(landing)
    batch = sorted(tuple(r) for r in Q._history_q(20)(spark, SF_MID).select(*COLS).collect())
    a, b = _both_streams(spark, landing)
    assert batch == a == b


def test_state_table_reports_late_turns(spark):
    """Nothing is held, later turns come first: the earlier ones are late, and all are reported."""
    import tempfile

    from parley.sources import fixtures as fx
    from parley.streaming.session_table import run_session_table_stream

    turns = fx.session_turns(spark, SF_MID)
    landing = tempfile.mkdtemp(prefix="parley-landing-")
    for cond in ("turn >= 3", "turn < 3"):
        turns.where(cond).coalesce(1).write.mode("append").parquet(landing)
    late = run_session_table_stream(spark, SF_MID, max_files_per_trigger=1, landing=landing, hold_ms=0, late=True)
    want = turns.where("turn < 3").join(turns.where("turn >= 3").select("conv_id").distinct(), "conv_id")
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, want.select("conv_id", "turn").collect()))


def test_split_writes_keys_only(spark, monkeypatch):
    from parley.operators import split

    from parley.operators import bottom_k as bk

    seen = []
    real = split.materialize

    def spy(df, name):
        out = real(df, name)
        seen.append((name, out.columns, out.count()))
        return out

    monkeypatch.setattr(split, "materialize", spy)
    monkeypatch.setattr(bk, "materialize", spy)
    rows = spark.range(20_000).select("id", (F.col("id") % 5 == 0).alias("flag"), F.lit("x").alias("messages")).repartition(4)
    out = split.stratified_split(rows, "flag", ["id"])
    assert out.count() == 20_000 and out.columns == ["id", "flag", "messages", "split"]
    split.leak_safe_split(rows, "flag", group_col="id").count()
    wide = split.stratified_split(rows, "flag", ["id"], quota=lambda a, b: (a // 2, b // 3))     # no limits known
    assert wide.where("split = 'eval'").groupBy("flag").count().collect() and seen[2][:2] == ("split_keys", ["id", "flag"])
    top = 30 + 295 + 2
    for name, columns, n in seen[:2]:      # at most the limits per task, with two counts: never a key per row
        assert name == "bottom_k" and "messages" not in columns and n <= 8 * top


@pytest.mark.parametrize("n, flags", [(0, 0), (3, 3), (50, 2), (3000, 700)])
def test_bottom_k_split_equals_sorting(spark, n, flags):
    from parley.operators import split

    rows = spark.range(n).select("id", (F.col("id") < flags).alias("flag")).repartition(3)
    for quota in ("A", "B"):
        got = {(r.id, r.split) for r in split.stratified_split(rows, "flag", ["id"], quota=quota).collect()}
        k_id, k_other = split.QUOTAS[quota](flags, n - flags)
        order = sorted(range(n), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
        chosen = {i for i in [i for i in order if i < flags][:k_id] + [i for i in order if i >= flags][:k_other]}
        assert got == {(i, "eval" if i in chosen else "train") for i in range(n)}


def test_seeded_shuffle_runs_the_upstream_once(spark):
    """No sampling of ranges: the rows are made once, and the order is that of the hash."""
    from parley.operators import curate

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(1000).repartition(4).mapInArrow(count, "id long")
    want = sorted(range(1000), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest())
    assert [r.id for r in curate.seeded_shuffle(rows, 7, ["id"]).collect()] == want and made.value == 1000
    ranked = curate.seeded_shuffle(rows, 7, ["id"], rank_col="rank")
    assert [r.id for r in ranked.orderBy("rank").collect()] == want and made.value == 2000
    assert [r["rank"] for r in ranked.orderBy("rank").collect()] == list(range(1, 1001))
    assert curate.seeded_shuffle(rows.where("id < 0"), 7, ["id"], rank_col="rank").count() == 0


def test_number_in_groups(spark):
    """One large group in many slices, small ones, a null group: as a plain window."""
    from pyspark.sql import Window

    from parley.operators.segments import number_in_groups

    rows = spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, F.lit(0)).when(F.col("id") % 10 == 9, F.lit(None)).otherwise(F.col("id") % 3).alias("k"),
        (F.col("id") * 7919 % 1500).alias("t"), F.col("id").alias("u"))
    w = Window.partitionBy("k")
    want = rows.select("*", F.row_number().over(w.orderBy("t", "u")).alias("rn"), F.min("t").over(w).alias("first_t"),
                       F.count(F.lit(1)).over(w).alias("group_rows"))
    for limit in (50, 10_000):
        got = number_in_groups(rows, "k", "t", ["u"], slice_rows=limit)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_sessions_read_rows_through_one_exchange(spark):
    """The rows of a session go through one exchange, for epochs and history, and nothing is written."""
    from parley.operators import chat_session as cs
    from parley.sources import fixtures as fx

    h = cs.session_history(cs.session_epochs(fx.session_turns(spark, SF_MID))).select("conv_id", "turn", "history_turns")
    h.collect()
    final = h._jdf.queryExecution().executedPlan().toString()
    plan = final[: final.index("Initial Plan")] if "Initial Plan" in final else final
    assert plan.count("Window") >= 2 and "ExistingRDD" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*_slice", plan)) == 1
