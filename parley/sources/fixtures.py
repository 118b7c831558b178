"""Inputs derived in Spark from the given tables (FIXTURES.md §2).

The reference reads JSONL chat files, a file listing, trainer logs and chat
turns.  The test data has none of these, so each is derived here, lazily and
row-for-row from a given table, so its size grows with the table:

* ``raw_lines``   — one JSONL line per conversation (three row shapes, defects)
* ``manifest``    — file listing from ``documents``
* ``run_log`` / ``checkpoints`` — trainer log from ``events``
* ``responses``   — assistant turns to score
* ``session_turns`` — chat input with commands
* ``chunks``      — generated text split into streamed pieces

Every rule is a function of the row's own id so an SQL oracle can state the
expected answer straight from the table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.segments import number_in_groups
from parley.session import input_key, work_dir

# --- fixed values (fixture rules, FIXTURES.md §2) ----------------------------
IDENTITY_FILE = "team_identity.jsonl"
SPEAKER_NAMES = {"user": "Human", "assistant": "GPT", "system": "system"}
MULTIPLIER_RULES = [("identity", 2)]           # (keyword, multiplier) in priority order
KEYWORDS = ["ung"]
SEED = 42
RUN_STEP_BLOCK = 100          # a run is planned in whole blocks of steps
HEARTBEAT_EVERY = 20
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _role_text(turns: Column, role: str) -> Column:
    """All texts of a role in turn order, one blank line between them; empty if none."""
    return F.array_join(F.transform(F.filter(turns, lambda x: x["role"] == role), lambda x: x["text"]), "\n\n")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(file, value)``: one JSONL line per conversation (FIXTURES §2.1)."""
    conv = table(spark, sf_dir, "conversations")
    # One group per conversation: bounded by a conversation's length.
    per = conv.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    cid = F.col("conv_id")
    short = (cid % 11) == 7
    msgs = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    msgs = F.when(short, F.slice(msgs, 1, 1)).otherwise(msgs)
    names = F.create_map(*[F.lit(x) for kv in SPEAKER_NAMES.items() for x in kv])
    conv_items = F.transform("t", lambda x: F.struct(F.element_at(names, x["role"]).alias("from"),
                                                     x["text"].alias("value")))
    conv_items = F.when(short, F.slice(conv_items, 1, 1)).otherwise(conv_items)
    response = F.when(short, F.lit("")).otherwise(_role_text(F.col("t"), "assistant"))
    shape0 = F.to_json(F.struct(cid.alias("conv_id"), msgs.alias("messages")))
    shape1 = F.to_json(F.struct(cid.alias("conv_id"), conv_items.alias("conversation")))
    shape2 = F.to_json(F.struct(cid.alias("conv_id"),
                                _role_text(F.col("t"), "user").alias("instruction"),
                                response.alias("response"),
                                F.nullif(_role_text(F.col("t"), "system"), F.lit("")).alias("system")))
    value = (F.when((cid % 11) == 3, F.concat(F.lit('{bad "conv_id":'), cid.cast("string"), F.lit(',"messages":[}')))
             .when((cid % 3) == 0, shape0)
             .when((cid % 3) == 1, shape1)
             .otherwise(shape2))
    file = F.when((cid % 5) == 0, F.lit(IDENTITY_FILE)).otherwise(
        F.concat(F.lit("general_"), (cid % 4).cast("string"), F.lit(".jsonl")))
    return per.select(file.alias("file"), value.alias("value"))


def line_conv_id(value: Column) -> Column:
    """The fixture's ``conv_id`` read from a raw line, also for broken JSON."""
    return F.regexp_extract(value, '"conv_id":(\\d+)', 1).cast("bigint")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, length, doc_id)`` file listing derived from ``documents`` (FIXTURES §2.2)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    ids = F.col("doc_id").cast("string")
    k = F.col("doc_id") % 6
    name = (F.when(k == 0, F.concat(ids, F.lit(".jsonl")))
            .when(k == 1, F.concat(ids, F.lit(".md")))
            .when(k == 2, F.lit("optimizer.pt"))
            .when(k == 3, F.lit("x.tmp"))
            .when(k == 4, F.concat(F.lit("checkpoint-"), ids, F.lit("/adapter.bin")))
            .otherwise(F.concat(ids, F.lit(".JSONL"))))
    path = F.concat(F.lit("runs/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"), name)
    return d.select(path.alias("path"), F.col("n_chars").alias("length"), "doc_id")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run_id, step, ts, elapsed, eval_loss, max_steps)`` from ``events``.

    ``step`` numbers a run's events by ``(ts, event_id)`` with the skew-safe
    numbering (a run may hold a large share of all events).  ``max_steps`` is
    the run's own event count rounded up to whole blocks of steps.
    """
    ev = table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 10 != 3, F.col("user_id")).alias("run_id"), "event_id", "ts",
        F.when(F.col("event_id") % 40 != 7, F.col("value")).alias("eval_loss"))
    numbered = number_in_groups(ev, "run_id", "ts", ["event_id"], name="step")
    blocks = F.ceil(F.col("group_rows") / F.lit(RUN_STEP_BLOCK)) * RUN_STEP_BLOCK
    numbered = numbered.withColumn("max_steps", blocks.cast("bigint"))
    # wall-clock difference of two local timestamps: no session time zone involved
    micros = F.expr("timestampdiff(MICROSECOND, first_ts, ts)")
    out = numbered.select(
        "run_id", F.col("step").cast("bigint").alias("step"), "ts",
        (micros / F.lit(1_000_000.0)).alias("elapsed"),
        "eval_loss", "max_steps")
    return out


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run_id, path, eval_loss)``: ``run-<run>/checkpoint-<step*10>`` per logged step."""
    rl = run_log(spark, sf_dir)
    return rl.select("run_id", F.concat(F.lit("run-"), F.coalesce(F.col("run_id").cast("string"), F.lit("none")), F.lit("/checkpoint-"),
                                        (F.col("step") * 10).cast("string")).alias("path"), "eval_loss")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, turn, step, text)``: assistant turns, step = turn."""
    conv = table(spark, sf_dir, "conversations")
    return conv.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.col("turn").alias("step"), "text")


def session_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, turn, role, text)`` chat input with commands injected (FIXTURES §2.2)."""
    conv = table(spark, sf_dir, "conversations").where(F.col("role").isin("user", "assistant"))
    cid, turn, user = F.col("conv_id"), F.col("turn"), F.col("role") == "user"
    text = (F.when(user & (cid % 4 == 1) & (turn == 4), F.lit(" /CLEAR "))
            .when(user & (cid % 4 == 2) & (turn == 2), F.lit("/History"))
            .when(user & (cid % 4 == 3) & (turn == 6), F.lit(" /exit"))
            .when(user & (cid % 5 == 0), F.concat(F.lit("\u00a0 "), F.col("text"), F.lit("\t ")))
            .when(~user & (cid % 5 == 1), F.concat(F.lit("\n"), F.col("text"), F.lit(" \n")))
            .otherwise(F.col("text")))
    return conv.select("conv_id", "turn", "role", text.alias("text"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, turn, seq, chunk)``: each text split on spaces."""
    conv = table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("seq", "chunk"))


FOLDER_CONVS = 64


def conversation_files(spark: SparkSession, sf_dir: str) -> str:
    """Text files, one per ``convs=<conv_id div 64>``, a line per turn; one empty file in ``empty`` and one in ``_hidden``."""
    root = work_dir(spark, "conversation_files", input_key(sf_dir), uuid.uuid4().hex[:12])
    conv = table(spark, sf_dir, "conversations").select(
        F.expr(f"conv_id div {FOLDER_CONVS}").alias("convs"), F.coalesce("text", F.lit("")).alias("value"))
    conv.repartition("convs").write.partitionBy("convs").text(root)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for name in ("empty", "_hidden"):
        path = hadoop.Path(f"{root}/{name}/none.txt")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()
    return root
