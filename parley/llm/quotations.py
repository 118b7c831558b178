"""Quotation linking: reply-ordered conversations without quotes, with DataFrame operations only.

* A line's quote level is the number of ``>`` in its prefix (up to three blanks,
  then ``>`` signs with at most one blank or tab after each).  Level 0 is the
  message's own text.  An own line that ends with ``wrote:`` right above a
  quoted line introduces the quote and goes with it.
* Each quoted line that is not blank is a passage: blanks are collapsed, the
  text trimmed and lower-cased, and hashed (MD5) together with its conversation.
* Own lines are hashed the same way; the original of a passage is the message
  with the smallest turn that has it as an own line.  Both sides are summed in
  tasks first, so one conversation or line with a third of all rows is a few
  rows per task; the join splits the quoting side where it is skewed.
* A message replies to the original that most of its level-1 passages link to
  (ties: the latest), if that is an earlier turn.  Following replies (by
  doubling joins over the linked messages) gives each its thread's first turn
  and its depth; a message without a linked quote starts a thread.
* The result is sorted by conversation, thread, depth and turn, so a reply
  stands after what it replies to.

Defined results: null text is empty; null conv_id is a conversation of its own;
a message with null turn links to nothing and is no original; rows that repeat
a (conv_id, turn) are parts of one message for linking and keep their own rows;
extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stash, text_of

PREFIX = "^[ \\t]{0,3}(?:>[ \\t]?)+"
BLANKS = "[ \\t\\r\\n\\f\\x0B]+"
INTRO = "(?i)wrote:[ \\t\\r]*$"


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, f"^{BLANKS}|{BLANKS}$", "")


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, PREFIX, 0), "[^>]", ""))


def parse(messages: DataFrame) -> DataFrame:
    """Adds ``lines``: array of (level, body, intro) of each message's lines."""
    lines = F.split(text_of("text"), "\r?\n")
    out = messages.withColumn("_lines", F.transform(lines, lambda x: F.struct(
        _level(x).alias("level"), F.regexp_replace(x, PREFIX, "").alias("body"))))
    after = lambda i: F.coalesce(F.get("_lines", i + 1)["level"], F.lit(0)) > 0
    return out.withColumn("lines", F.transform("_lines", lambda x, i: F.struct(
        x["level"].alias("level"), x["body"].alias("body"),
        ((x["level"] == 0) & x["body"].rlike(INTRO) & after(i)).alias("intro")))).drop("_lines")


def normalised(body: Column) -> Column:
    return F.lower(_trim(F.regexp_replace(body, BLANKS, " ")))


def link_quotes(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, reply_to, thread, depth, n_quoted, n_linked, text, formatted."""
    base = messages.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
                           text_of("text").alias("text"))
    parsed = parse(base)
    own = F.filter("lines", lambda x: (x["level"] == 0) & ~x["intro"])
    quoted = F.filter("lines", lambda x: (x["level"] > 0) & (F.length(_trim(x["body"])) > 0))
    rows = stash(parsed.select(
        "conv_id", "turn", "role", F.size(quoted).cast("long").alias("n_quoted"),
        _trim(F.array_join(F.transform(own, lambda x: x["body"]), "\n")).alias("text"),
        F.transform(quoted, lambda x: F.struct(x["level"].alias("level"), F.md5(normalised(x["body"])).alias("h"))).alias("q")),
        "quotes")
    passages = rows.where("n_quoted > 0 and turn is not null").select("conv_id", "turn", F.explode("q").alias("q"))
    passages = passages.groupBy("conv_id", "turn", F.col("q.level").alias("level"), F.col("q.h").alias("h")).agg(
        F.count(F.lit(1)).alias("n"))
    line = F.explode(F.split("text", "\r?\n"))
    lines = rows.where("turn is not null").select("conv_id", "turn", line.alias("line")).select(
        F.col("conv_id").alias("c"), "turn", normalised(F.col("line")).alias("line")).where("line <> ''")
    origin = lines.groupBy("c", F.md5("line").alias("o")).agg(F.min("turn").alias("origin"))
    linked = passages.join(origin, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h") == F.col("o")))
    linked = stash(linked.where("origin < turn").groupBy("conv_id", "turn", "level", "origin").agg(F.sum("n").alias("n")),
                   "quotes-links")
    replies = linked.groupBy("conv_id", "turn").agg(
        F.sum("n").alias("n_linked"),
        F.max(F.when(F.col("level") == 1, F.struct("n", "origin")))["origin"].alias("reply_to"))
    # thread and depth: (root, depth) doubles its reach per round, over the linked messages only
    reach = stash(replies.where("reply_to is not null").select(
        "conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).cast("long").alias("depth")), "quotes-reach")
    while True:
        up = reach.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("root").alias("r"),
                          F.col("depth").alias("d"))
        step = reach.join(up, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("root") == F.col("t")), "left")
        more = step.select("conv_id", "turn", F.coalesce("r", "root").alias("root"),
                           (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth"), F.col("r").isNotNull().alias("moved"))
        reach = stash(more, "quotes-reach")
        if not reach.where("moved").head(1):
            break
        reach = reach.drop("moved")
    threads = replies.join(reach.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "root", "depth"),
                           F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t")), "left")
    threads = threads.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "n_linked", "reply_to", "root", "depth")
    out = rows.join(threads, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t")), "left")
    out = out.select("conv_id", "turn", "role", "reply_to", F.coalesce("root", "turn").alias("thread"),
                     F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "n_quoted",
                     F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "text",
                     F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n")).alias("formatted"))
    return out.orderBy("conv_id", "thread", "depth", "turn")
