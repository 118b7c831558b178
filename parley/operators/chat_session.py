"""Chat sessions as tables: commands, epochs, rolling history, prompts.

Input rows ``(conv_id, turn, role, text)``: user rows are what was typed,
assistant rows are the replies.  The reference keeps one in-memory list per
session; here every quantity is an ordered computation over one conversation.

``skew_safe=True`` (default) cuts large conversations into slices (``parley.operators.segments``), so one
conversation holding a large share of all turns is still spread over many tasks; epochs and history
are one scan over the slices, with one exchange of the rows.  ``skew_safe=False`` leaves every conversation whole
(fine when sessions are known to be small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.text import strip_ws
from parley.operators.segments import SLICE_ROWS, before_slice, carried_rows, slice_window, whole_groups, with_slices
from parley.operators.template import render_chat

# --- fixed values -----------------------------------------------------------
COMMANDS = {"/exit": "exit", "/clear": "clear", "/history": "history"}
HISTORY_CAP = 20
# -----------------------------------------------------------------------------


def command_kind(text_col: str = "text", role_col: str = "role") -> Column:
    """H1: 'response' (assistant row), 'skip' (blank, or neither user nor assistant), 'exit' / 'clear' / 'history',
    or 'message'."""
    t = F.lower(strip_ws(F.col(text_col)))
    k = F.when(F.col(role_col) == "assistant", F.lit("response")).when(
        (t == "") | (F.coalesce(F.col(role_col), F.lit("")) != "user"), F.lit("skip"))
    for cmd, kind in COMMANDS.items():
        k = k.when(t == cmd, F.lit(kind))
    return k.otherwise(F.lit("message"))


def session_epochs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", skew_safe: bool = True,
                   slice_rows: int = SLICE_ROWS, keep_exited: bool = False) -> DataFrame:
    """H2: ``kind`` and ``epoch`` (number of ``/clear`` so far); rows from the first ``/exit`` on are dropped.

    Texts are stripped on both sides.  ``msg_ord``: messages of the conversation so far, ``msg_clear``: those up to the
    epoch's ``/clear``.  ``_key``, ``_slice`` and ``_large`` tell ``session_history`` how the rows lie.  ``keep_exited`` keeps all
    rows, with ``_exits``, the number of ``/exit`` so far.
    """
    t = with_slices(turns, conv, turn, slice_rows) if skew_safe else whole_groups(turns, conv)
    kind = F.col("kind")
    t = t.withColumn("text", strip_ws(F.col("text"))).withColumn("kind", command_kind())
    t = t.withColumns({"_c": (kind == "clear").cast("long"), "_x": (kind == "exit").cast("long"),
                       "_m": kind.isin("message", "response").cast("long")})
    so_far = slice_window(turn).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def scanned(rows: DataFrame) -> DataFrame:
        """Running values of each slice on its own."""
        r = rows.select("*", *[F.sum(c).over(so_far).alias(o) for o, c in
                               (("epoch", "_c"), ("_exits", "_x"), ("msg_ord", "_m"))])
        return r.select("*", F.max(F.when(kind == "clear", F.col("msg_ord"))).over(so_far).alias("msg_clear"))

    out = scanned(t)
    if skew_safe:
        borders = scanned(t.where("_large").select("_key", "_slice", turn, "kind", "_c", "_x", "_m")).groupBy(
            "_key", "_slice").agg(F.sum("_c").alias("c"), F.sum("_x").alias("x"), F.sum("_m").alias("m"),
                                  F.max("msg_clear").alias("at"))
        sums = before_slice(borders, {"_c0": "c", "_x0": "x", "_m0": "m"})
        sums = sums.join(borders.select("_key", "_slice", "at"), ["_key", "_slice"])
        before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("_key", "_slice", "_c0", "_x0", "_m0", F.max(F.col("_m0") + F.col("at")).over(before).alias("_at0"))
        out = out.join(F.broadcast(sums), ["_key", "_slice"], "left")
        zero = F.lit(0)
        out = out.withColumns({
            "msg_clear": F.coalesce(F.col("msg_clear") + F.coalesce("_m0", zero), F.col("_at0"), zero),
            "epoch": F.col("epoch") + F.coalesce("_c0", zero), "_exits": F.col("_exits") + F.coalesce("_x0", zero),
            "msg_ord": F.col("msg_ord") + F.coalesce("_m0", zero)})
    else:
        out = out.withColumn("msg_clear", F.coalesce("msg_clear", F.lit(0)))
    names = [*turns.columns, "kind", F.col("epoch").cast("bigint").alias("epoch"), "msg_ord", "msg_clear", "_key", "_slice", "_large"]
    return out.select(*names, "_exits") if keep_exited else out.where(F.col("_exits") == 0).select(*names)


def session_history(epochs: DataFrame, cap: int = HISTORY_CAP, conv: str = "conv_id", turn: str = "turn",
                    skew_safe: bool = True) -> DataFrame:
    """H3: for every typed message, the last ``cap`` messages of its epoch before it.

    Command and blank rows are removed first, so they never enter history.
    Adds ``history`` (array of ``(turn, role, text)``), ``n_history`` and
    ``history_turns`` ('t1,t2,...').  The frame runs over the slices of ``session_epochs``, in their exchange and sort; a slice
    of a large conversation begins with the last ``cap`` messages of the slices before it.
    """
    if "_slice" not in epochs.columns:
        epochs = whole_groups(epochs, conv)
    msgs = epochs.where(F.col("kind").isin("message", "response")).withColumn(
        "_item", F.struct(F.col(turn).alias("turn"), "role", "text", "epoch"))
    h = msgs.withColumn("_h", F.collect_list("_item").over(slice_window(turn).rowsBetween(-cap, -1)))
    h = h.where(F.col("kind") == "message")
    if skew_safe:
        carried = carried_rows(msgs.where("_large"), turn, "_item", cap, "_carried")
        h = h.join(carried, ["_key", "_slice"], "left")
        h = h.withColumn("_h", F.when(F.col("_carried").isNull(), F.col("_h")).otherwise(F.concat("_carried", "_h")))
    # epochs follow each other in turn order: the last messages of this epoch are the last of all, as far as they are of it
    own = F.filter("_h", lambda x: x["epoch"] == F.col("epoch"))
    own = F.slice(own, F.greatest(F.size(own) - F.lit(cap), F.lit(0)) + 1, F.lit(cap))
    h = h.withColumn("history", F.transform(own, lambda x: F.struct(
        x["turn"].alias(turn), x["role"].alias("role"), x["text"].alias("text"))))
    return h.drop("_h", "_item", "_carried", "_key", "_slice", "_large").withColumn(
        "n_history", F.size("history").cast("bigint")).withColumn(
        "history_turns", F.array_join(F.transform("history", lambda x: x[turn].cast("string")), ","))


def history_count(epochs: DataFrame, cap: int = HISTORY_CAP, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """H5: at each ``/history`` command, ``least(cap, messages so far in the epoch)``: two running values of the scan."""
    so_far = (F.col("msg_ord") - F.col("msg_clear")).cast("bigint")
    return epochs.where(F.col("kind") == "history").select(
        conv, turn, F.least(F.lit(cap).cast("bigint"), so_far).alias("n_history"))


def session_prompt(history: DataFrame, system_prompt: str | None) -> DataFrame:
    """H4: system + history + this message, rendered with the open assistant turn."""
    hist = F.transform("history", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    user = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    parts: list[Column] = []
    if system_prompt:
        parts.append(F.array(F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content"))))
    msgs = F.concat(*parts, hist, user)
    return history.withColumn("prompt", render_chat(msgs, add_generation_prompt=True))


def join_chunks(chunks: DataFrame, keys: Sequence[str], seq: str = "seq", chunk: str = "chunk",
                sep: str = "") -> DataFrame:
    """H6: concatenate streamed pieces in ``seq`` order, then strip.

    One group per generated message (bounded by that message's length).
    """
    parts = F.array_sort(F.collect_list(F.struct(seq, chunk)))
    return chunks.groupBy(*keys).agg(
        strip_ws(F.array_join(F.transform(parts, lambda x: x[chunk]), sep)).alias("text"))
