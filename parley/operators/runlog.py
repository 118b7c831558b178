"""Trainer run logs and checkpoints as tables.

All per-run results are plain aggregates (``max_by`` / ``min_by``) with
map-side partial aggregation, so a run holding most of the log does not land
whole in one task.  ``retain`` keeps the newest and the best of blocks of steps, then of runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECKPOINT_RE = "checkpoint-(\\d+)$"


def heartbeat(log: DataFrame, every: int, run_col: str = "run_id") -> DataFrame:
    """M1: at steps divisible by ``every``: ``rate = step/max(elapsed,1)``, ``eta = (max-step)/max(rate,0.001)``."""
    s = F.col("step")
    rate = s.cast("double") / F.greatest(F.col("elapsed"), F.lit(1.0))
    return (log.where((s > 0) & (s % every == 0))
            .select(run_col, "step", "max_steps", rate.alias("rate"))
            .select(run_col, "step", "rate",
                    ((F.col("max_steps") - F.col("step")).cast("double")
                     / F.greatest(F.col("rate"), F.lit(0.001))).alias("eta")))


def peaks(log: DataFrame, every: int, value_col: str = "eval_loss", run_col: str = "run_id") -> DataFrame:
    """M2: per log interval ``bucket = ceil(step/every)``: peak and last value, both unrounded (display rounds)."""
    b = F.ceil(F.col("step") / F.lit(every)).cast("bigint")
    return log.groupBy(run_col, b.alias("bucket")).agg(
        F.max(value_col).alias("peak"), F.max_by(value_col, "step").alias("last_value"))


def checkpoint_step(path_col: str = "path"):
    """Numeric suffix of ``.../checkpoint-<n>``; NULL when absent or not a number."""
    num = F.regexp_extract(F.col(path_col), CHECKPOINT_RE, 1)
    return F.when(num != "", num).try_cast("bigint")


def latest_checkpoint(ckpts: DataFrame, run_col: str = "run_id", path_col: str = "path") -> DataFrame:
    """M3: newest checkpoint by *numeric* suffix; names without a number are left out."""
    st = checkpoint_step(path_col)
    return (ckpts.select(run_col, path_col, st.alias("_step")).where(F.col("_step").isNotNull())
            .groupBy(run_col).agg(F.max_by(path_col, "_step").alias(path_col)))


def best_checkpoint(ckpts: DataFrame, run_col: str = "run_id", path_col: str = "path",
                    loss_col: str = "eval_loss") -> DataFrame:
    """M4: lowest eval loss per run; ties go to the lowest step.  Checkpoints without a loss are no candidates."""
    st = checkpoint_step(path_col)
    c = ckpts.select(run_col, path_col, loss_col, st.alias("_step")).where(
        F.col("_step").isNotNull() & F.col(loss_col).isNotNull())
    return c.groupBy(run_col).agg(
        F.min_by(F.struct(path_col, loss_col), F.struct(loss_col, "_step")).alias("_b")).select(
        run_col, F.col(f"_b.{path_col}").alias(path_col), F.col(f"_b.{loss_col}").alias(loss_col))


def retain_checkpoints(ckpts: DataFrame, keep_last: int = 2, run_col: str = "run_id", path_col: str = "path",
                       loss_col: str = "eval_loss", block: int = 65_536) -> DataFrame:
    """M4: the newest ``keep_last`` checkpoints plus the best one, per run, from one pass over the log.

    Two rounds of one mergeable aggregate, the newest ``keep_last`` and the best of a set: of every block of ``block`` steps,
    then of every run's blocks.  A group collects at most ``block`` steps, then the few rows that each block leaves.
    """
    st = checkpoint_step(path_col)
    row = F.struct(F.col("_step"), F.col(loss_col).alias("loss"), F.col(path_col).alias("path"))
    rows = ckpts.select(run_col, path_col, loss_col, st.alias("_step")).where(F.col("_step").isNotNull())

    def kept(of: DataFrame, by: list[str]) -> DataFrame:
        rows = F.col("_rows")
        newest = F.slice(F.reverse(F.array_sort(rows)), 1, keep_last)
        some = F.filter(rows, lambda r: r["loss"].isNotNull())
        best = F.transform(some, lambda r: F.struct(r["loss"].alias("loss"), r["_step"].alias("_step"), r["path"].alias("path")))
        best = F.transform(F.slice(F.array_sort(best), 1, 1), lambda r: F.struct(
            r["_step"].alias("_step"), r["loss"].alias("loss"), r["path"].alias("path")))
        return of.groupBy(*by).agg(F.collect_list("_row").alias("_rows")).withColumn("_rows", F.array_union(newest, best))

    level = F.floor(F.col("_step") / F.lit(block)).alias("_block")
    blocks = kept(rows.select(run_col, row.alias("_row"), level), [run_col, "_block"])
    runs = kept(blocks.select(run_col, F.explode("_rows").alias("_row")), [run_col])
    paths = F.array_distinct(F.transform("_rows", lambda r: r["path"]))
    return runs.select(run_col, F.explode(paths).alias(path_col))
