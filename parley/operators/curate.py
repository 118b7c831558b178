"""Curation: multipliers, oversampling, keyword coverage, guards, shuffle.

SURVEY J1, J2, U1, O1, O2, K1, K2, A1–A3, G1, G2, L1, L2.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from parley.functions.text import any_keyword, joined_contents
from parley.operators.numbering import range_partitions
from parley.session import work_dir

# --- fixed values -----------------------------------------------------------
SOFT_GUARD_MIN_PCT = 10.0           # data prep warns below this share
TRAIN_GUARD_MIN_PCT = 5.0           # training warns below this share
BAND_GUARD = (10.0, 18.0)           # hard stop outside [min, max]
PREP_BATCH = 16                     # rows per optimiser step in the prep summary
PREP_EPOCHS = 2
PREP_ITERS_PER_SEC = 0.15           # assumed speed used for the time estimate
# -----------------------------------------------------------------------------


class GuardError(RuntimeError):
    """Raised by an enforced guard before any sink runs."""


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_stem(file_col) -> Column:
    """Lower-cased base name with ``.jsonl`` removed (the multiplier match text)."""
    base = F.regexp_extract(_col(file_col), "([^/]*)$", 1)
    return F.lower(F.replace(base, F.lit(".jsonl"), F.lit("")))


def multiplier_expr(file_col, rules: Sequence[tuple[str, int]], default: int = 1) -> Column:
    """J1 as an expression: first rule (in order) whose keyword occurs in the stem.

    Rules are a caller parameter, so this is a CASE over literals: no join
    and no shuffle for any number of rows.
    """
    stem = file_stem(file_col)
    expr = None
    for kw, mult in rules:
        cond = F.instr(stem, F.lit(kw.lower())) > 0
        expr = F.when(cond, F.lit(int(mult))) if expr is None else expr.when(cond, F.lit(int(mult)))
    return F.lit(int(default)) if expr is None else expr.otherwise(F.lit(int(default)))


def file_multiplier(files: DataFrame, rules: Sequence[tuple[str, int]], file_col: str = "file",
                    default: int = 1) -> DataFrame:
    """J1 over a file table: ``(file, mult)``, one row per input row for any number of rules."""
    return files.select(file_col, multiplier_expr(file_col, rules, default).alias("mult"))


def category_multiplier(category_col, mults: dict[str, int], default: int = 1) -> Column:
    """Category → multiplier."""
    c = _col(category_col)
    expr = None
    for cat, m in mults.items():
        expr = F.when(c == cat, F.lit(int(m))) if expr is None else expr.when(c == cat, F.lit(int(m)))
    return F.lit(int(default)) if expr is None else expr.otherwise(F.lit(int(default)))


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """Append every file's rows (bag semantics, by column name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def oversample(df: DataFrame, mult_col: str = "mult", replica_col: str = "replica") -> DataFrame:
    """O1: one copy per ``1..mult`` (mult ≤ 1 keeps the row once).

    Copies are made in place (a generator, no shuffle); apply it as late as
    possible since it multiplies every downstream byte.
    """
    return df.select("*", F.explode(F.sequence(F.lit(1), F.greatest(_col(mult_col).cast("int"), F.lit(1))))
                     .alias(replica_col))


def shuffle_key(seed: int | str, *key_cols) -> Column:
    """md5 of ``'<seed>:<key>[:<key2>...]'`` — same value in Spark and DuckDB."""
    parts = [F.lit(str(seed))]
    for c in key_cols:
        parts += [F.lit(":"), _col(c).cast("string")]
    return F.md5(F.concat(*parts))


def seeded_shuffle(df: DataFrame, seed: int, key_cols: Sequence[str], rank_col: str | None = None) -> DataFrame:
    """O2: reproducible shuffle = sort by the seeded hash (key breaks ties).

    The hash is uniform, so its leading 32 bits cut the rows into even ranges: no sampling run of the upstream, which is
    evaluated once.  Partition ``i`` holds the ``i``-th range, sorted.  With ``rank_col`` (1-based position) the sorted rows are
    written to the checkpoint folder once, and the ranges' counts (one row each) are added up.
    """
    n = range_partitions(df)
    keyed = df.withColumn("_h", shuffle_key(seed, *key_cols))
    slot = F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long") * n / F.lit(1 << 32)).cast("int")
    out = keyed.repartitionById(n, F.coalesce(slot, F.lit(0))).sortWithinPartitions("_h", *key_cols)
    if not rank_col:
        return out.drop("_h")
    work_dir(df.sparkSession)   # make sure a checkpoint dir is set
    tagged = out.drop("_h").select("*", F.spark_partition_id().alias("_pid"),
                                   F.monotonically_increasing_id().alias("_mid")).checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_pid", F.coalesce(before, F.lit(0)).alias("_off"))
    place = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return tagged.join(F.broadcast(offsets), "_pid").withColumn(rank_col, F.col("_off") + place + 1).drop("_pid", "_mid", "_off")


def keyword_flag(df: DataFrame, keywords: Sequence[str], *, messages_col: str = "messages",
                 case_sensitive: bool = True, word_boundary: bool = False, out: str = "flag") -> DataFrame:
    """K1/K2: ``flag`` = any keyword in the contents joined by one space."""
    text = joined_contents(messages_col, " ")
    return df.withColumn(out, any_keyword(text, keywords, case_sensitive, word_boundary))


def keyword_coverage(df: DataFrame, flag_col: str = "flag") -> DataFrame:
    """A2/A3: one row ``n_key, n_total, pct`` (pct = 0.0 over zero rows, D15)."""
    agg = df.agg(F.count_if(_col(flag_col)).alias("n_key"), F.count(F.lit(1)).alias("n_total"))
    return agg.select("n_key", "n_total", pct_expr("n_key", "n_total").alias("pct"))


def pct_expr(n_key, n_total) -> Column:
    return F.when(_col(n_total) == 0, F.lit(0.0)).otherwise(
        F.lit(100.0) * _col(n_key).cast("double") / _col(n_total).cast("double"))


def soft_verdict(pct, min_pct: float = SOFT_GUARD_MIN_PCT) -> Column:
    """G1 for a coverage row: 'warn' below ``min_pct`` else 'ok'."""
    return F.when(_col(pct) < F.lit(float(min_pct)), F.lit("warn")).otherwise(F.lit("ok"))


def soft_guard(coverage: DataFrame, min_pct: float = SOFT_GUARD_MIN_PCT) -> DataFrame:
    """G1: ``(pct, verdict)``."""
    return coverage.select("pct", soft_verdict("pct", min_pct).alias("verdict"))


def band_guard(coverage: DataFrame, band: tuple[float, float] = BAND_GUARD, enforce: bool = False) -> DataFrame:
    """G2: 'raise' below, 'lower' above, 'ok' inside (edges allowed).

    ``enforce=True`` evaluates the one-row verdict now and raises
    ``GuardError`` when it is not 'ok', so a sink downstream never runs.
    """
    lo, hi = band
    out = coverage.select("pct", F.when(F.col("pct") < F.lit(float(lo)), F.lit("raise"))
                          .when(F.col("pct") > F.lit(float(hi)), F.lit("lower"))
                          .otherwise(F.lit("ok")).alias("verdict"))
    if enforce:
        row = out.first()   # one-row aggregate
        if row is None or row["verdict"] != "ok":
            raise GuardError(f"keyword share {None if row is None else row['pct']} outside {band}: "
                             f"{None if row is None else row['verdict']} the multiplier")
    return out


MANIFEST = "_published.json"


def guarded_write(rows: DataFrame, path: str, write: Callable[[DataFrame, str], str], seed: int,
                  key_cols: Sequence[str], flag_col: str = "flag",
                  band: tuple[float, float] = BAND_GUARD) -> str:
    """G2 with S8: write, audit, publish, in one evaluation of ``rows``; returns the published folder.

    The shuffled rows are written to a staging folder under ``path`` that readers of ``path`` do not see, and the
    share is counted by the tasks that write (each partition once, whatever is retried: the count is in the job's
    last stage).  Within ``band`` a manifest naming the folder is put in place, in one small write: ``published``
    reads by it.  Else the staging folder is removed and ``GuardError`` raised.  After a crash there is no new manifest: readers
    find the earlier version, or nothing.
    """
    spark = rows.sparkSession
    staging = f"{path.rstrip('/')}/_data-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    counted = seeded_shuffle(rows, seed, key_cols).observe(
        seen, F.count_if(_col(flag_col)).alias("n_key"), F.count(F.lit(1)).alias("n_total"))
    write(counted, staging)
    got = seen.get
    pct = 100.0 * got["n_key"] / got["n_total"] if got["n_total"] else 0.0
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    lo, hi = band
    if not lo <= pct <= hi:
        fs.delete(hadoop.Path(staging), True)
        if not fs.listStatus(root):
            fs.delete(root, False)
        raise GuardError(f"keyword share {pct} outside {band}: {'raise' if pct < lo else 'lower'} the multiplier")
    record = json.dumps({"folder": staging.rsplit("/", 1)[1], "n_key": got["n_key"], "n_total": got["n_total"]})
    fresh = hadoop.Path(f"{staging}.json")
    out = fs.create(fresh, True)
    out.write(bytearray(record, "utf-8"))
    out.close()
    target = hadoop.Path(f"{path.rstrip('/')}/{MANIFEST}")
    fs.delete(target, False)
    fs.rename(fresh, target)
    return staging


def published(spark: SparkSession, path: str) -> str:
    """The folder that the manifest under ``path`` names; ``FileNotFoundError`` where nothing is published."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        raise FileNotFoundError(f"nothing is published under {path}")
    stream = fs.open(target)
    record = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return f"{path.rstrip('/')}/{json.loads(record)['folder']}"


def file_stats(normalized: DataFrame, file_col: str = "file", mult_col: str = "mult") -> DataFrame:
    """A1: per file ``n_original, n_final, n_invalid, n_json_error`` (keyed by full path, D20)."""
    o = F.col("outcome")
    ok = o == "ok"
    return normalized.groupBy(file_col).agg(
        F.count_if(ok).alias("n_original"),
        F.sum(F.when(ok, F.greatest(_col(mult_col), F.lit(1))).otherwise(F.lit(0))).cast("bigint").alias("n_final"),
        F.count_if(~o.isin("ok", "blank", "json_error")).alias("n_invalid"),
        F.count_if(o == "json_error").alias("n_json_error"))


def prep_summary(coverage: DataFrame, batch: int = PREP_BATCH, epochs: int = PREP_EPOCHS,
                 iters_per_sec: float = PREP_ITERS_PER_SEC) -> DataFrame:
    """L2: rows, share, steps per epoch, total steps, estimated minutes."""
    n = F.col("n_total")
    total = F.floor((n * F.lit(epochs)) / F.lit(batch))
    return coverage.select(
        n.alias("n_rows"), "pct",
        F.floor(n / F.lit(batch)).cast("bigint").alias("steps_per_epoch"),
        total.cast("bigint").alias("total_steps"),
        (total.cast("double") / F.lit(float(iters_per_sec)) / F.lit(60.0)).alias("est_minutes"))


def step_plan(n_rows, micro_batch: int, grad_accum: int, epochs: int, eval_floor: int) -> list[Column]:
    """L1: ``steps_per_epoch, total_steps, eval_every`` as expressions over a row count."""
    spe = F.greatest(F.lit(1), F.ceil(_col(n_rows).cast("double") / F.lit(float(micro_batch * grad_accum))))
    spe = spe.cast("bigint")
    return [spe.alias("steps_per_epoch"), (spe * F.lit(epochs)).alias("total_steps"),
            F.greatest(F.lit(eval_floor).cast("bigint"), F.floor(spe / F.lit(3)).cast("bigint")).alias("eval_every")]

