"""Stratified train/eval split.

Quotas depend on the strata's counts, but have upper limits (``LIMITS``), so counts and candidates come from one pass
(``bottom_k``): per stratum the number of rows and, for each task, the few keys that come first by hash.  The eval keys are
then broadcast — their number is bounded by the quota and checked — and joined to
tag every row, so no ``row_number`` over a two-valued stratum is needed.  A quota of the caller without
limits reads keys and flags, written once, in two passes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.operators.bottom_k import bottom_k, counts_of, smallest
from parley.operators.curate import shuffle_key
from parley.operators.numbering import number_rows
from parley.session import materialize

# --- fixed values -----------------------------------------------------------
EVAL_BUDGET_A = 300     # profile A: total eval rows
EVAL_ID_CAP = 30        # at most this many keyword (identity) rows in eval
EVAL_ID_MIN_A = 5       # profile A: at least this many (nominal, see quota_profile_a)
EVAL_OTHER_CAP_B = 270  # profile B: other rows in eval
PROFILES = {
    # name: (micro_batch, grad_accum, epochs, eval_floor)
    "A": (2, 8, 2, 100),
    "B": (2, 4, 1, 20),
}
# -----------------------------------------------------------------------------

BROADCAST_EVAL_LIMIT = 100_000

Quota = Callable[[int, int], tuple[int, int]]


def quota_profile_a(n_id: int, n_other: int) -> tuple[int, int]:
    """``min(30, max(5, n_id//10))`` keyword rows, ``min(300 - that, n_other//20)`` others.

    With fewer than 5 keyword rows all of them go to eval, but the budget
    still subtracts the nominal 5.
    """
    k_id = min(EVAL_ID_CAP, max(EVAL_ID_MIN_A, n_id // 10))
    k_other = min(EVAL_BUDGET_A - k_id, n_other // 20)
    return k_id, max(k_other, 0)


def quota_profile_b(n_id: int, n_other: int) -> tuple[int, int]:
    """``min(30, n_id//2)`` and ``min(270, n_other//2)``."""
    return min(EVAL_ID_CAP, n_id // 2), min(EVAL_OTHER_CAP_B, n_other // 2)


QUOTAS: dict[str, Quota] = {"A": quota_profile_a, "B": quota_profile_b}
#: The most rows a quota ever takes: (keyword rows, others).
LIMITS: dict[Quota, tuple[int, int]] = {quota_profile_a: (EVAL_ID_CAP, EVAL_BUDGET_A - EVAL_ID_MIN_A),
                                        quota_profile_b: (EVAL_ID_CAP, EVAL_OTHER_CAP_B)}


def _stratum_counts(units: DataFrame, flag_col: str) -> tuple[int, int]:
    row = units.agg(F.count_if(F.col(flag_col)).alias("i"),
                    F.count_if(~F.col(flag_col)).alias("o")).first()
    return int(row["i"] or 0), int(row["o"] or 0)


def _eval_keys(units: DataFrame, flag_col: str, order: Sequence[Column], key_cols: Sequence[str],
               k_id: int, k_other: int) -> DataFrame:
    parts = []
    for flag_value, k in ((True, k_id), (False, k_other)):
        if k > 0:
            stratum = units.where(F.col(flag_col) == F.lit(flag_value))
            if k <= BROADCAST_EVAL_LIMIT:
                top = stratum.orderBy(*order).limit(k)
            else:   # a quota of any size: numbered in ranges, never collected in one task
                top = number_rows(stratum, order, name="_rank").where(F.col("_rank") <= k)
            parts.append(top.select(*key_cols))
    if not parts:
        return units.select(*key_cols).limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _tag(df: DataFrame, eval_keys: DataFrame, key_cols: Sequence[str], n_eval: int) -> DataFrame:
    ek = eval_keys.withColumn("_is_eval", F.lit(True))
    if n_eval <= BROADCAST_EVAL_LIMIT:
        ek = F.broadcast(ek)
    j = df.join(ek, list(key_cols), "left")
    return j.withColumn("split", F.when(F.col("_is_eval"), F.lit("eval")).otherwise(F.lit("train"))).drop("_is_eval")


def stratified_split(df: DataFrame, flag_col: str, key_cols: Sequence[str], *, seed: int = 42,
                     quota: Quota | str = "A", limits: tuple[int, int] | None = None,
                     materialize_input: bool = True) -> DataFrame:
    """Add ``split`` ('train'/'eval'); row-level, like the reference (``compat``).

    ``key_cols`` must identify a row (e.g. ``conv_id`` or ``(conv_id, replica)``);
    order inside a stratum is ``md5('<seed>:<key>...')``.  ``limits``: the most rows that the quota takes of each
    stratum (known for the profiles): then counts and first rows are one pass over keys and flags, and an expensive
    upstream runs twice, for that and for the tagged rows.  Without limits keys and flags
    (never whole rows) are written once as parquet (``materialize_input``) and read twice.
    """
    q = QUOTAS[quota] if isinstance(quota, str) else quota
    units = df.select(*key_cols, flag_col)
    ek, n_eval = _choose(units, flag_col, shuffle_key(seed, *key_cols), key_cols, q, limits, materialize_input)
    return _tag(df, ek, key_cols, n_eval)


def _choose(units: DataFrame, flag_col: str, order: Column, key_cols: Sequence[str], quota: Quota,
            limits: tuple[int, int] | None, materialize_input: bool) -> tuple[DataFrame, int]:
    """Keys of the eval rows and their number."""
    limits = limits or LIMITS.get(quota)
    if limits and max(limits) <= BROADCAST_EVAL_LIMIT:
        records = bottom_k(units, F.col(flag_col), order, key_cols, {True: limits[0], False: limits[1]})
        count = counts_of(records)
        n_id, n_other = count.get(True, 0), count.get(False, 0)
        k_id, k_other = (min(k, top) for k, top in zip(quota(n_id, n_other), limits))
        return smallest(records, key_cols, {True: k_id, False: k_other}), min(k_id, n_id) + k_other
    if materialize_input:
        units = materialize(units, "split_keys")
    n_id, n_other = _stratum_counts(units, flag_col)
    k_id, k_other = quota(n_id, n_other)
    by = [order, *[F.col(c) for c in key_cols]]
    return _eval_keys(units, flag_col, by, key_cols, min(k_id, n_id), k_other), min(k_id, n_id) + k_other


def content_key(messages_col: str = "messages") -> Column:
    """Group key for copies: SHA-256 of the messages as JSON."""
    return F.sha2(F.to_json(F.col(messages_col)), 256)


def leak_safe_split(df: DataFrame, flag_col: str, *, seed: int = 42, quota: Quota | str = "A",
                    group_col: str = "_group", order_col: str | None = None, replica_col: str = "replica",
                    limits: tuple[int, int] | None = None, materialize_input: bool = True) -> DataFrame:
    """Split whole content groups, so no copy of a row reaches both sides.

    Quotas are computed over distinct groups (``group_col``; computed from
    ``messages`` when absent).  Groups are ordered by
    ``md5('<seed>:' || min(order_col))`` (default: the group key).  Eval keeps
    one copy of each row (``replica == 1``); train keeps every replica.
    """
    q = QUOTAS[quota] if isinstance(quota, str) else quota
    if group_col not in df.columns:
        df = df.withColumn(group_col, content_key())
    oc = order_col or group_col
    units = df.select(*dict.fromkeys([group_col, flag_col, oc]))   # group, flag and order only, never whole rows
    groups = units.groupBy(group_col).agg(F.max(F.col(flag_col)).alias(flag_col), F.min(F.col(oc)).alias("_ord"))
    if materialize_input and not (limits or q in LIMITS):
        groups = materialize(groups, "split_keys")
    ek, n_eval = _choose(groups, flag_col, shuffle_key(seed, "_ord"), [group_col], q, limits, False)
    tagged = _tag(df, ek, [group_col], n_eval)
    if replica_col in df.columns:
        tagged = tagged.where((F.col("split") == "train") | (F.col(replica_col) == 1))
    return tagged


def split_summary(split_df: DataFrame, flag_col: str) -> DataFrame:
    """Rows per ``(split, flag)``."""
    return split_df.groupBy("split", flag_col).agg(F.count(F.lit(1)).alias("n"))


def leak_report(split_df: DataFrame, group_col: str) -> DataFrame:
    """One row ``n_leaked``: groups with rows in both train and eval."""
    per = split_df.groupBy(group_col).agg(
        F.count_if(F.col("split") == "eval").alias("_e"), F.count_if(F.col("split") == "train").alias("_t"))
    return per.agg(F.count_if((F.col("_e") > 0) & (F.col("_t") > 0)).alias("n_leaked"))
