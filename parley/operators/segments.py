"""Large groups in slices: running values and look-back with one exchange of the rows.

A window over a group runs in one task.  Here a group of over ``slice_rows`` rows is cut into slices by values
of its order column, so a row's slice follows from the row itself: nothing is sampled per plan branch, nothing
has to be written, and every window over ``(group, slice)`` shares one exchange and one sort.  What a slice
needs from the slices before it (sums, the last rows) is a border record; the records of a group are folded over one row per
slice and joined back.  Groups within the limit are one slice and have no records.

Bounds: there are at most ``rows / slice_rows`` large groups, each with up to ``MAX_CUTS`` cut values, so the table of
cuts and that of sums are broadcast: with the default limit 10^12 rows have a million of them.  A group of over
``MAX_CUTS * slice_rows`` rows has larger slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.numbering import null_safe_join

SLICE_ROWS = 1_000_000
MAX_CUTS = 999


def with_slices(df: DataFrame, group: str, order: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` with ``_key`` (the group, never null), ``_slice`` (rising with ``order``) and ``_large`` (has cuts).

    ``order``: a number, date or timestamp; rows without one are in the first slice, equal ones stay together.
    """
    large = df.groupBy(group).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > slice_rows)
    ranks = F.array(*[F.lit(n / (MAX_CUTS + 1)) for n in range(1, MAX_CUTS + 1)])
    per = null_safe_join(df.select(group, order), F.broadcast(large), [group]).groupBy(group).agg(
        F.percentile_approx(order, ranks, F.lit(10 * MAX_CUTS)).alias("_values"), F.max("_rows").alias("_rows"))
    parts = F.least(F.ceil(F.col("_rows") / slice_rows), F.lit(MAX_CUTS + 1)).cast("int")
    places = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.floor(i * (MAX_CUTS + 1) / parts).cast("int"))
    cuts = per.select(group, F.array_distinct(F.transform(places, lambda p: F.get("_values", p - 1))).alias("_cuts"))
    out = null_safe_join(df, F.broadcast(cuts), [group], how="left")
    below = F.size(F.filter("_cuts", lambda c: c < F.col(order)))
    return out.select(*df.columns, F.struct(F.col(group).alias("g")).alias("_key"),
                      F.when(F.col("_cuts").isNull(), 0).otherwise(F.greatest(below, F.lit(0))).alias("_slice"),
                      F.col("_cuts").isNotNull().alias("_large"))


def whole_groups(df: DataFrame, group: str) -> DataFrame:
    """The same columns with every group in one slice (for data known to have small groups)."""
    return df.select("*", F.struct(F.col(group).alias("g")).alias("_key"), F.lit(0).alias("_slice"),
                     F.lit(False).alias("_large"))


def slice_window(order: str) -> Window:
    return Window.partitionBy("_key", "_slice").orderBy(order)


def number_in_groups(df: DataFrame, group: str, order: str, ties: Sequence[str] = (), name: str = "rn",
                     slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` with the 1-based ``name`` of each row in its group by ``(order, *ties)``, ``first_<order>`` (the group's first
    value) and ``group_rows``: one exchange of the rows, nothing written.

    ``(group, order, *ties)`` must identify a row.
    """
    rows = with_slices(df, group, order, slice_rows)
    sort = Window.partitionBy("_key", "_slice").orderBy(order, *ties)
    whole = sort.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = rows.select("*", F.row_number().over(sort).cast("long").alias("_rn"), F.first(order).over(
        sort.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_first"), F.count(F.lit(1)).over(whole).alias("_rows"))
    borders = rows.where("_large").groupBy("_key", "_slice").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    group_all = Window.partitionBy("_key")
    sums = before_slice(borders, {"_n0": "n"}).join(borders.select(
        "_key", "_slice", F.sum("n").over(group_all).alias("_all"), F.min("first").over(group_all).alias("_f0")), ["_key", "_slice"])
    out = out.join(F.broadcast(sums), ["_key", "_slice"], "left")
    return out.select(*df.columns, (F.col("_rn") + F.coalesce("_n0", F.lit(0))).alias(name),
                      F.coalesce("_f0", "_first").alias(f"first_{order}"), F.coalesce("_all", "_rows").alias("group_rows"))


def before_slice(borders: DataFrame, sums: dict[str, str]) -> DataFrame:
    """``(_key, _slice, *sums)``: for each slice of a group the sums over the slices before it.

    ``borders``: one row per slice of the large groups; ``sums``: output name to column.
    """
    w = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return borders.select("_key", "_slice", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(o) for o, c in sums.items()])


def carried_rows(rows: DataFrame, order: str, item: str, count: int, name: str) -> DataFrame:
    """``(_key, _slice, name)``: the last ``count`` items of a group before each of its slices that has rows.

    ``rows``: those of the large groups; at most ``count`` rows of a slice leave its task.
    """
    last = Window.partitionBy("_key", "_slice").orderBy(F.desc(order))
    tails = rows.withColumn("_n", F.row_number().over(last)).where(F.col("_n") <= count).groupBy("_key", "_slice").agg(
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(item).alias("i")))).alias("_tail"))
    # every slice here has an item, so ``count`` slices hold enough
    w = Window.partitionBy("_key").orderBy("_slice").rowsBetween(-count, -1)
    full = F.transform(F.flatten(F.collect_list("_tail").over(w)), lambda x: x["i"])
    tails = tails.select("_key", "_slice", full.alias("_full"))
    return tails.select("_key", "_slice", F.slice(
        "_full", F.greatest(F.size("_full") - F.lit(count), F.lit(0)) + 1, F.lit(count)).alias(name))
