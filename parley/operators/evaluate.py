"""Response scoring against keyword rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import any_keyword, preview


def passes(text, must: Sequence[str], must_not: Sequence[str], case_sensitive: bool = True) -> Column:
    """K3: has any ``must`` keyword and no ``must_not`` keyword."""
    return any_keyword(text, must, case_sensitive) & ~any_keyword(text, must_not, case_sensitive)


def response_pass(df: DataFrame, must: Sequence[str], must_not: Sequence[str], *, text_col: str = "text",
                  preview_len: int = 100) -> DataFrame:
    """Adds ``ok`` and a ``preview`` of the first characters."""
    return df.withColumn("ok", passes(text_col, must, must_not)).withColumn(
        "preview", preview(text_col, preview_len))


def pass_by_step(scored: DataFrame, every: int, step_col: str = "step") -> DataFrame:
    """``(step, n_pass, n)`` at steps > 0 divisible by ``every``."""
    s = F.col(step_col)
    return (scored.where((s > 0) & (s % every == 0))
            .groupBy(step_col).agg(F.count_if("ok").alias("n_pass"), F.count(F.lit(1)).alias("n")))
