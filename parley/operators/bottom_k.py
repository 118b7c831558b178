"""Counts and the smallest keys of every stratum in one pass.

``bottom_k`` is a mergeable aggregate: a task keeps, per stratum, the number of its rows and its ``k`` smallest
``(hash, key)``; the union of these records has the counts as sums and the ``k`` smallest of all among its keys.  The input is
evaluated once; what is written is at most ``k`` keys per stratum and task, never a key per row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.session import materialize


def bottom_k(df: DataFrame, stratum: Column, order: Column, keys: Sequence[str], ks: dict) -> DataFrame:
    """Records ``(_stratum, _rows, _order, *keys)``, written once: per task and stratum one with the number of rows
    (no order), and the ``ks[stratum]`` rows that come first by ``order`` (a string), then keys.

    ``stratum``: a boolean column; rows where it is null are in no stratum.
    """
    rows = df.select(stratum.alias("_stratum"), order.alias("_order"), *keys).where(F.col("_stratum").isNotNull())
    fields = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([T.StructField("_stratum", T.BooleanType()), T.StructField("_rows", T.LongType()),
                           T.StructField("_order", T.StringType()), *[T.StructField(k, fields[k]) for k in keys]])

    def first(table: pa.Table, k: int) -> pa.Table:
        by = [("_order", "ascending"), *[(c, "ascending") for c in keys]]
        return table.take(pc.select_k_unstable(table, k, by)) if table.num_rows > k else table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = dict.fromkeys(ks, 0), dict.fromkeys(ks)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for s, k in ks.items():
                own = table.filter(pc.equal(table["_stratum"], s))
                count[s] += own.num_rows
                if k > 0 and own.num_rows:
                    own = first(own, k)
                    best[s] = own if best[s] is None else first(pa.concat_tables([best[s], own]), k)
        names = ["_stratum", "_rows", "_order", *keys]
        for s in ks:
            if not count[s]:
                continue
            empty = [pa.nulls(1, table.schema.field(c).type) for c in keys]
            yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([count[s]], pa.int64()), pa.nulls(1, pa.utf8()), *empty], names)
            if best[s] is not None:
                for b in best[s].combine_chunks().to_batches():
                    yield pa.RecordBatch.from_arrays(
                        [b["_stratum"], pa.array(np.zeros(b.num_rows), pa.int64()), b["_order"].cast(pa.utf8()),
                         *[b[c] for c in keys]], names)

    return materialize(rows.mapInArrow(run, schema), "bottom_k")


def counts_of(records: DataFrame) -> dict[bool, int]:
    """Rows per stratum: two numbers."""
    got = records.groupBy("_stratum").agg(F.sum("_rows").alias("n")).collect()
    return {r["_stratum"]: int(r["n"]) for r in got}


def smallest(records: DataFrame, keys: Sequence[str], ks: dict) -> DataFrame:
    """``keys`` of the first ``ks[stratum]`` rows of each stratum (at most the ``k`` that ``bottom_k`` was given)."""
    out = None
    for s, k in ks.items():
        own = records.where((F.col("_stratum") == s) & F.col("_order").isNotNull())
        top = own.orderBy("_order", *keys).limit(max(k, 0)).select(*keys)
        out = top if out is None else out.unionByName(top)
    return out
