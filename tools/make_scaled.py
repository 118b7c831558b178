"""Write a scaled copy of a data folder: conversations repeated ×k (fresh ids), other tables linked.

usage: python tools/make_scaled.py <src_sf_dir> <dst_dir> <k>
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from parley.session import build_session  # noqa: E402


def main():
    src, dst, k = sys.argv[1], sys.argv[2], int(sys.argv[3])
    os.makedirs(dst, exist_ok=True)
    spark = build_session("local[8]", 8)
    conv = spark.read.parquet(f"{src}/conversations.parquet")
    span = conv.agg(F.max("conv_id")).first()[0] + 1
    rep = conv.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_r")).select(
        (F.col("conv_id") + F.col("_r") * F.lit(span)).alias("conv_id"), "turn", "role", "text")
    rep.repartition(8).write.mode("overwrite").parquet(f"{dst}/conversations.parquet")
    for name in os.listdir(src):
        if name != "conversations.parquet" and not os.path.exists(f"{dst}/{name}"):
            os.symlink(f"{src}/{name}", f"{dst}/{name}")


if __name__ == "__main__":
    main()
