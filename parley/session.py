"""Session helper and the shared work folder.

The work folder holds every intermediate file this library writes (derived
inputs, sinks, streaming checkpoints).  On a cluster it must be the shared
folder named by ``spark.checkpoint.dir``; only when that setting is absent
(local tests) do we create one under the machine's temp folder.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import SparkSession

# Confs the operators rely on.  Duplicate JSON keys keep the last value, as a
# Python ``json.loads`` does.
REQUIRED_CONF = {
    "spark.sql.variant.allowDuplicateKeys": "true",
}

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # tasks talk to their Python workers by files instead of local ports: fewer microseconds a state call
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # drop checkpoint files once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "parley", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the confs the operators need to an existing session (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def work_dir(spark: SparkSession, *parts: str) -> str:
    """Folder under the cluster's checkpoint dir for this library's files."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base and not spark.sparkContext.getCheckpointDir():
        # the cluster names the shared folder; make DataFrame.checkpoint() use it too
        spark.sparkContext.setCheckpointDir(base)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
        if base:
            # SparkContext appends a random child folder; use its parent.
            base = os.path.dirname(base.rstrip("/"))
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # Unset: local tests only.  Create one and register it so later
        # checkpoint() calls and other helpers agree on the location.
        base = tempfile.mkdtemp(prefix="parley-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    path = os.path.join(base, "parley", *parts)
    return path


def input_key(sf_dir: str) -> str:
    """Stable folder name for inputs derived from one data directory."""
    path = sf_dir if "://" in sf_dir else os.path.abspath(sf_dir)
    return hashlib.md5(path.encode()).hexdigest()[:12]


def materialize(df, name: str):
    """Write ``df`` once as parquet under the work folder and return a reader over it.

    Used where one input feeds several passes (counts, top-k, join): later
    passes read only the columns they need, and the lineage is cut, so a lost
    executor re-reads files instead of recomputing the input.
    """
    import uuid

    spark = df.sparkSession
    path = work_dir(spark, "tables", name, uuid.uuid4().hex[:12])
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
