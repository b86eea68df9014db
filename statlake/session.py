"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Engine settings that matter for correctness or for skewed keys. Partition
# counts and memory belong to the cluster and are not set here.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keyed stream state on disk, so that a batch touches its own keys only.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",     # top-n per group cuts each input task
}


def build_session(app: str = "statlake", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only where the cluster names none and the master is local is a local folder
    made and recorded in the session, as in tests.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="statlake-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is ever overwritten there."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back: cuts lineage, survives lost executors, keeps statistics exact."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(df: DataFrame, key: str) -> DataFrame:
    """Rows of a key in one task, as a rule, so that later folds by it shuffle little.

    ``rebalance`` cuts a key that has too many rows for a task, and the later grouping still
    meets across tasks: dealt by a hash of the key, rows do not count as grouped by it.
    """
    return df.withColumn("_deal", F.xxhash64(key)).hint("rebalance", F.col("_deal")).drop("_deal")
