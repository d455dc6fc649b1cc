"""Session helpers.

Library code never hard-codes a machine-local path: streaming checkpoints and
lineage cuts go below ``spark.checkpoint.dir``, which a cluster sets to a
shared folder.  Only when the setting is absent (local runs, tests) do we
create one ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # transformWithState needs the RocksDB provider.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app_name: str = "tidemark",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators rely on."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, asked for by jobs that need one; a local one
    is made only where the setting is absent and the master is this process."""
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def stage_rows(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write ``df`` once below the shared checkpoint folder: (the table read back,
    its row count).  A lost executor loses nothing of it, and its size is known."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "staged", f"{name}-{uuid.uuid4().hex[:12]}")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["n"]


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming query's offsets and state."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")
