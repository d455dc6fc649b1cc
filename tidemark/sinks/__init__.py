"""Sinks: Kafka (S4), keyed upsert log (S6), side outputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .manifest import atomic_upsert_batch, read_committed, write_version  # noqa: F401


def kafka_sink(df: DataFrame, servers: str, topic: str, value: str = "value",
               key: str | None = None, checkpoint: str | None = None):
    """Write one text record per row to ``topic`` (batch: a job; stream: a query,
    which needs a named checkpoint to go on after a restart without gaps)."""
    cols = [F.col(value).cast("string").alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    out = df.select(*cols)
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a stream into a topic needs a named checkpoint")
        return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                   .option("topic", topic)
                   .option("checkpointLocation", checkpoint)
                   .start())
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None


def split_by_kind(df: DataFrame, kinds: Sequence[str], kind: str = "kind") -> dict:
    """S7 batch form: one DataFrame per side output.  Each computes ``df`` anew:
    to write several of them use ``write_kinds``."""
    return {k: df.filter(F.col(kind) == k) for k in kinds}


def write_kinds(df: DataFrame, path: str, kinds: Sequence[str], kind: str = "kind") -> dict[str, int]:
    """S7 in one pass: every side output in a folder of its own below ``path``, from one
    run of ``df``; the rows per kind, counted while they are written."""
    seen = Observation()
    counts = [F.sum((F.col(kind) == k).cast("long")).alias(f"n{i}") for i, k in enumerate(kinds)]
    (df.filter(F.col(kind).isin(list(kinds))).observe(seen, *counts)
       .write.mode("overwrite").partitionBy(kind).parquet(path))
    return {k: seen.get[f"n{i}"] or 0 for i, k in enumerate(kinds)}


def read_kind(spark: SparkSession, path: str, value: str, kind: str = "kind") -> DataFrame:
    """One side output written by ``write_kinds`` (only its folder is read)."""
    return spark.read.parquet(path).filter(F.col(kind) == value)


def foreach_kind(writers: dict[str, Callable[[DataFrame, int], None]], kind: str = "kind"):
    """S7 streaming form: a ``foreachBatch`` function routing each kind to its writer;
    the micro-batch is persisted once and read by every writer."""
    def run(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for k, w in writers.items():
                w(batch.filter(F.col(kind) == k), epoch)
        finally:
            batch.unpersist()
    return run


def upsert_batch(path: str, keys: Sequence[str], run: int = 0, order: str | None = None):
    """``foreachBatch`` function that appends each micro-batch as
    ``<path>/run=<run>/batch_id=<epoch>`` (overwritten on retry: idempotent).

    ``run`` numbers the query's checkpoint: a query that goes on from its
    checkpoint keeps it (its epochs go on too); one that starts over with a new
    checkpoint takes the next number, so its values are the newer ones.  Of
    several rows of a key in a batch the one with the largest ``order`` stays
    (without ``order`` a key must occur once per batch).
    """
    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch
        if order is not None:
            vals = [c for c in batch.columns if c not in keys]
            rows = (batch.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col(order)).alias("_v"))
                         .select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals]))
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}/batch_id={epoch}")
    return write


def upsert_sink(df: DataFrame, keys: Sequence[str], path: str, checkpoint: str,
                output_mode: str = "update", run: int = 0, order: str | None = None):
    """S6 as a streaming query: keyed upsert of ``df`` into ``path``.  The
    checkpoint must be named: a restarted query has to find it again."""
    return (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
              .foreachBatch(upsert_batch(path, keys, run, order)).start())


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Latest value per key over all runs and batches (max_by: partial aggregation)."""
    log = spark.read.option("basePath", path).parquet(path)
    vals = [c for c in log.columns if c not in [*keys, "run", "batch_id"]]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.struct("run", "batch_id")).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])


def compact_upserted(spark: SparkSession, path: str, keys: Sequence[str], out: str, run: int) -> None:
    """Write the current value of every key as one batch (epoch 0 of ``run``, above all
    runs so far) of a new log ``out``; the sink then goes on there with a higher run."""
    read_upserted(spark, path, keys).write.mode("overwrite").parquet(f"{out.rstrip('/')}/run={run}/batch_id=0")
