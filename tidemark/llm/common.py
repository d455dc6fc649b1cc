"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word is a run of anything but ASCII space, tab, LF, VT, FF, CR.  On UTF-8
#: bytes this is what ``bytes.split()`` yields, so Python code splits bytes.
WORD_RE = r"[^\x20\x09-\x0D]+"


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Ready the session for Python work on texts: workers find this package where
    the driver found it (a path that a worker does not have is ignored), and
    Arrow batches are cut small, since one text may have megabytes."""
    if int(spark.conf.get(_BATCH)) > 512:
        spark.conf.set(_BATCH, "512")
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts lineage without executor-local state: a lost executor loses nothing
    of a staged table.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def releasing(task):
    """A task's generator that, when it ends, gives freed memory back to the system:
    Python workers stay between tasks, and would otherwise keep their largest size."""
    @functools.wraps(task)
    def run(given):
        yield from task(given)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return run


def shuffle_width(spark: SparkSession) -> int:
    """The configured number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n (a null id counts as remainder 0)."""
    return F.coalesce(F.pmod(F.crc32(col.cast("string")), F.lit(n)), F.lit(0)).cast("int")


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), without Python."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD_RE), F.lit(0))), F.lit(0)).cast("long")


def word_spans(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts, dictionary-encoded, and how many each text has."""
    raw = b" ".join(texts)
    a = np.frombuffer(raw, np.uint8)
    blank = (a == 32) | ((a >= 9) & (a <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    offsets = np.empty(2 * len(starts) + 1, np.int32)
    offsets[0:-1:2], offsets[1::2], offsets[-1] = starts, ends, len(raw)
    spans = pa.Array.from_buffers(pa.binary(), 2 * len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    stops = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.concatenate(([0], np.searchsorted(starts, stops))))
    return spans.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode(), counts


def components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 40) -> DataFrame:
    """Connected components of an undirected edge list of longs: (node, label).

    Large-star / small-star rounds; every round is staged in the shared folder
    and only two numbers per round reach the driver.  ``label`` is the
    smallest node id of the component.  Nodes without an edge do not appear.
    """
    def summary(e):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    e = (edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
              .filter("u <> v").distinct())
    e = staged(e, "edges")
    seen = summary(e)
    if not seen[0]:
        return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    for _ in range(max_rounds):
        # large star: every neighbour above the node points at the node's smallest neighbour
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        # small star: the node and its lower neighbours point at the lowest of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = (e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
              .union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        e = staged(e, "edges")
        now = summary(e)
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
