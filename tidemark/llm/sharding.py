"""Operator 4 - longest-processing-time sharding of groups of equal texts.

Groups (equal texts) stay together.  Every group of at least
total / ``heavy_parts`` bytes is an item of its own (there can be no more than
``heavy_parts`` of them); all lighter groups fall by hash into ``lots`` lots,
and a lot is one item.  The items - at most heavy_parts + lots, whatever the
input - are sorted by size and each goes to the least loaded shard through a
heap.  ``heavy_parts`` and ``lots`` say how fine the items are, at every size of
the table: a group is placed by itself if it holds more than 1 / heavy_parts of
all bytes, so shards differ by the heap's rule for items that small.  Documents find their shard by a broadcast of that bounded table, so no
group is ever moved or gathered.

Defined results: a null text is empty (size 1, crc of no bytes) but forms its
own group, apart from empty texts; repeated rows keep their own slots; ties in
the heap go to the lowest shard; an empty table gives an empty result; other
columns of the input survive ``with_shards`` (its own working columns start
with ``_tm_``).
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import documents, prepare, staged

HEAVY_PARTS = 1 << 14
LOTS = 1 << 14
#: Rows of (shard, partition) offsets, of 24 bytes each, that are broadcast.
OFFSETS = 1 << 20


def lpt(items: list[tuple], shards: int) -> dict:
    """{key: shard} for (key, size) items, largest first, ties by key."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for key, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, s = heapq.heappop(heap)
        placed[key] = s
        heapq.heappush(heap, (load + size, s))
    return placed


def with_shards(docs: DataFrame, shards: int = 8, heavy_parts: int = HEAVY_PARTS, lots: int = LOTS,
                group=None, size=None) -> DataFrame:
    """``docs`` plus ``shard``.  ``group`` and ``size`` are Columns; by default
    equal texts form a group and the size is the UTF-8 length plus 1."""
    spark = docs.sparkSession
    group = F.xxhash64("text") if group is None else group
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long") if size is None else size
    rows = docs.withColumn("_tm_g", group)
    groups = staged(rows.select("_tm_g", size.alias("_tm_z")).groupBy("_tm_g")
                        .agg(F.sum("_tm_z").alias("_tm_bytes")), "groups")
    total = groups.agg(F.sum("_tm_bytes")).first()[0] or 0
    least = total / heavy_parts
    heavy = groups.filter(F.col("_tm_bytes") >= F.lit(least)).collect()
    light = (groups.filter(F.col("_tm_bytes") < F.lit(least))
                   .groupBy(F.pmod("_tm_g", F.lit(lots)).alias("lot")).agg(F.sum("_tm_bytes").alias("b")).collect())
    placed = lpt([((0, r[0]), r[1]) for r in heavy] + [((1, r[0]), r[1]) for r in light], shards)
    own = spark.createDataFrame([(k, s) for (kind, k), s in placed.items() if kind == 0],
                                "_tm_hg long, _tm_hs int")
    lot = spark.createDataFrame([(k, s) for (kind, k), s in placed.items() if kind == 1],
                                "_tm_lot long, _tm_ls int")
    # at most heavy_parts and lots rows
    return (rows.join(F.broadcast(own), F.col("_tm_g") == F.col("_tm_hg"), "left")
                .join(F.broadcast(lot), F.pmod("_tm_g", F.lit(lots)) == F.col("_tm_lot"), "left")
                .withColumn("shard", F.coalesce("_tm_hs", "_tm_ls"))
                .drop("_tm_g", "_tm_hg", "_tm_hs", "_tm_lot", "_tm_ls"))


def shard_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard.  Rows are counted per shard while
    they are staged, inside the partition they are in, and shifted by the counts
    of the partitions before: no row is moved, no shard is gathered."""
    prepare(rows.sparkSession)
    shard_at = rows.columns.index("shard")
    schema = StructType(rows.schema.fields + [StructField("_tm_part", LongType()), StructField("_tm_n", LongType())])

    def counted(batches):
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            shard = batch.column(shard_at).to_numpy(zero_copy_only=False)
            n = np.empty(len(shard), np.int64)
            for s in np.unique(shard).tolist():
                at = np.flatnonzero(shard == s)
                n[at] = np.arange(seen[s], seen[s] + len(at))
                seen[s] += len(at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), part, np.int64)), pa.array(n)],
                                             names=schema.names)

    marked = staged(rows.mapInArrow(counted, schema), "shards")
    counts = marked.groupBy("shard", "_tm_part").agg(F.count(F.lit(1)).alias("_tm_c"))
    before = Window.partitionBy("shard").orderBy("_tm_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(counts.select(F.col("shard").alias("_tm_s"), F.col("_tm_part").alias("_tm_p"),
                                   F.coalesce(F.sum("_tm_c").over(before), F.lit(0)).alias("_tm_off")), "offsets")
    # a row per shard and input partition; its size is known, it goes to all tasks while it is small
    small = F.broadcast(offsets) if offsets.count() <= OFFSETS else offsets
    return (marked.join(small, (F.col("shard") == F.col("_tm_s")) & (F.col("_tm_part") == F.col("_tm_p")), "left")
                  .withColumn("slot", F.col("_tm_off") + F.col("_tm_n"))
                  .drop("_tm_part", "_tm_n", "_tm_s", "_tm_p", "_tm_off"))


def sharded(docs: DataFrame, shards: int = 8) -> DataFrame:
    """All columns of ``docs`` plus ``shard`` and ``slot`` (replacing columns of
    those names): the pipeline's last stage."""
    clash = [c for c in docs.columns if c.lower() in ("shard", "slot")]
    return shard_slots(with_shards(docs.drop(*clash), shards))


def op4_sharding(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    # the digest carries no text: group, size and checksum are taken from it once
    base = docs.select("doc_id", F.xxhash64("text").alias("g"),
                       (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.coalesce("text", F.lit(""))).cast("long").alias("text_crc32"))
    base = staged(base, "sizes")
    rows = with_shards(base, 8, group=F.col("g"), size=F.col("size")).drop("g")
    return shard_slots(rows).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                    F.lit(None).cast("int").alias("grown_shard"))
