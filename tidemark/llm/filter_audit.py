"""Operator 11 - filter interaction audit over a sparse document-term matrix.

Five filters (A: too few words, B: too few distinct ones, C: too many capitals,
D: markup symbols, E: a copy of a smaller doc_id's text) are applied in all 120
orders; per language and step the audit says what the step's filter removes,
what it would have removed had others not come first, what is lost, and how
many removals the filter gets over all orders (its Shapley sum).

The matrix.  A task cuts its documents into shards of about ``SHARD_BYTES`` of
text and encodes each shard's words in a dictionary of its own.  The shard
dictionaries are dealt by word, sorted, and every different word gets its
global number there: one row per (word, shard), never per occurrence, so the
most frequent word is as heavy as there are shards.  The numbers go back to
their shards, which become CSR arrays over global columns.  Row sums (words)
and stored entries of a row (distinct words) decide A and B.

E compares texts by their SHA-256 and joins each with the smallest doc_id of
its text on both columns, so a large group of copies is never one key.  The
flags are counted per language before they meet the orders.

Memory.  A task has one Python worker: what reads the matrix runs in the task
that makes its rows (``each``).  Workers stay between tasks, so they give freed
memory back when a task ends.

Defined results: null and empty texts are equal; null and empty languages are
one part; a null doc_id is neither smaller nor greater than any, so its row
never fails E; rows of the same doc_id and text do not fail each other;
repeated rows count as often as they occur; of several labels of a doc_id any 1
counts, and a document without label is neither good nor toxic; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, prepare, releasing, shuffle_width, staged, word_spans

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITAL_PERCENT = 10
SHARD_BYTES = 8 << 20
SHARD_ROWS = 20_000
#: Words numbered at a time.
RUN_ROWS = 1 << 18
#: Bytes of an Arrow batch: shards are rows of megabytes, and one is enough.
BATCH_BYTES = 4 << 20
_CAPITALS = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"
_NOT_LEADING = bytes(range(0x80, 0xC0))  # UTF-8 continuation bytes
_CODEC = pa.Codec("zstd", 1)
#: A shard: CSR arrays over its own dictionary, the dictionary, and a value per row.
LOCAL = ("shard long, entries long, indptr binary, indices binary, data binary, words array<binary>,"
         " doc_id array<long>, part array<string>, digest array<binary>, fails array<int>")
#: The same over global columns.
CSR = ("shard long, indptr binary, indices binary, data binary,"
       " doc_id array<long>, part array<string>, digest array<binary>, fails array<int>")
#: A row per document.
FLAGS = "doc_id long, part string, digest binary, fails int, n_words long, n_distinct long"


def squeezed(a: np.ndarray) -> bytes:
    """An integer array with bytes of equal weight side by side, compressed."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return _CODEC.compress(planes.tobytes(), asbytes=True)


def restored(blob: bytes, n: int, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = _CODEC.decompress(blob, n * size, asbytes=True)
    return np.frombuffer(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).tobytes(), kind)


def surface_fails(raw: bytes) -> int:
    """Bits of C and D for a text in UTF-8."""
    points = len(raw) - (0 if raw.isascii() else len(raw) - len(raw.translate(None, _NOT_LEADING)))
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return (4 if 100 * capitals > MAX_CAPITAL_PERCENT * points else 0) | (8 if any(s in raw for s in _SYMBOLS) else 0)


@releasing
def local_shards(batches):
    """Shards (``LOCAL``) of rows (doc_id, part, text as bytes)."""
    number = TaskContext.get().partitionId() << 32  # a repeated task numbers its shards alike
    held: list[tuple] = []
    size = 0

    def flush():
        nonlocal number
        ids, parts, texts = zip(*held)
        held.clear()
        words, counts = word_spans(list(texts))
        codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        v = max(len(words.dictionary), 1)
        row = np.repeat(np.arange(len(counts)), counts)
        cell, times = np.unique(row * v + codes, return_counts=True)
        indptr = np.concatenate(([0], np.cumsum(np.bincount(cell // v, minlength=len(counts))))).astype(np.int64)
        one = [[number], [len(cell)], [squeezed(indptr)], [squeezed((cell % v).astype(np.int32))],
               [squeezed(times.astype(np.int32))], [words.dictionary], [ids], [parts],
               [[hashlib.sha256(t).digest() for t in texts]], [[surface_fails(t) for t in texts]]]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), None, pa.list_(pa.int64()),
                 pa.list_(pa.string()), pa.list_(pa.binary()), pa.list_(pa.int32())]
        arrays = [pa.ListArray.from_arrays(pa.array([0, len(x[0])], pa.int32()), x[0]) if k is None else pa.array(x, k)
                  for x, k in zip(one, kinds)]
        number += 1
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in LOCAL.split(", ")])

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
            held.append(row)
            size += len(row[2]) + 1
            if size >= SHARD_BYTES or len(held) >= SHARD_ROWS:
                yield flush()
                size = 0
    if held:
        yield flush()


def _larger(batches, rows: int):
    """The rows of many small batches in batches of about ``rows``."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


@releasing
def numbered_words(batches):
    """Global numbers of words that arrive sorted: per shard and run of rows one
    row (shard, first number, codes, numbers from the first one on)."""
    base = TaskContext.get().partitionId() << 40
    last, number = None, -1
    for batch in _larger(batches, RUN_ROWS):
        word = batch.column(0)
        code = word.dictionary_encode()
        # sorted, so the codes of a batch ascend; the first word may go on from the batch before
        numbers = code.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        numbers += number if word[0].as_py() == last else number + 1
        last, number = word[-1].as_py(), int(numbers[-1])
        shard, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        order = np.argsort(shard, kind="stable")
        shard, own, numbers = shard[order], own[order], numbers[order]
        at = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
        cut = list(zip(at.tolist(), [*at[1:].tolist(), len(shard)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard[at]), pa.array(base + numbers[at]),
             pa.array([own[x:y].astype(np.int32).tobytes() for x, y in cut], pa.binary()),
             pa.array([(numbers[x:y] - numbers[x]).astype(np.int32).tobytes() for x, y in cut], pa.binary())],
            names=["shard", "first", "codes", "numbers"])


def _global_columns(batches):
    """Shards with their dictionaries' numbers: ``CSR`` with the columns of a row ascending."""
    for batch in batches:
        for r in range(batch.num_rows):
            one = {n: batch.column(i)[r] for i, n in enumerate(batch.schema.names)}
            n, docs = one["entries"].as_py(), len(one["doc_id"].as_py())
            indptr = restored(one["indptr"].as_py(), docs + 1, "<i8")
            indices = restored(one["indices"].as_py(), n, "<i4")
            data = restored(one["data"].as_py(), n, "<i4")
            runs = one["runs"].as_py() or []
            column = np.full(sum(len(x["codes"]) for x in runs) // 4, -1, np.int64)
            for x in runs:
                column[np.frombuffer(x["codes"], "<i4")] = np.frombuffer(x["numbers"], "<i4").astype(np.int64) + x["first"]
            wide = column[indices]
            order = np.lexsort((wide, np.repeat(np.arange(docs), np.diff(indptr))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([one["shard"].as_py()]), pa.array([indptr.tobytes()], pa.binary()),
                 pa.array([wide[order].tobytes()], pa.binary()), pa.array([data[order].tobytes()], pa.binary()),
                 *[batch.column(batch.schema.get_field_index(c)).slice(r, 1) for c in ("doc_id", "part", "digest", "fails")]],
                names=[c.split()[0] for c in CSR.split(", ")])


def term_matrix(docs: DataFrame, doc_id: str = "doc_id", part: str = "lang", each=None, schema: str = CSR) -> DataFrame:
    """The document-term matrix as CSR shards (``CSR``): per shard ``indptr``,
    ``indices`` (global word numbers) and ``data`` (counts) as little-endian longs,
    longs and ints, with the id, part, text digest and surface flags of its rows.

    ``each`` turns a task's shards into rows of ``schema`` where they are made: as a
    step of its own it would have every task hold a second Python worker."""
    spark = prepare(docs.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(part, F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    local = staged(rows.mapInArrow(local_shards, LOCAL), "term-shards")
    words = local.select("shard", F.posexplode("words").alias("code", "word")).select("word", "shard", "code")
    # the width fixed: a word's number is made of its partition's and its place there
    runs = (words.repartition(shuffle_width(spark), "word").sortWithinPartitions("word")
                 .mapInArrow(numbered_words, "shard long, first long, codes binary, numbers binary"))
    runs = runs.groupBy("shard").agg(F.collect_list(F.struct("first", "codes", "numbers")).alias("runs"))

    @releasing
    def columns(batches):
        shards = _global_columns(batches)
        yield from each(shards) if each else shards

    return local.drop("words").join(runs, "shard", "left").mapInArrow(columns, schema)


def _row_flags(batches):
    """One row per document: A and B from the matrix, C and D as they came."""
    for batch in batches:
        for r in range(batch.num_rows):
            indptr = np.frombuffer(batch.column(1)[r].as_py(), "<i8")
            sums = np.concatenate(([0], np.cumsum(np.frombuffer(batch.column(3)[r].as_py(), "<i4"), dtype=np.int64)))
            words, distinct = np.diff(sums[indptr]), np.diff(indptr)
            ids, parts, digests, fails = (batch.column(i).slice(r, 1).flatten() for i in range(4, 8))
            mask = fails.to_numpy(zero_copy_only=False) | (words < MIN_WORDS)
            mask = mask | np.where(100 * distinct < MIN_DISTINCT_PERCENT * words, 2, 0)
            yield pa.RecordBatch.from_arrays(
                [ids, parts, digests, pa.array(mask.astype(np.int32)), pa.array(words), pa.array(distinct)],
                names=["doc_id", "part", "digest", "fails", "n_words", "n_distinct"])


def document_flags(docs: DataFrame, doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """doc_id, part, fails (bits A = 1 to E = 16), n_words, n_distinct of every document."""
    rows = staged(term_matrix(docs, doc_id, part, _row_flags, FLAGS), "flags")
    first = (rows.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
                 .withColumn("first", F.lit(True)))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return (rows.join(first, ["digest", "doc_id"], "left")
                .select("doc_id", "part", F.col("fails").bitwiseOR(F.when(copy, 16).otherwise(0)).alias("fails"),
                        "n_words", "n_distinct"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    flags = document_flags(docs).groupBy("doc_id", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    cells = flags.join(known, "doc_id", "left").groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    # at most 32 cells a part meet the 600 steps
    orders = ["".join(p) for p in permutations(FILTERS)]
    before = [sum(1 << FILTERS.index(c) for c in o[:k]) for o in orders for k in range(5)]
    own = [1 << FILTERS.index(o[k]) for o in orders for k in range(5)]
    i = F.col("i")
    steps = cells.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(len(own) - 1)))).select(
        "part", "fails", "n", "good", "toxic",
        F.element_at(F.lit(orders), (F.floor(i / 5) + 1).cast("int")).alias("filter_order"),
        (i % 5 + 1).cast("int").alias("step"), F.element_at(F.lit(own), i + 1).alias("own"),
        F.element_at(F.lit(before), i + 1).alias("before"))
    hit = F.col("fails").bitwiseAND(F.col("own")) != 0
    gone = F.col("fails").bitwiseAND(F.col("before")) != 0

    def total(cond, col="n"):
        return F.sum(F.when(cond, F.col(col)).otherwise(F.lit(0))).cast("long")

    share = F.floor(F.lit(120) / F.bit_count("fails"))  # orders in which one of the failing filters comes first
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~hit & ~gone).alias("kept"), total(hit & ~gone).alias("removed"), total(hit & gone).alias("redundant"),
        total(F.col("fails") == F.col("own")).alias("unique_fails"), total(hit & ~gone, "good").alias("good_lost"),
        total(hit & ~gone, "toxic").alias("toxic_lost"),
        F.sum(F.when(hit, F.col("n") * share).otherwise(F.lit(0))).cast("long").alias("shapley"))


def op11_filter_audit(spark, sf_dir):
    return filter_audit(documents(spark, sf_dir).select("doc_id", "text", "lang"),
                        spark.read.parquet(f"{sf_dir}/labels.parquet"))
