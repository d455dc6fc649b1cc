"""Atomic upserts and one-pass side outputs."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark import daily_cap
from tidemark.sinks import read_kind, split_by_kind, write_kinds
from tidemark.sinks.manifest import ManifestWriter, atomic_upsert_batch, committed_files, read_committed

from paths import SF


def values(df):
    return {r.k: r.n for r in df.collect()}


def test_upserts_are_seen_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "table")
    write = atomic_upsert_batch(path)
    assert read_committed(spark, path, ["k"]) is None
    write(spark.range(100).select((F.col("id") % 10).alias("k"), F.col("id").alias("n")).groupBy("k").agg(F.max("n").alias("n")), 0)
    first = values(read_committed(spark, path, ["k"]))
    assert first == {k: 90 + k for k in range(10)}

    # a batch whose last task fails: other tasks have written their files, nothing is published
    fails = F.udf(lambda i: 1 // (0 if i == 99 else 1), "long")
    broken = spark.range(0, 100, 1, 8).select((F.col("id") % 10).alias("k"), (fails("id") + 1000).alias("n"))
    with pytest.raises(Exception):
        write(broken, 1)
    assert values(read_committed(spark, path, ["k"])) == first

    # tasks done, the driver lost before the commit: the files are there, the reader does not see them
    writer = ManifestWriter(path, "00000000-000000000001")
    rows = spark.createDataFrame([(1, 5000, 0, 1)], "k long, n long, run long, batch_id long")
    message = writer.write(iter(rows.toArrow().to_batches()))
    assert os.path.exists(f"{path}/{message.name}") and values(read_committed(spark, path, ["k"])) == first
    writer.abort([message])
    assert not os.path.exists(f"{path}/{message.name}")

    # the retry is published once, however often it is repeated
    again = spark.createDataFrame([(1, 7), (77, 8)], "k long, n long")
    write(again, 1)
    files = committed_files(path)
    write(again, 1)
    assert committed_files(path) == files
    assert values(read_committed(spark, path, ["k"])) == {**first, 1: 7, 77: 8}
    write(again.limit(0), 2)
    assert values(read_committed(spark, path, ["k"])) == {**first, 1: 7, 77: 8}


def test_side_outputs_in_one_pass(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = daily_cap(ev, ["event_type"], 20, seq="event_id")
    want = {k: sorted(r.event_id for r in d.collect()) for k, d in split_by_kind(df, ["pass", "warning"]).items()}
    watched = df.mapInArrow(counted, df.schema)
    n = write_kinds(watched, str(tmp_path / "kinds"), ["pass", "warning", "none"])
    assert n == {"pass": len(want["pass"]), "warning": len(want["warning"]), "none": 0}
    assert runs.value == len(want["pass"]) + len(want["warning"])  # the operator ran once for both outputs
    for k, ids in want.items():
        got = read_kind(spark, str(tmp_path / "kinds"), k)
        assert sorted(r.event_id for r in got.collect()) == ids
        assert "PartitionFilters: [isnotnull(kind" in got._jdf.queryExecution().executedPlan().toString()
