"""Streaming forms vs their batch twins, over events cut by time into files
(one file per micro-batch, ``availableNow``)."""

import os
import tempfile
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark import consecutive_events, daily_cap, sliding_count, unique_per_window
from tidemark.operators.patterns import match_sequence, order_timeout
from tidemark.session import checkpoint_location
from tidemark.streaming import (prepare, stream_consecutive_events, stream_daily_cap,
                                stream_match_sequence, stream_order_timeout, stream_reconcile,
                                stream_sliding_count, stream_unique_per_window, top_n_batches)

from paths import SF

N_FILES = 4


def write_part(pdf, path, i):
    """One parquet file per micro-batch; ``ts`` as UTC-adjusted micros (Spark TIMESTAMP)."""
    pdf = pdf.copy()
    pdf["ts"] = pdf["ts"].dt.tz_localize("UTC")
    pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), path, coerce_timestamps="us",
                   allow_truncated_timestamps=True)
    os.utime(path, (1_000_000 + i, 1_000_000 + i))


@pytest.fixture(scope="module")
def events(spark):
    return (spark.read.parquet(f"{SF}/events.parquet")
            .select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "props")
            .cache())


@pytest.fixture(scope="module")
def stream_dir(events):
    pdf = events.orderBy("event_id").toPandas()
    d = tempfile.mkdtemp(prefix="tidemark-stream-")
    step = -(-len(pdf) // N_FILES)
    for i, part in enumerate(pdf.iloc[j:j + step] for j in range(0, len(pdf), step)):
        write_part(part, os.path.join(d, f"part-{i:03d}.parquet"), i)
    return d


def read_stream(spark, events, stream_dir):
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(stream_dir)


def run(df, mode="append", expect_rows=None):
    """availableNow run; with ``expect_rows`` (processing-time timers keep a
    query issuing no-data batches) stop once that many input rows were read."""
    name = f"q_{uuid.uuid4().hex[:8]}"
    w = (df.writeStream.outputMode(mode).format("memory").queryName(name)
         .option("checkpointLocation", checkpoint_location(df.sparkSession, name)))
    if expect_rows is None:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
    else:
        q = w.start()
        deadline = time.time() + 120
        while sum(p["numInputRows"] for p in q.recentProgress) < expect_rows and time.time() < deadline:
            time.sleep(0.5)
        q.stop()
    return df.sparkSession.table(name)


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def max_t_us(events, where="true"):
    return events.filter(where).select(F.max(F.unix_micros("ts"))).first()[0]


def test_stream_sliding_count(spark, events, stream_dir):
    s = read_stream(spark, events, stream_dir)
    out = run(stream_sliding_count(s, ["event_type"], "1 hour", "5 minutes"))
    batch = sliding_count(events, ["event_type"], "1 hour", "5 minutes")
    got = set(rows(out, ["event_type", "window_end", "cnt"]))
    want = set(rows(batch, ["event_type", "window_end", "cnt"]))
    assert got and got <= want
    horizon = max_t_us(events) - 3_600_000_000
    closed = {r for r in want if r[1] * 1000 <= horizon}
    assert closed <= got


def test_stream_unique_visitors(spark, events, stream_dir):
    s = read_stream(spark, events, stream_dir).filter("event_type = 'view'")
    out = run(stream_unique_per_window(s, "user_id", "1 hour"))
    batch = unique_per_window(events.filter("event_type = 'view'"), "user_id", "1 hour")
    got = set(rows(out, ["window_end", "uv"]))
    want = set(rows(batch, ["window_end", "uv"]))
    assert got and got <= want
    horizon = max_t_us(events) - 3_600_000_000
    assert {r for r in want if r[0] * 1000 <= horizon} <= got


def test_stream_top_n(spark, events, stream_dir):
    s = read_stream(spark, events, stream_dir).filter("event_type = 'view'").select(
        "ts", F.get_json_object("props", "$.k").cast("long").alias("item_id"))
    counts = stream_sliding_count(s, ["item_id"], "1 hour", "5 minutes")
    sink_dir = os.path.join(tempfile.mkdtemp(prefix="tidemark-topn-"), "out")

    def sink(df, epoch):
        df.write.mode("append").parquet(sink_dir)

    q = (counts.writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint_location(spark, "topn"))
         .foreachBatch(top_n_batches(3, sink)).trigger(availableNow=True).start())
    q.awaitTermination()
    got = set(rows(spark.read.parquet(sink_dir), ["window_end", "item_id", "cnt", "rank"]))
    from tidemark import top_n_per_window

    vb = events.filter("event_type = 'view'").select(
        "ts", F.get_json_object("props", "$.k").cast("long").alias("item_id"))
    want = set(rows(top_n_per_window(sliding_count(vb, ["item_id"], "1 hour", "5 minutes"), 3),
                    ["window_end", "item_id", "cnt", "rank"]))
    horizon = max_t_us(events, "event_type = 'view'") // 1000
    assert got <= want and {r for r in want if r[0] <= horizon} <= got


def test_stream_daily_cap(spark, events, stream_dir):
    s = prepare(read_stream(spark, events, stream_dir).select("event_id", "ts", "user_id", "event_type"),
                "ts", "event_id")
    out = run(stream_daily_cap(s, ["user_id", "event_type"], 2))
    batch = daily_cap(events.select("event_id", "ts", "user_id", "event_type"), ["user_id", "event_type"], 2,
                      seq="event_id")
    assert rows(out, ["event_id", "kind"]) == rows(batch, ["event_id", "kind"])


def test_stream_consecutive_events(spark, events, stream_dir):
    s = prepare(read_stream(spark, events, stream_dir).select("event_id", "ts", "user_id", "event_type"),
                "ts", "event_id")
    out = run(stream_consecutive_events(s, "user_id", "event_type", "error", "6 hours"))
    batch = consecutive_events(events, "user_id", "event_type", "error", "6 hours", seq="event_id",
                               carry=["event_id"])
    assert rows(out, ["event_id", "prev_seq"]) == rows(batch, ["event_id", "prev_event_id"])


def test_stream_sequence(spark, events, stream_dir):
    s = prepare(read_stream(spark, events, stream_dir).select("event_id", "ts", "user_id", "event_type"),
                "ts", "event_id")
    out = run(stream_match_sequence(s, "user_id", ["click", "purchase"], "6 hours",
                                    emit=("match", "timeout")))
    batch = match_sequence(events, "user_id", ["click", "purchase"], "6 hours", seq="event_id",
                           emit=("match", "timeout"), carry=["event_id"])
    got = set(rows(out, ["start_seq", "kind"]))
    want = set(rows(batch, ["event_id_0", "kind"]))
    assert got and got <= want
    horizon = max_t_us(events) - 6 * 3_600_000_000
    decided = {r.event_id for r in events.filter(F.unix_micros("ts") < horizon).select("event_id").collect()}
    assert {r for r in want if r[0] in decided} <= got


def test_stream_order_timeout(spark, events, stream_dir):
    s = prepare(read_stream(spark, events, stream_dir).select("event_id", "ts", "user_id", "event_type"),
                "ts", "event_id")
    out = run(stream_order_timeout(s, "user_id", "event_type", "click", "6 hours"))
    batch = order_timeout(events, "user_id", "event_type", "click", "6 hours")
    got = set(r.start_seq for r in out.collect())
    want = set(r.event_id for r in batch.collect())
    assert got and got <= want
    horizon = max_t_us(events) - 6 * 3_600_000_000 - 1
    decided = {r.event_id for r in events.filter(F.unix_micros("ts") < horizon).select("event_id").collect()}
    assert want & decided <= got


def test_stream_reconcile_fixture(spark, tx):
    o, p = tx
    # the union's watermark is the min of both inputs: both must move on for timers to fire
    tick = spark.createDataFrame([(9, "tick", "create", "1558431000")], o.schema)
    ptick = spark.createDataFrame([(9, "tick", "none", "1558431000")], p.schema)
    d = tempfile.mkdtemp(prefix="tidemark-tx-")

    def to_files(df, sub, parts):
        os.makedirs(os.path.join(d, sub))
        pdf = df.withColumn("ts", F.timestamp_seconds(F.col("event_time").cast("long"))).toPandas()
        for i, part in enumerate(parts):
            write_part(pdf.iloc[part], os.path.join(d, sub, f"p{i}.parquet"), i)
        return df.withColumn("ts", F.timestamp_seconds(F.col("event_time").cast("long"))).schema

    so = to_files(o.unionByName(tick), "orders", [list(range(6)), [6]])
    sp = to_files(p.unionByName(ptick), "pays", [[0, 1, 2], [3]])
    os_ = spark.readStream.schema(so).option("maxFilesPerTrigger", 1).parquet(os.path.join(d, "orders"))
    ps_ = spark.readStream.schema(sp).option("maxFilesPerTrigger", 1).parquet(os.path.join(d, "pays"))
    out = run(stream_reconcile(os_, ps_, "order_id", "ts", "ts", "seq", "seq", wait="3 seconds"))
    got = sorted((r.key, r.kind) for r in out.collect())
    # create and pay rows of an order are one side; its later row is the one that meets the payment
    assert got == [("1", "matched"), ("2", "matched"), ("3", "unmatched_order"), ("4", "unmatched_pay"),
                   ("tick", "matched")]
    detail = [r.order_detail for r in out.collect() if r.kind == "unmatched_order" and r.key == "3"][0]
    assert '"event_type":"pay"' in detail and '"event_time":"1558430849"' in detail

    # built-in interval join over the order side's pay rows
    from tidemark.streaming import stream_reconcile_join

    j = run(stream_reconcile_join(os_.filter("event_type <> 'create' OR order_id = 'tick'"), ps_, "order_id", tolerance="3 seconds"))
    got = sorted((r.key, r.kind) for r in j.collect())
    assert ("1", "matched") in got and ("2", "matched") in got
    assert ("3", "unmatched_order") in got and ("4", "unmatched_pay") in got


def test_stream_marketing_and_approx(spark, events, stream_dir):
    from tidemark import marketing_counts
    from tidemark.streaming import stream_marketing_counts, stream_unique_approx

    s = read_stream(spark, events, stream_dir).select(
        "ts", F.lit("events").alias("channel"), F.col("event_type").alias("behavior"), "user_id")
    b = events.select("ts", F.lit("events").alias("channel"), F.col("event_type").alias("behavior"), "user_id")
    cols = ["window_start", "window_end", "channel", "behavior", "cnt"]
    for total in (False, True):
        got = set(rows(run(stream_marketing_counts(s, size="1 hour", slide="10 minutes", exclude="signup",
                                                   total=total)), cols))
        want = set(rows(marketing_counts(b, size="1 hour", slide="10 minutes", exclude="signup",
                                         by_key=not total, total=total), cols))
        last = max_t_us(events, "event_type <> 'signup'") // 1_000_000
        closed = {r for r in want if _epoch(r[1]) <= last}
        assert closed and got <= want and closed <= got
    uv = rows(run(stream_unique_approx(s, "user_id", "1 day")), ["window_end", "uv"])
    assert uv and all(n > 0 for _, n in uv)


def test_stream_daily_cap_processing_time(spark, events, stream_dir):
    s = prepare(read_stream(spark, events, stream_dir).select("event_id", "ts", "user_id", "event_type"),
                "ts", "event_id")
    out = run(stream_daily_cap(s, ["user_id", "event_type"], 2, day_mode="processing"),
              expect_rows=events.count())
    # one wall-clock day: each key passes its first 3 rows overall and warns once
    batch = events.select("event_id", "user_id", "event_type").withColumn("ts", F.lit(0))
    from pyspark.sql import Window

    w = Window.partitionBy("user_id", "event_type").orderBy("event_id")
    want = batch.withColumn("rn", F.row_number().over(w)).filter("rn <= 4")
    want = {(r.event_id, "pass" if r.rn <= 3 else "warning") for r in want.collect()}
    assert set(rows(out, ["event_id", "kind"])) == want


def test_stream_update_mode_upsert(spark, events, stream_dir):
    """T6 + S6: update mode refines each window's count every micro-batch; the
    upsert log keeps the latest per window, which equals the batch count for
    every window (open ones included)."""
    from tidemark import tumbling_count
    from tidemark.sinks import read_upserted, upsert_sink
    from tidemark.streaming import stream_tumbling_count

    s = read_stream(spark, events, stream_dir)
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-upsert-"), "counts")
    q = upsert_sink(stream_tumbling_count(s, "6 hours"), ["window_end"], path, checkpoint_location(spark, "upsert"))
    q.processAllAvailable()
    q.stop()
    got = set(rows(read_upserted(spark, path, ["window_end"]), ["window_end", "cnt"]))
    want = set(rows(tumbling_count(events, "6 hours"), ["window_end", "cnt"]))
    assert got == want


def _epoch(text):
    import datetime as dt

    return int(dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=dt.timezone.utc).timestamp())


def _files(spark, rows, schema, cuts, name):
    """Rows (with ``t`` seconds) as a stream of the given consecutive parts."""
    import pandas as pd

    d = tempfile.mkdtemp(prefix=f"tidemark-{name}-")
    cols = [c.split()[0] for c in schema.split(", ")]
    pdf = pd.DataFrame(rows, columns=cols)
    pdf["ts"] = pd.to_datetime(pdf["t"], unit="s")
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(pdf)])):
        write_part(pdf.iloc[a:b], os.path.join(d, f"p{i}.parquet"), i)
    s = spark.createDataFrame([], schema + ", ts timestamp").schema
    return spark.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(d)


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 2), (3, 4)])
def test_stream_daily_cap_with_disorder_equals_batch(spark, seed, parts):
    import random

    r = random.Random(seed)
    day = 86_400
    rows = [(i, r.choice("xy"), (20 + i // 60) * day + r.choice([-30, -5, 10, 40]) * 60) for i in range(180)]
    schema = "seq long, k string, t long"
    cuts = sorted(r.sample(range(1, 180), parts - 1))
    s = prepare(_files(spark, rows, schema, cuts, "cap"), "ts", "seq", watermark="3 days")
    got = rows_of(run(stream_daily_cap(s, ["k"], 3, order="arrival")), ["seq", "kind"])
    batch = daily_cap(spark.createDataFrame(rows, schema), ["k"], 3, ts="t", unit="s", seq="seq", order="arrival")
    assert got == rows_of(batch, ["seq", "kind"])


def rows_of(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("seed,parts", [(4, 1), (5, 2), (6, 4)])
def test_stream_reconcile_equals_batch_however_cut(spark, seed, parts):
    import random

    from tidemark import reconcile

    r = random.Random(seed)
    base = 1_700_000_000
    keys = [str(i) for i in range(40)]
    orders = sorted((base + r.randrange(100), k) for k in keys if r.random() < 0.8)
    pays = sorted((base + r.randrange(100), k) for k in keys if r.random() < 0.8)
    # the last rows move the watermark past everything
    orders, pays = orders + [(base + 1000, "tick")], pays + [(base + 1000, "tick")]
    o = [(i, k, t) for i, (t, k) in enumerate(orders)]
    p = [(i, k, t) for i, (t, k) in enumerate(pays)]
    schema = "seq long, order_id string, t long"

    def cut(n):
        return sorted(r.sample(range(1, n - 1), parts - 1)) + [n - 1]

    so, sp = _files(spark, o, schema, cut(len(o)), "o"), _files(spark, p, schema, cut(len(p)), "p")
    out = run(stream_reconcile(so, sp, "order_id", "ts", "ts", "seq", "seq", wait="20 seconds",
                               watermark="200 seconds"))
    b = reconcile(spark.createDataFrame(o, schema), spark.createDataFrame(p, schema), "order_id", "t", "t", "seq", "seq",
                  unit="s", tolerance="20 seconds")
    assert [x for x in rows_of(out, ["key", "kind"]) if x[0] != "tick"] == \
        [x for x in rows_of(b, ["order_id", "kind"]) if x[0] != "tick"]


class _State:
    """Stand-in for the state store: what a processor keeps for one key."""

    def __init__(self):
        self.values, self.timers = {}, set()

    def getListState(self, name, schema):
        store = self.values.setdefault(name, [])

        class L:
            exists = staticmethod(lambda: bool(store))
            get = staticmethod(lambda: iter(list(store)))
            put = staticmethod(lambda rows: store.__setitem__(slice(None), rows))
            appendValue = staticmethod(store.append)
            clear = staticmethod(store.clear)
        return L

    def getValueState(self, name, schema):
        store = self.values.setdefault(name, [])

        class V:
            exists = staticmethod(lambda: bool(store))
            get = staticmethod(lambda: store[0])
            update = staticmethod(lambda v: store.__setitem__(slice(None), [v]))
            clear = staticmethod(store.clear)
        return V

    def registerTimer(self, ms):
        self.timers.add(ms)


class _Wm:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


@pytest.mark.parametrize("kind", ["sequence", "timeout"])
def test_idle_keys_hold_no_state(kind):
    import random

    from pyspark.sql import Row
    from pyspark.sql import types as T

    from tidemark.streaming import stateful

    fields = [T.StructField("k", T.LongType()), T.StructField("typ", T.StringType())]
    for seed in range(30):
        r = random.Random(seed)
        if kind == "sequence":
            proc = stateful.SequenceProcessor(fields, "k", "typ", ["create", "pay"], 5_000_000, ("match", "timeout"), ["typ"])
        else:
            proc = stateful.OrderTimeoutProcessor(fields, "typ", "create", 5_000_000)
        h = _State()
        proc.init(h)
        # some keys never see a start
        types = ["pay"] if seed % 3 == 0 else ["create", "pay", "other"]
        t, wm = 0, 0
        for _ in range(40):
            t += r.randrange(3_000_000)
            list(proc.handleInputRows((None,), [Row(k=None, typ=r.choice(types), _t=t, _seq=t)], _Wm(wm)))
            wm = t // 1000
            while any(x <= wm for x in h.timers):
                x = min(h.timers)
                h.timers.discard(x)
                list(proc.handleExpiredTimer((None,), _Wm(wm), _Wm(x)))
        wm = t // 1000 + 60_000
        while h.timers:
            x = min(h.timers)
            if x > wm:
                wm = x
            h.timers.discard(x)
            list(proc.handleExpiredTimer((None,), _Wm(wm), _Wm(x)))
        assert not any(h.values.values()), (seed, h.values)


def test_stream_sequence_emits_whole_rows(spark):
    rows = [(0, 7, "create", "a", 100), (1, 7, "pay", "b", 102), (2, 8, "create", "c", 103), (3, 9, "x", "d", 500)]
    s = prepare(_files(spark, rows, "seq long, oid long, event_type string, ip string, t long", [2, 3], "seqrows"), "ts", "seq")
    out = run(stream_match_sequence(s, "oid", ["create", "pay"], "5 seconds", emit=("match", "timeout")))
    got = {(r.oid, r.kind, r.ip_0, r.ip_1, r.event_type_1) for r in out.collect()}
    assert got == {(7, "match", "a", "b", "pay"), (8, "timeout", "c", None, None)}


def test_late_rows_are_dropped(spark):
    """A row two micro-batches late for its window is not counted."""
    from tidemark.streaming import stream_tumbling_count

    rows = [(0, 10), (1, 20), (2, 4000), (3, 9000), (4, 9100), (5, 30), (6, 9200), (7, 20000)]
    s = _files(spark, rows, "seq long, t long", [2, 4, 5, 7], "late")
    got = dict((r.window_end, r.cnt) for r in run(stream_tumbling_count(s, "1 hour")).collect())
    assert got[3_600_000] == 2 and got[7_200_000] == 1 and got[10_800_000] == 3


def test_stream_cap_then_windows(spark, events, stream_dir):
    """A8 on a stream: the daily cap, then sliding counts over what passes."""
    s = prepare(read_stream(spark, events, stream_dir).select("event_id", "ts", "user_id", "event_type"), "ts", "event_id")
    passed = stream_daily_cap(s, ["user_id", "event_type"], 2, event_time="ts").filter("kind = 'pass'")
    got = set(rows(run(stream_sliding_count(passed, ["event_type"], "1 hour", "5 minutes", chained=True)),
                   ["event_type", "window_end", "cnt"]))
    b = daily_cap(events, ["user_id", "event_type"], 2, seq="event_id").filter("kind = 'pass'")
    want = set(rows(sliding_count(b, ["event_type"], "1 hour", "5 minutes"), ["event_type", "window_end", "cnt"]))
    horizon = max_t_us(events) // 1000
    assert got <= want and {x for x in want if x[1] < horizon} <= got


def test_stream_bitmap_refined_upsert_and_restart(spark, events, stream_dir):
    """A5 + T6 + S6: bitmap visitors refined per micro-batch, stopped and restarted."""
    from tidemark.operators.distinct import unique_per_window_bitmap
    from tidemark.sinks import compact_upserted, read_upserted, upsert_batch
    from tidemark.streaming import stream_unique_bitmap, unique_from_buckets

    root = tempfile.mkdtemp(prefix="tidemark-uv-")
    path, ck, keys = os.path.join(root, "log"), os.path.join(root, "ck"), ["window_end", "bucket"]
    src = tempfile.mkdtemp(prefix="tidemark-uvin-")
    files = sorted(os.listdir(stream_dir))

    def go(run_no=0):
        s = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = (stream_unique_bitmap(s, "user_id", "6 hours").writeStream.outputMode("update")
             .option("checkpointLocation", ck).foreachBatch(upsert_batch(path, keys, run_no))
             .trigger(availableNow=True).start())
        q.awaitTermination()

    import shutil

    for part in (files[:2], files[2:]):  # the second pass restarts from the checkpoint
        for f in part:
            shutil.copy2(os.path.join(stream_dir, f), os.path.join(src, f))
        go()
    want = set(rows(unique_per_window_bitmap(events, "user_id", "6 hours"), ["window_end", "uv"]))
    assert set(rows(unique_from_buckets(read_upserted(spark, path, keys)), ["window_end", "uv"])) == want
    # a later run's low epochs are newer than an earlier run's high ones
    spark_row = spark.createDataFrame([(1, 0, 60)], "window_end long, bucket long, uv long")
    upsert_batch(path, keys, run=0)(spark_row.withColumn("uv", F.lit(7).cast("long")), 900)
    upsert_batch(path, keys, run=1)(spark_row, 0)
    assert read_upserted(spark, path, keys).filter("window_end = 1").first().uv == 60
    compact_upserted(spark, path, keys, os.path.join(root, "log2"), run=2)
    assert rows(read_upserted(spark, os.path.join(root, "log2"), keys), ["window_end", "bucket", "uv"]) == \
        rows(read_upserted(spark, path, keys), ["window_end", "bucket", "uv"])


def test_upsert_keeps_the_latest_of_a_batch(spark):
    from tidemark.sinks import read_upserted, upsert_batch

    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-order-"), "log")
    upsert_batch(path, ["k"], order="v")(spark.createDataFrame([(1, 5), (1, 9), (1, 7)], "k long, v long"), 0)
    assert [tuple(r) for r in read_upserted(spark, path, ["k"]).collect()] == [(1, 9)]


def test_program_streams_from_the_command_line(spark):
    from tidemark import __main__ as cli

    root = tempfile.mkdtemp(prefix="tidemark-cli-")
    src, out, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("".join(f"u{i % 7},i{i % 3},c,pv,{i * 60}\n" for i in range(300)))
    for job in ("page_views", "hot_items", "unique_visitors"):
        cli.main([job, src, "--stream", "--out", out, "--checkpoint", ck, "--available-now"])
    pv = {r.window_end: r.pv for r in spark.read.parquet(f"{out}/page_views_0").collect()}
    assert pv[3_600_000] == 60 and pv[14_400_000] == 60
    assert spark.read.parquet(f"{out}/hot_items_0").filter("rank = 1").count() > 0
    assert {r.uv for r in spark.read.parquet(f"{out}/unique_visitors_0").collect()} == {7}
    clicks = os.path.join(root, "clicks")
    os.makedirs(clicks)
    with open(os.path.join(clicks, "a.csv"), "w") as f:
        f.write("".join(f"1,2,bj,bj,{i}\n" for i in range(200)) + "3,3,sh,sh,20000\n")
    cli.main(["blacklist", clicks, "--stream", "--out", out, "--checkpoint", ck, "--available-now", "--max-count", "3"])
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{out}/blacklist_1").select("user_id", "ad_id").collect()] == [(1, 2)]
    assert spark.read.parquet(f"{out}/blacklist_0").agg(F.max("cnt")).first()[0] == 4


@pytest.mark.parametrize("kind", ["sequence", "timeout"])
def test_a_key_is_read_once_per_watermark(kind):
    """Many timers of a key expire together: the first settles all, the rest read nothing."""
    from pyspark.sql import Row
    from pyspark.sql import types as T

    from tidemark.streaming import stateful

    fields = [T.StructField("k", T.LongType()), T.StructField("typ", T.StringType())]
    proc = (stateful.SequenceProcessor(fields, "k", "typ", ["create", "pay"], 5_000_000, ("timeout",), ["typ"])
            if kind == "sequence" else stateful.OrderTimeoutProcessor(fields, "typ", "create", 5_000_000))
    h = _State()
    proc.init(h)
    n, step = 400, 6_000_000
    rows_ = [Row(k=1, typ="create", _t=i * step, _seq=i) for i in range(n)]
    list(proc.handleInputRows((1,), rows_, _Wm(0)))
    read = []
    state = proc.buf if kind == "sequence" else proc.starts
    get = state.get
    state.get = staticmethod(lambda: (read.append(1), get())[1])
    wm = n * step // 1000
    out = [r for x in sorted(h.timers) for r in proc.handleExpiredTimer((1,), _Wm(wm), _Wm(x))]
    assert len(out) == n and len(read) == 1
