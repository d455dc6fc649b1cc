"""Stateful stream operators with bounded state: pane counts, top-N, capped hot keys."""

import datetime as dt
import os
import random
import tempfile
import tracemalloc

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import daily_cap, sliding_count, top_n_per_window
from tidemark.streaming import prepare, stream_daily_cap, stream_pane_count, stream_top_n
from tidemark.streaming.panes import window_counts
from tidemark.streaming.stateful import DailyCapProcessor

from paths import SF
from test_streaming import events, read_stream, rows, run, stream_dir, write_part  # noqa: F401


def slow_windows(panes, size, slide, after, upto):
    return [(e, n) for e in range(after + slide, upto + slide, slide)
            if (n := sum(c for p, c in panes.items() if p <= e < p + size))]


def test_window_counts_bruteforce():
    rnd = random.Random(1)
    for _ in range(300):
        slide = rnd.choice([1, 2, 5])
        size = slide * rnd.randrange(1, 7)
        panes = {slide * rnd.randrange(1, 30): rnd.randrange(1, 4) for _ in range(rnd.randrange(6))}
        after = slide * rnd.randrange(0, 20)
        upto = after + slide * rnd.randrange(0, 30)
        assert sorted(window_counts(panes, size, slide, after, upto)) == slow_windows(panes, size, slide, after, upto)


@pytest.mark.parametrize("keys, size, slide", [(["event_type"], "6 hours", "30 minutes"), (None, "1 hour", "5 minutes")])
def test_pane_state_equals_batch(spark, events, stream_dir, keys, size, slide):  # noqa: F811
    got = run(stream_pane_count(read_stream(spark, events, stream_dir), keys, size, slide))
    last = events.agg(F.max(F.unix_millis("ts"))).first()[0]
    want = sliding_count(events, keys, size, slide).filter(F.col("window_end") <= last)
    cols = [*(keys or []), "window_end", "cnt"]
    assert rows(got, cols) == rows(want, cols)
    assert got.filter(F.unix_millis("window_time") != F.col("window_end")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_pane_state_with_late_rows(spark, seed):
    """A late row counts in the windows that the watermark before its batch left open."""
    rnd = random.Random(seed)
    base, folder, batches = 1_700_000_000, tempfile.mkdtemp(prefix="tidemark-late-"), []
    for i in range(5):
        part = [(rnd.choice(["a", "b", None]), base + max(0, 20 * i + rnd.randrange(-30, 20))) for _ in range(12)]
        batches.append(part)
        write_part(pd.DataFrame({"k": [k for k, _ in part], "ts": pd.to_datetime([t for _, t in part], unit="s")}),
                   os.path.join(folder, f"p{i}.parquet"), i)
    size, slide, lateness = 30, 5, 7
    want, mark = {}, None
    for part in batches:
        for k, t in part:
            for e in range(t - t % slide + slide, t - t % slide + slide + size, slide):
                if mark is None or e > mark:
                    want[k, e * 1000] = want.get((k, e * 1000), 0) + 1
        mark = max([t - lateness for _, t in part] + ([] if mark is None else [mark]))
    stream = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(folder)
    got = run(stream_pane_count(stream, "k", f"{size} seconds", f"{slide} seconds", lateness=lateness))
    assert {(r.k, r.window_end): r.cnt for r in got.collect()} == {x: n for x, n in want.items() if x[1] <= mark * 1000}


@pytest.mark.parametrize("salts", [1, 5])
def test_top_n_stream_equals_batch(spark, events, stream_dir, salts):  # noqa: F811
    item = F.get_json_object("props", "$.k").cast("long") % 9
    counts = stream_pane_count(read_stream(spark, events, stream_dir).withColumn("item_id", item), "item_id", "6 hours", "2 hours")
    got = run(stream_top_n(counts, 3, salts=salts))
    last = events.agg(F.max(F.unix_millis("ts"))).first()[0]
    whole = sliding_count(events.withColumn("item_id", item), "item_id", "6 hours", "2 hours")
    want = top_n_per_window(whole.filter(F.col("window_end") <= last), 3)
    cols = ["window_end", "item_id", "cnt", "rank"]
    assert rows(got, cols) == rows(want, cols)


def test_salted_cap_equals_batch(spark, events, stream_dir):  # noqa: F811
    src = prepare(read_stream(spark, events, stream_dir).withColumn("k", F.lit("hot")), seq="event_id")
    got = run(stream_daily_cap(src, ["k"], 4, event_time="ts", salts=6))
    want = daily_cap(events.withColumn("k", F.lit("hot")), ["k"], 4, seq="event_id")
    assert rows(got, ["event_id", "kind"]) == rows(want, ["event_id", "kind"])


class _State:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v


class _Handle:
    def getValueState(self, *_):
        return _State()

    def registerTimer(self, *_):
        pass


class _Times:
    def getCurrentProcessingTimeInMs(self):
        return 0


def test_a_hot_key_keeps_the_workers_memory_flat():
    """One key with 10^6 rows in a batch: the processor holds the few rows that can still matter."""
    proc = DailyCapProcessor(["n"], 100)
    proc.init(_Handle())
    n = 1_000_000
    tracemalloc.start()
    out = list(proc.handleInputRows(("hot", 0), ({"_t": (i * 7919) % n, "_seq": i, "n": i} for i in range(n)), _Times()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [r["kind"] for r in out] == ["pass"] * 101 + ["warning"] and peak < 2 << 20
    assert sorted((r["n"] * 7919) % n for r in out) == list(range(102))
    assert list(proc.handleInputRows(("hot", 0), iter([{"_t": 0, "_seq": n, "n": n}]), _Times())) == []
