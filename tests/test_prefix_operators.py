"""Operators built on prefix scans, against plain loops.  ``target_rows`` is small, so
that keys, windows and the whole table are cut on almost every case."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import (drop_late, hash61, order_timeout_state, reconcile_pairs, running_distinct, sliding_count,
                      sliding_count_on_time, unique_per_window, visitor_sketches, visitors_from_sketches)

LOOSE = settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
TARGETS = [7, 1 << 18]


def slow_pairs(orders, pays, tolerance):
    """(key, kind, order seq, pay seq) by one waiting row per key."""
    rows = sorted([(k, t, 0, q) for q, k, t in orders] + [(k, t, 1, q) for q, k, t in pays], key=lambda r: r[1:])
    waiting, out = {}, []

    def alone(k, w):
        out.append((k, "unmatched_order" if w[1] == 0 else "unmatched_pay", None if w[1] else w[2], w[2] if w[1] else None))

    for k, t, side, q in rows:
        w = waiting.pop(k, None)
        if w and tolerance is not None and t - w[0] > tolerance:
            alone(k, w)
            w = None
        if w and w[1] != side:
            out.append((k, "matched", q if side == 0 else w[2], q if side else w[2]))
        else:
            waiting[k] = (t, side, q)
    for k, w in waiting.items():
        alone(k, w)
    return sorted(out, key=repr)


@pytest.mark.parametrize("target", TARGETS)
@LOOSE
@given(seed=st.integers(0, 10_000), tolerance=st.sampled_from([None, 0, 2, 5]))
def test_reconcile_pairs_bruteforce(spark, target, seed, tolerance):
    rnd = random.Random(seed)
    rows = [(i, "hot" if rnd.random() < 0.6 else rnd.choice(["x", None]), rnd.randrange(40)) for i in range(70)]
    orders, pays = rows[:40], rows[40:]
    o = spark.createDataFrame(orders, "seq long, k string, t long")
    p = spark.createDataFrame([r + ("w",) for r in pays], "n long, k string, at long, channel string")
    got = reconcile_pairs(o, p, "k", "t", "at", "seq", "n", unit="s", tolerance=tolerance, bucket=3, target_rows=target)
    assert sorted(((r.k, r.kind, r.order and r.order.seq, r.pay and r.pay.n) for r in got.collect()), key=repr) == slow_pairs(
        orders, pays, tolerance)


def test_reconcile_pairs_repeats(spark, tx):
    """order, pay, order, pay of one key are two pairs; the literal rows give the reference's unmatched ones."""
    rows = [(0, "a", 1), (1, "a", 3)]
    o = spark.createDataFrame(rows, "seq long, k string, t long")
    p = spark.createDataFrame([(0, "a", 2), (1, "a", 4)], "seq long, k string, t long")
    got = reconcile_pairs(o, p, "k", "t", "t", "seq", "seq", unit="s")
    assert sorted((r.kind, r.order.seq, r.pay.seq) for r in got.collect()) == [("matched", 0, 0), ("matched", 1, 1)]
    assert {(r.kind, r.order.seq, r.pay.seq) for r in reconcile_pairs(o, p, "k", "t", "t", "seq", "seq", unit="s",
                                                                    tolerance=0, kinds=["matched"]).collect()} == set()
    orders, pays = tx
    r = reconcile_pairs(orders, pays, "order_id", "event_time", "event_time", "seq", "seq", unit="s").collect()
    alone = {(x.kind, x.order_id) for x in r if x.kind != "matched"}
    assert alone == {("unmatched_order", "3"), ("unmatched_pay", "4")} and len(r) == 4


def slow_machine(rows, limit, clock):
    """Alerted seqs; rows (seq, key, type, t), 'a' starts."""
    rows = sorted(rows, key=lambda r: (r[3], r[0]))
    saved, timers, out, seen = {}, {}, [], {}

    def fire(k, upto):
        for x in sorted(t for t in timers.get(k, []) if upto is None or t < upto):
            timers[k].remove(x)
            s = saved.pop(k, None)
            if s and s[1] == "a":
                out.append(s[0])

    for q, k, typ, t in rows:
        now = seen.get(None if clock == "stream" else ("k", k))
        if now is not None:
            fire(k, now)
        if typ != "a" or k not in saved:
            saved[k] = (q, typ)
        timers.setdefault(k, []).append(t + limit)
        seen[None] = seen["k", k] = t
    for k in list(timers):
        fire(k, None)
    return sorted(out)


@pytest.mark.parametrize("clock", ["stream", "key"])
@pytest.mark.parametrize("target", TARGETS)
@LOOSE
@given(seed=st.integers(0, 10_000), limit=st.integers(1, 9))
def test_order_timeout_state_bruteforce(spark, clock, target, seed, limit):
    rnd = random.Random(seed)
    rows = [(i, "hot" if rnd.random() < 0.6 else rnd.choice(["x", None]), rnd.choice("aaab"), rnd.randrange(60))
            for i in range(80)]
    df = spark.createDataFrame(rows, "seq long, k string, typ string, t long")
    got = order_timeout_state(df, "k", "typ", "a", limit, ts="t", unit="s", clock=clock, bucket=3, target_rows=target)
    assert sorted(r.seq for r in got.collect()) == slow_machine(rows, limit, clock)


@pytest.mark.parametrize("rows, alerts", [
    ([("o", "create", 0), ("o", "pay", 5)], []),                                        # exactly at the limit
    ([("o", "create", 0), ("o", "create", 1), ("o", "pay", 2)], []),                    # first start kept, overwritten
    ([("o", "pay", 0), ("o", "create", 1)], []),                                        # a pay in the state suppresses
    ([("o", "create", 0), ("o", "pay", 6)], []),                                        # time stood still until the pay
    ([("o", "create", 0), ("z", "pay", 6), ("o", "pay", 6)], [0]),                      # another key moved it
    ([("o", "create", 0), ("o", "pay", 3), ("z", "pay", 6), ("o", "create", 6), ("z", "pay", 9)], [3]),  # 2 s early
])
def test_order_timeout_state_cases(spark, rows, alerts):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, k string, event_type string, t long")
    got = order_timeout_state(df, "k", limit=5, ts="t", unit="s")
    assert sorted(r.seq for r in got.collect() if r.k == "o") == alerts


def slow_open(rows, delay, size, slide):
    """seq -> open window ends; rows (seq, key, t)."""
    seen, out = None, {}
    for q, k, t in sorted(rows):
        first = t - t % slide + slide
        out[q] = [e for e in range(first, first + size, slide) if seen is None or e > seen - delay]
        seen = t if seen is None else max(seen, t)
    return out


@pytest.mark.parametrize("target", TARGETS)
@LOOSE
@given(seed=st.integers(0, 10_000), delay=st.sampled_from([0, 3, 7]), mult=st.integers(1, 4), slide=st.sampled_from([1, 2, 5]))
def test_drop_late_bruteforce(spark, target, seed, delay, mult, slide):
    rnd = random.Random(seed)
    rows = [(i * 3, rnd.choice("xyz"), max(0, i + rnd.randrange(-25, 10))) for i in range(60)]
    df = spark.createDataFrame(rows, "seq long, k string, t long")
    want = slow_open(rows, delay, mult * slide, slide)
    got = drop_late(df, "t", "seq", delay, mult * slide, slide, unit="s", target_rows=target)
    assert {r.seq: r.open_from // 1000 for r in got.collect()} == {q: min(e) for q, e in want.items() if e}
    counts = {}
    for q, k, _ in rows:
        for e in want[q]:
            counts[k, e * 1000] = counts.get((k, e * 1000), 0) + 1
    c = sliding_count_on_time(df, ["k"], mult * slide, slide, "t", "seq", delay, unit="s", block=7, target_rows=target)
    assert {(r.k, r.window_end): r.cnt for r in c.collect()} == counts


def test_drop_late_keeps_ordered_rows(spark):
    df = spark.createDataFrame([(i, i // 2) for i in range(40)], "seq long, t long")
    assert drop_late(df, "t", "seq", size=4, unit="s").count() == 40
    a = sliding_count_on_time(df, None, 4, 2, "t", "seq", unit="s")
    assert sorted(a.collect()) == sorted(sliding_count(df, None, 4, 2, "t", "s").collect())
    assert drop_late(df.limit(0), "t", "seq", size=4, unit="s").count() == 0


@pytest.mark.parametrize("hashed", [False, True])
@pytest.mark.parametrize("target", TARGETS)
@LOOSE
@given(seed=st.integers(0, 10_000))
def test_running_distinct_bruteforce(spark, target, hashed, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["a", "b", "c", "dd", "e", None]), rnd.choice([1, 2, 3, 25])) for i in range(80)]
    df = spark.createDataFrame(rows, "seq long, u string, t long")
    code = {r.u: r.h for r in df.select("u", hash61(F.col("u")).alias("h")).distinct().collect()}
    seen, want = {}, {}
    for q, u, t in rows:
        end = (t // 10 + 1) * 10_000
        users = seen.setdefault(end, set())
        if u is not None:
            users.add(code[u] if hashed else u)
        want[q] = (end, len(users))
    got = running_distinct(df, "u", 10, "t", "seq", unit="s", hashed=hashed, target_rows=target)
    assert {r.seq: (r.window_end, r.uv) for r in got.collect()} == want


def test_stored_sketches_merge_into_longer_windows(spark, tmp_path):
    rows = spark.range(86_400).select((F.col("id") % 50_000).alias("user_id"), (F.col("id") % 86_400).alias("t"))
    visitor_sketches(rows, "user_id", "1 hour", "t", "s").write.parquet(str(tmp_path / "hourly"))
    stored = spark.read.parquet(str(tmp_path / "hourly"))
    assert stored.count() == 24
    exact = unique_per_window(rows, "user_id", "1 day", "t", "s").collect()
    merged = visitors_from_sketches(stored, "1 day").collect()
    assert [r.window_end for r in merged] == [r.window_end for r in exact] == [86_400_000]
    assert abs(merged[0].uv / exact[0].uv - 1) < 4 * 1.04 / 2 ** 8  # 4 standard errors at 2^16 registers
