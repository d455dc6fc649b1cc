"""Streaming forms of the per-key stateful operators (``transformWithState``).

Each processor keeps only what its rule needs per key, in the state store
(RocksDB), with event-time timers for what must wait for the watermark.
Decisions compare event times; they never rely on the order in which timers
fire.  The batch operators in ``tidemark.operators`` give the same answer on
bounded input once the watermark has passed every row (end of input does
not flush a stream).

Input frames carry ``_t`` (event time, epoch microseconds) and ``_seq``
(arrival tie-break); ``prepare`` adds both.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from heapq import nsmallest

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.text import CAP_WARNING, LOGIN_ALERT_SUFFIX
from ..functions.time import epoch_micros, parse_duration
from ..plans.ordered import floor_div

DAY_MS = 86_400_000


def prepare(df: DataFrame, ts: str = "ts", seq: str | None = None, watermark="0 seconds") -> DataFrame:
    """Add ``_t``/``_seq`` and declare the watermark on ``ts`` (TIMESTAMP)."""
    out = df.withColumn("_t", epoch_micros(df, ts))
    out = out.withColumn("_seq", F.col(seq).cast("long") if seq else F.lit(0).cast("long"))
    return out.withWatermark(ts, watermark if isinstance(watermark, str)
                             else f"{parse_duration(watermark)} microseconds")


def _wm_us(timer_values) -> int:
    return int(timer_values.getCurrentWatermarkInMs()) * 1000


def _settled(state, wm: int) -> bool:
    """True if ``state`` has the watermark; else it is noted: the first of a batch's
    timers of a key reads its rows, the others have nothing left to do."""
    if state.exists() and state.get()[0] == wm:
        return True
    state.update((wm,))
    return False


def _user_fields(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if f.name not in ("_t", "_seq")]


def _emit(r: Row, cols: Sequence[str], **extra) -> Row:
    d = {c: r[c] for c in cols}
    d.update(extra)
    return Row(**d)


# --------------------------------------------------------------------------- R1
class DailyCapProcessor(StatefulProcessor):
    """Rows 1..max+1 of a key per day pass, row max+2 warns once, the rest drop.

    ``day_mode='event'``: one state per (key, UTC day of the row), so rows of
    neighbouring days may mix in any order; it is cleared when the watermark
    passes the day.  ``'processing'``: one state per key, reset at the next UTC
    midnight of the wall clock, as the reference does.
    """

    def __init__(self, cols: Sequence[str], max_count: int, day_mode: str = "event", order: str = "event", day_at: int = -1):
        self.cols, self.max_count, self.day_mode, self.order = list(cols), max_count, day_mode, order
        self.day_at = day_at  # where the key holds the day

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("cap", "day long, cnt long, warned boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        day, cnt, warned = self.state.get() if self.state.exists() else (None, 0, False)
        msg = CAP_WARNING.format(max=self.max_count)
        by = (lambda r: r["_seq"]) if self.order == "arrival" else (lambda r: (r["_t"], r["_seq"]))
        # however many rows a batch brings, only the first ones can still pass or warn
        for r in nsmallest(max(self.max_count + 2 - cnt - warned, 0), rows, key=by):
            if day is None:
                now = int(timerValues.getCurrentProcessingTimeInMs())
                day = key[self.day_at] if self.day_mode == "event" else now // DAY_MS
                self.handle.registerTimer((day + 1) * DAY_MS)
            if cnt > self.max_count:
                if not warned:
                    warned = True
                    yield _emit(r, self.cols, kind="warning", msg=msg)
                continue
            cnt += 1
            yield _emit(r, self.cols, kind="pass", msg=None)
        for _ in rows:  # a key that has warned drops its rows unread
            pass
        if day is not None:
            self.state.update((day, cnt, warned))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists() and (self.state.get()[0] + 1) * DAY_MS <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_daily_cap(df: DataFrame, keys: Sequence[str], max_count: int = 100,
                     day_mode: str = "event", order: str = "event", event_time: str | None = None,
                     salts: int = 1) -> DataFrame:
    """Run R1 on a ``prepare``d stream; columns = input + kind + msg.

    With ``salts`` (event days, ``event_time`` named) a first stage caps each key's
    rows per salt at the max + 2 that can matter, so that a hot key is spread
    over that many tasks and the second stage meets at most salts x (max + 2) rows
    of it a day.

    ``order`` sorts the rows of a micro-batch: by (time, seq), or ``'arrival'``
    by ``seq``, which equals the batch operator's arrival order however the
    stream is cut.  ``event_time`` names the watermarked column, so that
    event-time operators may follow (``stream_sliding_count(chained=True)``).
    """
    fields = _user_fields(df.schema)
    schema = T.StructType(fields + [T.StructField("kind", T.StringType()), T.StructField("msg", T.StringType())])
    by = list(keys)
    if day_mode == "event":
        df = df.withColumn("_day", floor_div(F.col("_t"), DAY_MS * 1000))
        by.append("_day")
    mode = "EventTime" if day_mode == "event" else "ProcessingTime"
    if salts > 1:
        if day_mode != "event" or not event_time:
            raise ValueError("salts need event days and a named event time")
        names = df.columns
        marked = T.StructType(df.schema.fields + [T.StructField("kind", T.StringType()), T.StructField("msg", T.StringType())])
        first = DailyCapProcessor(names, max_count + 1, day_mode, order, day_at=-2)
        spread = df.withColumn("_salt", F.pmod(F.xxhash64("_t", "_seq"), F.lit(salts)).cast("int"))
        df = (spread.groupBy(*by, "_salt").transformWithState(first, marked, "Append", mode, eventTimeColumnName=event_time)
                    .filter(F.col("kind") == "pass").select(*names))
    proc = DailyCapProcessor([f.name for f in fields], max_count, day_mode, order)
    return df.groupBy(*by).transformWithState(proc, schema, "Append", mode, eventTimeColumnName=event_time or "")


# --------------------------------------------------------------------------- F1
class ConsecutiveEventProcessor(StatefulProcessor):
    """on an ``event`` row, alert if the key's previous row (arrival order)
    was ``event`` less than ``gap`` earlier; any other type resets."""

    def __init__(self, cols, key: str, type_col: str, event: str, gap_us: int):
        self.cols, self.key, self.type_col, self.event, self.gap = list(cols), key, type_col, event, gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "t long, seq long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get() if self.last.exists() else None
        for r in sorted(rows, key=lambda r: r["_seq"]):
            if r[self.type_col] == self.event:
                if last is not None and r["_t"] < last[0] + self.gap:
                    yield _emit(r, self.cols, prev_seq=last[1],
                                msg=f"{r[self.key]}{LOGIN_ALERT_SUFFIX}")
                last = (r["_t"], r["_seq"])
            else:
                last = None
        if last is None:
            self.last.clear()
        else:
            self.last.update(last)

    def close(self) -> None:
        pass


def stream_consecutive_events(df: DataFrame, key: str, type_col: str = "event_type",
                              event: str = "fail", gap="2 seconds") -> DataFrame:
    fields = _user_fields(df.schema)
    schema = T.StructType(fields + [T.StructField("prev_seq", T.LongType()),
                                    T.StructField("msg", T.StringType())])
    proc = ConsecutiveEventProcessor([f.name for f in fields], key, type_col, event, parse_duration(gap))
    return df.groupBy(key).transformWithState(proc, schema, "Append", "None")


# --------------------------------------------------------------------------- F2/F3
def _kept_schema(fields, extra: str) -> T.StructType:
    """State rows: bookkeeping columns, then the user's."""
    return T.StructType(T._parse_datatype_string(extra).fields + [T.StructField(f.name, f.dataType) for f in fields])


class SequenceProcessor(StatefulProcessor):
    """strict-contiguity pattern per key in event-time order.

    A start waits until the watermark passes ``start + within``; then every row
    its outcome depends on has arrived, and it is judged exactly like the batch
    ``match_sequence``.  Kept are the rows from the earliest open start on and,
    while none is open, rows the watermark has not passed (an earlier start may
    still come); a timer per row frees both, so idle keys hold nothing.
    """

    def __init__(self, fields, key: str, type_col: str, steps: Sequence[str], within_us: int, emit: Sequence[str],
                 carry: Sequence[str]):
        self.key, self.type_col, self.steps = key, type_col, list(steps)
        self.w, self.emit, self.carry = within_us, set(emit), list(carry)
        self.cols = [f.name for f in fields]
        self.schema = _kept_schema(fields, "_kt long, _ks long")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", self.schema)
        self.settled = handle.getValueState("settled", "wm long")
        self.typ, self.own = 2 + self.cols.index(self.type_col), 2 + self.cols.index(self.key)

    def _load(self):
        return sorted((tuple(x) for x in self.buf.get()), key=lambda x: x[:2]) if self.buf.exists() else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in rows:
            t = r["_t"]
            self.buf.appendValue((t, r["_seq"], *(r[c] for c in self.cols)))
            self.settled.clear()
            start = r[self.type_col] == self.steps[0]
            self.handle.registerTimer(-(-(t + self.w) // 1000) if start else t // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wm = _wm_us(timerValues)
        if not self.buf.exists() or _settled(self.settled, wm):  # an earlier timer of this batch settled all
            return iter([])
        buf = self._load()
        out, keep_from = [], None
        for i, row in enumerate(buf):
            t, seq = row[:2]
            if row[self.typ] != self.steps[0]:
                continue
            if t + self.w > wm:
                keep_from = i if keep_from is None else keep_from
                continue
            kind = "match"
            for step in range(1, len(self.steps)):
                nx = buf[i + step] if i + step < len(buf) else None
                if nx is None or nx[0] - t >= self.w:
                    kind = "timeout"
                    break
                if nx[self.typ] != self.steps[step]:
                    kind = "broken"
                    break
            if kind in self.emit:
                steps = buf[i:i + len(self.steps)] if kind == "match" else [row]
                d = {self.key: row[self.own], "kind": kind, "start_t": t, "start_seq": seq,
                     "end_seq": steps[-1][1] if kind == "match" else None}
                for n in range(len(self.steps)):
                    for c in self.carry:
                        d[f"{c}_{n}"] = steps[n][2 + self.cols.index(c)] if n < len(steps) else None
                out.append(Row(**d))
        left = buf[keep_from:] if keep_from is not None else [x for x in buf if x[0] > wm]
        self.buf.clear()
        if left:
            self.buf.put(left)
        else:
            self.settled.clear()
        return iter(out)

    def close(self) -> None:
        pass


def stream_match_sequence(df: DataFrame, key: str, steps: Sequence[str], within,
                          type_col: str = "event_type", emit=("match",), carry: Sequence[str] | None = None) -> DataFrame:
    """F2/F3 on a ``prepare``d stream: the key (its own type), kind, start_t,
    start_seq, end_seq, and ``<c>_<i>`` for each carried column of step i
    (default: every input column but the key)."""
    fields = _user_fields(df.schema)
    carry = [f.name for f in fields if f.name != key] if carry is None else list(carry)
    types = {f.name: f.dataType for f in fields}
    schema = T.StructType([T.StructField(key, types[key])]
                          + T._parse_datatype_string("kind string, start_t long, start_seq long, end_seq long").fields
                          + [T.StructField(f"{c}_{i}", types[c]) for i in range(len(steps)) for c in carry])
    proc = SequenceProcessor(fields, key, type_col, steps, parse_duration(within), emit, carry)
    return df.groupBy(key).transformWithState(proc, schema, "Append", "EventTime")


# --------------------------------------------------------------------------- F4
class OrderTimeoutProcessor(StatefulProcessor):
    """F4 contract: alert start c unless another start lies in [c-limit, c) or
    a non-start in [c, c+limit]; judged once the watermark passes c+limit.

    Other rows are kept as times only, while an open or possible start may need
    them; every kept row has a timer, so idle keys hold nothing.
    """

    def __init__(self, fields, type_col: str, start: str, limit_us: int):
        self.type_col, self.start, self.lim = type_col, start, limit_us
        self.cols = [f.name for f in fields]
        self.schema = _kept_schema(fields, "_kt long, _ks long, _kd boolean")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.starts = handle.getListState("starts", self.schema)
        self.others = handle.getListState("others", "t long")
        self.settled = handle.getValueState("settled", "wm long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in rows:
            t = r["_t"]
            self.settled.clear()
            if r[self.type_col] == self.start:
                self.starts.appendValue((t, r["_seq"], False, *(r[c] for c in self.cols)))
                self.handle.registerTimer((t + self.lim) // 1000 + 1)
            else:
                self.others.appendValue((t,))
                self.handle.registerTimer(t // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wm = _wm_us(timerValues)
        if not (self.starts.exists() or self.others.exists()) or _settled(self.settled, wm):
            return iter([])
        starts = sorted((tuple(x) for x in self.starts.get()), key=lambda x: x[:2]) if self.starts.exists() else []
        others = sorted(x[0] for x in self.others.get()) if self.others.exists() else []
        times = [x[0] for x in starts]
        out, after = [], []
        for row in starts:
            t, seq, done = row[:3]
            if not done and t + self.lim < wm:
                i, j = bisect_left(times, t), bisect_left(others, t)
                absorbed = i > 0 and times[i - 1] >= t - self.lim
                answered = j < len(others) and others[j] <= t + self.lim
                if not absorbed and not answered:
                    out.append(Row(**dict(zip(self.cols, row[3:])), start_t=t, start_seq=seq))
                row = (t, seq, True, *row[3:])
            after.append(row)
        first = min([x[0] for x in after if not x[2]] + [wm])  # open starts and those that may come
        left = [x for x in after if not x[2] or x[0] >= first - self.lim]
        # a judged start matters no longer than limit: free it by a timer of its own
        for x in left:
            if x[2]:
                self.handle.registerTimer((max(x[0] + self.lim, wm) // 1000) + 1)
        self.starts.clear()
        if left:
            self.starts.put(left)
        later = [(t,) for t in others if t >= first]
        self.others.clear()
        if later:
            self.others.put(later)
        if not left and not later:
            self.settled.clear()
        return iter(out)

    def close(self) -> None:
        pass


def stream_order_timeout(df: DataFrame, key: str, type_col: str = "event_type", start: str = "create",
                         limit="15 minutes") -> DataFrame:
    """F4 on a ``prepare``d stream: the alerted input rows with start_t, start_seq."""
    fields = _user_fields(df.schema)
    proc = OrderTimeoutProcessor(fields, type_col, start, parse_duration(limit))
    schema = T.StructType(fields + T._parse_datatype_string("start_t long, start_seq long").fields)
    return df.groupBy(key).transformWithState(proc, schema, "Append", "EventTime")


# --------------------------------------------------------------------------- J1
class ReconcileProcessor(StatefulProcessor):
    """Each side keeps its latest unmatched row.  A row of the other side at
    most ``wait`` away in event time makes the pair; if it is further away the
    earlier of the two has expired and is reported, the later one stays.  A row
    still alone when the watermark passes its time + ``wait`` is reported.
    Event times decide, so the answer does not depend on how rows are batched.
    Input rows carry ``_side`` ('order'/'pay') and a ``detail`` text."""

    def __init__(self, wait_us: int):
        self.wait = wait_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.order = handle.getValueState("order", "t long, detail string, timer long")
        self.pay = handle.getValueState("pay", "t long, detail string, timer long")

    def _timer(self, t: int) -> int:
        return (t + self.wait) // 1000 + 1

    def _alone(self, key, side: str, detail: str) -> Row:
        order = side == "order"
        return Row(key=key, kind=f"unmatched_{side}", order_detail=detail if order else None,
                   pay_detail=None if order else detail)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        k = key[0]
        for r in sorted(rows, key=lambda r: (r["_t"], r["_side"] == "pay", r["_seq"])):
            side, t = r["_side"], r["_t"]
            far = "pay" if side == "order" else "order"
            mine, other = (self.order, self.pay) if side == "order" else (self.pay, self.order)
            if other.exists():
                o = other.get()
                if abs(o[0] - t) <= self.wait:
                    self.handle.deleteTimer(o[2])
                    other.clear()
                    od, pd = (r["detail"], o[1]) if side == "order" else (o[1], r["detail"])
                    yield Row(key=k, kind="matched", order_detail=od, pay_detail=pd)
                    continue
                if t < o[0]:
                    yield self._alone(k, side, r["detail"])
                    continue
                self.handle.deleteTimer(o[2])
                other.clear()
                yield self._alone(k, far, o[1])
            if mine.exists():
                m = mine.get()
                if m[0] > t:
                    continue  # a later row of this side already waits
                self.handle.deleteTimer(m[2])
            tm = self._timer(t)
            mine.update((t, r["detail"], tm))
            self.handle.registerTimer(tm)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, out = expiredTimerInfo.getExpiryTimeInMs(), []
        for side, state in (("order", self.order), ("pay", self.pay)):
            if state.exists() and state.get()[2] <= now:
                out.append(self._alone(key[0], side, state.get()[1]))
                state.clear()
        return iter(out)

    def close(self) -> None:
        pass


def stream_reconcile(orders: DataFrame, pays: DataFrame, key: str, orders_ts: str = "ts",
                     pays_ts: str = "ts", orders_seq: str | None = None, pays_seq: str | None = None,
                     wait="0 seconds", watermark="0 seconds") -> DataFrame:
    """J1 on two streams (each with a TIMESTAMP ``*_ts`` column)."""
    def side(df, ts, seq, name):
        d = df.select(F.col(key).cast("string").alias(key), F.col(ts).alias("_ts"),
                      epoch_micros(df, ts).alias("_t"),
                      (F.col(seq).cast("long") if seq else F.lit(0).cast("long")).alias("_seq"),
                      F.lit(name).alias("_side"),
                      F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("detail"))
        return d.withWatermark("_ts", watermark)
    both = side(orders, orders_ts, orders_seq, "order").unionByName(side(pays, pays_ts, pays_seq, "pay"))
    return both.groupBy(key).transformWithState(
        ReconcileProcessor(parse_duration(wait)),
        "key string, kind string, order_detail string, pay_detail string", "Append", "EventTime")


def stream_reconcile_join(orders: DataFrame, pays: DataFrame, key: str, orders_ts: str = "ts",
                          pays_ts: str = "ts", tolerance="5 seconds", watermark="0 seconds") -> DataFrame:
    """J1 with Spark's own stream-stream join: full outer on the key and
    ``|pay.ts - order.ts| <= tolerance``, both sides watermarked.

    Every order row pairs with every pay row of its key inside the interval
    (no 'latest per key' reduction - filter the order side first, e.g. to
    pay rows, when one row per key is wanted); rows left alone are emitted
    with kind 'unmatched_*' once the watermark passes ts + tolerance.
    """
    tol = parse_duration(tolerance)
    o = orders.select(F.col(key).alias("_ok"), F.col(orders_ts).alias("_ots"),
                      F.struct(*[F.col(c) for c in orders.columns]).alias("order")).withWatermark("_ots", watermark)
    p = pays.select(F.col(key).alias("_pk"), F.col(pays_ts).alias("_pts"),
                    F.struct(*[F.col(c) for c in pays.columns]).alias("pay")).withWatermark("_pts", watermark)
    cond = ((F.col("_ok") == F.col("_pk"))
            & (F.col("_pts") >= F.col("_ots") - F.expr(f"INTERVAL {tol} MICROSECONDS"))
            & (F.col("_pts") <= F.col("_ots") + F.expr(f"INTERVAL {tol} MICROSECONDS")))
    j = o.join(p, cond, "full_outer")
    kind = (F.when(F.col("order").isNotNull() & F.col("pay").isNotNull(), F.lit("matched"))
             .when(F.col("order").isNotNull(), F.lit("unmatched_order")).otherwise(F.lit("unmatched_pay")))
    return j.select(F.coalesce("_ok", "_pk").cast("string").alias("key"), kind.alias("kind"), "order", "pay")
