"""Finely sliding counts and top-N as stateful stream operators.

``stream_pane_count`` keeps, per key, one number per pane (a slide-wide slice of
time): at most size / slide panes that still matter, whatever the number of
windows.  Rows are combined to panes inside their input partition before they are
shuffled, so a hot key costs a row per pane and partition, and are never copied
to the windows they belong to; a window comes to exist when it is emitted.

``stream_top_n`` ranks the rows of a window in two stages, so that no task holds a
window: heaps of at most n rows per (window, salt), merged per window.  Both
are append-mode streams, so other operators can follow.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.time import epoch_micros, floor_to, parse_duration


def _wm_us(timer_values) -> int:
    return int(timer_values.getCurrentWatermarkInMs()) * 1000


def window_counts(panes: dict[int, int], size: int, slide: int, after: int, upto: int) -> Iterator[tuple[int, int]]:
    """(window end, count) of the windows with rows that end in (after, upto].

    ``panes``: pane end -> rows.  A running sum walks over the window ends at which
    a pane enters or leaves; the ends in between repeat it."""
    turns: dict[int, int] = {}
    for end, n in panes.items():
        first = max(end, after + slide)
        if first < end + size:
            turns[first] = turns.get(first, 0) + n
            turns[end + size] = turns.get(end + size, 0) - n
    total, at = 0, sorted(turns)
    for i, e in enumerate(at):
        total += turns[e]
        stop = min(at[i + 1] if i + 1 < len(at) else e, upto + slide)
        if total:
            for w in range(e, stop, slide):
                yield w, total


class PaneCountProcessor(StatefulProcessor):
    """A2 per key from pane counts; a window is closed once the watermark reaches its
    end.  A late row counts in the windows of its pane that are still open."""

    def __init__(self, keys: Sequence[str], size: int, slide: int, out: str):
        self.keys, self.size, self.slide, self.out = list(keys), size, slide, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane long", "n long")
        self.done = handle.getValueState("done", "t long")

    def _floor(self, wm: int) -> int:
        return wm - wm % self.slide

    def _settle(self, key, wm: int) -> Iterator[Row]:
        """Emit the windows that the watermark has closed, forget panes that ended."""
        upto = self._floor(wm)
        after = self.done.get()[0] if self.done.exists() else None
        if after is not None and after >= upto:
            return
        panes = {k[0]: v[0] for k, v in self.panes.iterator()} if self.panes.exists() else {}
        if panes:
            since = min(panes) - self.slide if after is None else after
            for end, n in window_counts(panes, self.size, self.slide, since, upto):
                yield Row(**dict(zip(self.keys, key)), window_time=_timestamp(end), window_end=end // 1000, **{self.out: n})
        for p in panes:
            if p + self.size <= upto + self.slide:
                self.panes.removeKey((p,))
        left = [p for p in panes if p + self.size > upto + self.slide]
        if left:
            self.done.update((upto,))
            self._wake(max(min(left), upto + self.slide))
        else:
            self.panes.clear()
            self.done.clear()

    def _wake(self, end: int) -> None:
        self.handle.registerTimer(-(-end // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = _wm_us(timerValues)
        yield from self._settle(key, wm)
        upto = self._floor(wm)
        fresh: dict[int, int] = {}
        for r in rows:
            if r["_pe"] + self.size > upto + self.slide:  # its last window is open
                fresh[r["_pe"]] = fresh.get(r["_pe"], 0) + r["_n"]
        for p, n in fresh.items():
            old = self.panes.getValue((p,)) if self.panes.containsKey((p,)) else None
            self.panes.updateValue((p,), ((old[0] if old else 0) + n,))
        if fresh:
            # what is closed now never opens again, also for panes that came late
            if upto > 0 and not self.done.exists():
                self.done.update((upto,))
            self._wake(max(min(fresh), upto + self.slide))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._settle(key, _wm_us(timerValues))

    def close(self) -> None:
        pass


def _timestamp(us: int):
    import datetime as dt

    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=us)


def stream_pane_count(df: DataFrame, keys, size, slide, ts: str = "ts", lateness=0, out: str = "cnt",
                      chained: bool = False) -> DataFrame:
    """A2 (T4, T5) on a stream by pane state: ``keys``, ``window_time`` (the window's end
    as a timestamp, the event time of what follows), ``window_end`` (epoch ms), ``out``.

    The watermark lies ``lateness`` behind the largest ``ts``; windows with an end at or
    below it are emitted once and take no more rows.  ``chained``: the input comes from
    a stateful operator, whose watermark then closes the windows.
    """
    by = [] if keys is None else [keys] if isinstance(keys, str) else list(keys)
    z, s = parse_duration(size), parse_duration(slide)
    if z % s:
        raise ValueError("window size must be a multiple of the slide")
    pane = floor_to(epoch_micros(df, ts), s) + F.lit(s)
    marked = df if chained else df.withWatermark(ts, f"{parse_duration(lateness)} microseconds")
    rows = marked.select(*by, pane.alias("_pe"))
    if not by:  # the combined rows of all partitions, a few per pane
        rows, by = rows.withColumn("_all", F.lit(0)), ["_all"]
    schema = T.StructType([*rows.select(*by, "_pe").schema.fields, T.StructField("_n", T.LongType())])

    def combined(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch]).group_by([*by, "_pe"]).aggregate([([], "count_all")])
            t = t.rename_columns([*by, "_pe", "_n"] if t.column_names[-1] == "count_all" else ["_n", *by, "_pe"])
            yield from t.select([*by, "_pe", "_n"]).combine_chunks().to_batches()

    panes = rows.select(*by, "_pe").mapInArrow(combined, schema)
    types = {f.name: f.dataType for f in schema.fields}
    result = T.StructType([T.StructField(k, types[k]) for k in by]
                          + [T.StructField("window_time", T.TimestampType()), T.StructField("window_end", T.LongType()),
                             T.StructField(out, T.LongType())])
    got = panes.groupBy(*by).transformWithState(PaneCountProcessor(by, z, s, out), result, "Append", "EventTime",
                                                eventTimeColumnName="window_time")
    return got.drop("_all")


class _Best:
    """Order of a heap's rows: the worst first (small count, then large items)."""

    __slots__ = ("count", "items", "row")

    def __init__(self, count, items, row):
        self.count, self.items, self.row = count, items, row

    def __lt__(self, other):
        return (self.count, other.items) < (other.count, self.items)


class TopNProcessor(StatefulProcessor):
    """The n best rows of a group by (count desc, items asc), emitted when the watermark
    reaches the group's window; ``rank`` numbers them."""

    def __init__(self, cols: Sequence[str], n: int, window: str, time: str, count: str, items: Sequence[str], rank: str | None):
        self.cols, self.n, self.window, self.time = list(cols), n, window, time
        self.count, self.items, self.rank = count, list(items), rank
        self.schema: T.StructType | None = None

    def with_schema(self, schema: T.StructType) -> TopNProcessor:
        self.schema = schema
        return self

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", self.schema)

    def _heap(self, rows) -> list[_Best]:
        return [_Best(r[self.cols.index(self.count)], self._key(r), tuple(r)) for r in rows]

    def _key(self, r) -> tuple:
        values = [r[self.cols.index(i)] for i in self.items]
        return tuple((v is not None, v) for v in values)  # NULL comes first, as in a sort

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        heap = self._heap(self.best.get()) if self.best.exists() else []
        heapq.heapify(heap)
        when = None
        for r in rows:
            when = r[self.time]
            new = self._heap([tuple(r[c] for c in self.cols)])[0]
            if len(heap) < self.n:
                heapq.heappush(heap, new)
            elif heap[0] < new:
                heapq.heapreplace(heap, new)
        self.best.put([x.row for x in heap])
        if when is not None:
            self.handle.registerTimer(-(-int(when.timestamp() * 1_000_000) // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        found = sorted(self._heap(self.best.get()), reverse=True) if self.best.exists() else []
        self.best.clear()
        for i, x in enumerate(found):
            extra = {self.rank: i + 1} if self.rank else {}
            yield Row(**dict(zip(self.cols, x.row)), **extra)

    def close(self) -> None:
        pass


def stream_top_n(counts: DataFrame, n: int, window: str = "window_end", time: str = "window_time", count: str = "cnt",
                 item="item_id", rank: str = "rank", salts: int = 16) -> DataFrame:
    """A3 on a stream: the n largest counts per window with their rank, as a stream in
    append mode.  ``counts`` come from a stateful operator whose event time is
    ``time`` (``stream_pane_count``); ties go to the smaller item, as in
    ``top_n_per_window``.  State: at most n rows per (window, salt) and per window.
    """
    items = [item] if isinstance(item, str) else list(item)
    cols, fields = counts.columns, counts.schema.fields
    salted = counts.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(i) for i in items]), F.lit(salts)).cast("int"))

    def ranked(df, by, name):
        extra = [T.StructField(name, T.LongType())] if name else []
        proc = TopNProcessor(cols, n, window, time, count, items, name).with_schema(T.StructType(fields))
        return df.groupBy(*by).transformWithState(proc, T.StructType(fields + extra), "Append", "EventTime",
                                                  eventTimeColumnName=time)

    return ranked(ranked(salted, [window, "_salt"], None), [window], rank)
