"""Operators that follow the order in which rows arrive: what a watermark would
drop (T1, T7) and counts refined row by row (T6), as batch queries.

Both are prefix scans over the arrival order (``plans.ordered.running``), cut by
row counts: neither the whole table nor a crowded window is one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash61
from ..functions.time import epoch_micros, floor_to, parse_duration
from ..plans.ordered import TARGET_ROWS, balanced_buckets, floor_div, large_keys, running
from .rules import ARRIVAL_SLOT
from .windows import windows_from_panes


def _arrival_running(df, keys, order, value, how, out, strict, target_rows):
    large = large_keys(df, keys, target_rows)
    b = balanced_buckets(df, keys, F.col("_q"), ARRIVAL_SLOT, target_rows, "_b", large)
    return running(b, keys, order, value, how, out, None if large is None else "_b", strict).drop("_b")


def _open_rows(df: DataFrame, ts: str, seq: str, delay, size, slide, unit: str, target_rows: int) -> DataFrame:
    """``df`` with ``_pe`` (its first window end) and ``_in`` (the first that is still
    open when the row arrives), in epoch microseconds; rows without any are gone."""
    z, s = parse_duration(size), parse_duration(slide if slide is not None else size)
    if z % s:
        raise ValueError("window size must be a multiple of the slide")
    base = (df.withColumn("_t", epoch_micros(df, ts, unit)).withColumn("_q", F.col(seq).cast("long"))
              .withColumn("_all", F.lit(0)))
    base = _arrival_running(base, ["_all"], ["_q"], F.col("_t"), "max", "_wm", True, target_rows)
    mark = F.col("_wm") - F.lit(parse_duration(delay))
    pe = floor_to(F.col("_t"), s) + F.lit(s)
    # greatest skips the NULL mark of the first row
    first = F.greatest(pe, floor_to(mark, s) + F.lit(s))
    return (base.withColumn("_pe", pe).withColumn("_in", first)
                .filter(F.col("_in") <= F.col("_pe") + F.lit(z - s)).drop("_q", "_all", "_wm", "_t"))


def drop_late(df: DataFrame, ts: str = "ts", seq: str = "seq", delay=0, size="1 hour", slide=None,
              unit: str = "auto", out: str = "open_from", target_rows: int = TARGET_ROWS) -> DataFrame:
    """T1/T7 on a table: the rows that a stream with a watermark of ``delay`` takes.

    Rows arrive in the order of ``seq`` and the watermark follows every row: the
    largest time of the rows before it minus ``delay``.  A window is closed once
    the watermark has reached its end; a row is dropped if all its windows are
    closed.  ``out`` is the end (epoch ms) of the first window that still takes
    the row: with sliding windows a late row counts only from there on.
    """
    rows = _open_rows(df, ts, seq, delay, size, slide, unit, target_rows)
    return rows.select(*df.columns, floor_div(F.col("_in"), 1000).alias(out))


def sliding_count_on_time(df: DataFrame, keys, size, slide, ts: str = "ts", seq: str = "seq", delay=0,
                          unit: str = "auto", out: str = "cnt", block=None, target_rows: int = TARGET_ROWS) -> DataFrame:
    """A2 over what a watermark lets through: per (keys, window) the rows that arrived
    before the window closed.  Same panes and columns as ``sliding_count``; a late
    row joins its pane's windows from the first open one on."""
    by = [] if keys is None else [keys] if isinstance(keys, str) else list(keys)
    rows = _open_rows(df, ts, seq, delay, size, slide, unit, target_rows)
    panes = rows.groupBy(*by, "_pe", "_in").agg(F.count(F.lit(1)).alias("_n"))
    return windows_from_panes(panes, by, size, slide, out=out, block=block)


def running_distinct(df: DataFrame, user: str = "user_id", size="1 hour", ts: str = "ts", seq: str = "seq",
                     unit: str = "auto", hashed: bool = False, out: str = "uv",
                     target_rows: int = TARGET_ROWS) -> DataFrame:
    """T6 on a table: every row with its window's end (``window_end``, epoch ms) and the
    distinct users of that window so far, itself included, in the order of ``seq``
    (rows of one ``seq`` count together; a NULL user counts as none).

    ``hashed`` counts ``hash61`` values, as the bitmap form does.  The first row of
    every (window, user) comes from a partial aggregate and enters the window's
    line as a mark of 1 before that row; the count is the running sum of marks.
    """
    z = parse_duration(size)
    u = hash61(F.col(user)) if hashed else F.col(user)
    rows = df.withColumn("window_end", floor_div(floor_to(epoch_micros(df, ts, unit), z) + F.lit(z), 1000)).withColumn(
        "_q", F.col(seq).cast("long"))
    marks = (rows.filter(F.col(user).isNotNull()).groupBy("window_end", u.alias("_u")).agg(F.min("_q").alias("_q"))
                 .select("window_end", "_q", F.lit(1).alias("_mark")))
    line = rows.withColumn("_mark", F.lit(0)).unionByName(marks, allowMissingColumns=True)
    line = _arrival_running(line, ["window_end"], ["_q", F.col("_mark").desc()], F.col("_mark"), "sum", out, False, target_rows)
    return line.filter(F.col("_mark") == 0).select(*df.columns, "window_end", F.col(out).cast("long").alias(out))
