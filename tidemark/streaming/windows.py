"""Streaming forms of the window operators (append mode, event-time watermark).

A window is emitted once, when the watermark passes its end; late rows of a
closed window are dropped (no allowed lateness, as in the reference).  Unlike
a bounded reference run, the end of input does not flush open windows.

Sliding counts explode each row to the window ends it belongs to and put the
watermark on that window end with delay = size (+ lateness): a window then
closes when max event time >= its end - the reference's closing rule - and
state is kept per (keys, window end) only until then.  Partial aggregation
still runs map-side before the state-store shuffle.  For slides much finer than
the size ``panes.stream_pane_count`` keeps panes instead of windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash61
from ..functions.time import epoch_micros, floor_to, parse_duration, render_epoch_ms
from ..operators.topn import top_n_per_window
from .panes import stream_pane_count


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _with_window_ends(df: DataFrame, size, slide, ts: str, lateness) -> DataFrame:
    z, s = parse_duration(size), parse_duration(slide)
    if z % s:
        raise ValueError("window size must be a multiple of the slide")
    pe = floor_to(epoch_micros(df, ts), s) + F.lit(s)
    out = df.withColumn("_we", F.explode(F.sequence(pe, pe + F.lit(z - s), F.lit(s))))
    out = out.withColumn("_we", F.timestamp_micros("_we"))
    return out.withWatermark("_we", f"{z + parse_duration(lateness)} microseconds")


def stream_sliding_count(df: DataFrame, keys, size, slide, ts: str = "ts", lateness=0,
                         out: str = "cnt", with_start: bool = False, chained: bool = False) -> DataFrame:
    """A2 on a stream; same columns as the batch ``sliding_count``.

    ``chained``: the input comes from a stateful operator that keeps the
    watermark on ``ts`` (a stream takes no second one), which then also closes
    the windows; ``lateness`` is that watermark's delay.
    """
    keys = _keys(keys)
    z = parse_duration(size)
    if chained:
        w = F.window(F.col(ts), f"{z} microseconds", f"{parse_duration(slide)} microseconds")
        agg = df.groupBy(*keys, w.alias("_w")).agg(F.count(F.lit(1)).alias(out))
        cols = [*keys] + ([F.unix_millis("_w.start").alias("window_start")] if with_start else [])
        return agg.select(*cols, F.unix_millis("_w.end").alias("window_end"), out)
    agg = _with_window_ends(df, size, slide, ts, lateness).groupBy(*keys, "_we").agg(
        F.count(F.lit(1)).alias(out))
    cols = [*keys]
    end_ms = F.unix_millis("_we")
    if with_start:
        cols.append((end_ms - F.lit(z // 1000)).alias("window_start"))
    return agg.select(*cols, end_ms.alias("window_end"), out)


def stream_tumbling_count(df: DataFrame, size, keys=None, ts: str = "ts", lateness=0,
                          out: str = "cnt") -> DataFrame:
    return stream_sliding_count(df, keys, size, size, ts, lateness, out)


def stream_unique_per_window(df: DataFrame, user: str = "user_id", size="1 hour", ts: str = "ts",
                             lateness=0, out: str = "uv") -> DataFrame:
    """A4 on a stream: ``countDistinct`` is not allowed on streams, so dedup
    (window, user) with watermark-bounded state, then count per window.  NULL
    users are no visitors, as in the batch form."""
    w = _with_window_ends(df, size, size, ts, lateness)
    pairs = w.dropDuplicates(["_we", user])
    return pairs.groupBy("_we").agg(F.count(F.col(user)).alias(out)).select(
        F.unix_millis("_we").alias("window_end"), out)


def stream_unique_bitmap(df: DataFrame, user: str = "user_id", size="1 hour", ts: str = "ts",
                         lateness=0, out: str = "uv") -> DataFrame:
    """A5 on a stream: per (window, bitmap bucket) the bits set so far.  In update
    mode each micro-batch refines the buckets it touches (T6); upsert them by
    (window_end, bucket) and add them up with ``unique_from_buckets``."""
    w = _with_window_ends(df, size, size, ts, lateness).withColumn("_h", hash61(F.col(user)))
    agg = w.groupBy("_we", F.bitmap_bucket_number("_h").alias("bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("_h"))).cast("long").alias(out))
    return agg.select(F.unix_millis("_we").alias("window_end"), "bucket", out)


def unique_from_buckets(buckets: DataFrame, out: str = "uv") -> DataFrame:
    """Visitors per window from the current bucket counts."""
    return buckets.groupBy("window_end").agg(F.sum(out).cast("long").alias(out))


def stream_unique_approx(df: DataFrame, user: str = "user_id", size="1 hour", ts: str = "ts",
                         lateness=0, rsd: float = 0.05, out: str = "uv") -> DataFrame:
    """A6 on a stream (HLL buffers in the state store)."""
    w = _with_window_ends(df, size, size, ts, lateness)
    return w.groupBy("_we").agg(F.approx_count_distinct(user, rsd).cast("long").alias(out)).select(
        F.unix_millis("_we").alias("window_end"), out)


def stream_marketing_counts(df: DataFrame, channel: str = "channel", behavior: str = "behavior",
                            size="60 seconds", slide="1 second", ts: str = "ts", lateness=0,
                            exclude="UNINSTALL", total: bool = False, label: str = "Total") -> DataFrame:
    """A7 on a stream: per (channel, behavior), or the total labelled ``label``."""
    if exclude is not None:
        df = df.filter(F.col(behavior) != exclude)
    counts = stream_pane_count(df, None if total else [channel, behavior], size, slide, ts, lateness)
    names = [F.lit(label), F.lit(label)] if total else [F.col(channel), F.col(behavior)]
    start = F.col("window_end") - F.lit(parse_duration(size) // 1000)
    res = counts.select(names[0].alias("channel"), names[1].alias("behavior"), start.alias("window_start"), "window_end", "cnt")
    return res.select(render_epoch_ms(F.col("window_start")).alias("window_start"),
                      render_epoch_ms(F.col("window_end")).alias("window_end"), "channel", "behavior", "cnt")


def top_n_batches(n: int, sink: Callable[[DataFrame, int], None], window: str = "window_end",
                  count: str = "cnt", item: str = "item_id") -> Callable[[DataFrame, int], None]:
    """A3 on a stream, as a ``foreachBatch`` function over append-mode counts.

    In append mode every (item, window) count of a window is emitted in the
    same micro-batch (they close on the same watermark), so the batch top-N
    (with its map-side group limit) is exact per window.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        sink(top_n_per_window(batch, n, window, count, item), epoch)
    return run
