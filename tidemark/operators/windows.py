"""Event-time window counts.

``sliding_count`` never expands rows by size/slide before a shuffle (that is
720x for 1 h / 5 s).  Instead:

1. **panes** - rows are counted per (keys, slide-aligned pane); Catalyst's
   partial aggregate combines map-side, so a hot key costs one row per pane
   per map task, not one per event;
2. **deltas** - a pane of n rows raises every window it belongs to by n: +n at
   its first window end, -n just after its last.  Window ends are cut into
   blocks of ``block`` (default: the window size, at least one hour) so the running sum is
   partitioned by (keys, block) - never by a whole key or a whole time line;
   a pane is copied into at most 1 + size/block blocks;
3. **segments** - a running sum over each block's deltas gives a count that
   is constant between consecutive change points; each constant segment is
   expanded to its window ends as the very last, map-side step.  The deltas
   exchange keeps ``spark.sql.shuffle.partitions`` partitions (no AQE
   coalescing), because the expansion after it is where the output is made.

Shuffle volume is O(panes), not O(rows x size/slide); output is one row per
non-empty (keys, window) exactly as ``F.window`` gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import epoch_micros, floor_to, parse_duration, render_epoch_ms
from ..plans.ordered import floor_div


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _shuffle_width(spark) -> int:
    """The configured shuffle parallelism: size it for the output rows, which are
    made after this exchange."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pane_counts(df: DataFrame, keys, slide, ts: str = "ts", unit: str = "auto") -> DataFrame:
    """Rows per (keys, pane end); pane end in epoch microseconds (``_pe``)."""
    s = parse_duration(slide)
    pe = floor_to(epoch_micros(df, ts, unit), s) + F.lit(s)
    return df.groupBy(*_keys(keys), pe.alias("_pe")).agg(F.count(F.lit(1)).alias("_n"))


def windows_from_panes(panes: DataFrame, keys, size, slide, out: str = "cnt",
                       block=None, with_start: bool = False) -> DataFrame:
    """Sliding counts from ``pane_counts`` output (see module doc).  A column ``_in``
    of the panes is the first window end that counts them (default: the pane end)."""
    keys = _keys(keys)
    z, s = parse_duration(size), parse_duration(slide)
    if z % s:
        raise ValueError("window size must be a multiple of the slide")
    if z == s:  # tumbling: a pane is a window
        res = panes.select(*keys, F.col("_pe").alias("_we"), F.col("_n").alias(out))
    else:
        # default block: the window size, but at least an hour - small windows in tiny
        # blocks mean many tiny sort groups and two copies of most panes
        want = max(z, 3_600_000_000) if block is None else parse_duration(block)
        b = max(s, -(-want // s) * s)
        pe, n = F.col("_pe"), F.col("_n")
        first = F.col("_in") if "_in" in panes.columns else pe
        blk = F.col("_blk")
        bstart = blk * F.lit(b)
        bend = bstart + F.lit(b)
        copies = panes.select(*panes.columns, F.explode(F.sequence(
            floor_div(first, b), floor_div(pe + F.lit(z - s), b))).alias("_blk"))
        enter = F.struct(F.greatest(first, bstart).alias("t"), n.alias("d"))
        leave = F.when(pe + F.lit(z) < bend, F.struct((pe + F.lit(z)).alias("t"), (-n).alias("d")))
        deltas = copies.select(*keys, "_blk", F.explode(F.filter(
            F.array(enter, leave), lambda x: x.isNotNull())).alias("e"))
        deltas = deltas.select(*keys, "_blk", F.col("e.t").alias("_t"), F.col("e.d").alias("_d"))
        # The deltas are small but each segment expands to many windows after this
        # exchange: fix its width at the configured shuffle parallelism so AQE does
        # not coalesce it into a few tasks that then emit all the output.  Keys and
        # block travel as one struct: the optimizer drops constant keys from a
        # window's partitioning but not from a repartition, and would then add a
        # second exchange; it cannot take the struct apart.
        deltas = deltas.withColumn("_part", F.struct(F.col("_blk"), *[F.col(c) for c in keys]))
        deltas = deltas.repartition(_shuffle_width(panes.sparkSession), "_part")
        w = Window.partitionBy("_part").orderBy("_t")
        seg = deltas.select(
            *keys, "_t", "_blk",
            F.sum("_d").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("_cum"),
            F.coalesce(F.lead("_t").over(w), bend).alias("_nx"))
        seg = seg.filter((F.col("_cum") > 0) & (F.col("_nx") > F.col("_t")))
        res = seg.select(*keys, F.explode(F.sequence(
            F.col("_t"), F.col("_nx") - F.lit(s), F.lit(s))).alias("_we"),
            F.col("_cum").cast("long").alias(out))
    cols = [*keys]
    if with_start:
        cols.append(floor_div(F.col("_we") - F.lit(z), 1000).alias("window_start"))
    cols.append(floor_div(F.col("_we"), 1000).alias("window_end"))
    return res.select(*cols, out)


def sliding_count(df: DataFrame, keys, size, slide, ts: str = "ts", unit: str = "auto",
                  out: str = "cnt", block=None, with_start: bool = False) -> DataFrame:
    """A2: rows per (keys, sliding event-time window).

    Windows are epoch-aligned ``[end - size, end)``; ``window_end`` (and
    ``window_start``) are epoch milliseconds.  Empty windows emit nothing.
    """
    return windows_from_panes(pane_counts(df, keys, slide, ts, unit), keys, size, slide,
                              out=out, block=block, with_start=with_start)


def tumbling_count(df: DataFrame, size, keys=None, ts: str = "ts", unit: str = "auto",
                   out: str = "cnt", with_start: bool = False) -> DataFrame:
    """Rows per (keys, tumbling window)."""
    return sliding_count(df, keys, size, size, ts, unit, out, with_start=with_start)


def marketing_counts(df: DataFrame, channel: str = "channel", behavior: str = "behavior",
                     size="60 seconds", slide="1 second", ts: str = "ts", unit: str = "auto",
                     exclude: str | Sequence[str] | None = "UNINSTALL", by_key: bool = True,
                     total: bool = False, label: str = "Total", tz: str | None = None) -> DataFrame:
    """Marketing count rows (window_start, window_end as text, channel, behavior, cnt).

    ``by_key`` gives counts per (channel, behavior); ``total`` the same windows
    over all rows labelled ``label``/``label``.  When both are asked the total
    is derived from the keyed panes, so the input is scanned and shuffled once.
    """
    if exclude is not None:
        ex = [exclude] if isinstance(exclude, str) else list(exclude)
        df = df.filter(~F.col(behavior).isin(ex))
    keys = [channel, behavior]
    panes = pane_counts(df, keys if by_key else None, slide, ts, unit)
    parts = []
    if by_key:
        parts.append(windows_from_panes(panes, keys, size, slide, with_start=True)
                     .select(F.col(channel).alias("channel"), F.col(behavior).alias("behavior"),
                             "window_start", "window_end", "cnt"))
    if total:
        tp = panes.groupBy("_pe").agg(F.sum("_n").alias("_n")) if by_key else panes
        parts.append(windows_from_panes(tp, None, size, slide, with_start=True)
                     .select(F.lit(label).alias("channel"), F.lit(label).alias("behavior"),
                             "window_start", "window_end", "cnt"))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res.select(render_epoch_ms(F.col("window_start"), tz).alias("window_start"),
                      render_epoch_ms(F.col("window_end"), tz).alias("window_end"),
                      "channel", "behavior", "cnt")
