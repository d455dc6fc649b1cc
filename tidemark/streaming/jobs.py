"""The reference's programs as streams.

Each function takes parsed streaming input (see ``sources.read_delimited`` with
``streaming=True``) and returns the output streams of the program, for append
mode.  ``start`` writes them as Parquet, one checkpoint per output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import format_topn_report
from ..functions.time import event_time, render_epoch_ms
from .stateful import (prepare, stream_consecutive_events, stream_daily_cap, stream_match_sequence,
                       stream_order_timeout, stream_reconcile)
from .panes import stream_pane_count, stream_top_n
from .windows import (stream_marketing_counts, stream_tumbling_count, stream_unique_approx,
                      stream_unique_bitmap, stream_unique_per_window, unique_from_buckets)


def _views(behavior: DataFrame) -> DataFrame:
    return event_time(behavior, "event_time", "s").filter(F.col("behavior") == "pv")


def hot_items(behavior: DataFrame, size="60 minutes", slide="5 minutes", top: int = 3) -> list[DataFrame]:
    """The ``top`` items of every closed window."""
    ranked = stream_top_n(stream_pane_count(_views(behavior), ["item_id"], size, slide), top)
    return [ranked.select("window_end", "item_id", "cnt", "rank")]


def page_views(behavior: DataFrame, size="1 hour") -> list[DataFrame]:
    return [stream_tumbling_count(_views(behavior), size, out="pv")]


def unique_visitors(behavior: DataFrame, size="1 hour", method: str = "exact") -> list[DataFrame]:
    """'exact' and 'approx' close windows; 'bitmap' gives bucket counts, final per closed window."""
    fn = {"exact": stream_unique_per_window, "approx": stream_unique_approx, "bitmap": stream_unique_bitmap}[method]
    return [fn(_views(behavior), "user_id", size)]


def _geo(df: DataFrame, size, slide, chained: bool) -> DataFrame:
    counts = stream_pane_count(df, ["province"], size, slide, chained=chained)
    return counts.select(render_epoch_ms(F.col("window_end")).alias("window_end"), "province", "cnt")


def ad_statistics_by_geo(clicks: DataFrame, size="1 hour", slide="5 seconds") -> list[DataFrame]:
    return [_geo(event_time(clicks, "event_time", "s"), size, slide, False)]


def blacklist(clicks: DataFrame, max_count: int = 100, size="1 hour", slide="5 seconds") -> list[DataFrame]:
    """(geo counts over the rows that pass the daily cap, warnings)."""
    capped = stream_daily_cap(prepare(event_time(clicks, "event_time", "s")), ["user_id", "ad_id"], max_count,
                              event_time="ts")
    return [_geo(capped.filter(F.col("kind") == "pass"), size, slide, True),
            capped.filter(F.col("kind") == "warning").select("user_id", "ad_id", "msg")]


def app_marketing_by_channel(events: DataFrame, size="60 seconds", slide="1 second") -> list[DataFrame]:
    return [stream_marketing_counts(event_time(events, "event_time", "ms"), size=size, slide=slide)]


def app_marketing_statistics(events: DataFrame, size="60 seconds", slide="1 second") -> list[DataFrame]:
    return [stream_marketing_counts(event_time(events, "event_time", "ms"), size=size, slide=slide, total=True)]


def login_fail(logins: DataFrame, gap="2 seconds") -> list[DataFrame]:
    s = prepare(event_time(logins, "event_time", "s"))
    return [stream_consecutive_events(s, "user_id", "event_type", "fail", gap)]


def login_fail_pattern(logins: DataFrame, within="2 seconds") -> list[DataFrame]:
    m = stream_match_sequence(prepare(event_time(logins, "event_time", "s")), "user_id", ["fail", "fail"], within)
    return [m.select("user_id", F.col("ip_1").alias("ip"), F.col("event_type_1").alias("event_type"))]


def order_pattern_timeout(orders: DataFrame, within="5 seconds") -> list[DataFrame]:
    m = stream_match_sequence(prepare(event_time(orders, "event_time", "s")), "order_id", ["create", "pay"], within,
                              emit=("timeout",))
    return [m.select("order_id", F.col("event_type_0").alias("event_type"), F.col("event_time_0").alias("event_time"))]


def order_timeout_state(orders: DataFrame, limit="5 seconds") -> list[DataFrame]:
    t = stream_order_timeout(prepare(event_time(orders, "event_time", "s")), "order_id", "event_type", "create", limit)
    return [t.select("order_id", "event_type", "event_time")]


def tx_match(orders: DataFrame, pays: DataFrame, wait="5 seconds") -> list[DataFrame]:
    """Matched pairs and both unmatched sides, told apart by ``kind``."""
    return [stream_reconcile(event_time(orders, "event_time", "s"), event_time(pays, "event_time", "s"),
                             "order_id", wait=wait)]


ONE_INPUT: dict[str, Callable[..., list[DataFrame]]] = {f.__name__: f for f in (
    hot_items, page_views, unique_visitors, ad_statistics_by_geo, blacklist, app_marketing_by_channel,
    app_marketing_statistics, login_fail, login_fail_pattern, order_pattern_timeout, order_timeout_state)}


def start(job: str, outputs: list[DataFrame], out: str, checkpoint: str, available_now: bool = False,
          report: bool = False) -> list:
    """Start one query per output; ``checkpoint`` is the job's folder and must stay the same on a restart."""
    queries = []
    for i, df in enumerate(outputs):
        path = f"{out.rstrip('/')}/{job}_{i}"

        def append(batch, epoch, path=path):
            # one folder per epoch, overwritten by a retry
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={epoch}")

        def ranked(batch, epoch):
            append(format_topn_report(batch) if report else batch, epoch)

        def visitors(batch, epoch):
            append(unique_from_buckets(batch), epoch)

        fn = ranked if job == "hot_items" else visitors if "bucket" in df.columns else append
        w = (df.writeStream.outputMode("append").option("checkpointLocation", f"{checkpoint.rstrip('/')}/{job}_{i}")
               .foreachBatch(fn))
        queries.append((w.trigger(availableNow=True) if available_now else w).start())
    return queries
