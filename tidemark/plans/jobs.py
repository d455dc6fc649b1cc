"""The reference's analytic programs as DataFrame jobs (one call each).

Inputs are DataFrames already parsed with ``tidemark.sources`` (or the
reference's text files via ``read_delimited``); each job returns the result
DataFrames the program printed or forwarded.  They are compositions of the
operators - no extra logic lives here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import format_topn_report
from ..functions.time import render_epoch_ms
from ..operators import (consecutive_events, daily_cap, marketing_counts, match_sequence,
                         order_timeout, reconcile, reconcile_pairs, sliding_count, top_n_per_window, tumbling_count,
                         unique_per_window, unique_per_window_approx, unique_per_window_bitmap)
from ..operators import order_timeout_state as order_timeout_machine
from ..sources.delimited import AD_CLICK, USER_BEHAVIOR, read_delimited


def user_behavior(spark: SparkSession, path: str) -> DataFrame:
    """Behaviour text file (user, item, category, behavior, epoch seconds)."""
    return read_delimited(spark, path, USER_BEHAVIOR)


def ad_clicks(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, AD_CLICK)


def hot_items(behavior: DataFrame, n: int = 3, size="60 minutes", slide="5 minutes",
              report: bool = False) -> DataFrame:
    """Page views per item over sliding windows, top n per window end."""
    pv = behavior.filter(F.col("behavior") == "pv")
    counts = sliding_count(pv, ["item_id"], size, slide, ts="event_time", unit="s")
    top = top_n_per_window(counts, n)
    return format_topn_report(top) if report else top


def page_views(behavior: DataFrame, size="1 hour") -> DataFrame:
    pv = behavior.filter(F.col("behavior") == "pv")
    return tumbling_count(pv, size, ts="event_time", unit="s", out="pv")


def unique_visitors(behavior: DataFrame, size="1 hour", method: str = "exact") -> DataFrame:
    """Distinct page-viewing users per window: 'exact', 'bitmap' (hashed) or 'approx'."""
    pv = behavior.filter(F.col("behavior") == "pv")
    fn = {"exact": unique_per_window, "bitmap": unique_per_window_bitmap,
          "approx": unique_per_window_approx}[method]
    return fn(pv, "user_id", size, ts="event_time", unit="s")


def ad_statistics_by_geo(clicks: DataFrame, size="1 hour", slide="5 seconds") -> DataFrame:
    """Clicks per province over sliding windows (window end as text)."""
    res = sliding_count(clicks, ["province"], size, slide, ts="event_time", unit="s")
    return res.select(render_epoch_ms(F.col("window_end")).alias("window_end"), "province", "cnt")


def blacklist(clicks: DataFrame, max_count: int = 100, size="1 hour", slide="5 seconds",
              seq: str | None = "seq") -> tuple[DataFrame, DataFrame]:
    """(filtered geo counts, warnings): the daily cap per (user, ad), then geo
    counts over the rows that passed."""
    capped = daily_cap(clicks, ["user_id", "ad_id"], max_count, ts="event_time", unit="s", seq=seq)
    warnings = capped.filter(F.col("kind") == "warning").select("user_id", "ad_id", "msg")
    geo = ad_statistics_by_geo(capped.filter(F.col("kind") == "pass"), size, slide)
    return geo, warnings


def app_marketing_by_channel(events: DataFrame, size="60 seconds", slide="1 second") -> DataFrame:
    """Marketing behaviour rows (event_time in ms), UNINSTALL excluded."""
    return marketing_counts(events, size=size, slide=slide, ts="event_time", unit="ms")


def app_marketing_statistics(events: DataFrame, size="60 seconds", slide="1 second") -> DataFrame:
    return marketing_counts(events, size=size, slide=slide, ts="event_time", unit="ms",
                            by_key=False, total=True)


def login_fail(logins: DataFrame, gap="2 seconds", seq: str = "seq") -> DataFrame:
    """Alerts for a failure following a failure of the same user within ``gap``."""
    return consecutive_events(logins, "user_id", "event_type", "fail", gap, ts="event_time",
                              unit="s", seq=seq, carry=["ip", "event_time"])


def login_fail_pattern(logins: DataFrame, within="2 seconds", seq: str = "seq") -> DataFrame:
    """fail, next fail within ``within``: (user, ip, type) of the second row."""
    m = match_sequence(logins, "user_id", ["fail", "fail"], within, ts="event_time", unit="s",
                       seq=seq, carry=["ip", "event_type"])
    return m.select("user_id", F.col("ip_1").alias("ip"), F.col("event_type_1").alias("event_type"))


def order_pattern_timeout(orders: DataFrame, within="5 seconds", seq: str = "seq") -> DataFrame:
    """create, next pay within ``within``: the creates that timed out."""
    m = match_sequence(orders, "order_id", ["create", "pay"], within, ts="event_time", unit="s",
                       seq=seq, emit=("timeout",), carry=["event_type", "event_time"])
    return m.select("order_id", F.col("event_type_0").alias("event_type"),
                    F.col("event_time_0").alias("event_time"))


def order_timeout_state(orders: DataFrame, limit="5 seconds", machine: bool = False, seq: str = "seq") -> DataFrame:
    """The event-time contract, or (``machine``) the saved row with timers itself."""
    if machine:
        return order_timeout_machine(orders, "order_id", "event_type", "create", limit, ts="event_time", seq=seq, unit="s")
    return order_timeout(orders, "order_id", "event_type", "create", limit, ts="event_time", unit="s")


def tx_match(orders: DataFrame, pays: DataFrame, seq: str | None = "seq",
             tolerance=None, repeated: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched, unmatched orders, unmatched pays); ``repeated``: a key pairs as often as its sides meet."""
    def side(*kinds):
        return (reconcile_pairs if repeated else reconcile)(orders, pays, "order_id", "event_time", "event_time", seq, seq, unit="s",
                         tolerance=tolerance, kinds=kinds)

    return (side("matched"), side("unmatched_order").select("order.*"), side("unmatched_pay").select("pay.*"))
