"""Driver queries over the supplied tables.

Rendered times are pinned to UTC so results do not depend on the session zone.

``events`` stands in for the reference's behaviour logs: view = page view,
click = ad click / marketing action, error = failed login, signup/purchase =
order / pay.  Every query reads its tables whole (no date, id or row cuts).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import format_topn_report
from ..operators.arrival import drop_late, running_distinct, sliding_count_on_time
from ..operators.distinct import (unique_per_window, unique_per_window_approx,
                                  unique_per_window_bitmap, visitor_sketches, visitors_from_sketches)
from ..operators.patterns import match_sequence, order_timeout, order_timeout_state
from ..operators.reconcile import reconcile, reconcile_pairs
from ..operators.rules import consecutive_events, daily_cap
from ..operators.topn import top_n_per_window
from ..operators.windows import marketing_counts, sliding_count, tumbling_count
from ..functions.time import render_epoch_ms
from ..sources.delimited import parse_delimited
from ..sources.kafka import decode_records
from ..sources.tables import table

SIX_HOURS = "6 hours"
EVENT_LINE = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("event_time", T.LongType())])


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def _views(spark, sf):
    return (_events(spark, sf).filter(F.col("event_type") == "view")
            .select("ts", "user_id", F.get_json_object("props", "$.k").cast("long").alias("item_id")))


def hot_item_counts(spark, sf):
    return sliding_count(_views(spark, sf), ["item_id"], "60 minutes", "5 minutes")


def hot_items_topn(spark, sf):
    return top_n_per_window(hot_item_counts(spark, sf), 3).select("window_end", "item_id", "cnt", "rank")


def hot_items_report(spark, sf):
    return format_topn_report(hot_items_topn(spark, sf), tz="UTC")


def page_views_hourly(spark, sf):
    return tumbling_count(_views(spark, sf), "1 hour", out="pv")


def unique_visitors_hourly(spark, sf):
    return unique_per_window(_views(spark, sf), "user_id", "1 hour")


def unique_visitors_bitmap(spark, sf):
    return unique_per_window_bitmap(_views(spark, sf), "user_id", "1 hour")


def unique_visitors_approx(spark, sf):
    return unique_per_window_approx(_views(spark, sf), "user_id", "1 hour")


def geo_clicks_sliding(spark, sf):
    clicks = _events(spark, sf).filter(F.col("event_type") == "click")
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("province"))
    geo = (clicks.join(cust, clicks.user_id == cust.c_custkey)
                 .join(nation, F.col("c_nationkey") == nation.n_nationkey)
                 .select("ts", "province"))
    res = sliding_count(geo, ["province"], "1 hour", "5 seconds")
    return res.select(render_epoch_ms(F.col("window_end"), "UTC").alias("window_end"), "province", "cnt")


def events_sliding_1h_5s(spark, sf):
    """T4 at full size: every event, 1 h / 5 s windows by type (720 windows per row)."""
    return sliding_count(_events(spark, sf), ["event_type"], "1 hour", "5 seconds")


def events_total_60s_1s(spark, sf):
    """T5 with no key: every event, 60 s / 1 s windows (the dummy-key total)."""
    return sliding_count(_events(spark, sf), None, "60 seconds", "1 second")


def _marketing_input(spark, sf):
    """A channel per row (the item's remainder by 6) and its behaviour."""
    k = F.get_json_object("props", "$.k").cast("long")
    return _events(spark, sf).select("ts", F.concat(F.lit("ch"), F.pmod(k, F.lit(6)).cast("string")).alias("channel"),
                                     F.col("event_type").alias("behavior"))


def channel_counts_sliding(spark, sf):
    return marketing_counts(_marketing_input(spark, sf), exclude="signup", by_key=True, tz="UTC")


def total_counts_sliding(spark, sf):
    return marketing_counts(_marketing_input(spark, sf), exclude="signup", by_key=False, total=True,
                            tz="UTC")


def _capped(spark, sf):
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return daily_cap(ev, ["user_id", "event_type"], max_count=2, seq="event_id")


def daily_cap_warnings(spark, sf):
    return (_capped(spark, sf).filter(F.col("kind") == "warning")
            .select("user_id", "event_type", "event_id", "msg"))


def daily_cap_passed(spark, sf):
    return _capped(spark, sf).filter(F.col("kind") == "pass").select("event_id", "user_id", "event_type")


def capped_sliding_counts(spark, sf):
    passed = _capped(spark, sf).filter(F.col("kind") == "pass")
    return sliding_count(passed, ["event_type"], "1 hour", "5 minutes")


def consecutive_failures(spark, sf):
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return consecutive_events(ev, "user_id", "event_type", "error", SIX_HOURS, seq="event_id",
                              carry=["event_id"]).select("user_id", "event_id", "prev_event_id")


def login_fail_pattern(spark, sf):
    """F2 as the reference's login pattern: error, next error (event-time order) within 6 h."""
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return match_sequence(ev, "user_id", ["error", "error"], SIX_HOURS, seq="event_id",
                          carry=["event_id"]).select("user_id", "event_id_0", "event_id_1")


def _click_purchase(spark, sf, emit):
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return match_sequence(ev, "user_id", ["click", "purchase"], SIX_HOURS, seq="event_id",
                          emit=emit, carry=["event_id"])


def sequence_match(spark, sf):
    return _click_purchase(spark, sf, ("match",)).select("user_id", "event_id_0", "event_id_1")


def sequence_timeout(spark, sf):
    return _click_purchase(spark, sf, ("timeout",)).select("user_id", "event_id_0")


def order_timeouts(spark, sf):
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return order_timeout(ev, "user_id", "event_type", "click", SIX_HOURS).select("user_id", "event_id")


def _daily(spark, sf):
    """signup / purchase rows keyed by (user, UTC day): per-day reconciliation."""
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type",
                                   F.unix_date(F.col("ts").cast("date")).cast("long").alias("day"))
    return ev.filter(F.col("event_type") == "signup"), ev.filter(F.col("event_type") == "purchase")


def reconcile_tolerance(spark, sf):
    """J1 with a 12 h tolerance: a pair further apart reports both sides unmatched."""
    orders, pays = _daily(spark, sf)
    r = reconcile(orders, pays, key=["user_id", "day"], orders_seq="event_id", pays_seq="event_id",
                  tolerance="12 hours")
    return r.select("user_id", "day", "kind", F.col("order.event_id").alias("order_event_id"),
                    F.col("pay.event_id").alias("pay_event_id"))


def _reconciled(spark, sf, wanted):
    """Each (user, day)'s latest signup against its latest purchase."""
    orders, pays = _daily(spark, sf)
    r = reconcile(orders, pays, key=["user_id", "day"], orders_seq="event_id", pays_seq="event_id", kinds=[wanted])
    return r.select("user_id", "day", "kind", F.col("order.event_id").alias("order_event_id"),
                    F.col("pay.event_id").alias("pay_event_id"))


def reconcile_matched(spark, sf):
    return _reconciled(spark, sf, "matched")


def reconcile_unmatched_left(spark, sf):
    return _reconciled(spark, sf, "unmatched_order")


def reconcile_unmatched_right(spark, sf):
    return _reconciled(spark, sf, "unmatched_pay")


def parsed_events(spark, sf):
    """Every event written as delimited text and parsed back (typed, extra trailing field)."""
    ev = _events(spark, sf)
    lines = ev.select(F.concat_ws("|", F.col("event_id"), F.col("user_id"), F.col("event_type"),
                                  F.unix_micros(F.col("ts").cast("timestamp")), F.lit("extra")).alias("value"))
    return parse_delimited(lines, EVENT_LINE, sep="|")


def decoded_events(spark, sf):
    """S3: the same records as binary key / value pairs, decoded like a topic's."""
    ev = _events(spark, sf)
    raw = ev.select(F.col("event_id").cast("string").cast("binary").alias("key"),
                    F.concat_ws(",", "event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")))
                     .cast("binary").alias("value"))
    return decode_records(raw, EVENT_LINE).withColumn("key", F.col("key").cast("long"))


def epoch_scaling(spark, sf):
    """Times given in seconds, milliseconds and text seconds, counted per hour."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    sec, ms = (us / 1_000_000).cast("long"), (us / 1000).cast("long")
    ev = _events(spark, sf).select(sec.alias("s"), ms.alias("ms"), sec.cast("string").alias("txt"))
    parts = [tumbling_count(ev, "1 hour", ts=c, unit=u).select(F.lit(c).alias("unit"), "window_end", "cnt")
             for c, u in (("s", "s"), ("ms", "ms"), ("txt", "s"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def login_alerts(spark, sf):
    """F1 with its alert text."""
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return consecutive_events(ev, "user_id", "event_type", "error", SIX_HOURS, seq="event_id",
                              carry=["event_id"]).select("event_id", "msg")


def unique_visitors_approx_error(spark, sf):
    """A6 against A4: per window, whether the sketch is within 4 standard errors."""
    approx, exact = unique_visitors_approx(spark, sf), unique_visitors_hourly(spark, sf).withColumnRenamed("uv", "n")
    return approx.join(exact, "window_end").select(
        "window_end", (F.abs(F.col("uv") - F.col("n")) <= F.greatest(F.lit(1.0), F.col("n") * 4 * 0.05)).alias("within"))


def unique_visitors_daily_merged(spark, sf):
    """A6 stored: hourly sketches, merged into days."""
    return visitors_from_sketches(visitor_sketches(_views(spark, sf), "user_id", "1 hour"), "1 day")


def _user_pairs(spark, sf, tolerance=None):
    """J1 with repeated pairing: a user's signups and purchases over the whole table."""
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    r = reconcile_pairs(ev.filter(F.col("event_type") == "signup"), ev.filter(F.col("event_type") == "purchase"),
                        key="user_id", orders_seq="event_id", pays_seq="event_id", tolerance=tolerance)
    return r.select("user_id", "kind", F.col("order.event_id").alias("order_event_id"),
                    F.col("pay.event_id").alias("pay_event_id"))


def reconcile_repeated(spark, sf):
    return _user_pairs(spark, sf)


def reconcile_repeated_within(spark, sf):
    return _user_pairs(spark, sf, "12 hours")


def _timeout_states(spark, sf, clock):
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return order_timeout_state(ev, "user_id", "event_type", "click", SIX_HOURS, seq="event_id",
                               clock=clock).select("user_id", "event_id")


def order_timeout_machine(spark, sf):
    """F4 as the saved row with timers, time moving with every row of the stream."""
    return _timeout_states(spark, sf, "stream")


def order_timeout_machine_by_key(spark, sf):
    return _timeout_states(spark, sf, "key")


def _disordered(spark, sf):
    """Events in an arrival order of their own: up to about four hours late."""
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return ev.withColumn("arrival", (us + F.pmod(F.col("event_id") * 7919, F.lit(14_400)) * 1_000_000) * 1024
                         + F.pmod("event_id", F.lit(1024)))


def late_rows_kept(spark, sf):
    """Which rows a watermark of one hour takes into 2 h / 30 min windows, and from which on."""
    return drop_late(_disordered(spark, sf), seq="arrival", delay="1 hour", size="2 hours",
                     slide="30 minutes").select("event_id", "open_from")


def on_time_counts(spark, sf):
    """A2 without the late rows, no watermark delay."""
    return sliding_count_on_time(_disordered(spark, sf), ["event_type"], "2 hours", "30 minutes", seq="arrival")


def unique_visitors_running(spark, sf):
    """The visitors of the hour so far, for every page view."""
    ev = _events(spark, sf).filter(F.col("event_type") == "view").select("event_id", "ts", "user_id")
    return running_distinct(ev, "user_id", "1 hour", seq="event_id").select("event_id", "window_end", "uv")


def capped_geo_sliding(spark, sf):
    """A8 as the reference has it: by province, 1 h / 5 s, what the daily cap lets through."""
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("province"))
    passed = _capped(spark, sf).filter(F.col("kind") == "pass").select("ts", "user_id")
    geo = (passed.join(cust, passed.user_id == cust.c_custkey)
                 .join(nation, F.col("c_nationkey") == nation.n_nationkey).select("ts", "province"))
    return sliding_count(geo, ["province"], "1 hour", "5 seconds")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hot_items_topn": hot_items_topn,
    "hot_items_report": hot_items_report,
    "page_views_hourly": page_views_hourly,
    "unique_visitors_hourly": unique_visitors_hourly,
    "unique_visitors_bitmap": unique_visitors_bitmap,
    "unique_visitors_approx": unique_visitors_approx,
    "geo_clicks_sliding": geo_clicks_sliding,
    "events_sliding_1h_5s": events_sliding_1h_5s,
    "events_total_60s_1s": events_total_60s_1s,
    "channel_counts_sliding": channel_counts_sliding,
    "total_counts_sliding": total_counts_sliding,
    "daily_cap_warnings": daily_cap_warnings,
    "daily_cap_passed": daily_cap_passed,
    "capped_sliding_counts": capped_sliding_counts,
    "consecutive_failures": consecutive_failures,
    "login_fail_pattern": login_fail_pattern,
    "sequence_match": sequence_match,
    "sequence_timeout": sequence_timeout,
    "order_timeout": order_timeouts,
    "reconcile_tolerance": reconcile_tolerance,
    "reconcile_matched": reconcile_matched,
    "reconcile_unmatched_left": reconcile_unmatched_left,
    "reconcile_unmatched_right": reconcile_unmatched_right,
    "parsed_events": parsed_events,
    "decoded_events": decoded_events,
    "epoch_scaling": epoch_scaling,
    "login_alerts": login_alerts,
    "unique_visitors_approx_error": unique_visitors_approx_error,
    "unique_visitors_daily_merged": unique_visitors_daily_merged,
    "unique_visitors_running": unique_visitors_running,
    "reconcile_repeated": reconcile_repeated,
    "reconcile_repeated_within": reconcile_repeated_within,
    "order_timeout_machine": order_timeout_machine,
    "order_timeout_machine_by_key": order_timeout_machine_by_key,
    "late_rows_kept": late_rows_kept,
    "on_time_counts": on_time_counts,
    "capped_geo_sliding": capped_geo_sliding,
}
