"""Report and alert texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .time import render_epoch_ms

# Fixed values (must equal the reference's printed texts):
#   login alert suffix:  "2s内连续登录失败"
#   blacklist warning:   "Click over <max> times today."
#   top-N report lines:  "No<rank>: 商品ID=<item> 浏览量=<count>", header "时间：<window end>",
#                        a rule of 43 '=' above and a rule of 44 '=' below.
LOGIN_ALERT_SUFFIX = "2s内连续登录失败"
CAP_WARNING = "Click over {max} times today."
REPORT_LINE = ("No", ": 商品ID=", " 浏览量=")
REPORT_TIME = "时间："
REPORT_RULE_TOP = "=" * 43
REPORT_RULE_BOTTOM = "=" * 44


def login_alert(user: Column) -> Column:
    return F.concat(user.cast("string"), F.lit(LOGIN_ALERT_SUFFIX))


def cap_warning(max_count: int) -> Column:
    return F.lit(CAP_WARNING.format(max=max_count))


def format_topn_report(topn: DataFrame, window_end_ms: str = "window_end", rank: str = "rank",
                       item: str = "item_id", count: str = "cnt", tz: str | None = None) -> DataFrame:
    """One text report per window from ``top_n_per_window`` output.

    Each window holds at most N ranked rows, so the per-window collect is bounded.
    """
    g = (topn.groupBy(window_end_ms)
             .agg(F.sort_array(F.collect_list(F.struct(F.col(rank).alias("rank"),
                                                       F.col(item).alias("item"),
                                                       F.col(count).alias("cnt")))).alias("rows")))
    when_txt = render_epoch_ms(F.col(window_end_ms), tz, fraction=True)
    body = F.array_join(F.transform("rows", lambda r: F.concat(
        F.lit(REPORT_LINE[0]), r["rank"].cast("string"), F.lit(REPORT_LINE[1]),
        r["item"].cast("string"), F.lit(REPORT_LINE[2]), r["cnt"].cast("string"))), "\n")
    report = F.concat_ws("\n", F.lit(REPORT_RULE_TOP), F.concat(F.lit(REPORT_TIME), when_txt), body,
                         F.lit(REPORT_RULE_BOTTOM), F.lit(""), F.lit(""))
    return g.select(window_end_ms, report.alias("report"))
