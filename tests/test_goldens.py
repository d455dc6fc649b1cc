"""Goldens of SURVEY 5.1 on the reference's fixtures."""

from pyspark.sql import functions as F

from tidemark import (consecutive_events, daily_cap, hash61, match_sequence,
                      order_timeout, reconcile, sliding_count)


def test_read_delimited(ad_clicks):
    assert ad_clicks.count() == 143
    assert ad_clicks.select("user_id").distinct().count() == 13
    by = {r.province: r["count"] for r in ad_clicks.groupBy("province").count().collect()}
    assert by == {"beijing": 123, "guangdong": 5, "zhejiang": 5, "jiangsu": 4, "henan": 3,
                  "shanghai": 2, "hebei": 1}
    first = ad_clicks.orderBy("seq").first()
    assert (first.user_id, first.ad_id, first.province, first.event_time) == (543462, 1715, "beijing", 1511658000)


def test_consecutive_failures_login(login_events):
    res = consecutive_events(login_events, "user_id", "event_type", "fail", "2 seconds",
                             ts="event_time", unit="s", seq="seq", carry=["ip"]).collect()
    got = sorted((r.user_id, r.event_time, r.ip, r.prev_ip) for r in res)
    assert got == [("1", "1558430843", "192.168.0.2", "192.168.0.1"),
                   ("1", "1558430844", "192.168.0.3", "192.168.0.2")]
    assert all(r.msg == "1" + "2s内连续登录失败" for r in res)


def test_match_sequence_login(login_events):
    res = match_sequence(login_events, "user_id", ["fail", "fail"], "2 seconds", ts="event_time",
                         unit="s", seq="seq", carry=["ip", "event_type"]).collect()
    got = sorted((r.user_id, r.ip_1, r.event_type_1) for r in res)
    assert got == [("1", "192.168.0.2", "fail"), ("1", "192.168.0.3", "fail")]


def test_pattern_timeout_orders(order_events):
    res = match_sequence(order_events, "order_id", ["create", "pay"], "5 seconds", ts="event_time",
                         unit="s", seq="seq", emit=("match", "timeout", "broken"),
                         carry=["event_time"]).collect()
    kinds = sorted((r.order_id, r.kind, r.event_time_0) for r in res)
    assert kinds == [("1", "timeout", "1558430842"), ("2", "match", "1558430843")]


def test_order_timeout_state_timer(order_events):
    res = order_timeout(order_events, "order_id", "event_type", "create", "5 seconds",
                        ts="event_time", unit="s").collect()
    assert [(r.order_id, r.event_type, r.event_time) for r in res] == [("1", "create", "1558430842")]


def test_reconcile_fixture(tx):
    o, p = tx
    for tol in (None, "3 seconds"):
        res = reconcile(o, p, "order_id", "event_time", "event_time", "seq", "seq", unit="s",
                        tolerance=tol).collect()
        matched = sorted(r.order_id for r in res if r.kind == "matched")
        uo = [(r.order.order_id, r.order.event_type, r.order.event_time) for r in res if r.kind == "unmatched_order"]
        up = [(r.pay.order_id, r.pay.channel, r.pay.event_time) for r in res if r.kind == "unmatched_pay"]
        assert matched == ["1", "2"]
        assert uo == [("3", "pay", "1558430849")]
        assert up == [("4", "zhifubao", "1558430850")]


def _by_end(rows, end_s):
    return {r.province: r.cnt for r in rows if r.window_end == end_s * 1000}


def test_geo_sliding_1h_5s(ad_clicks):
    rows = sliding_count(ad_clicks, ["province"], "1 hour", "5 seconds", ts="event_time", unit="s").collect()
    assert len(rows) == 5991
    assert sum(r.cnt for r in rows) == 102960 == 143 * 720
    assert _by_end(rows, 1511661600) == {"beijing": 2, "guangdong": 5, "shanghai": 2}
    assert _by_end(rows, 1511661715)["beijing"] == 117
    assert _by_end(rows, 1511661720) == {"beijing": 122, "zhejiang": 5, "guangdong": 4, "jiangsu": 4,
                                         "henan": 3, "shanghai": 2, "hebei": 1}


def test_sliding_equals_f_window(ad_clicks):
    ours = sliding_count(ad_clicks, ["province"], "10 minutes", "1 minute", ts="event_time", unit="s")
    ref = (ad_clicks.withColumn("ts", F.timestamp_seconds("event_time"))
           .groupBy("province", F.window("ts", "10 minutes", "1 minute")).count()
           .select("province", (F.unix_millis(F.col("window.end"))).alias("window_end"), F.col("count").alias("cnt")))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_daily_cap_blacklist(ad_clicks):
    res = daily_cap(ad_clicks, ["user_id", "ad_id"], 100, ts="event_time", unit="s", seq="seq")
    warn = res.filter("kind = 'warning'").collect()
    assert [(r.user_id, r.ad_id, r.msg) for r in warn] == [(937166, 1715, "Click over 100 times today.")]
    assert warn[0].seq == 123  # line 124 of the file
    passed = res.filter("kind = 'pass'")
    assert passed.count() == 123
    assert passed.filter("user_id = 937166 AND ad_id = 1715").count() == 101


def test_capped_geo_counts(ad_clicks):
    passed = daily_cap(ad_clicks, ["user_id", "ad_id"], 100, ts="event_time", unit="s", seq="seq").filter("kind = 'pass'")
    rows = sliding_count(passed, ["province"], "1 hour", "5 seconds", ts="event_time", unit="s").collect()
    assert len(rows) == 5988
    assert sum(r.cnt for r in rows) == 88560 == 123 * 720
    assert _by_end(rows, 1511661715)["beijing"] == 102
    assert _by_end(rows, 1511661720)["beijing"] == 102


def test_hash61(spark):
    ids = ["1", "937166", "abcdefghij", "", "1234567890123"]
    want = [49, 5543688, 454937155, 0, 134946931]
    got = [r.h for r in spark.createDataFrame([(i,) for i in ids], "id string")
           .select(hash61("id").alias("h")).collect()]
    assert got == want
