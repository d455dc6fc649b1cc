"""Reference programs as jobs, sources/sinks, driver contract."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import format_topn_report
from tidemark.plans import jobs
from tidemark.sinks import foreach_kind, read_upserted, split_by_kind, upsert_batch
from tidemark.sources import AD_CLICK, ORDER_EVENT, decode_records, kafka_options, parse_delimited, read_delimited

from paths import FIXTURES, SF


def test_blacklist_job(spark):
    clicks = jobs.ad_clicks(spark, os.path.join(FIXTURES, "ad_clicks.csv"))
    geo, warnings = jobs.blacklist(clicks)
    assert [(r.user_id, r.ad_id) for r in warnings.collect()] == [(937166, 1715)]
    assert geo.count() == 5988
    row = geo.filter("window_end = '2017-11-26 02:01:55' AND province = 'beijing'").first()
    assert row.cnt == 102  # end 1511661715 rendered in UTC


def test_login_and_order_jobs(login_events, order_events, tx):
    assert sorted(r.ip for r in jobs.login_fail(login_events).collect()) == ["192.168.0.2", "192.168.0.3"]
    assert sorted(tuple(r) for r in jobs.login_fail_pattern(login_events).collect()) == [
        ("1", "192.168.0.2", "fail"), ("1", "192.168.0.3", "fail")]
    assert [tuple(r) for r in jobs.order_pattern_timeout(order_events).collect()] == [("1", "create", "1558430842")]
    assert [r.order_id for r in jobs.order_timeout_state(order_events).collect()] == ["1"]
    # the pay of order 3 moves the clock past order 1's timer before its own pay comes
    assert [r.order_id for r in jobs.order_timeout_state(order_events, machine=True).collect()] == ["1"]
    m, uo, up = jobs.tx_match(*tx, repeated=True)
    assert m.count() == 2 and [r.order_id for r in uo.collect()] == ["3"] and [r.order_id for r in up.collect()] == ["4"]
    m, uo, up = jobs.tx_match(*tx)
    assert sorted(r.order_id for r in m.collect()) == ["1", "2"]
    assert [(r.order_id, r.event_type, r.event_time) for r in uo.collect()] == [("3", "pay", "1558430849")]
    assert [(r.order_id, r.channel, r.event_time) for r in up.collect()] == [("4", "zhifubao", "1558430850")]


def test_behavior_jobs(spark):
    rows = [("1", "10", "c", "pv", 1511658000), ("2", "10", "c", "pv", 1511658060),
            ("1", "11", "c", "pv", 1511658120), ("3", "12", "c", "buy", 1511658130),
            ("2", "11", "c", "pv", 1511661700)]
    b = spark.createDataFrame(rows, "user_id string, item_id string, category_id string, behavior string, event_time long")
    top = jobs.hot_items(b, n=1).filter("window_end = 1511658300000").collect()
    assert [(r.item_id, r.cnt, r.rank) for r in top] == [("10", 2, 1)]
    assert {(r.window_end, r.pv) for r in jobs.page_views(b).collect()} == {(1511661600000, 3), (1511665200000, 1)}
    for m in ("exact", "bitmap", "approx"):
        assert {(r.window_end, r.uv) for r in jobs.unique_visitors(b, method=m).collect()} == {
            (1511661600000, 2), (1511665200000, 1)}


def test_marketing_jobs(spark):
    rows = [("u1", "BROWSE", "weibo", 1_000_500), ("u2", "CLICK", "weibo", 1_000_700),
            ("u3", "UNINSTALL", "weibo", 1_000_800), ("u4", "BROWSE", "weibo", 1_001_200)]
    m = spark.createDataFrame(rows, "user_id string, behavior string, channel string, event_time long")
    by = jobs.app_marketing_by_channel(m)
    assert by.filter("behavior = 'UNINSTALL'").count() == 0
    assert by.select(F.sum("cnt")).first()[0] == 3 * 60
    tot = jobs.app_marketing_statistics(m).collect()
    assert {r.channel for r in tot} == {"Total"}
    assert max(r.cnt for r in tot) == 3
    first = min(tot, key=lambda r: r.window_end)
    assert (first.window_start, first.window_end) == ("1970-01-01 00:15:41", "1970-01-01 00:16:41")


def test_topn_report_text(spark):
    top = spark.createDataFrame([(1511658900000, "812879", 7, 1), (1511658900000, "138964", 5, 2),
                                 (1511658900000, "4568476", 5, 3)], "window_end long, item_id string, cnt long, rank long")
    text = format_topn_report(top).first().report
    assert text == ("=" * 43 + "\n时间：2017-11-26 01:15:00.0\n"
                    "No1: 商品ID=812879 浏览量=7\nNo2: 商品ID=138964 浏览量=5\nNo3: 商品ID=4568476 浏览量=5\n"
                    + "=" * 44 + "\n\n")


def test_parse_is_strict(spark):
    lines = spark.createDataFrame([("1,2,beijing,beijing,notanumber",)], "value string")
    with pytest.raises(Exception):
        parse_delimited(lines, AD_CLICK).collect()
    short = spark.createDataFrame([("1,2,beijing",)], "value string")
    with pytest.raises(Exception):
        parse_delimited(short, AD_CLICK).collect()


def test_kafka_options_and_decode(spark):
    o = kafka_options("broker:9092", "clicks", group_id="consumer-group")
    assert o == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "clicks",
                 "startingOffsets": "latest", "kafka.group.id": "consumer-group"}
    raw = spark.createDataFrame([(None, bytearray(b"543462,1715,beijing,beijing,1511658000"))], "key binary, value binary")
    r = decode_records(raw, AD_CLICK).first()
    assert (r.user_id, r.ad_id, r.event_time, r.key) == (543462, 1715, 1511658000, None)


def test_upsert_log_and_side_outputs(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-upsert-"), "uv")
    fn = upsert_batch(path, ["window_end"])
    fn(spark.createDataFrame([(1, 5), (2, 7)], "window_end long, uv long"), 0)
    fn(spark.createDataFrame([(1, 6)], "window_end long, uv long"), 1)
    fn(spark.createDataFrame([(1, 6)], "window_end long, uv long"), 1)  # retried batch: idempotent
    assert sorted(tuple(r) for r in read_upserted(spark, path, ["window_end"]).collect()) == [(1, 6), (2, 7)]
    df = spark.createDataFrame([(1, "pass"), (2, "warning"), (3, "pass")], "id long, kind string")
    parts = split_by_kind(df, ["pass", "warning"])
    assert parts["pass"].count() == 2 and parts["warning"].count() == 1
    seen = {}
    foreach_kind({"pass": lambda d, e: seen.setdefault("pass", d.count()),
                  "warning": lambda d, e: seen.setdefault("warning", d.count())})(df, 0)
    assert seen == {"pass": 2, "warning": 1}


def test_driver_contract(spark):
    import __spark_entry__ as e
    from tidemark.plans import queries

    df = e.entry(spark)
    assert set(df.columns) == {"window_end", "item_id", "cnt", "rank"}
    assert df.count() > 0
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    own = set(queries.QUERIES)  # the optional training-data queries come on top
    assert own <= set(q) and len(own - set(o)) == 1


def test_approx_error_bound(spark):
    from tidemark import unique_per_window, unique_per_window_approx

    ev = spark.read.parquet(f"{SF}/events.parquet")
    exact = {r.window_end: r.uv for r in unique_per_window(ev, "user_id", "1 day").collect()}
    approx = {r.window_end: r.uv for r in unique_per_window_approx(ev, "user_id", "1 day", rsd=0.05).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= max(2, 0.15 * exact[k]) for k in exact)


def test_cli_writes_job_results(spark):
    from tidemark.__main__ import main

    out = tempfile.mkdtemp(prefix="tidemark-cli-")
    main(["blacklist", os.path.join(FIXTURES, "ad_clicks.csv"), "--out", out])
    assert spark.read.parquet(f"{out}/blacklist_0").count() == 5988
    assert [r.user_id for r in spark.read.parquet(f"{out}/blacklist_1").collect()] == [937166]


def test_seq_follows_files_by_name_and_rows(spark, tmp_path):
    (tmp_path / "a_first.csv").write_text("1,create,100\n")
    (tmp_path / "b_second.csv").write_text("".join(f"{i},create,{i}\n" for i in range(2, 5000)))
    (tmp_path / "c_third.csv").write_text("5000,pay,1\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")  # several splits of one file
    try:
        rows = read_delimited(spark, str(tmp_path), ORDER_EVENT).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [int(r.order_id) for r in rows] == list(range(1, 5001))
    assert len({r.seq for r in rows}) == 5000


def test_separator_is_literal(spark):
    lines = spark.createDataFrame([("7|create|100",), ("8|pay|101",)], "value string")
    got = parse_delimited(lines, ORDER_EVENT, sep="|").collect()
    assert [tuple(r) for r in got] == [("7", "create", "100"), ("8", "pay", "101")]


def test_cli_prints_every_row(spark, tmp_path, capsys):
    from tidemark import __main__ as cli

    f = tmp_path / "b.csv"
    f.write_text("".join(f"u{i},i{i},c,pv,{i * 3600}\n" for i in range(120)))
    cli.main(["page_views", str(f)])
    assert len(capsys.readouterr().out.strip().splitlines()) == 121  # a header and 120 windows


def test_batch_session_needs_no_checkpoint_folder():
    import inspect

    from tidemark import session

    assert "ensure_checkpoint_dir" not in inspect.getsource(session.get_session)
