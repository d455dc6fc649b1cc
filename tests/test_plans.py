"""Physical-plan shape: the properties the operators rely on at scale."""

import re

import pytest

from pyspark.sql import functions as F

from tidemark import daily_cap, sliding_count
from tidemark.plans import queries as Q
from tidemark.plans.ordered import time_bucket, with_neighbors

from paths import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sliding_count_no_expand_partial_agg_then_block_window(spark):
    p = plan(Q.geo_clicks_sliding(spark, SF))
    assert "Expand" not in p
    assert "partial_count(1)" in p
    # the running sum is partitioned by (key, time block), never by the key alone
    assert re.search(r"Exchange hashpartitioning\(_part#\d+", p) and "struct(_blk" in p


def test_no_key_total_is_split_by_time_block(spark):
    p = plan(Q.total_counts_sliding(spark, SF))
    assert re.search(r"Exchange hashpartitioning\(_part#\d+", p)
    assert "SinglePartition" not in p


def test_top_n_and_cap_limit_map_side(spark):
    p = plan(Q.hot_items_topn(spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p
    ev = spark.read.parquet(f"{SF}/events.parquet")
    p2 = plan(daily_cap(ev, ["user_id", "event_type"], 2, seq="event_id"))
    assert re.search(r"WindowGroupLimit .*Partial", p2)


def test_neighbors_shuffle_full_rows_by_bucket(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp")))
    df = with_neighbors(ev, ["user_id"], ["_t", "event_id"], time_bucket(F.col("_t"), 3_600_000_000),
                        ["event_id"], lags=1, leads=1)
    p = plan(df)
    # full rows are partitioned by (key, bucket), never by the plain key column
    assert re.search(r"Exchange hashpartitioning\(_nb_k#\d+, _nb_b#\d+", p)
    assert not re.search(r"Exchange hashpartitioning\(user_id#\d+, \d+\)", p)
    assert "Join" not in p


@pytest.mark.parametrize("keys", [["channel"], ["channel", "event_type"], None])
def test_sliding_count_has_one_exchange_after_the_panes(spark, keys):
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("channel", F.lit("one"))
    p = plan(sliding_count(ev, keys, "60 seconds", "1 second"))
    panes = p.index("HashAggregate")
    assert len(re.findall(r"Exchange hashpartitioning\(_part#", p)) == 1
    assert len(re.findall(r"\bExchange hashpartitioning", p[:panes])) == 1


def test_order_timeout_frames_are_one_sided(spark):
    p = plan(Q.order_timeouts(spark, SF))
    assert "specifiedwindowframe(RangeFrame, unboundedpreceding$()" in p
    assert not re.search(r"RangeFrame, (cast\()?-\d+", p) and "Generate explode" not in p


def test_reconcile_matched_is_an_inner_join(spark):
    p = plan(Q.reconcile_matched(spark, SF))
    assert "Inner" in p and "FullOuter" not in p
    assert "LeftAnti" in plan(Q.reconcile_unmatched_left(spark, SF))


def test_daily_cap_has_one_plan(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    shapes = [re.sub(r"#\d+L?|plan_id=\d+|<= \d+|, \d+, (Partial|Final)|WindowGroupLimit.*", "", plan(daily_cap(ev, ["user_id"], m, seq="event_id")))
              for m in (100, 700)]
    assert [len(re.findall("Exchange", x)) for x in shapes][0] == [len(re.findall("Exchange", x)) for x in shapes][1]


def test_scans_prune_and_push_down(spark):
    p = plan(Q.page_views_hourly(spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in p  # only the two columns used


def test_batch_plans_have_no_python(spark):
    for name, fn in Q.QUERIES.items():
        p = plan(fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_cap_without_large_keys_is_one_window(spark):
    """One job finds that no key is large (one scan, one exchange); the plan itself has no join."""
    p = plan(Q.daily_cap_warnings(spark, SF))
    assert p.count("Scan parquet") == 1 and "Join" not in p
    assert len(re.findall(r"\bExchange hashpartitioning", p)) == 1


def test_prefix_scans_without_large_keys_have_no_join(spark):
    p = plan(Q.reconcile_repeated(spark, SF))
    assert "Join" not in p and len(re.findall(r"\bExchange hashpartitioning", p)) == 1
    p = plan(Q.unique_visitors_running(spark, SF))
    assert "Join" not in p and p.count("Scan parquet") == 2


def test_only_rows_of_large_keys_meet_the_edges(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    p = plan(daily_cap(ev, ["event_type"], 2, seq="event_id", target_rows=3))
    assert "LeftAnti" in p and "LeftSemi" in p and re.search(r"Window.*_gk#\d+, _bk#\d+", p)
