"""Run one of the reference's programs on its text input and print the result.

    python -m tidemark hot_items behavior.csv
    python -m tidemark blacklist clicks.csv --max-count 100
    python -m tidemark tx_match orders.csv pays.csv
    python -m tidemark page_views input_dir --stream --out DIR --checkpoint DIR
    spark-submit --py-files tidemark.zip -m tidemark ...   (on a cluster)

Inputs are the reference's comma-separated layouts (see ``sources.delimited``).
``--out DIR`` writes parquet; without it every result row is printed, fetched
partition by partition.  ``--stream`` follows an input folder and appends to
``--out``; ``--checkpoint`` must stay the same on a restart, and
``--available-now`` ends when the files present are read.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from .plans import jobs
from .session import get_session
from .sources.delimited import AD_CLICK, LOGIN_EVENT, MARKETING, ORDER_EVENT, PAY_EVENT, USER_BEHAVIOR, read_delimited
from .streaming import jobs as stream_jobs

ONE_INPUT = {
    "hot_items": ("behavior", lambda d, a: [jobs.hot_items(d, a.top, report=a.report)]),
    "page_views": ("behavior", lambda d, a: [jobs.page_views(d)]),
    "unique_visitors": ("behavior", lambda d, a: [jobs.unique_visitors(d, method=a.method)]),
    "ad_statistics_by_geo": ("clicks", lambda d, a: [jobs.ad_statistics_by_geo(d)]),
    "blacklist": ("clicks", lambda d, a: list(jobs.blacklist(d, a.max_count))),
    "app_marketing_by_channel": ("marketing", lambda d, a: [jobs.app_marketing_by_channel(d)]),
    "app_marketing_statistics": ("marketing", lambda d, a: [jobs.app_marketing_statistics(d)]),
    "login_fail": ("login", lambda d, a: [jobs.login_fail(d)]),
    "login_fail_pattern": ("login", lambda d, a: [jobs.login_fail_pattern(d)]),
    "order_pattern_timeout": ("order", lambda d, a: [jobs.order_pattern_timeout(d)]),
    "order_timeout_state": ("order", lambda d, a: [jobs.order_timeout_state(d, machine=a.machine)]),
}


SCHEMAS = {"behavior": USER_BEHAVIOR, "clicks": AD_CLICK, "marketing": MARKETING, "login": LOGIN_EVENT,
           "order": ORDER_EVENT, "pay": PAY_EVENT}


def _stream(spark, a) -> None:
    kinds = ["order", "pay"] if a.job == "tx_match" else [ONE_INPUT[a.job][0]]
    inputs = [read_delimited(spark, path, SCHEMAS[k], streaming=True) for k, path in zip(kinds, a.inputs)]
    extra = {"unique_visitors": {"method": a.method}, "blacklist": {"max_count": a.max_count},
             "hot_items": {"top": a.top}}.get(a.job, {})
    fn = stream_jobs.tx_match if a.job == "tx_match" else stream_jobs.ONE_INPUT[a.job]
    running = stream_jobs.start(a.job, fn(*inputs, **extra), a.out, a.checkpoint, a.available_now, a.report)
    for q in running:
        q.awaitTermination()


def _read(spark, kind: str, path: str) -> DataFrame:
    if kind == "behavior":
        return jobs.user_behavior(spark, path)
    if kind == "clicks":
        return jobs.ad_clicks(spark, path)
    return read_delimited(spark, path, SCHEMAS[kind])


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tidemark")
    ap.add_argument("job", choices=sorted([*ONE_INPUT, "tx_match"]))
    ap.add_argument("inputs", nargs="+")
    ap.add_argument("--top", type=int, default=3)
    ap.add_argument("--report", action="store_true")
    ap.add_argument("--method", default="exact", choices=["exact", "bitmap", "approx"])
    ap.add_argument("--max-count", type=int, default=100)
    ap.add_argument("--machine", action="store_true", help="order_timeout_state: the saved row with timers")
    ap.add_argument("--repeated", action="store_true", help="tx_match: a key may pair again and again")
    ap.add_argument("--out")
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--checkpoint")
    ap.add_argument("--available-now", action="store_true")
    a = ap.parse_args(argv)
    if a.stream and not (a.out and a.checkpoint):
        ap.error("--stream needs --out and --checkpoint")
    spark = get_session()
    if a.stream:
        _stream(spark, a)
        return
    if a.job == "tx_match":
        results = list(jobs.tx_match(_read(spark, "order", a.inputs[0]), _read(spark, "pay", a.inputs[1]),
                                     repeated=a.repeated))
    else:
        kind, fn = ONE_INPUT[a.job]
        results = fn(_read(spark, kind, a.inputs[0]), a)
    for i, df in enumerate(results):
        if a.out:
            df.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{a.job}_{i}")
        else:
            print("\t".join(df.columns))
            for row in df.toLocalIterator():
                print("\t".join("" if v is None else str(v) for v in row))


if __name__ == "__main__":
    main()
