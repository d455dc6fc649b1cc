"""Sequence patterns (F2 strict-contiguity match, F3 match timeout, F4 order timeout)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import epoch_micros, parse_duration
from ..plans.ordered import TARGET_ROWS, balanced_buckets, balanced_neighbors, large_keys, running


def match_sequence(df: DataFrame, key: str, steps: Sequence[Column | str], within,
                   ts: str = "ts", seq: str | None = "seq", unit: str = "auto",
                   type_col: str = "event_type", emit: Sequence[str] = ("match",),
                   carry: Sequence[str] | None = None, kind: str = "kind",
                   bucket="1 hour", target_rows: int = TARGET_ROWS) -> DataFrame:
    """``begin(steps[0]).next(steps[1])...within(within)`` per key.

    Rows of a key are taken in event-time order (ties by ``seq``).  Each row
    matching ``steps[0]`` starts an attempt; the following rows must match
    the next steps one by one (strict contiguity).  Outcome per start:

    * ``match``   - all steps matched and last.ts - first.ts < within;
    * ``timeout`` - the run ended (no next row) or the next row came at or
      after first.ts + within before the pattern completed;
    * ``broken``  - a next row inside the window did not match its step.

    Attempts overlap (every start is judged).  Returns one row per start whose
    kind is in ``emit``, with ``<c>_<i>`` for each carried column of step i.
    Keys with more than ``target_rows`` rows are cut along time (counted in slots
    of ``bucket``); ``bucket=None`` gives a plain per-key window.
    """
    n = len(steps)
    if n < 2:
        raise ValueError("a sequence needs at least two steps")
    preds = [F.col(type_col) == s if isinstance(s, str) else s for s in steps]
    w = parse_duration(within)
    carry = list(carry) if carry is not None else [c for c in (seq, ts) if c]
    base = df.withColumn("_t", epoch_micros(df, ts, unit))
    for i, p in enumerate(preds):
        base = base.withColumn(f"_s{i}", F.coalesce(p, F.lit(False)))
    ordering = [F.col("_t")] + ([F.col(seq)] if seq else [])
    payload = list(dict.fromkeys([*carry, "_t", *[f"_s{i}" for i in range(1, n)]]))
    nb = balanced_neighbors(base, [key], ordering, F.col("_t"), None if bucket is None else parse_duration(bucket),
                            payload, leads=n - 1, target=target_rows)
    outcome: Column = F.lit("match")
    for i in range(n - 1, 0, -1):
        nx = F.col(f"next{i}")
        outcome = (F.when(nx.isNull() | (nx["_t"] - F.col("_t") >= F.lit(w)), F.lit("timeout"))
                    .when(~nx[f"_s{i}"], F.lit("broken"))
                    .otherwise(outcome))
    res = nb.filter(F.col("_s0")).withColumn(kind, outcome).filter(F.col(kind).isin(list(emit)))
    cols = [F.col(key), F.col(kind)]
    for c in carry:
        cols.append(F.col(c).alias(f"{c}_0"))
    for i in range(1, n):
        for c in carry:
            cols.append(F.when(F.col(kind) == "match", F.col(f"next{i}")[c]).alias(f"{c}_{i}"))
    return res.select(*cols)


def order_timeout(df: DataFrame, key: str, type_col: str = "event_type", start: str = "create",
                  limit="15 minutes", ts: str = "ts", unit: str = "auto", bucket="1 hour",
                  target_rows: int = TARGET_ROWS) -> DataFrame:
    """F4 (state + timer form) as an event-time contract.

    A ``start`` row c alerts when (a) no other start of its key lies in
    [c.ts - limit, c.ts) - a repeated start is absorbed by the pending one -
    and (b) no non-start row of its key lies in [c.ts, c.ts + limit].

    Only the latest start before c and the first other row from c on matter:
    two running aggregates per (key, bucket).  Keys with more than
    ``target_rows`` rows are cut along time; of their other buckets a summary
    of two times per bucket is enough, so no row is copied and nothing depends
    on ``limit``.
    """
    lim = parse_duration(limit)
    t = F.col("_t")
    base = (df.withColumn("_t", epoch_micros(df, ts, unit))
              .withColumn("_st", F.coalesce(F.col(type_col) == start, F.lit(False))))
    large = large_keys(base, [key], target_rows) if bucket is not None else None
    width = parse_duration(bucket) if large is not None else 1
    cut = balanced_buckets(base, [key], t, width, target_rows, "_b", large).withColumn("_k", F.struct(F.col(key)))
    start_t, other_t = F.when(F.col("_st"), t), F.when(~F.col("_st"), t)
    up = Window.partitionBy("_k", "_b").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    down = (Window.partitionBy("_k", "_b").orderBy(F.col("_t").desc())
                  .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    rows = cut.select("*", F.max(start_t).over(up).alias("_before"), F.min(other_t).over(down).alias("_after"))
    if large is None:
        before, after = F.col("_before"), F.col("_after")
        return (rows.filter(F.col("_st") & (before.isNull() | (before < t - F.lit(lim)))
                            & (after.isNull() | (after > t + F.lit(lim)))).select(*df.columns))
    # what the other buckets of a cut key hold: the last start and the first other row
    per = (cut.filter(F.col("_b") > 0).groupBy("_k", "_b")
              .agg(F.max(start_t).alias("_ls"), F.min(other_t).alias("_fo")))
    wk = Window.partitionBy("_k").orderBy("_b")
    per = per.select("_k", "_b", F.max("_ls").over(wk.rowsBetween(Window.unboundedPreceding, -1)).alias("_xb"),
                     F.min("_fo").over(wk.rowsBetween(1, Window.unboundedFollowing)).alias("_xa"))
    res = rows.filter(F.col("_st")).join(per, ["_k", "_b"], "left")
    before, after = F.greatest("_before", "_xb"), F.least("_after", "_xa")  # both skip NULLs
    return (res.filter((before.isNull() | (before < t - F.lit(lim))) & (after.isNull() | (after > t + F.lit(lim))))
               .select(*df.columns))


def order_timeout_state(df: DataFrame, key: str, type_col: str = "event_type", start: str = "create",
                        limit="15 minutes", ts: str = "ts", seq: str = "seq", unit: str = "auto", clock: str = "stream",
                        bucket="1 hour", target_rows: int = TARGET_ROWS) -> DataFrame:
    """F4 as the state machine itself: per key one saved row and a timer at every
    row's time + ``limit``.  A ``start`` is saved if nothing is, any other row
    replaces what is saved; a timer reports a saved start and clears.

    Rows come in the order of (ts, seq).  A timer has fired before a row if a row
    before it had a later time than the timer: a row of any key (``clock='stream'``,
    the reference's watermark after every row) or of this key (``'key'``).  At the
    end of the input all timers fire.

    Rows and timers are put on one line per key, a row at the time the clock shows
    when it comes.  The timers that have fired number the runs of rows between two
    clearings; a run reports its first row if it holds starts only.  So a running
    count (keys with more than ``target_rows`` events are cut along time) and one
    aggregate are enough, however many timers a run has.
    """
    lim = parse_duration(limit)
    base = (df.withColumn("_t", epoch_micros(df, ts, unit)).withColumn("_q", F.col(seq).cast("long"))
              .withColumn("_st", F.coalesce(F.col(type_col) == start, F.lit(False))).withColumn("_all", F.lit(0)))
    scope = "_all" if clock == "stream" else key
    base = _cut_running(base, [scope], ["_t", "_q"], "_t", F.col("_t"), "max", "_clock", True, bucket, target_rows)
    # the first row of all finds a clock that has not begun
    events = base.withColumn("_e", F.explode(F.array(
        F.struct(F.coalesce("_clock", F.col("_t")).alias("at"), F.lit(0).alias("fires")),
        F.struct((F.col("_t") + F.lit(lim)).alias("at"), F.lit(1).alias("fires")))))
    events = events.withColumn("_at", F.col("_e.at")).withColumn("_fires", F.col("_e.fires"))
    # a row meets the timers before its clock; at the same instant the row comes first
    events = _cut_running(events.select(*df.columns, "_t", "_q", "_st", "_at", "_fires"), [key],
                          ["_at", "_fires", "_t", "_q"], "_at", F.col("_fires"), "sum", "_run", False, bucket, target_rows)
    rows = events.filter(F.col("_fires") == 0).withColumn("_k", F.struct(F.col(key)))
    runs = rows.groupBy("_k", "_run").agg(
        F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct("_t", "_q")).alias("_first"), F.min("_st").alias("_only"))
    return runs.filter("_only").select("_first.*")


def _cut_running(df, keys, order, pos, value, how, out, strict, bucket, target_rows):
    """``running`` with the keys above ``target_rows`` cut along ``pos``."""
    large = large_keys(df, keys, target_rows)
    b = balanced_buckets(df, keys, F.col(pos), parse_duration(bucket), target_rows, "_b", large)
    return running(b, keys, order, value, how, out, None if large is None else "_b", strict).drop("_b")
