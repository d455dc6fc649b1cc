"""Per-key stateful rules in batch form (R1 daily cap, F1 consecutive events)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import cap_warning, login_alert
from ..functions.time import epoch_micros, parse_duration
from ..plans.ordered import TARGET_ROWS, balanced_buckets, balanced_neighbors, floor_div, large_keys

DAY_US = 86_400_000_000
#: Sequence numbers per counting slot when rows are taken in arrival order.
ARRIVAL_SLOT = 1 << 20


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def daily_cap(df: DataFrame, keys: str | Sequence[str], max_count: int = 100, ts: str = "ts",
              seq: str | None = None, unit: str = "auto", kind: str = "kind", msg: str = "msg",
              bucket="1 hour", target_rows: int = TARGET_ROWS, order: str = "event") -> DataFrame:
    """Per key and UTC day, rows 1..max+1 pass, row max+2 warns, the rest drop.

    (The reference checks ``count > max`` *before* counting the row, so max+1
    rows pass.)  Returns the surviving rows with ``kind`` in ('pass','warning')
    and the warning text in ``msg``.  ``order='event'`` counts by (ts, seq);
    ``order='arrival'`` by ``seq``, as the reference meets the rows.

    One plan for every ``max_count``: where a (key, day) has more than
    ``target_rows`` rows, rows are ranked inside (key, day, bucket), at most max+2
    of a bucket stay, and the rank is completed by the row counts of the earlier
    buckets; where none has, inside (key, day).
    """
    keys = _keys(keys)
    limit = max_count + 2
    base = df.withColumn("_t", epoch_micros(df, ts, unit)).withColumn("_day", floor_div(F.col("_t"), DAY_US))
    if order == "arrival":
        ordering, pos, width = [F.col(seq)], F.col(seq), ARRIVAL_SLOT
    else:
        ordering, pos, width = [F.col("_t")] + ([F.col(seq)] if seq else []), F.col("_t"), parse_duration(bucket)
    large = large_keys(base, [*keys, "_day"], target_rows)
    if large is None:
        ranked = base.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_day").orderBy(*ordering)))
        ranked = ranked.filter(F.col("_rn") <= limit)
    else:
        b = (balanced_buckets(base, [*keys, "_day"], pos, width, target_rows, "_bk", large)
             .withColumn("_gk", F.struct(*[F.col(k) for k in keys], F.col("_day"))))  # NULL-safe group key
        ranked = b.withColumn("_rn", F.row_number().over(Window.partitionBy("_gk", "_bk").orderBy(*ordering)))
        ranked = ranked.filter(F.col("_rn") <= limit)
        counts = b.filter(F.col("_bk") > 0).groupBy("_gk", "_bk").agg(F.count(F.lit(1)).alias("_bc"))
        ws = Window.partitionBy("_gk").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("_gk", "_bk", F.coalesce(F.sum("_bc").over(ws), F.lit(0)).alias("_off"))
        ranked = (ranked.join(offsets, ["_gk", "_bk"], "left")
                        .withColumn("_rn", F.col("_rn") + F.coalesce("_off", F.lit(0))).filter(F.col("_rn") <= limit))
    return (ranked.withColumn(kind, F.when(F.col("_rn") <= max_count + 1, F.lit("pass"))
                              .otherwise(F.lit("warning")))
                  .withColumn(msg, F.when(F.col(kind) == "warning", cap_warning(max_count)))
                  .select(*df.columns, kind, msg))


def consecutive_events(df: DataFrame, key: str, type_col: str = "event_type", event: str = "fail",
                       gap="2 seconds", ts: str = "ts", seq: str = "seq", unit: str = "auto",
                       order: str = "arrival", carry: Sequence[str] | None = None,
                       bucket="1 hour", target_rows: int = TARGET_ROWS) -> DataFrame:
    """alert on an ``event`` row whose immediately preceding row of the same
    key is also ``event`` and lies less than ``gap`` earlier (strict; a negative
    gap - out-of-order input - alerts too).  Any other type in between resets.

    ``order='arrival'`` follows ``seq`` (the reference processes rows as they
    arrive); ``order='event'`` follows (ts, seq).  Adds ``prev_<c>`` for each
    carried column and the alert text ``msg``.  Keys with more than
    ``target_rows`` rows are cut along the order; ``bucket=None`` gives a plain
    per-key window.
    """
    carry = list(carry) if carry is not None else [c for c in (seq, ts) if c]
    g = parse_duration(gap)
    base = df.withColumn("_t", epoch_micros(df, ts, unit))
    if order == "arrival":
        ordering, pos, width = [F.col(seq)], F.col(seq), ARRIVAL_SLOT
    else:
        ordering, pos, width = [F.col("_t")] + ([F.col(seq)] if seq else []), F.col("_t"), bucket
    if bucket is None:
        width = None
    elif order != "arrival":
        width = parse_duration(bucket)
    payload = list(dict.fromkeys([type_col, "_t", *carry]))
    nb = balanced_neighbors(base, [key], ordering, pos, width, payload, lags=1, target=target_rows)
    p = F.col("prev1")
    hit = ((F.col(type_col) == event) & (p[type_col] == event)
           & (F.col("_t") < p["_t"] + F.lit(g)))
    return nb.filter(hit).select(*df.columns, *[p[c].alias(f"prev_{c}") for c in carry],
                                 login_alert(F.col(key)).alias("msg"))
