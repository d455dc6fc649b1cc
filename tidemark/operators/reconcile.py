"""Two-stream one-to-one reconciliation with both unmatched sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_micros, micros_of, parse_duration
from ..plans.ordered import TARGET_ROWS, balanced_buckets, large_keys, running, with_neighbors


KINDS = ("matched", "unmatched_order", "unmatched_pay")
_JOINS = {frozenset(KINDS): "full_outer", frozenset(KINDS[:1]): "inner", frozenset(KINDS[:2]): "left",
          frozenset((KINDS[0], KINDS[2])): "right", frozenset(KINDS[1:]): "full_outer"}


def latest_per_key(df: DataFrame, key, ts: str, seq: str | None = None, unit: str = "auto",
                   name: str = "row") -> DataFrame:
    """(key, struct of the latest row by (ts, seq)).  ``max_by`` is a plain
    aggregate: partial per map task, so a hot key costs one row per task."""
    ordering = F.struct(epoch_micros(df, ts, unit).alias("t"),
                        *([F.col(seq).alias("s")] if seq else []))
    payload = F.struct(*[F.col(c) for c in df.columns])
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.max_by(payload, ordering).alias(name))


def reconcile(orders: DataFrame, pays: DataFrame, key="order_id",
              orders_ts: str = "ts", pays_ts: str = "ts", orders_seq: str | None = None,
              pays_seq: str | None = None, unit: str = "auto", tolerance=None,
              kind: str = "kind", kinds=KINDS) -> DataFrame:
    """Pair each key's latest order row with its latest pay row.

    kind = 'matched' (both sides, and within ``tolerance`` of each other if
    given), 'unmatched_order', 'unmatched_pay' (a pair outside the tolerance
    yields both unmatched rows).  Columns: key, kind, ``order`` and ``pay``
    structs of the original rows.  Both sides are reduced to one row per key
    before the join, which then reuses their hash partitioning.  ``kinds`` names
    the wanted results: without a tolerance the join is only as wide as they
    need (inner, one-sided, anti or full).
    """
    keys = [key] if isinstance(key, str) else list(key)
    o = latest_per_key(orders, keys, orders_ts, orders_seq, unit, "order")
    p = latest_per_key(pays, keys, pays_ts, pays_seq, unit, "pay")
    has_o, has_p = F.col("order").isNotNull(), F.col("pay").isNotNull()
    if tolerance is None:
        k = (F.when(has_o & has_p, F.lit("matched")).when(has_o, F.lit("unmatched_order"))
              .otherwise(F.lit("unmatched_pay")))
        res = o.join(p, on=keys, how=_JOINS[frozenset(kinds)]) if len(kinds) > 1 or "matched" in kinds else None
        if res is None:  # one unmatched side: an anti join, the other struct stays NULL
            mine, other, name, lost = (o, p, "order", "pay") if "unmatched_order" in kinds else (p, o, "pay", "order")
            res = mine.join(other, on=keys, how="left_anti").withColumn(lost, F.lit(None).cast(other.schema[lost].dataType))
        return res.select(*keys, k.alias(kind), "order", "pay").filter(F.col(kind).isin(list(kinds)))
    j = o.join(p, on=keys, how="full_outer")
    tol = parse_duration(tolerance)
    o_us = micros_of(F.col(f"order.{orders_ts}"), orders.schema[orders_ts].dataType, unit)
    p_us = micros_of(F.col(f"pay.{pays_ts}"), pays.schema[pays_ts].dataType, unit)
    states = (F.when(has_o & has_p & (F.abs(p_us - o_us) <= F.lit(tol)), F.array(F.lit("matched")))
              .when(has_o & has_p, F.array(F.lit("unmatched_order"), F.lit("unmatched_pay")))
              .when(has_o, F.array(F.lit("unmatched_order")))
              .otherwise(F.array(F.lit("unmatched_pay"))))
    res = j.select(*keys, F.explode(states).alias(kind), "order", "pay").filter(F.col(kind).isin(list(kinds)))
    return res.select(*keys, kind,
                      F.when(F.col(kind) != "unmatched_pay", F.col("order")).alias("order"),
                      F.when(F.col(kind) != "unmatched_order", F.col("pay")).alias("pay"))


def reconcile_pairs(orders: DataFrame, pays: DataFrame, key="order_id", orders_ts: str = "ts", pays_ts: str = "ts",
                    orders_seq: str | None = None, pays_seq: str | None = None, unit: str = "auto", tolerance=None,
                    kind: str = "kind", kinds=KINDS, bucket="1 hour", target_rows: int = TARGET_ROWS) -> DataFrame:
    """J1 with repeated pairing: a key's rows of both sides meet in event-time
    order (ties: orders first, then ``seq``), each side keeps its latest waiting
    row, and a row that finds one of the other side waiting makes a pair with it
    and clears both; then the key starts anew.  With ``tolerance`` a row waits
    only that long, and is reported alone when it ends.  A waiting row that a
    later one of its own side replaces is not reported, as in the reference.

    Columns as in ``reconcile``: key, kind, ``order``, ``pay``; one row per pair
    and per row left alone.

    A row that follows one of its own side, or none, or one that waits no longer,
    waits afterwards whatever came before it ("set"); any other row turns
    waiting into a pair or the reverse ("flip").  Such maps compose, so the state
    after a row is the parity of the rows since the last "set", a prefix maximum
    over row numbers, and a pair always consists of neighbours.  Keys with more
    than ``target_rows`` rows are cut along time.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def side(df, name, ts, seq):
        empty = {"order": orders, "pay": pays}
        cols = {n: F.lit(None).cast(d.select(F.struct(*[F.col(c) for c in d.columns])).schema[0].dataType)
                for n, d in empty.items()}
        cols[name] = F.struct(*[F.col(c) for c in df.columns])
        return df.select(*[F.col(k) for k in keys], epoch_micros(df, ts, unit).alias("_t"), F.lit(int(name == "pay")).alias("_side"),
                         (F.col(seq).cast("long") if seq else F.lit(0).cast("long")).alias("_seq"),
                         *[c.alias(f"_{n}") for n, c in cols.items()])

    rows = side(orders, "order", orders_ts, orders_seq).unionByName(side(pays, "pay", pays_ts, pays_seq))
    order = ["_t", "_side", "_seq"]
    large = large_keys(rows, keys, target_rows)
    b = balanced_buckets(rows, keys, F.col("_t"), parse_duration(bucket), target_rows, "_b", large)
    cut = None if large is None else "_b"
    payload = ["_t", "_side", "_order", "_pay"]
    nb = with_neighbors(b, keys, order, None if cut is None else F.col(cut), payload, lags=1, leads=1,
                        whole=F.col("_b") == 0)
    before, after, t = F.col("prev1"), F.col("next1"), F.col("_t")
    late = F.lit(False) if tolerance is None else t - before["_t"] > F.lit(parse_duration(tolerance))
    sets = before.isNull() | (before["_side"] == F.col("_side")) | late
    nb = running(nb, keys, order, F.lit(1), "sum", "_rn", cut)
    nb = running(nb, keys, order, F.when(sets, F.col("_rn")), "max", "_set", cut)
    pairs = (F.col("_rn") - F.col("_set")) % 2 == 1
    over = after.isNull() if tolerance is None else (
        after.isNull() | (after["_t"] - t > F.lit(parse_duration(tolerance))))
    of = (F.when(pairs, F.lit("matched")).when(~over, F.lit(None))
           .when(F.col("_side") == 0, F.lit("unmatched_order")).otherwise(F.lit("unmatched_pay")))
    return (nb.withColumn(kind, of).filter(F.col(kind).isin(list(kinds)))
              .select(*keys, kind, *[F.when(pairs, F.coalesce(F.col(f"_{n}"), before[f"_{n}"])).otherwise(F.col(f"_{n}")).alias(n)
                                     for n in ("order", "pay")]))
