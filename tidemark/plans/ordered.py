"""Skew-safe neighbour lookups over a per-key order.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one task;
with one key holding a third of the data that task is the whole job.
``balanced_buckets`` therefore cuts the keys with more than ``target`` rows -
and only those - into buckets along the order, with edges from row counts, so
a bucket holds about ``target`` rows however dense a stretch of time is.  The
large keys are found first, by one job over the key columns (``large_keys``);
where there are none, the operators use plain windows.

``with_neighbors`` ranks rows inside (key, bucket) and takes the neighbours of
a cut key's edge rows from a second window over its edge rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_rows

#: Keys with more rows than this are cut into buckets of about this many rows.
TARGET_ROWS = 1 << 18
_CUTS = 1 << 20


def _ordered(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def large_keys(df: DataFrame, keys: Sequence[str], target: int = TARGET_ROWS) -> DataFrame | None:
    """The keys with more than ``target`` rows as a staged table of one struct
    column ``_bb_k``; None if there are none (then plain windows do).

    Runs one job over the key columns with partial aggregates.  A key is large
    only with its share of all rows, so there are at most rows / target of them.
    """
    k = F.struct(*[F.col(c) for c in keys])
    counts = df.groupBy(k.alias("_bb_k")).agg(F.count(F.lit(1)).alias("_bb_n"))
    table, n = stage_rows(counts.filter(F.col("_bb_n") > target).select("_bb_k"), "large-keys")
    return table if n else None


def balanced_buckets(df: DataFrame, keys: Sequence[str], pos: Column, width: int,
                     target: int = TARGET_ROWS, out: str = "_nb_b", large: DataFrame | None = None) -> DataFrame:
    """Add ``out``: 0 for every row of a key with at most ``target`` rows, else a
    bucket number above 0 that does not decrease along ``pos`` (a long).

    ``large`` is the result of ``large_keys``; only rows of these keys meet the
    edges: they are counted per slot of ``width`` (partial aggregates on two
    columns); runs of sparse slots share a bucket and a slot with more rows than
    the target is cut evenly.  Rows of one single ``pos`` are never parted.  The
    edges decide where work is done, never a result.
    """
    if large is None:
        return df.withColumn(out, F.lit(0).cast("long"))
    keyed = df.withColumn("_bb_k", F.struct(*[F.col(k) for k in keys]))
    light = keyed.join(large, "_bb_k", "left_anti").withColumn(out, F.lit(0).cast("long"))
    base = (keyed.join(large, "_bb_k", "left_semi").withColumn("_bb_p", pos.cast("long"))
                 .withColumn("_bb_s", floor_div(F.col("_bb_p"), width)))
    slots = base.groupBy("_bb_k", "_bb_s").agg(F.count(F.lit(1)).alias("_bb_n"))
    w = Window.partitionBy("_bb_k").orderBy("_bb_s").rowsBetween(Window.unboundedPreceding, -1)
    edges = slots.select("_bb_k", "_bb_s", floor_div(F.coalesce(F.sum("_bb_n").over(w), F.lit(0)), target).alias("_bb_g"),
                         F.when(F.col("_bb_n") > target, F.least(F.ceil(F.col("_bb_n") / target), F.lit(_CUTS)))
                          .alias("_bb_c"))
    dense = F.col("_bb_c").isNotNull()
    part = floor_div((F.col("_bb_p") - F.col("_bb_s") * F.lit(width)) * F.col("_bb_c"), width)
    bucket = ((F.col("_bb_g") * 2 + dense.cast("long")) * F.lit(_CUTS) + F.coalesce(part, F.lit(0)) + 1)
    heavy = base.join(edges, ["_bb_k", "_bb_s"], "left").withColumn(out, bucket.cast("long"))
    return light.select(*df.columns, out).unionByName(heavy.select(*df.columns, out))


def with_neighbors(df: DataFrame, keys: Sequence[str], order: Sequence, bucket: Column | None,
                   payload: Sequence[str], lags: int = 0, leads: int = 0,
                   prefix: tuple[str, str] = ("prev", "next"), whole: Column | None = None) -> DataFrame:
    """Add ``prev1..prev{lags}`` / ``next1..next{leads}`` struct columns.

    ``prevj`` is the payload of the j-th row before this one in ``order`` within
    the same key (NULL if none), ``nextj`` the j-th row after.  ``order`` must
    be a total order per key and ``bucket`` must not decrease along it.
    ``whole`` is true for rows whose key has a single bucket.

    A row among the first or last k = max(lags, leads) of its bucket may have
    neighbours elsewhere; in the sequence of all such rows of a key they are
    at the same distance, so a window over these rows alone (2k per bucket)
    completes them.  All other rows are complete inside their bucket.
    """
    order_cols = _ordered(order)
    if bucket is None:
        return _plain_neighbors(df, keys, order_cols, payload, lags, leads, prefix)
    k = max(lags, leads)
    # one struct key: NULL key values group together, as in a window
    base = df.withColumn("_nb_k", F.struct(*[F.col(c) for c in keys])).withColumn("_nb_b", bucket)
    base = base.withColumn("_nb_w", F.lit(False) if whole is None else whole)
    w = Window.partitionBy("_nb_k", "_nb_b").orderBy(*order_cols)

    def shifted(fn, j, over):
        # per-column lag/lead (a prebuilt struct would ride the shuffle twice);
        # row presence tells a missing neighbour from NULL values
        present = fn(F.lit(True), j).over(over)
        return F.when(present, F.struct(*[fn(F.col(c), j).over(over).alias(c) for c in payload]))

    moves = [(F.lag, j, f"{prefix[0]}{j}") for j in range(1, lags + 1)]
    moves += [(F.lead, j, f"{prefix[1]}{j}") for j in range(1, leads + 1)]
    ranked = base.select("*", F.row_number().over(w).alias("_nb_rn"),
                         F.lead(F.lit(True), k).over(w).isNull().alias("_nb_last"),
                         *[shifted(fn, j, w).alias(name) for fn, j, name in moves])
    edge = ~F.col("_nb_w") & ((F.col("_nb_rn") <= k) | F.col("_nb_last"))
    inner = ranked.filter(~edge).select(*df.columns, *[m[2] for m in moves])
    wk = Window.partitionBy("_nb_k").orderBy(*order_cols)
    outer = ranked.filter(edge).select(*df.columns, *[
        F.coalesce(F.col(name), shifted(fn, j, wk)).alias(name) for fn, j, name in moves])
    return inner.unionByName(outer)


def _plain_neighbors(df, keys, order_cols, payload, lags, leads, prefix):
    """``bucket=None``: one window per key - fewer stages, but a key is one task.
    Only for inputs whose keys are known to be small."""
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    p = F.struct(*[F.col(c) for c in payload])
    out = [F.lag(p, j).over(w).alias(f"{prefix[0]}{j}") for j in range(1, lags + 1)]
    out += [F.lead(p, j).over(w).alias(f"{prefix[1]}{j}") for j in range(1, leads + 1)]
    return df.select("*", *out)


def balanced_neighbors(df: DataFrame, keys: Sequence[str], order: Sequence, pos: Column, width: int | None,
                       payload: Sequence[str], lags: int = 0, leads: int = 0,
                       target: int = TARGET_ROWS) -> DataFrame:
    """``with_neighbors`` over ``balanced_buckets``; one plain window per key with
    ``width=None`` and where no key is large."""
    large = large_keys(df, keys, target) if width is not None else None
    if large is None:
        return with_neighbors(df, keys, order, None, payload, lags, leads)
    b = balanced_buckets(df, keys, pos, width, target, "_bb_b", large)
    return with_neighbors(b, keys, order, F.col("_bb_b"), payload, lags, leads,
                          whole=F.col("_bb_b") == 0).drop("_bb_b")


def running(df: DataFrame, keys: Sequence[str], order: Sequence, value: Column, how: str, out: str,
            bucket: str | None = None, strict: bool = False) -> DataFrame:
    """Add ``out``: the sum or max (``how``) of ``value`` over the rows of the key up
    to this one in ``order`` (``strict``: before this one).

    ``bucket`` names a column of ``balanced_buckets``: a prefix inside each
    (key, bucket) is completed by one row per earlier bucket.  None: one window
    per key.
    """
    agg = {"sum": F.sum, "max": F.max}[how]
    order_cols = _ordered(order)
    frame = (Window.unboundedPreceding, -1 if strict else Window.currentRow)
    if bucket is None:
        got = agg(value).over(Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(*frame))
        return df.withColumn(out, F.coalesce(got, F.lit(0)) if how == "sum" else got)
    base = df.withColumn("_rv", value).withColumn("_rk", F.struct(*[F.col(k) for k in keys]))
    inner = agg("_rv").over(Window.partitionBy("_rk", bucket).orderBy(*order_cols).rowsBetween(*frame))
    per = base.filter(F.col(bucket) > 0).groupBy("_rk", bucket).agg(agg("_rv").alias("_rs"))
    earlier = Window.partitionBy("_rk").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_rk", bucket, agg("_rs").over(earlier).alias("_ro"))
    both = (F.coalesce("_ri", F.lit(0)) + F.coalesce("_ro", F.lit(0)) if how == "sum"
            else F.greatest("_ri", "_ro"))  # greatest skips NULLs
    return (base.withColumn("_ri", inner).join(per, ["_rk", bucket], "left")
                .select(*df.columns, both.alias(out)))


def floor_div(c: Column, width: int) -> Column:
    """Exact integer floor division (also for negatives): the numerator is
    made an exact multiple of ``width`` before dividing."""
    c = c.cast("long")
    return ((c - F.pmod(c, F.lit(width))) / F.lit(width)).cast("long")


def time_bucket(t_us: Column, width_us: int) -> Column:
    """Bucket id of an epoch-microsecond column."""
    return floor_div(t_us, width_us)
