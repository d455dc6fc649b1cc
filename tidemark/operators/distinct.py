"""Distinct users per window (A4 exact, A5 hashed bitmap, A6 sketch).

All avoid routing a whole window to one task: the exact form dedups on
(window, user) first (exchange on both columns), the bitmap form builds one
32,768-bit chunk per (window, bucket) with partial aggregation, and the
sketch forms merge HLL buffers - one kind per query, one kept in tables:
``visitor_sketches`` scans the rows once per short window, and
``visitors_from_sketches`` answers any longer window from the stored sketches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash61
from ..functions.time import epoch_micros, floor_to, parse_duration
from ..plans.ordered import floor_div

SKETCH_PRECISION = 16


def _window_end(df: DataFrame, size, ts: str, unit: str):
    z = parse_duration(size)
    return floor_div(floor_to(epoch_micros(df, ts, unit), z) + F.lit(z), 1000)


def unique_per_window(df: DataFrame, user: str = "user_id", size="1 hour", ts: str = "ts",
                      unit: str = "auto", out: str = "uv") -> DataFrame:
    """A4: exact distinct ``user`` per tumbling window (window_end in epoch ms)."""
    we = _window_end(df, size, ts, unit).alias("window_end")
    pairs = df.select(we, F.col(user)).distinct()
    return pairs.groupBy("window_end").agg(F.count(F.col(user)).alias(out))


def unique_per_window_bitmap(df: DataFrame, user: str = "user_id", size="1 hour", ts: str = "ts",
                             unit: str = "auto", out: str = "uv") -> DataFrame:
    """A5: distinct ``hash61(user)`` per window through bitmaps.

    Equals ``count(distinct hash61(user))``: collisions can undercount, never
    overcount, exactly like the reference's single-hash bitmap.
    """
    we = _window_end(df, size, ts, unit).alias("window_end")
    # distinct hashes first (a hash aggregate): the bitmap aggregate sorts and
    # keeps 4 KiB buffers, so it should see each bit once
    h = df.select(we, hash61(F.col(user)).alias("_h")).distinct()
    chunks = (h.groupBy("window_end", F.bitmap_bucket_number("_h").alias("_bk"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_h")).alias("_bm")))
    return chunks.groupBy("window_end").agg(F.sum(F.bitmap_count("_bm")).cast("long").alias(out))


def unique_per_window_approx(df: DataFrame, user: str = "user_id", size="1 hour", ts: str = "ts",
                             unit: str = "auto", rsd: float = 0.05, out: str = "uv") -> DataFrame:
    """HyperLogLog++ estimate per window (mergeable, fixed memory)."""
    we = _window_end(df, size, ts, unit).alias("window_end")
    return df.select(we, F.col(user)).groupBy("window_end").agg(
        F.approx_count_distinct(user, rsd).cast("long").alias(out))


def visitor_sketches(df: DataFrame, user: str = "user_id", size="1 hour", ts: str = "ts", unit: str = "auto",
                     precision: int = SKETCH_PRECISION, out: str = "sketch") -> DataFrame:
    """A6 to be stored: per tumbling window (``window_end``, epoch ms) a mergeable HLL
    sketch of 2^precision registers (binary), whatever the number of users."""
    we = _window_end(df, size, ts, unit).alias("window_end")
    return df.select(we, F.col(user)).groupBy("window_end").agg(F.hll_sketch_agg(user, precision).alias(out))


def visitors_from_sketches(sketches: DataFrame, size="1 day", sketch: str = "sketch", out: str = "uv") -> DataFrame:
    """Users per window of ``size`` from the stored sketches of windows that divide it.

    The relative standard error is about 1.04 / sqrt(2^precision) (0.4 % at 16) for
    large counts; counts far below the number of registers are exact but for hash
    collisions.
    """
    z = parse_duration(size) // 1000
    # a short window belongs to the long one that holds its last instant
    we = floor_to(F.col("window_end") - F.lit(1), z) + F.lit(z)
    return (sketches.groupBy(we.alias("window_end"))
                    .agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).cast("long").alias(out)))
