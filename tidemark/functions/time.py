"""Event-time helpers (P3 epoch scaling, T1 watermark, P7/P8 window bounds).

Operators do their arithmetic on an integer epoch-microsecond column: it is
zone-free, codegen-friendly and makes pane / bucket maths exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

US_PER = {"us": 1, "ms": 1_000, "s": 1_000_000}

def _session_is_utc() -> bool:
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    return s is not None and s.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def _ntz_micros(c: Column) -> Column:
    """Wall-clock value of a TIMESTAMP_NTZ read as UTC, whatever the session zone.

    Under a UTC session the cast is exact (and cheapest).  Otherwise whole
    seconds come from the zone-free date/hour/minute/second fields and the
    sub-second part from the cast (zone offsets are whole seconds).
    """
    as_ts = F.unix_micros(c.cast("timestamp"))
    if _session_is_utc():  # the zone is fixed into the cast when the plan is analysed
        return as_ts
    day = F.unix_date(c.cast("date")).cast("long")
    secs = (F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("long")
    return day * F.lit(86_400_000_000) + secs * F.lit(1_000_000) + F.pmod(as_ts, F.lit(1_000_000))


def parse_duration(d) -> int:
    """'5 seconds' / '1 hour' / 3600 (seconds) / datetime.timedelta -> microseconds."""
    import datetime as _dt

    if isinstance(d, _dt.timedelta):
        return int(d.total_seconds() * 1_000_000)
    if isinstance(d, (int, float)):
        return int(d * 1_000_000)
    n, unit = str(d).strip().split(None, 1)
    unit = unit.lower().rstrip("s")
    mult = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
            "sec": 1_000_000, "minute": 60_000_000, "min": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}[unit]
    return int(float(n) * mult)


def micros_of(c: Column, dt: T.DataType, unit: str = "auto") -> Column:
    """Epoch microseconds (BIGINT) of ``c`` given its type ``dt``.

    TIMESTAMP_NTZ is read as UTC wall-clock time, independent of the session zone.
    Numbers and numeric text are scaled by ``unit`` ('s', 'ms', 'us').
    """
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, T.TimestampNTZType):
        return _ntz_micros(c)
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long") * F.lit(86_400_000_000)
    if unit == "auto":
        raise ValueError(f"a {dt.simpleString()} time needs unit='s'|'ms'|'us'")
    return c.cast("long") * F.lit(US_PER[unit])


def epoch_micros(df: DataFrame, col: str, unit: str = "auto") -> Column:
    """Epoch microseconds of column ``col`` of ``df`` (see ``micros_of``)."""
    return micros_of(F.col(col), df.schema[col].dataType, unit)


def event_time(df: DataFrame, col: str, unit: str = "auto", out: str = "ts",
               watermark=None) -> DataFrame:
    """Add a TIMESTAMP column ``out`` from epoch numbers, epoch text or NTZ.

    ``watermark`` (a delay such as '0 seconds') also declares the event-time
    watermark, the reference's ascending-timestamp assigner being delay 0.
    """
    us = epoch_micros(df, col, unit)
    res = df.withColumn(out, F.timestamp_micros(us))
    if watermark is not None:
        res = res.withWatermark(out, watermark if isinstance(watermark, str)
                                else f"{parse_duration(watermark)} microseconds")
    return res


def micros_to_ms(c: Column) -> Column:
    return F.floor(c / F.lit(1_000)).cast("long")


def floor_to(c: Column, step_us: int) -> Column:
    """Floor an epoch-microsecond column to a multiple of ``step_us`` (negatives too)."""
    return c - F.pmod(c, F.lit(step_us))


def render_ts(c: Column) -> Column:
    """P8: 'yyyy-MM-dd HH:mm:ss' in the session time zone (the reference uses the JVM zone)."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def render_epoch_ms(c: Column, tz: str | None = None, fraction: bool = False) -> Column:
    """Render epoch milliseconds as 'yyyy-MM-dd HH:mm:ss' (+ '.S' with ``fraction``).

    ``tz=None`` uses the session zone (the reference renders in the JVM's
    zone).  ``tz='UTC'`` does not depend on any session setting: the value
    becomes a TIMESTAMP_NTZ by interval arithmetic (no zone involved) and is
    cast to text - about 5x cheaper than field-by-field formatting.
    """
    if tz is None:
        return F.date_format(F.timestamp_millis(c), "yyyy-MM-dd HH:mm:ss" + (".S" if fraction else ""))
    if tz != "UTC":
        raise ValueError("tz must be None (session zone) or 'UTC'")
    ms = c.cast("long")
    whole_ms = ms - F.pmod(ms, F.lit(1000))
    if _session_is_utc():  # zone fixed into the cast at analysis: exact and cheapest
        txt = F.timestamp_millis(whole_ms).cast("string")
    else:
        ntz = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), (whole_ms / F.lit(1000)).cast("decimal(18,6)"))
        txt = ntz.cast("string")  # whole seconds: the cast prints no fraction
    if fraction:
        txt = F.concat(txt, F.lit("."), (F.pmod(ms, F.lit(1000)) / F.lit(100)).cast("long").cast("string"))
    return txt
