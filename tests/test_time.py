from pyspark.sql import functions as F

from tidemark.functions.time import epoch_micros, event_time, parse_duration


def test_parse_duration():
    assert parse_duration("5 seconds") == 5_000_000
    assert parse_duration("60 minutes") == parse_duration("1 hour") == 3_600_000_000
    assert parse_duration(2) == 2_000_000


def test_ntz_is_zone_free(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00.123456",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("ts"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = []
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got.append(df.select(epoch_micros(df, "ts").alias("us")).first().us)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1710037800123456] * 3


def test_event_time_units(spark):
    df = spark.createDataFrame([("1558430842", 1511658000, 1511658000123)], "txt string, s long, ms long")
    r = (event_time(event_time(event_time(df, "txt", "s", out="a"), "s", "s", out="b"), "ms", "ms", out="c")
         .select(F.unix_micros("a").alias("a"), F.unix_micros("b").alias("b"), F.unix_micros("c").alias("c")).first())
    assert (r.a, r.b, r.c) == (1558430842000000, 1511658000000000, 1511658000123000)


def test_render_utc_is_zone_free(spark):
    from tidemark.functions.time import render_epoch_ms

    df = spark.createDataFrame([(1511661715000,), (1511658900123,), (0,), (-1000,)], "ms long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r.s for r in df.select(render_epoch_ms(F.col("ms"), "UTC", fraction=True).alias("s")).collect()]
            assert got == ["2017-11-26 02:01:55.0", "2017-11-26 01:15:00.1", "1970-01-01 00:00:00.0",
                           "1969-12-31 23:59:59.0"]
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        assert df.select(render_epoch_ms(F.col("ms")).alias("s")).first().s == "2017-11-26 10:01:55"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
