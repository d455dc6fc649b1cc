"""Delimited text with positional fields, plus the reference's record schemas."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Record layouts of the reference's text inputs (field order = column order in the file).
USER_BEHAVIOR = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("item_id", T.StringType()),
    T.StructField("category_id", T.StringType()), T.StructField("behavior", T.StringType()),
    T.StructField("event_time", T.LongType()),          # epoch seconds
])
AD_CLICK = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("ad_id", T.LongType()),
    T.StructField("province", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("event_time", T.LongType()),          # epoch seconds
])
MARKETING = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("behavior", T.StringType()),
    T.StructField("channel", T.StringType()), T.StructField("event_time", T.LongType()),  # ms
])
LOGIN_EVENT = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("ip", T.StringType()),
    T.StructField("event_type", T.StringType()), T.StructField("event_time", T.StringType()),
])
ORDER_EVENT = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("event_type", T.StringType()),
    T.StructField("event_time", T.StringType()),
])
PAY_EVENT = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("channel", T.StringType()),
    T.StructField("event_time", T.StringType()),
])


def parse_delimited(lines: DataFrame, schema: T.StructType, sep: str = ",",
                    value: str = "value") -> DataFrame:
    """Split a text column and cast each positional field (ANSI casts: a bad
    number or a missing field fails the query, as ``.toLong``/``arr(i)`` do).
    Extra trailing fields are ignored; there is no quoting.  ``sep`` is taken
    literally."""
    parts = F.split(F.col(value), re.escape(sep))
    cols = [F.col(c) for c in lines.columns if c != value]
    return lines.select(*cols, *[parts.getItem(i).cast(f.dataType).alias(f.name)
                                 for i, f in enumerate(schema.fields)])


def _plain(uri: str) -> str:
    """One spelling of local file names (``file:///x`` and ``file:/x`` both occur)."""
    return re.sub("^file:/+", "file:/", uri)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   streaming: bool = False, seq: str | None = "seq", **options) -> DataFrame:
    """Read positional text records; ``seq`` numbers rows in arrival (file) order.

    Batch ``seq`` is a long built from the file's rank by path, the byte at
    which the row's split of the file begins, and the row's number in the
    split's partition: rows of a file keep their order and files follow each
    other by name, however Spark packs splits.  A folder whose arrival order is
    not its name order needs an order column of its own.  Streaming sources get
    no ``seq`` (arrival order is the micro-batch order).
    """
    if streaming:
        lines = spark.readStream.options(**options).text(path)
        return parse_delimited(lines, schema, sep)
    lines = spark.read.options(**options).text(path)
    if seq:
        # Rows take at least a byte each and a whole split starts its partition, so
        # begin + row number stays below the next split's begin.
        files = spark.createDataFrame(list(enumerate(sorted(map(_plain, lines.inputFiles())))), "_rank long, _file string")
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        lines = lines.select("value", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("_file"),
                             (F.col("_metadata.file_block_start") + row).alias("_at"))
        lines = (lines.join(files, "_file", "left")  # Spark's own listing of the input, broadcast while it is small
                      .select("value", (F.col("_rank") * F.lit(1 << 43) + F.col("_at")).alias(seq)))
    return parse_delimited(lines, schema, sep)
