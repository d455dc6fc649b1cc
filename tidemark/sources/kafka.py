"""S3: Kafka source (topic of text records).  Needs the spark-sql-kafka
connector on the classpath; this module only builds options and parses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .delimited import parse_delimited


def kafka_options(servers: str, topic: str, starting: str = "latest",
                  group_id: str | None = None, **extra) -> dict:
    """Reader options equivalent to a string consumer on ``topic``."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def decode_records(raw: DataFrame, schema: T.StructType | None = None, sep: str = ",") -> DataFrame:
    """(key, value) as text; with ``schema`` the value is parsed like S1."""
    kv = raw.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
    return parse_delimited(kv, schema, sep) if schema is not None else kv


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 group_id: str | None = None, schema: T.StructType | None = None,
                 streaming: bool = True, **extra) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    raw = reader.format("kafka").options(**kafka_options(servers, topic, starting, group_id, **extra)).load()
    return decode_records(raw, schema)
