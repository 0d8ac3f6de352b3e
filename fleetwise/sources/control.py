"""JSON control messages (calls, requests, rules) and message sources.

A message that is not valid JSON, or lacks a required field, or has a field
of the wrong type is dropped without failing the job: ``from_json`` in
permissive mode yields nulls for such input and the required-field filter
removes the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Wire schemas of the control messages (field names as sent on the wire).
CALL_SCHEMA = "userId BIGINT, timestamp BIGINT, longitude DOUBLE, latitude DOUBLE"
REQUEST_SCHEMA = "during BIGINT"
RULE_SCHEMA = "condition STRING"


def parse_messages(messages: DataFrame, schema: str, required: list[str] | None = None,
                   value_col: str = "value") -> DataFrame:
    """``value`` JSON text -> typed columns; rows missing a required field dropped."""
    # the generator keeps the filter above the parse, so each message is parsed once
    parsed = messages.select(F.inline_outer(F.array(F.from_json(F.col(value_col).cast("string"), schema))))
    req = required if required is not None else [f.strip().split(" ")[0] for f in schema.split(",")]
    cond = F.lit(True)
    for c in req:
        cond = cond & F.col(c).isNotNull()
    return parsed.where(cond)


def parse_calls(messages: DataFrame) -> DataFrame:
    return parse_messages(messages, CALL_SCHEMA).select(
        F.col("userId").alias("user_id"), "timestamp", "longitude", "latitude")


def parse_requests(messages: DataFrame) -> DataFrame:
    return parse_messages(messages, REQUEST_SCHEMA)


def parse_rules(messages: DataFrame) -> DataFrame:
    return parse_messages(messages, RULE_SCHEMA)


def kafka_messages(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Streaming message source: a topic read from ``starting`` offsets.

    Needs the Spark Kafka connector on the classpath (not bundled with plain
    PySpark); jobs only need a frame with a ``value`` column, so file or
    memory sources stand in where the connector is absent.
    """
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load()
            .select(F.col("value").cast("string").alias("value"), "timestamp"))
