"""Readers for the provided parquet tables.

Timestamps in the provided files are stored without a time zone; the domain is
UTC, and watermarks need zoned timestamps, so every ``timestamp_ntz`` column
becomes the ``timestamp`` at which a UTC clock shows it, right after the scan
and whatever the session's time zone.  That is a projection, so column pruning
and filter push-down still reach the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from fleetwise.functions.times import from_utc_clock

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cols = [from_utc_clock(F.col(f.name)).alias(f.name) if isinstance(f.dataType, TimestampNTZType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)
