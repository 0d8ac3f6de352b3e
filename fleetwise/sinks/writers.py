"""Sinks: console/memory/file for tests and local use, message topics and
point files for production.  Streaming sinks take a checkpoint folder; when
none is given the session's shared ``spark.checkpoint.dir`` is used."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame

from fleetwise.session import checkpoint_dir


def _ckpt(df: DataFrame, name: str, location: str | None) -> str:
    return location or posixpath.join(checkpoint_dir(df.sparkSession), "streams", name)


def kafka_sink(df: DataFrame, servers: str, topic: str, name: str, checkpoint: str | None = None,
               trigger: str = "30 seconds"):
    """Write ``key``/``value`` rows to a topic (needs the Kafka connector).
    Event time belongs in the JSON body: the sink has no timestamp column."""
    return (df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
            .writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", _ckpt(df, name, checkpoint))
            .trigger(processingTime=trigger).start())


def file_sink(df: DataFrame, path: str, name: str, fmt: str = "parquet", checkpoint: str | None = None,
              output_mode: str = "append", trigger: dict | None = None):
    w = (df.writeStream.format(fmt).option("path", path).option("checkpointLocation", _ckpt(df, name, checkpoint))
         .outputMode(output_mode))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def write_points(points: DataFrame, path: str, name: str, checkpoint: str | None = None):
    """Time-series point sink: each micro-batch's ``line`` column appended as
    text files under ``path/batch=<id>`` (idempotent per batch id)."""
    def _batch(batch: DataFrame, batch_id: int):
        batch.select("line").write.mode("overwrite").text(posixpath.join(path, f"batch={batch_id}"))
    if points.isStreaming:
        return (points.writeStream.foreachBatch(_batch)
                .option("checkpointLocation", _ckpt(points, name, checkpoint)).start())
    points.select("line").write.mode("overwrite").text(path)
    return None


def console_sink(df: DataFrame, name: str, output_mode: str = "append", checkpoint: str | None = None,
                 truncate: bool = False):
    """Print each micro-batch (the reference's test-mode output)."""
    return (df.writeStream.format("console").option("truncate", str(truncate).lower())
            .option("checkpointLocation", _ckpt(df, name, checkpoint)).outputMode(output_mode).start())
