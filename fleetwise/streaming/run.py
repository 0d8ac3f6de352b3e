"""Starting streaming jobs with the reference's fault-tolerance settings.

Exactly-once recovery comes from the query checkpoint (offsets + state) in
the shared checkpoint folder; state lives in the RocksDB state store; the
trigger interval plays the role of the 30 s checkpoint interval.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame

from fleetwise.session import checkpoint_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TRIGGER = "30 seconds"


def start_stream(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None,
                 output_mode: str = "append", trigger: str | None = TRIGGER, checkpoint: str | None = None,
                 foreach_batch=None):
    """Start ``df`` as a named streaming query.

    ``foreach_batch`` (a callable ``(batch, batch_id)``) takes precedence over
    ``fmt``/``path``.  The checkpoint defaults to ``<spark.checkpoint.dir>/streams/<name>``.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ckpt = checkpoint or posixpath.join(checkpoint_dir(spark), "streams", name)
    w = df.writeStream.queryName(name).option("checkpointLocation", ckpt).outputMode(output_mode)
    if trigger:
        w = w.trigger(processingTime=trigger)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    if path is not None:
        w = w.option("path", path)
    return w.format(fmt).start()
