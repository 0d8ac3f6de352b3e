"""Spark session helpers.

Jobs never create their own session; they receive one.  These helpers are for
tests, the bench and command-line use, and for reading cluster settings such as
the shared checkpoint folder.
"""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (the domain's times are UTC),
# adaptive execution for runtime re-planning (coalescing, skew-join splitting)
# and local merging of session windows before the shuffle.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "fleetwise", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("FLEETWISE_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    if "spark.checkpoint.dir" not in conf and master.startswith("local"):
        # local runs only: a scratch folder stands in for the cluster's shared one
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="fleetwise-ckpt-")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    The folder already registered with the context wins; then the session
    setting.  When neither exists, a local run gets a scratch folder,
    registered with the context, and a cluster run fails: a folder of the
    driver's machine would be lost on the executors.  Without a local context (a
    remote session) the server's own setting applies and the setting is
    returned as read.
    """
    try:
        sc = spark.sparkContext
        current = sc._jsc.sc().getCheckpointDir()
    except Exception:  # noqa: BLE001 - remote session: no local context
        return spark.conf.get("spark.checkpoint.dir", None)
    if current.isDefined():
        return current.get()
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="fleetwise-ckpt-")
    sc.setCheckpointDir(d)
    return sc._jsc.sc().getCheckpointDir().get()


def stored(df, what: str):
    """``df`` written as Parquet below the shared checkpoint folder and read back: cuts lineage, survives lost
    executors, and its size is known to the planner."""
    path = posixpath.join(checkpoint_dir(df.sparkSession), f"{what}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_if_narrow(df):
    """Round-robin ``df`` over the cores when its source yields fewer
    partitions than there are cores (a small single-split file); CPU-heavy
    per-row work (parsing, the route walk) then uses every core.  Sources of
    real size have many splits and are returned unchanged, as is everything
    when the session has no local context to ask."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - remote session
        return df
    return df.repartition(cores) if parts < cores else df
