"""Session configuration shared by all jobs.

``configure`` only sets SQL options that change results (time zone, map-key policy) or
that every job relies on (AQE, skew join).  Cluster sizing (shuffle partitions, file
split size) is left to the deployment unless the caller asks for it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Options the operators depend on for correct results.
_RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Loose key=value lines: a later duplicate key wins (map_from_entries).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Options for runtime re-planning at scale (safe defaults on any cluster).
_RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # transformWithState (streaming alerts) needs column families.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in {**_RESULT_CONF, **_RUNTIME_CONF}.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session for which the setting is absent (tests) gets a folder of its own under the
    system temp directory; on a cluster that would be a folder of one machine, so it is an error.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="sluice-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf)
    return conf


def local_session(cores: int | str = "*", app: str = "sluice", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, Arrow on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
