"""Session construction and lineage-cut helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "tidemart",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with AQE on and the UI off.

    On a cluster pass ``master=None`` and let spark-submit decide; the shuffle
    partition count then comes from the cluster config (AQE coalesces it at
    runtime). Locally we size it to the core count.
    """
    # Python workers (Arrow UDFs, transformWithStateInPandas) import this
    # package by name: make it importable for workers started from this driver.
    # On a cluster ship it with --py-files instead.
    pkg_root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if pkg_root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([pkg_root, *paths])
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.python.unix.domain.socket.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there. Only when the setting
    is unset -- local tests -- do we create one, and only in local mode.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
        return d
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="tidemart-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)
