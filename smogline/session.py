"""Session helpers: settings every job relies on and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_IN_MEMORY = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    """What every job relies on, whatever session it is given.

    UTC as the session time zone, so that window labels are the same everywhere; RocksDB as the state
    store, which keyed state with several variables needs (any other store that the caller named
    stays); and this library on the path of the Python workers.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(_STATE_STORE).rsplit(".", 1)[-1] == _IN_MEMORY.rsplit(".", 1)[-1]:
        spark.conf.set(_STATE_STORE, _ROCKSDB)
    return findable(spark)


def findable(spark: SparkSession) -> SparkSession:
    """Put the folder of the library on the workers' path, where they share it with the driver.

    On a cluster the library is installed or sent with --py-files; then this changes nothing.
    """
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if _ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [have, _ROOT]))
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="smogline-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a new table in the shared folder and go on from there.

    The lineage ends at the table, which outlives the executors that wrote it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
