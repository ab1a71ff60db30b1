"""The named stores of a streaming query, read as tables from its checkpoint.

Whatever the query has committed can be read while it runs or after it has stopped, by the name the
processor gave to the store; nothing of the query is started.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.streaming.stateful import OPEN, PANES, trend_columns


def stores(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operatorId, operatorName, stateStoreName, numPartitions, minBatchId, maxBatchId, ...) of a checkpoint."""
    return spark.read.format("state-metadata").load(checkpoint)


def store(spark: SparkSession, checkpoint: str, name: str, batch: int | None = None) -> DataFrame:
    """The entries of one store, as of its last committed batch or an earlier one."""
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name)
    return (reader if batch is None else reader.option("batchId", batch)).load()


def open_trends(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The trend records of all windows that are still open."""
    each = store(spark, checkpoint, OPEN, batch).select(F.explode("value.windows").alias("w"))
    return each.select("w.*").select("key", *trend_columns())


def open_panes(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(id, pane_start, rows, bytes) of the panes that open sensor windows consist of."""
    return store(spark, checkpoint, PANES, batch).selectExpr(
        "key.id AS id", "timestamp_micros(user_map_key.pane) AS pane_start",
        "length(user_map_value.rows) div 24 AS rows", "length(user_map_value.rows) AS bytes",
    )
