"""Streaming sinks: append tables, several tables of one query, batch tables, topics, JDBC."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from smogline.params import JDBC_BATCH_ROWS


def started(writer, trigger: dict | None) -> StreamingQuery:
    """Start a writer; without a trigger it takes what is there and stops."""
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def append_table(
    df: DataFrame, path: str, checkpoint: str, date_of: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Exactly-once Parquet table; ``date_of`` names the timestamp to partition by day."""
    writer = df
    if date_of:
        writer = df.withColumn("date", F.to_date(date_of))
    writer = writer.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    )
    return started(writer.partitionBy("date") if date_of else writer, trigger)


@dataclass
class Batch:
    """What a writer of several tables knows about the micro-batch it writes."""

    spark: SparkSession
    root: str
    checkpoint: str
    number: int
    kept: list[DataFrame] = field(default_factory=list)

    def keep(self, frame: DataFrame) -> DataFrame:
        """A frame that several tables are made of: computed once, let go with the batch."""
        self.kept.append(frame.persist())
        return self.kept[-1]

    @cached_property
    def query(self) -> str:
        """The id of the query, which its checkpoint keeps over restarts."""
        return json.loads(self.spark.read.text(f"{self.checkpoint}/metadata").first()[0])["id"]

    @cached_property
    def watermark_us(self) -> int:
        """The watermark that this batch runs under, as the offset log has it."""
        lines = [r[0] for r in self.spark.read.text(f"{self.checkpoint}/offsets/{self.number}").collect()]
        return 1000 * next(json.loads(x)["batchWatermarkMs"] for x in lines if "batchWatermarkMs" in x)

    def folder(self, table: str, number: int | None = None) -> str:
        return f"{self.root}/{table}/batch={self.query}-{self.number if number is None else number:09d}"

    def before(self, table: str, schema: str | StructType) -> DataFrame:
        """What the batch before this one left in a carried table; nothing before the first."""
        if self.number == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.folder(table, self.number - 1))


#: The tables of a batch: name to frame and, where the table is partitioned by day, the column of its time.
#: A name that begins with ``carried_`` is read again by the next batch.
Tables = Callable[[DataFrame, Batch], dict[str, tuple[DataFrame, str | None]]]
CARRIED = "carried_"


def _path(spark: SparkSession, path: str):
    """A path of whatever file system it names, and that file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def made(spark: SparkSession, *paths: str) -> None:
    """Create folders, so that a stream can wait for files in them."""
    for path in paths:
        path, files = _path(spark, path)
        files.mkdirs(path)


def publish(frame: DataFrame, batch: Batch, table: str, date_of: str | None = None, carried: bool = False) -> bool:
    """Write a frame as the folder of (table, batch) and make it appear at once; False if it is there.

    A batch that is repeated after a failure has the same rows, so a folder that is there is whole and
    stays as it is: a stream that has read its files does not meet them under other names. A table
    gets no folder for a batch that has no row for it, unless it is carried to the next batch; the folder of
    batch 0 is always made, so that the table can be read.
    """
    spark, final = batch.spark, batch.folder(table)
    target, files = _path(spark, final)
    if files.exists(target) or not carried and batch.number and frame.isEmpty():
        return False
    staging = f"{batch.root}/_staging/{table}/{final.rsplit('=', 1)[1]}"
    writer = (frame.withColumn("date", F.to_date(date_of)) if date_of else frame).write.mode("overwrite")
    (writer.partitionBy("date") if date_of else writer).parquet(staging)
    files.mkdirs(target.getParent())
    if not files.rename(_path(spark, staging)[0], target):
        raise OSError(f"cannot rename {staging} to {final}")
    return True


def several_tables(
    df: DataFrame, tables: Tables, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """One streaming query that writes several tables under ``root``.

    Each micro-batch is computed once and kept while its tables are written. A table has a folder for each
    batch, named by query and number. Started again on its checkpoint the query goes on, and a batch that
    had been written in part writes the tables that it still lacks.
    """
    def write(frame: DataFrame, number: int) -> None:
        batch = Batch(frame.sparkSession, root, checkpoint, number)
        try:
            for table, (result, date_of) in tables(batch.keep(frame), batch).items():
                publish(result, batch, table, date_of, table.startswith(CARRIED))
        finally:
            for kept in batch.kept:
                kept.unpersist()

    return started(
        df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write), trigger
    )


def table_of(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``several_tables`` writes, without the columns of its folders."""
    return spark.read.parquet(path).drop("batch", "date")


def batch_table(
    df: DataFrame, path: str, checkpoint: str, mode: str = "update", trigger: dict | None = None
) -> StreamingQuery:
    """Parquet table with one folder per micro-batch; a repeated batch overwrites its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return started(
        df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write),
        trigger,
    )


def kafka_topic(
    df: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """(key, value) text to a topic (needs the Kafka package on the class path)."""
    writer = (
        df.select("key", "value").writeStream.format("kafka").outputMode(mode)
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return started(writer, trigger)


def jdbc_writer(url: str, table: str, batch_rows: int = JDBC_BATCH_ROWS, **options: str):
    """A ``foreachBatch`` function that inserts the payload column, at least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.select("payload").write.format("jdbc").mode("append")
            .option("url", url).option("dbtable", table).option("batchsize", batch_rows)
            .options(**options).save()
        )

    return write


def jdbc_table(
    df: DataFrame, url: str, table: str, checkpoint: str, trigger: dict | None = None, **options: str
) -> StreamingQuery:
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        jdbc_writer(url, table, **options)
    )
    return started(writer, trigger)
