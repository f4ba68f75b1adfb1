"""Incremental ingest: new files are read once, repeats dropped, batches appended."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from offerloom.operators.warehouse import upsert_rows
from offerloom.sources.snapshots import append_snapshot, read_tables


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                files_per_batch: int | None = None) -> DataFrame:
    """A file stream over a folder or a glob pattern."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def first_seen(stream: DataFrame, uid: str, event_time: str, watermark: str) -> DataFrame:
    """Rows whose uid was not seen before, with state bounded by the watermark."""
    return stream.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([uid])


def run_to_end(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "append") -> None:
    """Processes everything available now; a restart resumes from the checkpoint."""
    query = (stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def append_batches(target: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that is safe to repeat: each batch owns one folder and overwrites only it."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
    return handle


def append_new(target: str, key: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that adds the rows whose key no earlier batch has written; a repeated batch overwrites its folder.

    The stream's own state ends at the watermark; this keeps keys unique for good.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = f"`{key}` {batch.schema[key].dataType.simpleString()}, batch bigint"
        spark.createDataFrame([], batch.schema).write.mode("append").parquet(f"{target}/batch=-1")
        known = spark.read.schema(schema).parquet(target).where(F.col("batch") < batch_id).select(key)
        batch.join(known, key, "left_anti").write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
    return handle


def latest(spark: SparkSession, target: str, keys: Sequence[str], value: str, schema: str) -> DataFrame:
    """The value that the newest batch wrote for each key, from batches of updated rows."""
    rows = spark.read.schema(f"{schema}, batch bigint").parquet(target)
    return rows.groupBy(*keys).agg(F.max_by(value, "batch").alias(value))


def upsert_batches(root: str, tables: Sequence[str], seq: str, now: Column) -> Callable[[DataFrame, int], None]:
    """Batch writer that appends the new rows of each batch of contributed offers as a warehouse snapshot.

    A repeated batch finds its uids present and adds nothing.
    """
    def handle(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        version = read_tables(spark, root)
        current = {name: version[name] for name in tables}
        append_snapshot(spark, root, upsert_rows(current, batch, seq, now))
    return handle
