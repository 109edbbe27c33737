"""The same operators over streams: pages that come in while others are asked for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_within(stream: DataFrame, at: str, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """Rows of a stream, each key once within the watermark's delay; state is kept no longer than that."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def windowed(stream: DataFrame, at: str, keys: list[str], length: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Counts by window and keys; rows later than the delay are left out."""
    g = stream.withWatermark(at, delay).groupBy(F.window(at, length), *keys).agg(F.count("*").alias("n"))
    return g.select(F.col("window.start").alias("start"), *keys, "n")


def sessions(stream: DataFrame, at: str, keys: list[str], gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions: rows of a key with less than the gap between neighbours, with start, end and count."""
    g = stream.withWatermark(at, delay).groupBy(*keys, F.session_window(at, gap).alias("s")).agg(F.count("*").alias("n"))
    return g.select(*keys, F.col("s.start").alias("start"), F.col("s.end").alias("stop"), "n")


def latest(stream: DataFrame, keys: list[str], table: str):
    """A writer that keeps, by foreachBatch, the latest row of each key in a Parquet folder `table`; a batch that runs again
    writes the same folder."""

    def put(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(keys).write.mode("overwrite").parquet(f"{table}/batch={number:09d}")

    return stream.writeStream.foreachBatch(put)


def run(stream: DataFrame, mode: str) -> DataFrame:
    """All that is there of a stream, as a table: batches go to a Parquet folder in the shared folder (spark.checkpoint.dir,
    which is a folder of one's own on one machine only), and so does the stream's own state. In complete mode a batch
    replaces the one before; else each has a folder, which it writes anew if it runs again."""
    spark = stream.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="sitesieve-stream-")
    folder = f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{'all' if mode == 'complete' else f'batch={number:09d}'}")

    q = stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{folder}-state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/*")
