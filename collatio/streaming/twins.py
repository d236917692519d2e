"""Streams that give what the incremental batch jobs give, run to the end of their input (AvailableNow)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stream_of(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1) -> DataFrame:
    """STM-01: the files under a path as a stream; what has been read is in the query's checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def deduplicated(stream: DataFrame, key: str, ts: str | None = None, late: str = "7 days") -> DataFrame:
    """STM-03: the first row of each key over all batches; with an event time, keys older than `late` are forgotten, which bounds the state."""
    if ts is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, ts: str, key: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Extension: rows a key and event-time window, with a bound on lateness."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def run_to_end(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """STM-05, SNK-10: hand each micro-batch to `each(df, batch_id)` until the input is used up. A batch may come twice after a failure, with the same id."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()
    query.awaitTermination()


def to_files(stream: DataFrame, checkpoint: str, path: str) -> None:
    """Exactly-once append of a stream to Parquet files."""
    query = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path)
    query.awaitTermination()
