"""Keyed state in streams: what has been processed, with an end to remembering it (STM-03), and the last time of a category (STM-02)."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, LongType, StructField, StructType

#: The state store that value states with an end need; a setting of the session that starts the stream.
PROVIDER = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Microseconds that a time is kept in: comparisons and maxima are those of whole numbers.
MICROS = StructType([StructField("at", LongType())])


def keep_state(spark: SparkSession) -> None:
    """Use the state store that the operators here need, unless the session has chosen one."""
    if PROVIDER[0] not in spark.conf.getAll:
        spark.conf.set(*PROVIDER)


class _FirstSeen(StatefulProcessor):
    """Lets the first row of a key pass and remembers the key for a while."""

    def __init__(self, remember_ms: int | None):
        self.remember_ms = remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", MICROS, self.remember_ms)

    def handleInputRows(self, key, rows, timer) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:  # a key's rows come in parts of bounded size
            if first is None and len(part):
                first = part.iloc[:1]
        if first is not None and not self.seen.exists():
            self.seen.update((1,))
            yield first

    def close(self) -> None:
        pass


def first_seen(stream: DataFrame, key: str, remember_ms: int | None = None) -> DataFrame:
    """STM-03: a row of each key that has not been processed, over all batches and restarts.

    A key is forgotten remember_ms after it was processed, and then counts as new: that bounds the state. Without it
    keys are kept for good. Rows without a key are left out. Of a key's rows in one batch any may come, so rows of one
    key should agree; each task lets one row of a key through before the shuffle, so that a hot key burdens no task.
    With remember_ms Spark goes on with empty batches, so that such a stream is ended by `run_until_read`.
    """
    keep_state(stream.sparkSession)
    schema = stream.schema
    at = schema.names.index(key)

    def one_each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.drop_duplicates(subset=[part.columns[at]])

    few = stream.where(F.col(key).isNotNull()).mapInPandas(one_each, schema)
    return few.groupBy(key).transformWithStateInPandas(_FirstSeen(remember_ms), outputStructType=schema, outputMode="Append", timeMode="None" if remember_ms is None else "ProcessingTime")


def run_until_read(stream: DataFrame, checkpoint: str, path: str, empty: int = 3, wait_s: float = 0.05) -> None:
    """Append a stream's rows to files until so many batches in a row have found no input, then stop: for streams that never end by themselves."""
    query = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("parquet").start(path)
    idle: set[int] = set()
    try:
        while query.isActive and len(idle) < empty:
            if at := query.lastProgress:
                idle = idle | {at["batchId"]} if at["numInputRows"] == 0 else set()
            time.sleep(wait_s)
        if error := query.exception():
            raise error
    finally:
        query.stop()


class _LastTime(StatefulProcessor):
    """Emits a category's last time whenever it moves on; it never moves back."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", MICROS)

    def handleInputRows(self, key, rows, timer) -> Iterator[pd.DataFrame]:
        found = max((int(part["at"].max()) for part in rows if len(part)), default=None)
        before = self.last.get() if self.last.exists() else None
        if found is not None and (before is None or found > before[0]):
            self.last.update((found,))
            yield pd.DataFrame({"category": [key[0]], "previous": pd.array([None if before is None else before[0]], dtype="Int64"), "at": [found]})

    def close(self) -> None:
        pass


def last_times(stream: DataFrame, category: str, ts: str) -> DataFrame:
    """STM-02: (category, previous, at) in microseconds, a row each time that a category's last time moves on; previous is null the first time.

    Each task sends a maximum a category and batch, not its rows. Rows without a category or a time are left out.
    """
    keep_state(stream.sparkSession)
    kind: DataType = stream.schema[category].dataType

    def maxima(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.groupby("category", as_index=False)["at"].max()

    rows = stream.where(F.col(category).isNotNull() & F.col(ts).isNotNull()).select(F.col(category).alias("category"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"))
    few = rows.mapInPandas(maxima, StructType([StructField("category", kind), StructField("at", LongType())]))
    out = StructType([StructField("category", kind), StructField("previous", LongType()), StructField("at", LongType())])
    return few.groupBy("category").transformWithStateInPandas(_LastTime(), outputStructType=out, outputMode="Append", timeMode="None")
