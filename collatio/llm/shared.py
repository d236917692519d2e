"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


T = TypeVar("T")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores in front as make it differ from all columns of df, so that no column is overwritten."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def free_of(df: DataFrame, *names: str) -> None:
    """Columns that an operator adds must not be there already: an error names those that are."""
    taken = {c.lower() for c in df.columns}
    if clash := [n for n in names if n.lower() in taken]:
        raise ValueError(f"the input has columns of the names that are to be added: {', '.join(clash)}; rename them or choose another prefix")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the whole cluster shares: spark.checkpoint.dir.

    A temporary one is made only where the session names none and runs on one machine, as in tests; a cluster without one is an error.
    """
    context = spark.sparkContext
    if found := context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None):
        return found
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="checkpoints-")


#: Spark's setting by which a query's shuffle files go when it ends instead of when the driver next collects garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The rule by which a query ends as soon as one side of a join proves empty, while stages of the other side still run.
#: With shuffle files deleted at the end those stages would wait minutes for files that are gone, each on a core.
EXCLUDED, EARLY_END = "spark.sql.adaptive.optimizer.excludedRules", "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows go to the folder that the whole cluster shares, and the shuffle files behind them go."""
    context, conf = df.sparkSession.sparkContext, df.sparkSession.conf
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    before = {name: conf.get(name, None) for name in (TIDY, EXCLUDED)}
    conf.set(TIDY, "true")
    conf.set(EXCLUDED, ",".join(filter(None, [before[EXCLUDED], EARLY_END])))
    try:
        # The first setting counts when a DataFrame is made, the second while it runs.
        return df.select("*").checkpoint()
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


#: Bytes of an Arrow batch between the JVM and a Python worker. Texts are long, and both sides hold a batch and its successor.
BATCH_BYTES = "4m"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by BATCH_BYTES for the whole session, unless it has a bound of its own. No result depends on it."""
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, BATCH_BYTES)


_KEPT: dict[str, object] = {}


def worker_state(name: str, make: Callable[[], T]) -> T:
    """What a Python worker keeps from task to task of one operator."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def forget(but: str | None) -> None:
    """Drop what tasks of other operators have left in this worker."""
    for name in [n for n in _KEPT if n != but]:
        del _KEPT[name]


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: str | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run in a worker that holds no state but `keep`, and that gives freed memory back at the end: workers outlive tasks and stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(keep)
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return wrapped


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id's decimal text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def hash_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About `rows` rows of df (all of them if it has fewer), chosen by a hash of key: the same ones on every run.

    The expected size is `rows` whatever the input's size; the final limit makes twice that a hard bound.
    """
    total = df.count()
    if total <= rows:
        return df
    share = int(2**31 * rows / total)
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(2**31)) < share).limit(2 * rows)
