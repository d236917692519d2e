"""Batch writers. A write either ends whole or fails; nothing is swallowed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collatio.sources import versions


def append(df: DataFrame, path: str) -> None:
    """SNK-01."""
    df.write.mode("append").parquet(path)


def updated(df: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """SNK-02, SNK-03: df with the non-null columns of `changes` (one row a key at most) set where the key matches; no key is added."""
    fields = [c for c in changes.columns if c != key]
    joined = df.alias("t").join(changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in fields]), key, "left")
    return joined.select(*[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns])


def update_report(df: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """SNK-03: how many changes there are, how many found their row, and how many changed it."""
    fields = [c for c in changes.columns if c != key]
    differs = F.lit(False)
    for c in fields:
        differs = differs | (F.col(f"_new_{c}").isNotNull() & ~F.col(f"_new_{c}").eqNullSafe(F.col(f"_old_{c}")))
    new = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in fields])
    old = df.select(key, F.lit(True).alias("_there"), *[F.col(c).alias(f"_old_{c}") for c in fields])
    return new.join(old, key, "left").agg(F.count("*").alias("total"), F.count_if(F.coalesce("_there", F.lit(False))).alias("matched"), F.count_if(F.coalesce("_there", F.lit(False)) & differs).alias("modified"))


def replaced_slices(df: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """SNK-04: df with every slice of `key` that `new` has rows of replaced whole."""
    return df.join(new.select(key).distinct(), key, "left_anti").select(*df.columns).unionByName(new.select(*df.columns))


def replace_slices(df: DataFrame, path: str, key: str) -> None:
    """SNK-04 on files: only the partitions that df has rows of are rewritten."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def rebuild(df: DataFrame, path: str, *order: str) -> None:
    """SNK-05: the target anew, rows in ranges of `order`, so that scans by it skip files."""
    (df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df).write.mode("overwrite").parquet(path)


def snapshot(df: DataFrame, folder: str, name: str, stamp: str) -> str:
    """SNK-06: a copy before a write; a stamp that is there already is kept."""
    path = f"{folder}/{name}/ts={stamp}"
    df.write.mode("ignore").parquet(path)
    return path


def json_lines(df: DataFrame, path: str) -> None:
    """SNK-07."""
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def asset_url(base: str, bucket: Column, folder: Column, name: Column) -> Column:
    """SNK-09: where an image ends up in the store at `base`; the copy itself happens outside Spark."""
    return F.concat(F.lit(f"{base.rstrip('/')}/"), bucket, F.lit("/"), F.when(F.coalesce(folder, F.lit("")) != "", F.concat(folder, F.lit("/"))).otherwise(""), name, F.lit(".webp"))


def unfinished(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """SNK-11: what an earlier run has not done yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def retention(files: DataFrame, now: Column, days: int = 7, modified: str = "modified") -> DataFrame:
    """SNK-12: files with `deleted`: strictly older than so many days. Deleting is the caller's."""
    return files.withColumn("deleted", F.col(modified) < now - F.expr(f"INTERVAL {int(days)} DAYS"))


def grown_manifest(known: DataFrame, seen: DataFrame, key: str = "path") -> DataFrame:
    """SNK-13: known assets and those of `seen` that are new, with `added`."""
    new = seen.join(known.select(key), key, "left_anti").dropDuplicates([key])
    return known.withColumn("added", F.lit(False)).unionByName(new.select(*known.columns).withColumn("added", F.lit(True)))


def write_state(rows: DataFrame, path: str, expected: int) -> int:
    """SNK-08: the version of a state table that follows `expected`; if another writer has made it, an error, which is the optimistic lock."""
    return versions.commit(rows.coalesce(1), path, expected)
