"""Aggregates, counters and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_values(df: DataFrame, field: str) -> DataFrame:
    """AGG-02: distinct values; a list counts element by element."""
    nested = df.schema[field].dataType.typeName() == "array"
    return df.select(F.explode(field).alias(field) if nested else field).where(F.col(field).isNotNull()).distinct()


def unique_in_scope(df: DataFrame, scope: str, value, field: str) -> DataFrame:
    """AGG-03."""
    return unique_values(df.where(F.col(scope) == F.lit(value)), field)


def counters(df: DataFrame, **conditions: Column) -> DataFrame:
    """AGG-05, AGG-19: how many rows meet each condition, in one pass; null conditions don't."""
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])


def top_k(df: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """AGG-06, SRT-06: the k most frequent values; of equal ones the one seen first comes first."""
    counted = df.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))
    return counted.orderBy(F.desc("n"), "first_seen").limit(k)


def histogram(df: DataFrame, value: Column, edges: list[float]) -> DataFrame:
    """AGG-11: (bucket, n) over half-open ranges between edges; empty buckets and values outside are left out."""
    bucket = None
    for lo, hi in zip(edges, edges[1:], strict=False):
        inside = (value >= lo) & (value < hi)
        label = F.lit(f"{lo:g}-{hi:g}")
        bucket = F.when(inside, label) if bucket is None else bucket.when(inside, label)
    return df.select(bucket.alias("bucket")).where("bucket is not null").groupBy("bucket").agg(F.count("*").alias("n"))


def counts_and_total(df: DataFrame, key: str) -> DataFrame:
    """AGG-14: rows a value of key, and all rows under a null key."""
    return df.groupBy(key).agg(F.count("*").alias("n")).unionByName(df.agg(F.count("*").alias("n")).select(F.lit(None).cast(df.schema[key].dataType).alias(key), "n"))


def last_written(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """AGG-16: the value with the largest ordinal."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def first_written(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """AGG-17: the value with the smallest ordinal."""
    return df.groupBy(key).agg(F.min_by(value, order).alias(value))


def deduplicated(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """AGG-18: the first row of each key by ordinal, in one mergeable aggregate."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_f")).select(*keys, "_f.*").select(*df.columns)


def union_all(*frames: DataFrame) -> DataFrame:
    """SET-01, SET-03: rows of all frames, by column name."""
    return reduce(DataFrame.unionByName, frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """SET-02."""
    return union_all(*frames).distinct()


def summary(df: DataFrame, value: str, order: str) -> DataFrame:
    """AGG-01, AGG-09, AGG-10, AGG-20: number, maximum and sum of a column, and its first and last value by an ordinal."""
    return df.agg(F.count("*").alias("n"), F.max(value).alias("largest"), F.sum(value).alias("total"), F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"))
