"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, field: str, value) -> DataFrame:
    """FLT-01: whether rows have a value, and how many."""
    return df.where(F.col(field) == F.lit(value)).agg(F.count("*").alias("count")).select((F.col("count") > 0).alias("exists"), "count")


def without_marks(c: Column, *marks: str) -> Column:
    """FLT-02, FLT-10: none of the marks in a text; null has none."""
    hit = F.lit(False)
    for mark in marks:
        hit = hit | F.contains(c, F.lit(mark))
    return ~F.coalesce(hit, F.lit(False))


def all_missing(*columns: str, sentinel: str = "-") -> Column:
    """FLT-04: every column is the sentinel."""
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(F.col(c) == sentinel, F.lit(False))
    return out


def allowed_page(path: Column, names: tuple[str, ...], prefixes: tuple[str, ...], keywords: tuple[str, ...]) -> Column:
    """FLT-05: no listed name, namespace, keyword or colon."""
    name = F.substring_index(path, "/", -1)
    bad = name.isin(*names) if names else F.lit(False)
    for p in prefixes:
        bad = bad | name.startswith(p)
    for k in keywords:
        bad = bad | F.contains(F.lower(name), F.lit(k))
    return ~(bad | F.contains(name, F.lit(":")))


def newer(ts: Column, watermark: Column) -> Column:
    """FLT-06, FLT-07: strictly after the watermark; without one everything passes, a null time too, which later never does."""
    return watermark.isNull() | F.coalesce(ts > watermark, F.lit(False))


def any_has(structs: Column, field: str, value: Column) -> Column:
    """FLT-09: some struct of a list has the value."""
    return F.coalesce(F.exists(structs, lambda s: s[field] == value), F.lit(False))


def same_folded(a: Column, b: Column) -> Column:
    """FLT-12: equal but for case and white space at the ends; null is the empty text."""
    return F.lower(F.trim(F.coalesce(a, F.lit("")))) == F.lower(F.trim(F.coalesce(b, F.lit(""))))


def all_present(*columns: str) -> Column:
    """FLT-19, FLT-20: no column is null or ""."""
    out = F.lit(True)
    for c in columns:
        out = out & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return out


def has_items(c: Column) -> Column:
    """FLT-15: a list with something in it."""
    return F.coalesce(F.size(c), F.lit(0)) > 0


def discrepant(existing: Column, expected: Column) -> Column:
    """FLT-17: fewer than expected, or not there."""
    return existing.isNull() | (existing < expected)


def split_by_reason(df: DataFrame, reason: str, wanted: str) -> tuple[DataFrame, DataFrame]:
    """FLT-18: rows of the wanted reason, and all others; a row without a reason is one of the others."""
    hit = F.coalesce(F.col(reason) == wanted, F.lit(False))
    return df.where(hit), df.where(~hit)
