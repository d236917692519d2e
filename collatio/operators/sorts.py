"""Orders with ties and missing keys settled, as lists of columns for orderBy or a window."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def best_first(similarity: Column, ordinal: Column, places: int = 3) -> list[Column]:
    """SRT-02: by rounded similarity, the largest first; equal ones as they came."""
    return [F.bround(similarity, places).desc(), ordinal.asc()]


def blank_first(key: Column, ordinal: Column) -> list[Column]:
    """SRT-01, SRT-03: ascending, null as the empty text."""
    return [F.coalesce(key, F.lit("")).asc(), ordinal.asc()]


def by_time(stamp: Column, ordinal: Column) -> list[Column]:
    """SRT-04: by the time that a text says; one that says none is the earliest of all."""
    return [F.coalesce(F.unix_seconds(F.try_to_timestamp(stamp)), F.lit(0).cast("long")).asc(), ordinal.asc()]


def longest_first(key: Column, ordinal: Column) -> list[Column]:
    """SRT-05: the longest key first; equal lengths as they came."""
    return [F.length(key).desc(), ordinal.asc()]
