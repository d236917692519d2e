"""Order-dependent operators. Each needs an ordinal column; none relies on the order of rows in partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collatio.operators.ranges import numbered_by_range
from collatio.operators.scans import ROWS, Scan


def occurrence_ids(df: DataFrame, key: str, order: str, mark: str = "_ALT") -> DataFrame:
    """WIN-01: df with `uid`: key, key_ALT, key_ALT2, ... in order; counted before anything is filtered out."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("_n", n).withColumn("uid", F.when(F.col("_n") == 1, F.col(key).cast("string")).when(F.col("_n") == 2, F.concat(F.col(key).cast("string"), F.lit(mark))).otherwise(F.concat(F.col(key).cast("string"), F.lit(mark), (F.col("_n") - 1).cast("string")))).drop("_n")


def row_numbers(df: DataFrame, order: str, name: str = "ordinal") -> DataFrame:
    """WIN-08: 0, 1, 2, ... over all rows by `order`, without a window over everything: ranges are numbered on their own and shifted by the counts before them."""
    return numbered_by_range(df, order, name)


def batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """WIN-02: df with `batch`: floor(place / size)."""
    return row_numbers(df, order, "_place").withColumn("batch", F.floor(F.col("_place") / size)).drop("_place")


def letter_suffix(place: Column) -> Column:
    """WIN-03: b, c, d, ... for places 0, 1, 2, ..."""
    return F.char(place + 98)


def carried_forward(df: DataFrame, group: str, order: str, header: Column, name: str, rows: int = ROWS) -> DataFrame:
    """WIN-04: df with the last header at or before each row of its group; null before the first."""
    return Scan(df, group, order, rows).last(header, name).done()


def segments(df: DataFrame, group: str, order: str, starts: Column, text: str, rows: int = ROWS) -> DataFrame:
    """WIN-05: (group, segment, text): the lines from one start to the next, joined; what stands before the first goes."""
    running = Scan(df, group, order, rows).total(F.when(starts, 1).otherwise(0), "segment").done()
    grouped = running.where("segment > 0").groupBy(group, "segment").agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("_l"))
    return grouped.select(group, "segment", F.array_join(F.transform("_l", lambda x: x[text]), "\n").alias(text))


def until_empty(df: DataFrame, group: str, order: str, empty: Column, k: int, rows: int = ROWS) -> DataFrame:
    """WIN-06: rows before the k-th empty one in a row of their group."""
    scan = Scan(df, group, order, rows).total(F.lit(1), "_place")
    # The run of empty rows that a row ends: its place after that of the last row that isn't empty.
    scan = scan.last(F.when(empty, None).otherwise(F.col("_place")), "_full")
    return scan.ever(F.col("_place") - F.coalesce("_full", F.lit(0)) >= k, "_stop").done("_place", "_full").where("_stop = 0").drop("_stop")


def between_headers(df: DataFrame, group: str, order: str, opens: Column, closes: Column, rows: int = ROWS) -> DataFrame:
    """WIN-07: rows after the header that opens and before the next header."""
    state = Scan(df, group, order, rows).last(F.when(opens, True).when(closes, False), "_in").done()
    return state.where(F.coalesce("_in", F.lit(False)) & ~opens).drop("_in")


def until_old(df: DataFrame, group: str, order: str, old: Column, rows: int = ROWS) -> DataFrame:
    """STM-06: rows before the first old one of their group: what a reader that stops there has seen."""
    return Scan(df, group, order, rows).ever(old, "_old").done().where("_old = 0").drop("_old")
