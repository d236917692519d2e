"""Global row numbers without a global window."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Quantiles that a table is cut at, and the rows of a range that it aims at: what lies between two quantiles is cut on.
BUCKETS, ROWS = 256, 1_000_000


def numbered_by_range(df: DataFrame, order: str, name: str) -> DataFrame:
    """df with 0, 1, 2, ... by the unique numeric column `order`, which has no nulls.

    Rows are put into ranges: BUCKETS by quantiles of `order`, each of them in equal widths by as many as its share of the
    rows asks for, so that ranges grow in number and not in size. A range is numbered by a window of its own and shifted by
    the sizes of the ranges before it; the driver holds a number for each.
    """
    cuts = sorted(set(df.approxQuantile(order, [i / BUCKETS for i in range(1, BUCKETS)], 0.001)))
    ranged = df.withColumn("_range", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(order))))
    found = ranged.groupBy("_range").agg(F.count("*").alias("n"), F.min(order).cast("double").alias("low"), F.max(order).cast("double").alias("high"))
    parts = found.select("_range", "low", "high", F.ceil(F.col("n") / ROWS).alias("parts"))
    place = F.when(F.col("high") > F.col("low"), F.floor((F.col(order) - F.col("low")) / (F.col("high") - F.col("low")) * F.col("parts"))).otherwise(0)
    # One row a quantile, BUCKETS at most.
    ranged = ranged.join(F.broadcast(parts), "_range").withColumn("_part", F.least(place, F.col("parts") - 1)).drop("low", "high", "parts")
    sizes = sorted((r[0], r[1], r[2]) for r in ranged.groupBy("_range", "_part").count().collect())
    before = list(accumulate([0, *(n for _, _, n in sizes)]))
    shifts = df.sparkSession.createDataFrame([(r, p, b) for (r, p, _), b in zip(sizes, before, strict=False)], "_range int, _part long, _shift long")
    row = F.row_number().over(Window.partitionBy("_range", "_part").orderBy(order))
    return ranged.join(F.broadcast(shifts), ["_range", "_part"]).withColumn(name, F.col("_shift") + row - 1).drop("_range", "_part", "_shift")
