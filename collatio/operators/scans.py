"""Ordered scans of groups of any size: what WIN-04 to WIN-07 and STM-06 carry from row to row.

A group of more than ROWS rows is cut into ranges of its order. Within a range a window scans as ever; each range has a
summary (its last value, its sum, its maximum), the summaries of a group's ranges are scanned in their turn, and what
comes from the ranges before is put to the rows of a range. So no task ever holds more than a range, if all rows are one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from collatio.operators.joins import small

#: Rows of a range, about, and quantiles that a group is cut at; what lies between two quantiles is cut on in equal widths.
ROWS, QUANTILES = 1_000_000, 256


class Scan:
    """df with scans by `order`, a number that is unique within `group` and never null; null groups are one group.

    Groups are counted first; if none has more than `rows` rows, a scan is one plain window. The driver holds up to
    QUANTILES numbers for each larger group, of which there are no more than rows of df over `rows`.
    """

    def __init__(self, df: DataFrame, group: str, order: str, rows: int = ROWS):
        self.group, self.order = group, order
        large = {r[0]: r[1] for r in df.groupBy(group).count().where(F.col("count") > rows).collect()}
        self.cut = bool(large)
        self.df = df.withColumn("_key", F.struct(group)).withColumn("_range", F.lit(0).cast("long"))
        if large:
            self.df = self._ranged(large, rows)

    def _ranged(self, large: dict, rows: int) -> DataFrame:
        kind = self.df.schema[self.group].dataType
        key = StructType([StructField(self.group, kind)])
        # As many quantiles as a group asks for, in powers of two, so that there are few kinds of groups.
        quantiles = {g: min(QUANTILES, 1 << (n // rows).bit_length()) for g, n in large.items()}
        found = []
        for k in sorted(set(quantiles.values())):
            own = self.df.sparkSession.createDataFrame([((g,),) for g, x in quantiles.items() if x == k], StructType([StructField("_key", key)]))
            cuts = F.percentile_approx(F.col(self.order).cast("double"), [i / k for i in range(1, k)], 10_000).alias("cuts")
            ends = F.min(F.col(self.order)).cast("double").alias("low"), F.max(F.col(self.order)).cast("double").alias("high")
            found += [(r["_key"], sorted({r["low"], *r["cuts"], r["high"]}), -(-large[r["_key"][0]] // (k * rows))) for r in self.df.join(small(own), "_key").groupBy("_key").agg(cuts, *ends).collect()]
        schema = StructType([StructField("_key", key), StructField("_cuts", ArrayType(DoubleType())), StructField("_parts", LongType())])
        placed = self.df.drop("_range").join(small(self.df.sparkSession.createDataFrame(found, schema)), "_key", "left")
        at = F.size(F.filter("_cuts", lambda c: c <= F.col(self.order)))
        low, high = F.get("_cuts", at - 1), F.get("_cuts", at)
        part = F.when(high > low, F.least(F.floor((F.col(self.order) - low) / (high - low) * F.col("_parts")), F.col("_parts") - 1)).otherwise(0)
        return placed.withColumn("_range", F.coalesce(at * F.col("_parts") + part, F.lit(0)).cast("long")).drop("_cuts", "_parts")

    def _here(self):
        return Window.partitionBy("_key", "_range").orderBy(self.order).rowsBetween(Window.unboundedPreceding, 0)

    def _put(self, summary: Column, before: Column, own: Column, both, name: str) -> Scan:
        """The scan `name`: own within a range, and with what the summaries of the ranges before come to."""
        if self.cut:
            found = self.df.groupBy("_key", "_range").agg(summary.alias("_s"))
            found = found.select("_key", "_range", before.over(Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)).alias("_before")).where("_before IS NOT NULL")
            self.df = self.df.withColumn(name, own).join(found, ["_key", "_range"], "left").withColumn(name, both(F.col(name), F.col("_before"))).drop("_before")
        else:
            self.df = self.df.withColumn(name, own)
        return self

    def last(self, value: Column, name: str) -> Scan:
        """The last value that is not null, up to and with the row."""
        summary = F.max_by(value, F.when(value.isNotNull(), F.col(self.order)))
        return self._put(summary, F.last("_s", ignorenulls=True), F.last(value, ignorenulls=True).over(self._here()), F.coalesce, name)

    def total(self, amount: Column, name: str) -> Scan:
        """The sum up to and with the row."""
        return self._put(F.sum(amount), F.sum("_s"), F.sum(amount).over(self._here()), lambda own, before: own + F.coalesce(before, F.lit(0)), name)

    def ever(self, flag: Column, name: str) -> Scan:
        """Whether a flag has been true, up to and with the row; null is false."""
        said = F.when(flag, 1).otherwise(0)
        return self._put(F.max(said), F.max("_s"), F.max(said).over(self._here()), lambda own, before: F.greatest(own, F.coalesce(before, F.lit(0))), name)

    def done(self, *names: str) -> DataFrame:
        """The rows without what only the scans needed."""
        return self.df.drop("_key", "_range", *names)
