"""A table by key whose upserts touch few files and move only what changes: JOIN-16, SNK-02, SNK-03.

Rows lie in slices by a hash of their key, each slice bucketed and sorted by the key. An upsert reads the slices that
its changes fall into and nothing else; these are read bucketed, so that the join sends the changes to the stored rows'
partitions and the stored side is not shuffled; and only those slices are rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE = "_slice"


class KeyedStore:
    """A table of one row a key at `path`, known to the session's catalog as `name`.

    slices bounds the numbers that the driver reads to find what an upsert touches. A rewrite stages its files and then
    moves slice by slice, so a run that fails halfway is run again: an upsert of the same rows changes nothing more. One
    writer at a time; `versions` has a commit that tells writers apart.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, key: str, slices: int = 256, buckets: int = 16):
        # Settings of the store's own session; the catalog and the executors are shared.
        self.session = spark.newSession()
        self.session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        self.session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
        self.session.conf.set("spark.sql.shuffle.partitions", str(buckets))
        # Buckets are read as partitions of their own even where a query alone would not need them.
        self.session.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        self.name, self.path, self.key, self.slices, self.buckets = name, path, key, slices, buckets

    def slice_of(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.slices)).cast("int").alias(SLICE)

    def create(self, rows: DataFrame) -> None:
        """The table from rows of one a key; rows without a key are left out."""
        laid = rows.where(F.col(self.key).isNotNull()).repartition(self.buckets, self.key).select("*", self.slice_of())
        laid.write.partitionBy(SLICE).bucketBy(self.buckets, self.key).sortBy(self.key).option("path", self.path).saveAsTable(self.name)

    def read(self) -> DataFrame:
        self.session.catalog.refreshTable(self.name)
        return self.session.table(self.name).drop(SLICE)

    def touched(self, changes: DataFrame) -> list[int]:
        """The slices that changes fall into: at most `slices` numbers."""
        return sorted(r[0] for r in changes.where(F.col(self.key).isNotNull()).select(self.slice_of()).distinct().collect())

    def rows_of(self, slices: list[int]) -> DataFrame:
        """The stored rows of some slices, bucketed by key; other slices' files are not read."""
        self.session.catalog.refreshTable(self.name)
        return self.session.table(self.name).where(F.col(SLICE).isin(slices)).drop(SLICE)

    def put(self, rows: DataFrame) -> None:
        """Rewrite the slices that rows have keys of; rows must be all rows of these slices, in the table's columns."""
        columns = [c for c in self.session.table(self.name).columns if c != SLICE]
        rows.select(*columns, self.slice_of()).write.insertInto(self.name, overwrite=True)

    def upsert(self, changes: DataFrame, merge) -> list[int]:
        """Put merge(stored, changes) in the place of the stored rows of the slices that changes fall into; returns these.

        merge joins changes to stored, by the key alone, and gives whole rows, known and new. Changes without a key are
        left out; no changes touch nothing. changes are read twice, so they should be written rows or a cheap plan.
        """
        changes = changes.where(F.col(self.key).isNotNull())
        slices = self.touched(changes)
        if slices:
            self.put(merge(self.rows_of(slices), changes))
        return slices

    def update(self, changes: DataFrame) -> list[int]:
        """SNK-02, SNK-03: non-null columns of changes (one row a key at most) set where the key is stored; no key is added."""
        fields = [c for c in changes.columns if c != self.key]

        def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
            new = new.select(self.key, *[F.col(c).alias(f"_new_{c}") for c in fields])
            joined = stored.join(new, self.key, "left")
            return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in fields else F.col(c) for c in stored.columns])

        return self.upsert(changes, merge)
