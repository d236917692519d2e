"""Price history: an append-only fact of price points as the store, and the map a product that readers see.

Products: product_link (key), price_history map<string, struct<price, stock>> by epoch milliseconds, created_at,
last_updated, and other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collatio.functions.scalars import merged

POINT = "struct<price:int,stock:int>"


def snapshot_rows(listing: DataFrame, run_ms: int, key: str = "product_link") -> DataFrame:
    """A run's listing (key, price, stock, ord, ...) as rows with a one-entry history; of a repeated key the last stays (Q-16)."""
    rest = [c for c in listing.columns if c not in (key, "ord")]
    last = listing.groupBy(key).agg(F.max_by(F.struct(*rest), "ord").alias("r")).select(key, "r.*")
    point = F.struct(F.col("price").cast("int").alias("price"), F.col("stock").cast("int").alias("stock"))
    return last.withColumn("price_history", F.create_map(F.lit(str(run_ms)), point)).drop("price", "stock")


def upserted(old: DataFrame, new: DataFrame, run_ms: int, key: str = "product_link") -> DataFrame:
    """JOIN-16: all rows after a run: histories of known keys merged, the new point winning; unknown keys inserted; others as they were.

    The result has `change`: insert, update or keep. Old rows must have one row a key; a failed read of them fails the
    run (Q-17).
    """
    fields = [c for c in new.columns if c not in (key, "price_history")]
    o = old.select(key, *[F.col(c).alias(f"_o_{c}") for c in old.columns if c != key], F.lit(True).alias("_old"))
    n = new.select(key, *[F.col(c).alias(f"_n_{c}") for c in new.columns if c != key], F.lit(True).alias("_new"))
    both = o.join(n, key, "full_outer")
    run = F.lit(run_ms).cast("long")
    change = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNotNull(), "update").otherwise("keep")
    return both.select(
        key,
        *[F.coalesce(f"_n_{c}", f"_o_{c}").alias(c) if c in fields else F.col(f"_o_{c}").alias(c) for c in old.columns if c not in (key, "price_history", "created_at", "last_updated")],
        merged(F.col("_o_price_history"), F.col("_n_price_history")).alias("price_history"),
        F.coalesce("_o_created_at", run).alias("created_at"),
        F.when(F.col("_new").isNotNull(), run).otherwise(F.col("_o_last_updated")).alias("last_updated"),
        change.alias("change"),
    )


def points(products: DataFrame, key: str = "product_link") -> DataFrame:
    """MAP-02: (key, ts, price, stock), a row a point."""
    return products.select(key, F.explode("price_history").alias("t", "p")).select(key, F.col("t").cast("long").alias("ts"), "p.price", "p.stock")


def histories(facts: DataFrame, key: str = "product_link") -> DataFrame:
    """The map of each product from its points; of points with one time the last written (largest seq) counts."""
    entry = F.struct(F.col("ts").cast("string").alias("k"), F.struct("price", "stock").alias("v"))
    latest = facts.groupBy(key, "ts").agg(F.max_by(entry, "seq").alias("e"))
    return latest.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list("e"))).alias("price_history"))


def latest_points(facts: DataFrame, key: str = "product_link") -> DataFrame:
    return facts.groupBy(key).agg(F.max("ts").alias("ts"), F.max_by("price", "ts").alias("price"))


def point_maps(facts: DataFrame, key: str = "product_link") -> DataFrame:
    """(key, points): the points of a run or a micro-batch alone, by time, each with its seq; of one time the largest seq counts."""
    entry = F.struct(F.col("ts").cast("string").alias("k"), F.struct("price", "stock", F.col("seq").cast("long").alias("seq")).alias("v"))
    latest = facts.where(F.col(key).isNotNull()).groupBy(key, "ts").agg(F.max_by(entry, "seq").alias("e"))
    return latest.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list("e"))).alias("points"))


def with_points(stored: DataFrame, new: DataFrame, key: str = "product_link") -> DataFrame:
    """STM-05, MAP-02: stored maps with new points put in, for `KeyedStore.upsert`; products that are not stored yet come in.

    Of two points of one time the larger seq stays, so a batch that comes twice or late changes nothing. A point without
    a price takes the place of earlier ones all the same (a tombstone): `live_points` leaves it out.
    """
    both = stored.withColumnRenamed("points", "_old").join(new.withColumnRenamed("points", "_new"), key, "full_outer")
    pick = lambda _, a, b: F.when(b.isNull() | (a["seq"] > b["seq"]), a).otherwise(b)
    merged_maps = F.map_zip_with("_old", "_new", pick)
    return both.select(key, F.coalesce(merged_maps, F.col("_old"), F.col("_new")).alias("points"))


def live_points(maps: DataFrame, key: str = "product_link") -> DataFrame:
    """(key, ts, price, stock) of maps with seq: a row a point that has a price."""
    return points(maps.withColumnRenamed("points", "price_history"), key).where("price IS NOT NULL")
