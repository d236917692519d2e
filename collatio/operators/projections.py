"""Projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filled(c: Column) -> Column:
    """"" as null."""
    return F.nullif(c.cast("string"), F.lit(""))


def remapped(df: DataFrame, source: str, **fields: tuple[str, ...]) -> DataFrame:
    """PRJ-01: a canonical row: tcg = source, then each field as the first of its columns that is neither null nor ""."""
    return df.select(F.lit(source).alias("tcg"), *[(F.coalesce(*[filled(F.col(c)) for c in names]) if names else F.lit(None).cast("string")).alias(field) for field, names in fields.items()])


def default_fill(c: Column, sentinel: str = "-", zero_too: bool = False) -> Column:
    """PRJ-02, PRJ-03: null and "" (and zero) as a sentinel."""
    text = c.cast("string")
    missing = text.isNull() | (text == "")
    return F.when(missing | (c == 0) if zero_too else missing, sentinel).otherwise(text)


def backup(df: DataFrame, **pairs: str) -> DataFrame:
    """PRJ-04: backup=source keeps what the backup column holds and fills it from the source else; a second run changes nothing."""
    return df.withColumns({b: F.coalesce(F.col(b), F.col(s)) if b in df.columns else F.col(s) for b, s in pairs.items()})


def overlay(df: DataFrame, other: DataFrame, key: str, *fields: str) -> DataFrame:
    """PRJ-06, JOIN-23: fields of the row of `other` with the key (one at most) where it has them."""
    right = other.select(key, *[F.col(f).alias(f"_r_{f}") for f in fields])
    joined = df.join(right, key, "left")
    return joined.select(*[F.coalesce(_present(joined, f"_r_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns])


def _present(df: DataFrame, name: str) -> Column:
    return F.nullif(F.col(name), F.lit("")) if df.schema[name].dataType.simpleString() == "string" else F.col(name)


def overwrite(df: DataFrame, other: DataFrame, key: str, *fields: str) -> DataFrame:
    """PRJ-07: fields of the row of `other`, its nulls included, where there is one."""
    right = other.select(key, F.lit(True).alias("_there"), *[F.col(f).alias(f"_r_{f}") for f in fields])
    joined = df.join(right, key, "left")
    return joined.select(*[F.when(F.col("_there"), F.col(f"_r_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns])


def stamped(df: DataFrame, run_ms: int, **constants) -> DataFrame:
    """PRJ-10: constants and the run's time, which the caller gives so that a rerun gives the same rows."""
    return df.withColumns({"last_updated": F.lit(run_ms).cast("long"), **{k: F.lit(v) for k, v in constants.items()}})


def object_id(c: Column) -> Column:
    """PRJ-12: an id as {"$oid": text}."""
    return F.to_json(F.struct(c.cast("string").alias("$oid")))


def sides(df: DataFrame, uid: str, is_double: Column) -> DataFrame:
    """PRJ-13: a front and a back row of double-sided cards, uids with _f and _b; one row with a null side of others."""
    side = F.explode(F.when(is_double, F.array(F.lit("front"), F.lit("back"))).otherwise(F.array(F.lit(None).cast("string"))))
    return df.withColumn("side", side).withColumn(uid, F.concat(F.col(uid).cast("string"), F.coalesce(F.concat(F.lit("_"), F.left("side", F.lit(1))), F.lit(""))))


def set_record(df: DataFrame, code: str, title: str) -> DataFrame:
    """PRJ-14: the row that a new set adds to the dimension of sets."""
    from collatio.functions import text

    return df.select(F.lower(code).alias("pathname"), F.col(title).alias("alt"), text.series_order(F.col(code)).alias("order"), text.series_category(F.col(code)).alias("category"))


def reprojected(structs: Column, **fields: str) -> Column:
    """PRJ-15: a list of structs with other field names: new=old."""
    return F.transform(structs, lambda s: F.struct(*[s[old].alias(new) for new, old in fields.items()]))


def set_nested(df: DataFrame, updates: DataFrame, key: str, items: str, pos: str, *fields: str) -> DataFrame:
    """PRJ-08: fields of single elements of the list `items`: updates is (key, pos from 0, fields), null fields change nothing.

    What is gathered of a key is at most one entry an element of its own list, if updates has one row a (key, pos).
    """
    new = updates.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.col(pos).cast("int"), F.struct(*fields)))).alias("_new"))

    def element(x: Column, i: Column) -> Column:
        found = F.try_element_at(F.col("_new"), i)
        for f in fields:
            x = x.withField(f, F.coalesce(found[f], x[f]))
        return x

    joined = df.join(new, key, "left")
    return joined.withColumn(items, F.when(F.col("_new").isNull(), F.col(items)).otherwise(F.transform(items, element))).select(*df.columns)
