"""Joins with the reference semantics of hand-built hash joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a dimension up to which it is broadcast; its owner checks with `small`.
SMALL = 100_000


def small(dim: DataFrame) -> DataFrame:
    """dim, to be broadcast if it has been counted as small; as it is otherwise, so that the join shuffles."""
    return F.broadcast(dim) if dim.limit(SMALL + 1).count() <= SMALL else dim


def translated(df: DataFrame, column: str, dim: DataFrame, key: str, value: str, default: str | None = None) -> DataFrame:
    """JOIN-01: column by a dimension of one row a key; others keep their value, or get the default."""
    right = small(dim.select(F.col(key).alias("_k"), F.col(value).alias("_v")))
    return df.join(right, F.col(column) == F.col("_k"), "left").withColumn(column, F.coalesce("_v", F.col(column) if default is None else F.lit(default))).drop("_k", "_v")


def first_rows(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """JOIN-03, JOIN-04: the first row of each key by `order`, as a mergeable minimum: no key's rows are gathered or sorted."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_f"))
    return best.select(*keys, "_f.*").select(*df.columns)


def unique_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """JOIN-04, AGG-07: rows of keys that occur once."""
    rest = [c for c in df.columns if c not in keys]
    once = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.first(F.struct(*rest)).alias("_f")).where("_n = 1")
    return once.select(*keys, "_f.*").select(*df.columns)


def collisions(df: DataFrame, keys: list[str], other: str) -> DataFrame:
    """JOIN-03: keys that more than one value of `other` claims, and how many lost."""
    return df.groupBy(*keys).agg((F.count_distinct(other) - 1).alias("lost")).where("lost > 0")


def cascade(df: DataFrame, row_id: str, candidates: list[tuple[str, Column, Column]], lookup: DataFrame) -> DataFrame:
    """JOIN-05: (row_id, prio, target) by the first candidate key that its lookup holds.

    candidates are (lookup kind, key, guard) in order; lookup is (kind, key, target), one target a (kind, key). All
    candidates are joined at once and the least priority stays, which is what trying one after the other gives.
    """
    keys = F.array(*[F.when(F.coalesce(guard, F.lit(False)) & (F.coalesce(key, F.lit("")) != ""), F.struct(F.lit(i).alias("prio"), F.lit(kind).alias("kind"), key.alias("key"))) for i, (kind, key, guard) in enumerate(candidates)])
    tried = df.select(row_id, F.explode(F.array_compact(keys)).alias("c")).select(row_id, "c.*")
    return tried.join(lookup, ["kind", "key"]).groupBy(row_id).agg(F.min("prio").alias("prio"), F.min_by("target", "prio").alias("target"))


def missing(known: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """JOIN-06, SET-04: the values of `seen` that `known` lacks, once each, in order."""
    return seen.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti").orderBy(key)


def members(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """JOIN-07: rows whose key is among the allowed."""
    return df.join(allowed.select(key).distinct(), key, "left_semi")


def differences(known: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """JOIN-08: (key, side): missing from known, or extra in it."""
    k, s = known.select(F.col(key).alias("_k")).distinct(), seen.select(F.col(key).alias("_s")).distinct()
    both = k.join(s, F.col("_k") == F.col("_s"), "full_outer").where("_k is null or _s is null")
    return both.select(F.coalesce("_k", "_s").alias(key), F.when(F.col("_k").isNull(), "missing").otherwise("extra").alias("side"))


def unmatched_groups(forms: DataFrame, group: str, key: str, known: DataFrame) -> DataFrame:
    """JOIN-11: groups none of whose forms has a key in `known`; groups without forms are not listed."""
    hit = forms.join(known.select(key).distinct(), key, "left_semi").select(group).distinct()
    return forms.select(group).distinct().join(hit, group, "left_anti")


def reconciled(expected: DataFrame, stored: DataFrame, key: str, count: str = "card_count") -> DataFrame:
    """JOIN-21: per expected key existing and missing counts and a reason: not_scraped, card_count_mismatch or up_to_date."""
    have = stored.groupBy(key).agg(F.count("*").alias("existing"))
    n = F.coalesce("existing", F.lit(0).cast("long"))
    reason = F.when(n == 0, "not_scraped").when((F.col(count) > 0) & (n != F.col(count)), "card_count_mismatch").otherwise("up_to_date")
    return expected.join(have, key, "left").select(key, F.col(count).alias("expected"), n.alias("existing"), (F.col(count) - n).alias("missing"), reason.alias("reason"))


def flagged_absent(df: DataFrame, stored: DataFrame, key: str, column: str, suffix: str) -> DataFrame:
    """JOIN-22: column with a suffix where the key is not stored."""
    there = stored.select(F.col(key), F.lit(True).alias("_there")).distinct()
    return df.join(there, key, "left").withColumn(column, F.when(F.col("_there").isNull(), F.concat(F.col(column), F.lit(suffix))).otherwise(F.col(column))).drop("_there")


def numbered(df: DataFrame, keys: list[str], *order: str) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def merged_back(df: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """JOIN-17: df with the rows of `changed`, a transformed part of it (one row a key), in place of its own."""
    rest = [c for c in df.columns if c != key]
    new = changed.select(F.col(key), F.struct(*rest).alias("_c"))
    return df.join(new, key, "left").select(key, F.coalesce("_c", F.struct(*rest)).alias("_r")).select(key, "_r.*").select(*df.columns)


def reused(df: DataFrame, stored: DataFrame, key: str, order: str, *fields: str) -> DataFrame:
    """JOIN-18: null and "" fields from the first stored row with the same key."""
    sibling = first_rows(stored.where(F.col(key).isNotNull()).select(key, order, *fields), [key], F.col(order))
    joined = df.join(sibling.select(key, *[F.col(f).alias(f"_s_{f}") for f in fields]), key, "left")
    return joined.select(*[F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_s_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns])


def preserving(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """JOIN-19 (Q-23): new rows with the columns that only the stored row of the key has."""
    kept = [c for c in old.columns if c not in new.columns]
    return new.join(old.select(key, *kept), key, "left")
