"""Exact similarity join by Ratcliff-Obershelp ratio: MTH-05, JOIN-12, JOIN-13.

A ratio of t needs 2 * common / (length + length) >= t, common being how many characters two keys share, each as often
as in both. So numbered characters (a1, a2, b1, ...) are tokens of a set similarity: rows meet through an inverted index
over their rarest tokens only (prefix filter), and a pair goes on if its whole sets allow the ratio (count filter). Of
what is left an upper bound that knows the order, the longest common subsequence, comes from bit-parallel arithmetic over
whole Arrow batches; the ratio itself is taken in falling order of bounds until none can be the best any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Commonest tokens whose order the index knows; all others count as rarer. Order costs or saves work, it loses nothing.
KNOWN_TOKENS = 4096
#: Rows of the right side in one block up to which a block is compared without the index.
SMALL_BLOCK = 256
#: Cells of the table of bit masks of a batch: left keys by characters.
CELLS = 2_000_000
#: Left rows whose best ratio so far, and pairs of keys whose ratio, a task remembers.
REMEMBERED = 100_000


def tokens_of(key: str) -> list[int]:
    """Characters numbered by occurrence, so that equal characters of two keys meet one by one."""
    seen: dict[str, int] = {}
    out = []
    for c in key:
        n = seen[c] = seen.get(c, 0) + 1
        out.append(ord(c) << 32 | n)
    return out


def tokens(key: Column, order: dict[int, int] | None = None) -> Column:
    """The tokens of a key, the rarest first; order: rank of the common ones, most common last."""
    known = order or {}

    @F.pandas_udf("array<long>")
    def sort(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: None if k is None else sorted(tokens_of(k), key=lambda t: (known.get(t, -1), t)))

    return sort(key)


def token_order(keys: DataFrame) -> dict[int, int]:
    """Ranks of the KNOWN_TOKENS commonest tokens of the column key: at most so many rows come to the driver."""
    counts = keys.where("key IS NOT NULL").select(F.explode(tokens(F.col("key"))).alias("t")).groupBy("t").count()
    top = counts.orderBy(F.desc("count"), "t").limit(KNOWN_TOKENS).collect()
    return {r["t"]: len(top) - i for i, r in enumerate(top)}


def prefix_length(n: Column, at_least: float) -> Column:
    """How many of its n rarest tokens a key must be found by: any partner shares at least n * t / (2 - t) of them."""
    return (n - F.ceil(n * F.lit(at_least / (2 - at_least)) - 1e-9) + 1).cast("int")


def candidates(left: DataFrame, right: DataFrame, at_least: float, blocks: list[str] | None = None, contains: tuple[str, str] | None = None) -> DataFrame:
    """Pairs l_*, r_* of rows (id, ord, key) whose keys' shared characters allow a ratio of at_least, with that `bound`; each pair once.

    blocks: columns of both sides that must be equal. contains: (column of left, list column of right) where the list
    must hold the value. Null or empty keys, null blocks and null lists pair with nothing. Blocks of more than
    SMALL_BLOCK right rows go through the index too, so a block that holds a third of all rows is not compared pair by pair.
    """
    if not 0 < at_least <= 1:
        raise ValueError("at_least must lie above 0 and be 1 at most")
    a, b, on = _blocked(left, right, blocks, contains)
    return _candidates(a, b, on, at_least).drop(*on)


def _blocked(left: DataFrame, right: DataFrame, blocks: list[str] | None, contains: tuple[str, str] | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides as (id, ord, key, b0, b1, ...), where rows may pair if all b are equal, and the names of these columns."""
    on = [f"b{i}" for i in range(len(blocks or []) + bool(contains))]
    a, b = (side.where("coalesce(key, '') <> ''").withColumns({f"b{i}": F.col(c) for i, c in enumerate(blocks or [])}) for side in (left, right))
    if contains:
        a, b = a.withColumn(on[-1], F.col(contains[0])), b.withColumn(on[-1], F.explode(F.array_distinct(contains[1])))
    return a.select("id", "ord", "key", *on), b.select("id", "ord", "key", *on), on


def _candidates(a: DataFrame, b: DataFrame, on: list[str], at_least: float) -> DataFrame:
    """`candidates` of both sides as `_blocked` gives them, with the columns `on`.

    All joins are merged: rows grow by their tokens, which the planner's sizes don't know, so it would broadcast them.
    """
    order = token_order(a.select("key").unionByName(b.select("key")))
    if on:
        sizes = b.groupBy(on).agg((F.count("*") > SMALL_BLOCK).alias("indexed"))
        a, b = a.join(sizes.hint("merge"), on), b.join(sizes.hint("merge"), on)
    else:
        a, b = a.withColumn("indexed", F.lit(True)), b.withColumn("indexed", F.lit(True))
    a, b = ((side.withColumn("tokens", tokens(F.col("key"), order))) for side in (a, b))

    def by_token(side: DataFrame, name: str) -> DataFrame:
        n = F.size("tokens")
        met = side.withColumns({"n": n, "prefix": F.slice("tokens", F.lit(1), F.least(n, prefix_length(n, at_least)))})
        met = met.withColumn("t", F.explode(F.when(F.col("indexed"), F.col("prefix")).otherwise(F.array(F.lit(-1).cast("long")))))
        return met.select(*on, "t", *[F.col(c).alias(f"{name}_{c}") for c in ("id", "ord", "key", "n", "tokens", "prefix")], *(["indexed"] if name == "l" else []))

    met = by_token(a, "l").join(by_token(b, "r").hint("merge"), [*on, "t"])
    total = F.col("l_n") + F.col("r_n")
    met = met.where(2.0 * F.least("l_n", "r_n") / total >= at_least)
    # A pair counts at the first token that both prefixes hold.
    met = met.where(~F.col("indexed") | (F.try_element_at(F.array_intersect("l_prefix", "r_prefix"), F.lit(1)) == F.col("t")))
    bound = 2.0 * F.size(F.array_intersect("l_tokens", "r_tokens")) / total
    return met.withColumn("bound", bound).where(F.col("bound") >= at_least).select(*on, "l_id", "l_ord", "l_key", "r_id", "r_ord", "r_key", "bound")


def subsequence_bounds(left: list[str], right: list[str], bounds: np.ndarray) -> np.ndarray:
    """For each pair twice its longest common subsequence over both lengths, at most the given bound.

    Matching blocks follow one another in both keys, so the ratio never exceeds it. Left keys beyond 64 characters, right
    ones beyond 256 and those with a zero character keep the bound that they have.
    """
    out = bounds.copy()
    fits = np.array([0 < len(a) <= 64 and 0 < len(b) <= 256 and "\0" not in a and "\0" not in b for a, b in zip(left, right, strict=True)], dtype=bool)
    rows = np.flatnonzero(fits)
    if not len(rows):
        return out
    keys, key_of = np.unique(np.array([left[i] for i in rows], dtype=object).astype(str), return_inverse=True)
    texts = np.array([right[i] for i in rows], dtype=object).astype(str)
    codes = texts.view(np.uint32).reshape(len(rows), -1)
    alphabet, codes = np.unique(codes, return_inverse=True)
    codes = codes.reshape(len(rows), -1)
    place = {chr(c): i for i, c in enumerate(alphabet.tolist()) if c}
    step = max(1, CELLS // len(alphabet))
    for low in range(0, len(keys), step):
        part = keys[low : low + step]
        masks = np.zeros((len(part), len(alphabet)), dtype=np.uint64)
        for k, key in enumerate(part.tolist()):
            for i, c in enumerate(key):
                if c in place:
                    masks[k, place[c]] |= np.uint64(1 << i)
        own = np.flatnonzero((key_of >= low) & (key_of < low + len(part)))
        key, code = key_of[own] - low, codes[own]
        state = np.full(len(own), ~np.uint64(0), dtype=np.uint64)
        for j in range(code.shape[1]):
            hit = masks[key, code[:, j]]
            state = (state + (state & hit)) | (state & ~hit)
        n = np.array([len(k) for k in part.tolist()], dtype=np.uint64)[key]
        common = np.bitwise_count(~state & (~np.uint64(0) >> (np.uint64(64) - n))).astype(np.int64)
        total = n.astype(np.int64) + np.array([len(right[i]) for i in rows[own]], dtype=np.int64)
        out[rows[own]] = np.minimum(out[rows[own]], 2.0 * common / total)
    return out


def scored(pairs: DataFrame, at_least: float, junk: bool = False) -> DataFrame:
    """pairs (of `candidates`) with their left key and ratio where it is at_least or more and where it may be the best of its left row.

    Pairs that cannot be the best of their left row are left out, those that tie with it never. Any split of the pairs
    over tasks is right: the rows that are left hold the best of every left row.
    """
    schema = StructType([f for f in pairs.schema if f.name not in ("r_key", "bound")] + [StructField("ratio", DoubleType())])
    names = [f.name for f in schema]
    # What a left row is told by: its id, its key and its block.
    told = [c for c in names[:-1] if c not in ("l_ord", "r_id", "r_ord")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, float] = {}
        known: dict[tuple[str, str], float] = {}
        for batch in batches:
            for memory in (best, known):
                if len(memory) > REMEMBERED:
                    memory.clear()
            left, right = batch.column("l_key").to_pylist(), batch.column("r_key").to_pylist()
            bounds = subsequence_bounds(left, right, batch.column("bound").to_numpy())
            whose = [[repr(x) if isinstance(x, list | dict) else x for x in batch.column(c).to_pylist()] for c in told]
            found: dict[int, float] = {}
            matcher = SequenceMatcher(None, autojunk=junk)
            for i in np.argsort(-bounds, kind="stable").tolist():
                if bounds[i] < at_least:
                    break
                row = tuple(c[i] for c in whose)
                if bounds[i] < best.get(row, 0.0):
                    continue
                pair = left[i], right[i]
                if (ratio := known.get(pair)) is None:
                    matcher.set_seqs(*pair)
                    ratio = known[pair] = matcher.ratio()
                if ratio >= at_least and ratio >= best.get(row, 0.0):
                    best[row] = found[i] = ratio
            at = pa.array(list(found), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in names[:-1]), pa.array(list(found.values()), pa.float64())], names=names)

    return pairs.mapInArrow(run, schema)


def best_matches(left: DataFrame, right: DataFrame, at_least: float, blocks: list[str] | None = None, contains: tuple[str, str] | None = None, junk: bool = False) -> DataFrame:
    """For each id of left the row of right with the highest ratio of at_least or more: l_id, r_id, similarity (3 digits).

    Ties go to the first row of left by ord, then to the first of right. Ids without such a row are left out.
    """
    a, b, on = _blocked(left, right, blocks, contains)
    # Rows with the same key in the same block have the same best row, and of equal ones on the right the first is it: keys
    # pair once a block, however many rows have them.
    lefts = a.groupBy(*on, "key").agg(F.lit(0).alias("id"), F.lit(0).alias("ord"))
    rights = b.groupBy(*on, "key").agg(F.max_by(F.struct("id", "ord"), F.struct((-F.col("ord")).alias("a"), "id")).alias("first")).select("first.id", "first.ord", "key", *on)
    rows = scored(_candidates(lefts, rights, on, at_least), at_least, junk)
    best = rows.groupBy(*on, F.col("l_key").alias("key")).agg(F.max_by(F.struct("r_id", "r_ord", "ratio"), F.struct("ratio", (-F.col("r_ord")).alias("b"))).alias("best"))
    found = a.join(best.hint("merge"), [*on, "key"]).select(F.col("id").alias("l_id"), "ord", "best.*")
    ids = found.groupBy("l_id").agg(F.max_by(F.struct("r_id", "ratio"), F.struct("ratio", (-F.col("ord")).alias("a"), (-F.col("r_ord")).alias("b"))).alias("best"))
    return ids.select("l_id", "best.r_id", F.bround("best.ratio", 3).alias("similarity"))
