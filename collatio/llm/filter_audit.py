"""Audit of how document filters interact in every order they could be applied in.

A document fails a set of filters: a mask of five bits. Whatever the order, what becomes of a document depends on its
mask alone, so the corpus is reduced to histograms over 32 masks, for each part one of all documents and one for each
label. Stacked as rows they are multiplied by integer matrices of 32 masks by 600 outcomes (120 orders by 5 steps):
kept, removed, redundant and unique. No order is applied to the corpus itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collatio.llm.shared import durable, releasing

FILTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
MASKS, STEPS = 2 ** len(FILTERS), len(FILTERS)
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text: few words, repeated words, capitals, signs."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return {"A": n_words < 100, "B": 100 * distinct.cast("long") < 80 * n_words.cast("long"), "C": 100 * capitals > 10 * F.length(text).cast("long"), "D": text.rlike(r"[#$%&*|]")}


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, id, n): how many rows of an id fail just the filters of a mask, A being the lowest bit.

    Texts that are equal to one of a smaller id are found by digest: the smallest id of a digest is a mergeable minimum,
    and whether a row has it is a join on digest and id together, so a text that a third of all rows share burdens no task.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bits = [F.when(fails, 1 << FILTERS.index(name)).otherwise(0) for name, fails in text_failures(F.col("text")).items()]
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    marked = read.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum(bits[1:], bits[0]).alias("mask"))
    # Rows that agree in everything are one before they are shuffled; the texts are read once and go no further.
    rows = durable(marked.groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n")))
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).where("id IS NOT NULL").withColumn("first", F.lit(True))
    fails = F.col("id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["digest", "id"], "left").select("part", (F.col("mask") + F.when(fails, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"), "id", "n")


def histograms(marked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents of a mask, and those among them with a label quality = 1 and toxic = 1."""
    flag = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)))
    labelled = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    of = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c)
    return marked.join(labelled, "id", "left").groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


@cache
def incidence() -> dict[str, np.ndarray]:
    """Integer matrices of 32 masks by 600 (order, step): 1 where a document of the mask has that outcome there."""
    out = {name: np.zeros((MASKS, len(ORDERS) * STEPS), dtype=np.int64) for name in ("kept", "removed", "redundant", "unique_fails")}
    for column, (order, step) in enumerate((o, s) for o in ORDERS for s in range(STEPS)):
        own, earlier = 1 << FILTERS.index(order[step]), sum(1 << FILTERS.index(f) for f in order[:step])
        for mask in range(MASKS):
            out["kept"][mask, column] = not mask & (own | earlier)
            out["removed"][mask, column] = bool(mask & own) and not mask & earlier
            out["redundant"][mask, column] = bool(mask & own) and bool(mask & earlier)
            out["unique_fails"][mask, column] = mask == own
    return out


def outcomes(hist: np.ndarray) -> dict[str, np.ndarray]:
    """Counts by part and (order, step) from histograms stacked as rows: for each part all, good and toxic documents."""
    n_parts = len(hist) // 3
    whole = hist.reshape(n_parts, 3, MASKS)[:, 0]
    matrices = incidence()
    found = {name: whole @ matrices[name] for name in ("kept", "redundant", "unique_fails")}
    removed = (hist @ matrices["removed"]).reshape(n_parts, 3, -1)
    found |= {"removed": removed[:, 0], "good_lost": removed[:, 1], "toxic_lost": removed[:, 2]}
    filters = np.array([FILTERS.index(f) for order in ORDERS for f in order])
    by_filter = np.stack([removed[:, 0][:, filters == f].sum(axis=1) for f in range(STEPS)], axis=1)
    return found | {"shapley": by_filter[:, filters]}


def interactions(hist: DataFrame) -> DataFrame:
    """One row per part, order and step from the histograms; a part has at most 32 masks, so its row is small."""
    orders = pa.array([o for o in ORDERS for _ in range(STEPS)])
    steps = pa.array(np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS)))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, bins in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                stacked = np.zeros((3, MASKS), dtype=np.int64)
                for b in bins:
                    stacked[:, b["mask"]] = b["n"], b["good"], b["toxic"]
                found = outcomes(stacked)
                names = ["part", "filter_order", "step", *COUNTS]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(orders)), orders, steps, *(pa.array(found[c][0]) for c in COUNTS)], names=names)

    return hist.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("bins")).mapInArrow(releasing(multiply), SCHEMA)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step: part, filter_order, step and the counts of COUNTS.

    A null text counts as empty, a null part as the empty string. Rows count as often as they are there. A null id has no
    smaller one and is smaller than none, so its text is no copy. Several labels of one id count once, with the largest
    flag; labels without an id or without a document count for nothing. An empty table has no part and gives no row.
    Other columns are ignored, whatever their names.
    """
    return interactions(histograms(masks(docs, id_col, text_col, part_col), labels, id_col))
