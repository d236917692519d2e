"""Incremental ingest: what is new, by difference, by watermark, by count, and the translation of what is left."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collatio.operators import filters, joins
from collatio.plans.calls import BATCH, Calls
from collatio.sources.edge import Translator


def new_rows(listed: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of the listing whose key is not stored, once a key: done before anything costly. Null keys are left out."""
    return listed.where(F.col(key).isNotNull()).dropDuplicates([key]).join(stored.select(key), key, "left_anti")


def after_watermark(df: DataFrame, state: DataFrame, category: str, ts: str) -> DataFrame:
    """STM-02, FLT-07: rows newer than their category's watermark, and all of categories without one."""
    marks = joins.small(state.select(category, F.col("last").alias("_last")))
    return df.join(marks, category, "left").where(filters.newer(F.col(ts), F.col("_last"))).drop("_last")


def advanced(state: DataFrame, seen: DataFrame, category: str, ts: str) -> DataFrame:
    """STM-01, AGG-08: the state after a run: the latest time a category, never earlier than before."""
    both = state.select(category, "last").unionByName(seen.select(category, F.col(ts).alias("last")))
    return both.groupBy(category).agg(F.max("last").alias("last"))


def watchlist(expected: DataFrame, stored: DataFrame, key: str, count: str) -> DataFrame:
    """STM-04: the watched sets that need work, with the reason."""
    return joins.reconciled(expected, stored, key, count).where("reason <> 'up_to_date'")


def _written(texts: DataFrame, translator: Translator, size: int = BATCH, calls: Calls | None = None) -> DataFrame:
    """(original, written) of distinct texts, `size` at a time; a batch that fails or comes back with another number stays as it is.

    With calls the texts go through that table of attempts: what was answered before is not asked again, and what fails is.
    """
    if calls is not None:
        calls.plan(texts)
        calls.run(translator)
        return calls.answers().join(texts, "original", "left_semi")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), size):
                asked = part["original"].tolist()[at : at + size]
                try:
                    found = translator.translate(asked)
                except Exception:
                    found = asked
                yield pd.DataFrame({"original": asked, "written": found if len(found) == len(asked) else asked})

    return texts.mapInPandas(run, "original string, written string")


def translated_lists(df: DataFrame, key: str, lists: list[str], translator: Translator, names: DataFrame | None = None, suffix: str = "JP", calls: Calls | None = None) -> DataFrame:
    """UDF-02 to UDF-05: each list of texts translated element by element, the original kept as list + suffix; null and blank elements stay.

    names (jp, en) are texts settled before, such as the names that a first pass translated: they win over the translator. calls is a table of attempts: finished texts are not asked again.
    """
    cells = df.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("list"), F.col(c).alias("texts")) for c in lists])).alias("x")).select(key, "x.list", F.posexplode("x.texts").alias("pos", "original"))
    texts = cells.select("original").where("trim(original) <> ''").distinct()
    if names is not None:
        known = names.select(F.col("jp").alias("original"), F.col("en").alias("written"))
        table = known.unionByName(_written(texts.join(known, "original", "left_anti"), translator, calls=calls))
    else:
        table = _written(texts, translator, calls=calls)
    # A row's own elements come together again: no more than it held before.
    done = cells.join(table, "original", "left").groupBy(key, "list").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("written", "original").alias("text")))).alias("l"))
    wide = done.groupBy(key).agg(*[F.max(F.when(F.col("list") == c, F.transform("l", lambda x: x["text"]))).alias(f"_t_{c}") for c in lists])
    joined = df.join(wide, key, "left")
    return joined.select(*[F.coalesce(f"_t_{c}", c).alias(c) if c in lists else F.col(c) for c in df.columns], *[F.col(c).alias(f"{c}{suffix}") for c in lists])


def translated_columns(df: DataFrame, columns: list[str], translator: Translator, suffix: str = "JP", calls: Calls | None = None) -> DataFrame:
    """UDF-01 to UDF-06: each column translated, the original kept as column + suffix.

    Every distinct text goes to the translator once (keyed by the original, Q-26), in Arrow batches on the executors;
    blank texts don't go, and texts it fails on stay as they are. calls is a table of attempts: finished texts are not asked again.
    """

    texts = df.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("original")).where("trim(original) <> ''").distinct()
    table = _written(texts, translator, calls=calls)
    for c in columns:
        named = table.select(F.col("original").alias(f"{c}{suffix}"), F.col("written").alias("_w"))
        df = df.withColumnRenamed(c, f"{c}{suffix}").join(named, f"{c}{suffix}", "left").withColumn(c, F.coalesce("_w", F.col(f"{c}{suffix}"))).drop("_w")
    return df
