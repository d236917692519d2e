"""Quality scores by a sparse rule ensemble.

Small trees are grown on statistics of labelled texts, each on a random part of rows and statistics; every path from a
root is a conjunctive rule. Lasso-penalised logistic regression gives the rules weights, most of them zero. The rules
left are compiled into one Spark column expression over the statistics, so scoring needs no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collatio.llm.shared import hash_sample, held_out

#: Labelled texts to learn from: expected number; at most twice as many.
TRAINING_TEXTS = 6000
TREES, DEPTH, LEAF, CUTS = 40, 3, 15, 24
PASS = 0.7


STATISTICS = ("log_words", "word_length", "upper", "marks", "marks_by_word", "digits", "stops", "commas", "other_words", "other_lines", "words_by_line")


def statistics(texts: DataFrame) -> DataFrame:
    """texts (text, others) -> others and STATISTICS of the whole text; null counts as empty, and shares of nothing are 0.

    Words, lines and counts are columns of projections of their own, so that each is worked out once a text.
    """
    others = [c for c in texts.columns if c != "text"]
    whole = texts.select(*others, F.coalesce("text", F.lit("")).alias("t"))
    split = whole.select(*others, "t", F.filter(F.split("t", r"\s+"), lambda w: w != "").alias("words"), F.split("t", "\n").alias("lines"))
    t, pattern = F.col("t"), lambda x: F.regexp_count("t", F.lit(x))
    n = {
        "chars": F.length(t), "words": F.size("words"), "lines": F.size("lines"),
        "upper": pattern(r"\p{Lu}"), "marks": pattern(r"[^\p{L}\p{N}\s.,;:'\"-]"), "digits": pattern(r"[0-9]"),
        "stops": pattern(r"[.!?](\s|$)"), "commas": F.octet_length(t) - F.octet_length(F.replace(t, F.lit(","), F.lit(""))),
        "other_words": F.size(F.array_distinct("words")), "other_lines": F.size(F.array_distinct("lines")),
    }
    counts = split.select(*others, F.struct(*[c.alias(name) for name, c in n.items()]).alias("n"))

    def per(part: str, all_of: str) -> Column:
        return F.when(F.col(f"n.{all_of}") > 0, F.col(f"n.{part}") / F.col(f"n.{all_of}")).otherwise(0.0).cast("double")

    found = (
        F.log1p("n.words"), per("chars", "words"), per("upper", "chars"), per("marks", "chars"), per("marks", "words"), per("digits", "chars"),
        per("stops", "words"), per("commas", "words"), per("other_words", "words"), per("other_lines", "lines"), per("words", "lines"),
    )
    return counts.select(*others, *[c.alias(name) for name, c in zip(STATISTICS, found, strict=True)])


@dataclass
class Model:
    names: list[str]
    bias: float
    #: (weight, ((statistic, above, cut), ...)); a rule holds if each statistic is > cut where above, else <= cut.
    rules: list[tuple[float, tuple[tuple[int, bool, float], ...]]]

    def score(self, stats: dict[str, Column]) -> Column:
        total = F.lit(self.bias)
        for weight, conditions in self.rules:
            holds = F.lit(True)
            for s, above, cut in conditions:
                value = stats[self.names[s]]
                holds = holds & ((value > F.lit(cut)) if above else (value <= F.lit(cut)))
            total = total + F.when(holds, F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _paths(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, path: tuple) -> list[tuple]:
    """Paths of one tree grown by the variance of y, those of inner nodes included."""
    found = [path] if path else []
    if depth == 0 or len(y) < 2 * LEAF or y.min() == y.max():
        return found
    best = None
    for s in rng.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False):
        for cut in np.unique(np.quantile(x[:, s], np.linspace(0.02, 0.98, CUTS))):
            above = x[:, s] > cut
            n = above.sum()
            if LEAF <= n <= len(y) - LEAF:
                gain = n * (y[above].mean() - y.mean()) ** 2 + (len(y) - n) * (y[~above].mean() - y.mean()) ** 2
                if best is None or gain > best[0]:
                    best = (gain, int(s), float(cut), above)
    if best is None or best[0] < 1e-9:
        return found
    _, s, cut, above = best
    return found + _paths(x[above], y[above], rng, depth - 1, (*path, (s, True, cut))) + _paths(x[~above], y[~above], rng, depth - 1, (*path, (s, False, cut)))


def fit(names: list[str], x: np.ndarray, y: np.ndarray, seed: int = 7, penalty: float = 0.002, rounds: int = 600) -> Model:
    """Grow trees, keep their paths as rules, and weigh them by proximal gradient steps with momentum."""
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return Model(names, float(np.log(rate / (1 - rate))), [])
    rng, paths = np.random.default_rng(seed), {}
    for _ in range(TREES):
        rows = rng.choice(len(y), max(2, len(y) // 2), replace=False)
        paths |= dict.fromkeys(_paths(x[rows], y[rows], rng, int(rng.integers(1, DEPTH + 1)), ()))
    rules = list(paths)
    holds = np.ones((len(y), len(rules)))
    for j, path in enumerate(rules):
        for s, above, cut in path:
            holds[:, j] *= (x[:, s] > cut) if above else (x[:, s] <= cut)
    center, scale = holds.mean(axis=0), np.maximum(holds.std(axis=0), 0.05)
    z = (holds - center) / scale
    w, b, ahead, ahead_b, t = np.zeros(len(rules)), 0.0, np.zeros(len(rules)), 0.0, 1.0
    rate = 4 / max(np.linalg.eigvalsh(z.T @ z / len(y)).max(), 1.0)
    for _ in range(rounds):
        slope = 1 / (1 + np.exp(-(z @ ahead + ahead_b))) - y
        moved = ahead - rate * (z.T @ slope) / len(y)
        after = np.sign(moved) * np.maximum(np.abs(moved) - rate * penalty, 0)
        after_b = ahead_b - rate * slope.mean()
        t_after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_b = after + (t - 1) / t_after * (after - w), after_b + (t - 1) / t_after * (after_b - b)
        w, b, t = after, after_b, t_after
    weights = w / scale
    kept = [(float(v), path) for v, path in zip(weights, rules, strict=True) if v]
    return Model(names, float(b - (weights * center).sum()), kept)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", training_texts: int = TRAINING_TEXTS) -> Model:
    """Learn from a bounded, hash-chosen sample of the labels outside the held-out fold; without any, every score is 0.5.

    A document that is labelled twice counts twice, an id that several documents share as the one whose text has the
    smallest hash; null labels and labels of no document count for nothing.
    """
    chosen = hash_sample(labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).where("id is not null and y is not null").where(~held_out(F.col("id"))), F.col("id"), training_texts)
    # At most 2 * training_texts labels: a bound that doesn't grow with the input. One text an id, by a minimum that merges.
    ids = chosen.select("id").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(ids), "id")
    stats = STATISTICS
    measured = statistics(texts.withColumn("hash", F.xxhash64("text"))).select("id", F.struct("hash", *stats).alias("found"))
    once = measured.groupBy("id").agg(F.min("found").alias("found"))
    table = once.join(F.broadcast(chosen), "id").select("id", "y", *[f"found.{n}" for n in stats]).toPandas().sort_values(["id", "y"])
    return fit(list(stats), table[list(stats)].to_numpy(dtype=float), table["y"].to_numpy(dtype=float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", at_least: float = PASS) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1), predicted (1 if score >= at_least). Reads whole texts; null is empty."""
    measured = statistics(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")))
    scored = measured.select("_id", model.score({n: F.col(n) for n in STATISTICS}).alias("score"))
    return scored.select(F.col("_id").alias("doc_id"), held_out(F.col("_id")).alias("held_out"), "score", (F.col("score") >= at_least).cast("int").alias("predicted"))
