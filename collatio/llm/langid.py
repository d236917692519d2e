"""Language identification with error-correcting output codes.

Each language gets a codeword; one binary classifier over hashed character n-grams predicts each bit. A text's margins
are compared with every codeword by weighted logistic loss, and the codeword with the least loss names the language. If
the runner-up is close the answer is flagged as ambiguous.

A margin is a mean over the n-grams of a text's words, so a worker finds a word's sums once and then only adds.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collatio.llm.shared import held_out, releasing
from collatio.llm.shingles import STEP, mix

#: Buckets of the n-gram hash, and the lengths of the n-grams of a word written between two blanks.
BUCKETS, GRAMS = 4096, (1, 2, 3)
#: Labelled texts to learn from, at most.
TRAINING_TEXTS = 2400
#: Words whose sums a Python worker remembers.
REMEMBERED = 100_000
#: Least share of the best language in the softmax over negative losses for an answer that isn't ambiguous.
CLEAR = 0.5
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def codebook(n: int) -> np.ndarray:
    """(n, bits) of +1 and -1: every split of the languages in two for up to 7 of them, else random rows far apart."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        columns = [(1, *rest) for rest in product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(columns, dtype=float).T
    rng = np.random.default_rng(n)
    bits = int(np.ceil(10 * np.log2(n)))
    tries = [rng.choice((-1.0, 1.0), size=(n, bits)) for _ in range(200)]
    # The best try has the largest least distance between two rows, and no bit that is the same for all.
    return max(tries, key=lambda c: ((bits - (c @ c.T - bits * np.eye(n))).min() / 2, -(np.abs(c.sum(axis=0)) == n).sum()))


def grams(found: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the n-grams of words that all have a letter, one array for each length in word order, and the words' sizes.

    A word of m letters has m, m + 1 and m of them. All words are hashed at once, written in a row with a blank between two.
    """
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    points = np.frombuffer(f" {' '.join(found)} ".encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    letter = points != 32
    pairs = points[:-1] | points[1:] << np.uint64(21)
    triples = pairs[:-1] | points[2:] << np.uint64(42)
    keys = (points[letter], pairs, triples[letter[1:-1]])  # a blank is the middle of no triple
    return [(mix(k * STEP + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int64) for n, k in zip(GRAMS, keys, strict=True)], sizes


def words(text: str) -> list[str]:
    """Runs of word characters that are no digits, those without a letter (such as a lone exponent) left out."""
    return [w for w in WORD.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


def gram_counts(texts: list[str]) -> np.ndarray:
    """(n, BUCKETS) counts of a text's n-grams, at most 65535 each."""
    out = np.zeros((len(texts), BUCKETS), dtype=np.uint16)
    for row, text in zip(out, texts, strict=True):
        if found := words(text):
            row[:] = np.minimum(np.bincount(np.concatenate(grams(found)[0]), minlength=BUCKETS), 65535)
    return out


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # (languages, bits)
    weights: np.ndarray  # (BUCKETS, bits)
    bias: np.ndarray  # (bits,)
    trust: np.ndarray  # (bits,), sums to 1

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest codeword and its softmax share, for (n, bits) margins."""
        loss = np.stack([np.logaddexp(0, -margins * code) @ self.trust for code in self.codes], axis=1)
        share = np.exp(-len(self.trust) * (loss - loss.min(axis=1, keepdims=True)))
        best = loss.argmin(axis=1)
        return best, share[np.arange(len(best)), best] / share.sum(axis=1)


def fit(x: np.ndarray, labels: list[str], rounds: int = 150, penalty: float = 1e-4) -> Model:
    """One logistic regression per bit, all at once, by full-batch Adam."""
    languages = sorted(set(labels))
    codes = codebook(len(languages))
    target = codes[[languages.index(v) for v in labels]]
    # Every language counts the same, however many texts it has.
    each = np.array([1 / labels.count(v) for v in languages])[[languages.index(v) for v in labels]][:, None] / len(languages)
    w, b = np.zeros((x.shape[1], codes.shape[1]), dtype=np.float32), np.zeros(codes.shape[1])
    m1, m2 = np.zeros((w.shape[0] + 1, w.shape[1])), np.zeros((w.shape[0] + 1, w.shape[1]))
    for t in range(1, rounds + 1):
        slope = (-target * each / (1 + np.exp(target * (x @ w + b)))).astype(np.float32)
        grad = np.vstack([x.T @ slope + penalty * w, slope.sum(axis=0)])
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        step = 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1].astype(np.float32), b - step[-1]
    right = (((x @ w + b) * target > 0) * each).sum(axis=0)
    trust = np.maximum(right - 0.5, 1e-3)
    return Model(languages, codes, w, b, trust / trust.sum())


def language_sample(rows: DataFrame, most: int) -> DataFrame:
    """At most `most` of rows (id, text, lang), with their hash h, spread over the languages as evenly as their numbers allow.

    Rows are chosen by a hash of id and text, the same ones on every run; equal rows count once. If there are more than
    `most` languages, the most frequent ones get a row each.
    """
    spark = rows.sparkSession
    hashed = rows.withColumn("h", F.pmod(F.xxhash64("id", "text", F.lit("sample")), F.lit(2**62)))
    counts = hashed.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect()
    caps, ends, left = {}, [], most
    for i, r in enumerate(reversed(counts)):  # what a rare language leaves goes to the others
        caps[r.lang] = cap = min(math.ceil(1.1 * r.n) + 1, left // (len(counts) - i))
        left -= cap
        # Enough for cap rows but for a chance below one in a million, and a bound for what the driver sees.
        ends.append((r.lang, int(min(1, (1.25 * cap + 6 * math.sqrt(cap) + 16) / max(r.n, 1)) * 2**62)))

    def below(cuts: list[tuple[str, int]]) -> DataFrame:
        # A row a language, at most `most` of them.
        return hashed.join(F.broadcast(spark.createDataFrame(cuts, "lang string, cut long")), "lang").where("h <= cut").drop("cut")

    found: dict[str, list[int]] = {}
    for lang, h in below(ends).select("lang", "h").distinct().collect():
        found.setdefault(lang, []).append(h)
    cuts = [(lang, sorted(hs)[: caps[lang]][-1]) for lang, hs in found.items()]
    return below(cuts).dropDuplicates(["lang", "h"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", training_texts: int = TRAINING_TEXTS) -> Model | None:
    """Learn from a bounded, hash-chosen sample of each language's labelled texts outside the held-out fold; None without any."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo in range(0, len(texts), 100):
                found = [r.tobytes() for r in gram_counts(texts[lo : lo + 100])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(found)), batch.column(1).slice(lo, len(found)), pa.array(found, pa.binary())], names=["h", "lang", "x"])

    # 8 KB a text and at most training_texts of them come to the driver.
    sample = language_sample(rows, training_texts).select("h", "lang", "text").repartition(24)
    found = sample.mapInArrow(measure, "h long, lang string, x binary").toArrow().sort_by([("h", "ascending"), ("lang", "ascending")])
    if not found.num_rows:
        return None
    labels = found["lang"].to_pylist()
    counts = np.frombuffer(b"".join(found["x"].to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)
    del found
    x = counts.astype(np.float32)
    total = x.sum(axis=1, keepdims=True)
    x *= 100 / np.maximum(total, 1)
    kept = total[:, 0] > 0
    if not kept.all():
        x, labels = x[kept], [v for v, k in zip(labels, kept, strict=True) if k]
    return fit(x, labels) if labels else None


class Scorer:
    """Margins of texts under a model, remembering the sums of words."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.sums = np.zeros((1 << 12, model.weights.shape[1] + 1), dtype=np.float32)

    def add(self, new: list[str]) -> None:
        n = len(self.known)
        while n + len(new) > len(self.sums):
            self.sums = np.resize(self.sums, (2 * len(self.sums), self.sums.shape[1]))
        buckets, sizes = grams(new)
        ends = np.cumsum(sizes)
        rows = self.sums[n : n + len(new)]
        rows[:, -1] = 3 * sizes + 1
        rows[:, :-1] = 0
        for at, starts in zip(buckets, (ends - sizes, ends - sizes + np.arange(len(new)), ends - sizes), strict=True):
            rows[:, :-1] += np.add.reduceat(self.model.weights[at], starts, axis=0)
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def margins(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(n, bits) margins and whether a text has a letter; texts are taken from Arrow one by one."""
        total = np.zeros((len(texts), self.sums.shape[1]))
        for i, text in enumerate(texts):
            found = words(text.as_py() or "")
            if new := [w for w in dict.fromkeys(found) if w not in self.known]:
                self.add(new)
            if found:
                at = np.fromiter(map(self.known.__getitem__, found), dtype=np.int64, count=len(found))
                total[i] = self.sums[at].sum(axis=0, dtype=np.float64)
            if len(self.known) > REMEMBERED:
                self.known = {}
        count = total[:, -1]
        return 100 * total[:, :-1] / np.maximum(count, 1)[:, None] + self.model.bias, count > 0


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", prefix: str = "") -> DataFrame:
    """docs with lang_pred (string), score (double, 0 to 1) and ambiguous (boolean) added, their names after `prefix`.

    lang_pred is a learned language, or "und" with score 0 for null texts and texts without a letter, and everywhere
    if nothing was learned. Of languages that are equally near the first in order of names is given. Whole texts are
    read; the row count and all other columns stay as they are, but for columns that have the names of the new ones,
    which give way.
    """
    added = [f"{prefix}lang_pred", f"{prefix}score", f"{prefix}ambiguous"]
    docs = docs.drop(*added)
    if model is None:
        return docs.withColumns(dict(zip(added, (F.lit(UNKNOWN), F.lit(0.0), F.lit(False)), strict=True)))
    shared_model = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared_model.value)
        for batch in batches:
            margins, lettered = scorer.margins(batch.column(at))
            best, share = scorer.model.decode(margins)
            names = [scorer.model.languages[i] if k else UNKNOWN for i, k in zip(best, lettered, strict=True)]
            share = np.where(lettered, share, 0.0)
            columns = [pa.array(names, pa.string()), pa.array(share), pa.array((share < CLEAR) & lettered)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added])

    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(added, kinds, strict=True))])
    return docs.mapInArrow(releasing(predict), schema)
