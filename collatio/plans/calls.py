"""External calls that outlive a run: UDF-04, UDF-05 and UDF-07 over a table of batches and their attempts.

Distinct texts are cut into batches once and the batches are written, so a later run has the same ones. A task adds the
outcome of a few batches at a time to a file of its own, a line each, and of a line that a dying task leaves torn nothing is
read; what is there before a job, an executor or a task dies is never asked for again. So there are as many files as tasks,
not as batches, and reading them takes no longer than their rows do. A batch that fails comes back in a later round, after a wait that
doubles; one that keeps failing is cut into single texts, so that a text that can't be answered takes no other with it.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.sources.edge import Translator
from collatio.sources.versions import folder_of

#: Texts that a translator gets at once (UDF-04).
BATCH = 12
PLANNED = "batch string, texts array<string>"
ATTEMPT = "batch string, attempt int, at double, error string, texts array<string>, answers array<string>"


def _name(texts: list[str]) -> str:
    """A batch's name follows from its texts; lengths keep ["a", "b"] and ["ab"] apart."""
    return hashlib.sha256("".join(f"{len(t)}:{t}" for t in texts).encode()).hexdigest()


def _single(text: Column) -> Column:
    """The name of the batch of one text, as _name gives it."""
    return F.sha2(F.concat(F.length(text).cast("string"), F.lit(":"), text), 256)


def _made(folder: str, names: str) -> set[str]:
    """The batches whose outcomes are in the files of a folder whose names begin so; torn lines are passed over."""
    made = set()
    for name in os.listdir(folder):
        if name.startswith(names):
            with open(f"{folder}/{name}") as f:
                for line in f:
                    with suppress(ValueError):
                        made.add(json.loads(line)["batch"])
    return made


def _asked(translator: Translator, texts: list[str]) -> tuple[list[str] | None, str | None]:
    """(answers, error) of one call; another number of answers than texts is an error too."""
    try:
        answers = list(translator.translate(texts))
    except Exception as error:
        return None, f"{type(error).__name__}: {error}"
    return (answers, None) if len(answers) == len(texts) else (None, f"{len(answers)} answers for {len(texts)} texts")


class Calls:
    """Work of one translator in `path`, a folder that driver and executors share as files.

    whole: failed attempts after which a batch is cut into single texts; tries: attempts that a single text gets;
    wait: seconds before the second attempt, twice as many before each further one; segment: batches whose outcomes are
    written together, the most that a dying task loses; lanes: calls at a time, the session's cores if not given.
    Two runs at once lose nothing but may ask for the same batch twice; its first written answer counts.
    """

    def __init__(self, spark: SparkSession, path: str, size: int = BATCH, whole: int = 2, tries: int = 3, wait: float = 1.0, segment: int = 16, lanes: int | None = None):
        if min(size, whole, tries, segment) < 1:
            raise ValueError("size, whole, tries and segment must be positive")
        self.spark, self.folder = spark, folder_of(path)
        self.size, self.whole, self.tries, self.wait, self.segment = size, whole, tries, wait, segment
        self.lanes = lanes or spark.sparkContext.defaultParallelism
        for part in ("batches", "attempts"):
            os.makedirs(f"{self.folder}/{part}", exist_ok=True)

    def batches(self) -> DataFrame:
        return self.spark.read.schema(PLANNED).parquet(f"file://{self.folder}/batches")

    def attempts(self) -> DataFrame:
        """A row for each attempt of a batch: error or answers. Lines that are torn are no attempts: their batches are asked for again."""
        return self.spark.read.schema(ATTEMPT).option("mode", "DROPMALFORMED").json(f"file://{self.folder}/attempts")

    def plan(self, texts: DataFrame, column: str = "original") -> None:
        """Cut the texts that no batch has yet into batches; null and blank ones are left out. Again with the same texts it adds nothing."""
        size = self.size
        known = self.batches().select(F.explode("texts").alias("text"))
        new = texts.select(F.col(column).alias("text")).where("trim(text) <> ''").distinct().join(known, "text", "left_anti")

        def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            left: list[str] = []
            for part in parts:
                left += part["text"].tolist()
                full = len(left) - len(left) % size
                groups, left = [left[i : i + size] for i in range(0, full, size)], left[full:]
                if groups:
                    yield pd.DataFrame({"batch": [_name(g) for g in groups], "texts": groups})
            if left:
                yield pd.DataFrame({"batch": [_name(left)], "texts": [left]})

        new.mapInPandas(cut, PLANNED).write.mode("append").parquet(f"file://{self.folder}/batches")

    def state(self) -> DataFrame:
        """A row a batch: texts, attempts, done, error (of the latest attempt), due (seconds, null before the first attempt), limit.

        Batches that were cut are not listed, their texts are.
        """
        # A batch has at most as many attempts as whole or tries allow, so merging them is a small aggregate on a short key.
        made = self.attempts().groupBy("batch").agg(
            F.max("attempt").alias("attempts"),
            F.max(F.col("answers").isNotNull()).alias("done"),
            F.max_by("error", "at").alias("error"),
            F.max("at").alias("last"),
        )
        tried = self._with(self.batches(), made, F.lit(self.whole))
        cut = ~F.col("done") & (F.col("attempts") >= self.whole) & (F.size("texts") > 1)
        singles = tried.where(cut).select(F.explode("texts").alias("text")).select(_single(F.col("text")).alias("batch"), F.array("text").alias("texts"))
        return tried.where(~cut).withColumn("limit", F.when(F.size("texts") > 1, F.col("limit")).otherwise(self.tries)).unionByName(self._with(singles, made, F.lit(self.tries)))

    def _with(self, planned: DataFrame, made: DataFrame, limit: Column) -> DataFrame:
        n = F.coalesce("attempts", F.lit(0))
        due = F.col("last") + self.wait * F.pow(F.lit(2.0), n - 1)
        return planned.join(made, "batch", "left").select("batch", "texts", n.alias("attempts"), F.coalesce("done", F.lit(False)).alias("done"), "error", due.alias("due"), limit.cast("int").alias("limit"))

    def round(self, translator: Translator, now: float | None = None) -> int:
        """Ask once for every batch that is open and due; returns the number of batches asked for."""
        now = time.time() if now is None else now
        folder, segment, this = f"{self.folder}/attempts", self.segment, uuid.uuid4().hex
        open_ = self.state().where(~F.col("done") & (F.col("attempts") < F.col("limit")) & (F.col("due").isNull() | (F.col("due") <= now)))
        # The same rows when a task is run again, so that it finds what it had finished among the files of this round and its partition.
        # By "batch" alone Spark would keep the join's partitions, which may be fewer than the lanes.
        laid = open_.select("batch", F.col("attempts").alias("attempt"), "texts").repartition(self.lanes, F.xxhash64("batch")).sortWithinPartitions("batch")

        def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names = f"{this}-{TaskContext.get().partitionId()}-"
            made, out = _made(folder, names), None
            try:
                for part in parts:
                    rows = [row for row in zip(part["batch"], part["attempt"], part["texts"], strict=True) if row[0] not in made]
                    for i in range(0, len(rows), segment):
                        lines = []
                        for batch, attempt, texts in rows[i : i + segment]:
                            asked = list(texts)
                            answers, error = _asked(translator, asked)
                            lines.append(json.dumps({"batch": batch, "attempt": int(attempt) + 1, "at": time.time(), "error": error, "texts": asked, "answers": answers}) + "\n")
                        out = out or open(f"{folder}/{names}{uuid.uuid4().hex}.json", "x")
                        out.writelines(lines)
                        out.flush()
                        os.fsync(out.fileno())
                    yield pd.DataFrame({"n": [len(part)]})
            finally:
                if out:
                    out.close()

        return laid.mapInPandas(ask, "n int").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]

    def run(self, translator: Translator, sleep: Callable[[float], None] = time.sleep) -> None:
        """Rounds until every batch is answered or has had its attempts; at most whole + tries of them have work."""
        while True:
            self.round(translator)
            left = self.state().where(~F.col("done") & (F.col("attempts") < F.col("limit"))).agg(F.count("*").alias("n"), F.min(F.coalesce("due", F.lit(0.0))).alias("due")).first()
            if not left["n"]:
                return
            sleep(max(0.0, left["due"] - time.time()))

    def answers(self) -> DataFrame:
        """(original, written): a row for each text that has an answer."""
        pairs = self.attempts().where("answers is not null").select("at", F.explode(F.arrays_zip("texts", "answers")).alias("x"))
        return pairs.groupBy(F.col("x.texts").alias("original")).agg(F.min_by("x.answers", "at").alias("written"))

    def failed(self) -> DataFrame:
        """(original, attempts, error): the texts that have had all their attempts without an answer."""
        return self.state().where(~F.col("done") & (F.col("attempts") >= F.col("limit"))).select(F.explode("texts").alias("original"), "attempts", "error")
