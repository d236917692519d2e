"""Removal of repeated runs of lines, by prefix doubling over line sequences.

A document is a sequence of line ids (blank lines left out). Prefix doubling ranks the suffixes that start at repeated
lines by their first 1, 2, 4, ... lines: rank 2k of a suffix is the order of (rank k here, rank k at k lines on). Two
suffixes with one rank are in one LCP interval of that depth; suffixes alone in theirs drop out of later rounds.

A run counts if it has at least `min_words` words. Any such run, however long, is covered by the shortest ones that
start or end at its lines, so the maximal repeated runs are the unions of those, and no more than log2(min_words)
rounds are needed, whatever the length of the longest repeat. A run of l lines is named by two overlapping ranks of
depth 2**floor(log2(l)): equal names mean a common prefix of l lines. Of each name the first occurrence stays,
by document id and then place; the lines of all others are deleted.

A round moves a suffix twice: to its document, where ranks at two places meet, and to its class, which counts and ranks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collatio.llm.shared import durable, releasing, unused

#: Words that a repeated run has at least.
MIN_WORDS = 50
#: Deletions up to which they are broadcast to the texts; more of them meet the texts in a shuffle.
BROADCAST_BYTES = 16_000_000
DOCUMENT = ["id_key", "text_hash"]
PLACE = [*DOCUMENT, "i"]
#: Numbers of lines in a document are below this, so that document * WIDE + line orders all lines of a batch.
WIDE = 2**33


def _batch(names: str, columns: list[np.ndarray]) -> pa.RecordBatch:
    """Columns under the names and types of a schema string."""
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [x.split() for x in names.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


LINES = "id_key long, text_hash long, i int, line int, h1 long, h2 long, least int, most int"


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """A row a non-blank line: its number among them (i) and among all (line), two hashes of it, and the lengths in lines
    of the runs from here that are looked for, least to most (0 if fewer than min_words words follow): the shortest run of
    min_words words that starts here, and those from here that are the shortest that end where they end."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in range(8)]
            for id_key, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                lines = text.split(b"\n")
                counts = np.array([len(x.split()) for x in lines])
                at = np.flatnonzero(counts)
                if not len(at):
                    continue
                ends = np.cumsum(counts[at])
                n, i = len(at), np.arange(len(at))
                # The line in which the min_words-th word from the start of line i lies.
                last = np.searchsorted(ends, ends - counts[at] + min_words)
                least = np.where(last < n, last - i + 1, 0)
                # A run from i is the shortest that ends at its end if the next line's shortest run ends later or nowhere.
                after = np.append(least[1:], 0)
                most = np.where(least > 0, np.maximum(least, np.where(after > 0, after, n - i)), 0)
                seen = [lines[k] for k in at]
                values = (
                    np.full(n, id_key), np.full(n, text_hash), i, at,
                    np.array([xxhash.xxh64_intdigest(x) for x in seen], dtype=np.uint64).view(np.int64),
                    np.array([xxhash.xxh64_intdigest(x, 1) for x in seen], dtype=np.uint64).view(np.int64),
                    least, most,
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            if columns[0]:
                yield _batch(LINES, [np.concatenate(c) for c in columns])

    return docs.mapInArrow(releasing(cut), LINES)


def _by_document(rows: DataFrame, order: list[Column], run: Callable[[np.ndarray, dict[str, np.ndarray]], pa.RecordBatch], schema: str) -> DataFrame:
    """run over batches that hold whole documents, in order within each; it gets each row's document number and the columns.

    A document's rows were one text, so they fit in a task; rows that repeat id and text must be one document's by now.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            if waiting:
                table = pa.Table.from_batches(waiting)
                columns = {name: table[name].to_numpy() for name in table.column_names}
                a, b = columns["id_key"], columns["text_hash"]
                yield run(np.cumsum(np.append(False, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))), columns)
                waiting.clear()

        for batch in batches:
            if not len(batch):
                continue
            a, b = batch.column("id_key").to_numpy(), batch.column("text_hash").to_numpy()
            # The last document of a batch may go on in the next one.
            start = int(np.flatnonzero((a != a[-1]) | (b != b[-1])).max(initial=-1)) + 1
            if start:
                waiting.append(batch.slice(0, start))
                yield from done()
            elif waiting and (waiting[-1].column("id_key")[-1].as_py(), waiting[-1].column("text_hash")[-1].as_py()) != (int(a[0]), int(b[0])):
                yield from done()
            waiting.append(batch.slice(start))
        yield from done()

    return rows.repartition(*DOCUMENT).sortWithinPartitions(*DOCUMENT, *order).mapInArrow(releasing(whole), schema)


NAMED = "id_key long, text_hash long, i int, lines int, r1 long, r2 long, least int, most int"


def _named(ranks: DataFrame, k: int, last: bool) -> DataFrame:
    """ranks of depth k (PLACE, rank, least, most) -> NAMED: runs of k to 2k - 1 lines by the ranks at their start and at k lines
    before their end, and, unless this is the last depth, the suffixes of the next one as runs of 2k lines."""

    def name(document: np.ndarray, rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        key = document * WIDE + rows["i"]
        least, most = np.maximum(rows["least"], k), np.minimum(rows["most"], 2 * k - 1)
        most = np.where(rows["least"] > 0, most, 0)
        count = np.maximum(most - least + 1, 0).astype(np.int64)
        start = np.repeat(np.arange(len(key)), count)
        lines = least[start] + np.arange(len(start)) - np.repeat(np.cumsum(count) - count, count)
        if not last:
            start, lines = np.concatenate([start, np.arange(len(key))]), np.concatenate([lines, np.full(len(key), 2 * k)])
        wanted = key[start] + lines - k
        end = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        found = key[end] == wanted
        start, lines, end = start[found], lines[found], end[found]
        rank = rows["rank"]
        return _batch(NAMED, [*(rows[c][start] for c in PLACE), lines, rank[start], rank[end], rows["least"][start], rows["most"][start]])

    return _by_document(ranks, [F.col("i")], name, NAMED)


def _ranked(classes: DataFrame, keys: list[str]) -> DataFrame | None:
    """classes (keys, others, n) with n > 1, n replaced by rank: how many suffixes of these classes come before in the order of keys.

    None if no class has more than one suffix.
    """
    ordered = durable(classes.where("n > 1").repartitionByRange(*keys).sortWithinPartitions(*keys))
    # A number for each partition, however many rows there are.
    totals = {r[0]: r[1] for r in ordered.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("n")).collect()}
    if not totals:
        return None
    before = dict(zip(sorted(totals), accumulate([0, *(totals[p] for p in sorted(totals))]), strict=False))
    names = [c for c in ordered.columns if c != "n"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = before.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            n = batch.column("n").to_numpy()
            ranks = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(ranks)], names=[*names, "rank"])

    kinds = dict(ordered.dtypes)
    return ordered.mapInArrow(number, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", rank long")


def repeated_runs(docs: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """docs (id_key, text_hash, text) -> the repeated lines (PLACE, line), and the runs (PLACE, lines) that are not first."""
    lines = durable(_lines(docs, min_words))
    keys = ["h1", "h2"]
    none = lines.select(*PLACE, F.lit(0).alias("lines")).where(F.lit(False))
    ranked = _ranked(lines.groupBy(*keys).agg(F.count("*").alias("n")), keys)
    if ranked is None:
        return lines.select(*PLACE, "line").where(F.lit(False)), none
    # Rows that repeat id and text are one document here.
    active = durable(lines.join(ranked, keys).drop(*keys).distinct())
    longest = active.agg(F.max("most")).first()[0]
    ranks, later, k = active.drop("line"), none, 1
    keys = ["lines", "r1", "r2"]
    while k <= longest:
        named = durable(_named(ranks, k, 2 * k > longest))
        # The suffixes of the next depth need a count only, runs also their first place.
        place = F.min(F.when(F.col("lines") < 2 * k, F.struct(*PLACE))).alias("first")
        classes = named.groupBy(*keys).agg(place, F.count("*").alias("n"))
        classes = classes.select(*keys, *(F.col(f"first.{c}").alias(f"first_{c}") for c in PLACE), "n")
        # Written on its own, so that both sides of the join come from exchanges, which Spark can split where a class is common.
        ranked = _ranked(classes, keys)
        if ranked is None:
            break
        placed = durable(named.join(ranked, keys).drop("r1", "r2"))
        other = F.lit(False)
        for c in PLACE:
            other = other | (F.col(c) != F.col(f"first_{c}"))
        later = later.unionByName(placed.where((F.col("lines") < 2 * k) & other).select(*PLACE, "lines"))
        ranks = placed.where(F.col("lines") == 2 * k).select(*PLACE, "rank", "least", "most")
        k *= 2
    return active.select(*PLACE, "line"), later


COVERED = "id_key long, text_hash long, line int"


def _covered(active: DataFrame, later: DataFrame) -> DataFrame:
    """COVERED: the repeated lines that lie in a run which is not first, each once, however many such runs it lies in."""

    def cover(document: np.ndarray, rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        key = document * WIDE + rows["i"]
        gone = (rows["line"] >= 0) & (np.maximum.accumulate(key + rows["lines"]) > key)
        return _batch(COVERED, [rows[c][gone] for c in (*DOCUMENT, "line")])

    both = active.withColumn("lines", F.lit(0)).unionByName(later.withColumn("line", F.lit(-1)))
    return _by_document(both, [F.col("i"), F.col("lines").desc()], cover, COVERED)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """docs with text_col cleaned, and n_lines and n_removed added.

    A run of lines with at least min_words words that occurred before, in a document of smaller id or earlier in the
    same one (it may overlap its copy, so of one line said a thousand times the first stays), is deleted; blank lines
    neither break runs nor go with them. Lines are equal when their bytes are. Null ids come before all others; null
    texts stay null and have no line; rows that repeat id and text fare alike. All other columns and all rows stay, but
    for columns that are called n_lines or n_removed, which give way to the new ones.
    """
    docs = docs.drop("n_lines", "n_removed")
    text = F.coalesce(F.col(text_col), F.lit(""))
    id_key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**62)))
    source = docs.select(id_key.alias("id_key"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    active, later = repeated_runs(source, min_words)
    k0, k1, gone = unused(docs, "id_key", "text_hash", "gone")
    found = _covered(active, later).groupBy(*DOCUMENT).agg(F.collect_list("line").alias(gone))
    found = durable(found.withColumnsRenamed({"id_key": k0, "text_hash": k1}))
    size = found.agg(F.count("*"), F.sum(F.size(gone))).first()
    # Some 40 bytes a document and 4 a line: where that is little, no text has to move.
    small = 40 * size[0] + 4 * (size[1] or 0) <= BROADCAST_BYTES
    joined = docs.withColumns({k0: id_key, k1: F.xxhash64(text)}).join(F.broadcast(found) if small else found, [k0, k1], "left")
    parts = F.split(F.col(text_col), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))
    cleaned = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))
    breaks = F.octet_length(text_col) - F.octet_length(F.replace(F.col(text_col), F.lit("\n"), F.lit("")))
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(breaks + 1).cast("long")
    counted = joined.withColumns({"n_lines": n_lines, "n_removed": F.coalesce(F.size(gone), F.lit(0)).cast("long"), text_col: cleaned})
    return counted.select(*docs.columns, "n_lines", "n_removed")
