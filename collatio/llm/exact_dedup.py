"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition becomes one run: its digests in order, each digest once, with the row that stays and a count.
Runs then meet in rounds. In round t the runs whose numbers agree but for their lowest t * BITS bits exchange their
digests, are merged in order and keep one entry a digest, so a run number loses BITS bits a round and log(runs) rounds
end in one entry a digest. A text that a third of all rows share costs one entry a run at the leaves and at most
2**BITS entries a merge above, wherever its rows lie. No round moves texts.

"Verified": an entry is (SHA-256, length in bytes, xxhash64), and entries merge only if all three agree, at every
level; two texts with one SHA-256 but another length or second hash would stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collatio.llm.shared import durable

#: Up to 2**BITS runs meet in one merge.
BITS = 4
ENTRY = ["digest", "n_bytes", "check"]
RUN_SCHEMA = "run long, digest binary, n_bytes long, check long, keep_id long, keep_row long, n_rows long"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold neighbours with equal run and entry; the first of them is the one that stays. Holds one batch and one row."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        table = table.combine_chunks()
        n = table.num_rows
        if not n:
            continue
        new = np.ones(n, dtype=bool)
        if n > 1:
            same = np.ones(n - 1, dtype=bool)
            for name in ("run", *ENTRY):
                column = table[name].chunk(0)
                same &= pc.equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[1:] = ~same
        starts = np.flatnonzero(new)
        counts = np.add.reduceat(table["n_rows"].to_numpy(), starts)
        folded = table.take(pa.array(starts))
        # The field stays as it came, or the held row would not fit the next batch: Spark's count of one is not nullable.
        at = folded.schema.get_field_index("n_rows")
        folded = folded.set_column(at, folded.schema.field(at), pa.array(counts))
        held = folded.slice(folded.num_rows - 1)
        yield from folded.slice(0, folded.num_rows - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def _merged(runs: DataFrame) -> DataFrame:
    ordered = runs.sortWithinPartitions("run", *ENTRY, F.col("keep_id").desc_nulls_last(), "keep_row")
    return ordered.mapInArrow(_merge, RUN_SCHEMA)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Column | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their (optionally normalised) UTF-8 is; null counts as the empty text. Of equal texts the row
    with the largest id stays; a null id is below every other, and of rows that repeat the id as well just one is kept.
    Other columns of docs are ignored, whatever their names. An empty table gives an empty result.
    """
    text = F.coalesce(normalise if normalise is not None else F.col(text_col), F.lit(""))
    rows = durable(
        docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t")).select(
            "id",
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2("t", 256)).alias("digest"),
            F.octet_length("t").cast("long").alias("n_bytes"),
            F.xxhash64("t").alias("check"),
        )
    ).withColumn("run", F.shiftright("row", 33))
    leaves = _merged(rows.select("run", *ENTRY, F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("n_rows")))
    n_runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    tree = leaves
    while n_runs > 1:
        tree = _merged(tree.withColumn("run", F.shiftright("run", BITS)).repartition("run", *ENTRY))
        n_runs = -(-n_runs // 2**BITS)
    # The answers go back down by (entry, run), so that the rows of a common text meet theirs in as many places as they have runs.
    groups = tree.where("n_rows > 1").select(*ENTRY, "keep_id", "keep_row", "n_rows")
    answers = leaves.select("run", *ENTRY).join(groups, ENTRY)
    found = rows.join(answers, ["run", *ENTRY], "left")
    alone = F.col("keep_row").isNull()
    return found.select(
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n_rows", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
