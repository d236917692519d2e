"""Exact duplicates against a dictionary."""

import hashlib
import random

from collatio.llm import exact_dedup

DOCS = "doc_id long, text string"


def brute(rows):
    best, size = {}, {}
    for doc, text in rows:
        text = text or ""
        size[text] = size.get(text, 0) + 1
        best[text] = max(best.get(text, doc), doc)
    return {doc: (best[text or ""], size[text or ""], doc == best[text or ""], hashlib.sha256((text or "").encode()).hexdigest()) for doc, text in rows}


def test_equals_dictionary_over_many_runs(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "", "a", "A", f"x{rng.randrange(50)}", f"own {i}"])) for i in range(3000)]
    rng.shuffle(rows)
    # 40 input partitions, so that the tree has more than one level; a third of all rows hold one text.
    rows += [(10_000 + i, "common") for i in range(1500)]
    got = exact_dedup.exact_duplicates(spark.createDataFrame(rows, DOCS).repartition(40)).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == brute(rows) and len(got) == len(rows)


def test_partition_of_several_arrow_batches(spark):
    # 25,000 rows in one partition are three batches; a text that 12,000 rows hold lies in two of them at least.
    rows = [(i, "common" if i % 25 < 12 else None if i % 25 == 12 else f"x{i % 5000}" if i % 25 < 18 else f"own {i}") for i in range(25_000)]
    random.Random(4).shuffle(rows)
    want = brute(rows)
    for parts in (1, 2):
        got = exact_dedup.exact_duplicates(spark.createDataFrame(rows, DOCS).repartition(parts)).collect()
        assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == want and len(got) == len(rows)


def test_odd_rows(spark):
    rows = [(1, "t", "x"), (1, "t", "y"), (None, "t", "z"), (None, "n", "w"), (2, "long " * 50_000, "v")]
    got = exact_dedup.exact_duplicates(spark.createDataFrame(rows, DOCS + ", digest string")).collect()
    assert sorted(r.kept for r in got if r.keep_id == 1) == [False, False, True]
    assert [(r.keep_id, r.group_size, r.kept) for r in got if r.doc_id is None and r.group_size == 1] == [(None, 1, True)]
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_merge_of_batches_keeps_counts():
    import pyarrow as pa

    names = [x.split()[0] for x in exact_dedup.RUN_SCHEMA.split(", ")]
    digests = [b"a", b"a", b"b", b"b", b"b", b"c"]
    rows = [(0, d, 1, 1, 9 - i, i, 1) for i, d in enumerate(digests)]
    kinds = [pa.int64(), pa.binary(), *[pa.int64()] * 5]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 2], strict=True), kinds, strict=True)], names=names) for i in range(0, 6, 2)]
    merged = pa.Table.from_batches(list(exact_dedup._merge(iter(batches)))).to_pylist()
    assert [(r["digest"], r["keep_id"], r["n_rows"]) for r in merged] == [(b"a", 9, 2), (b"b", 7, 3), (b"c", 4, 1)]
