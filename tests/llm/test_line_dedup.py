"""Repeated line runs against a direct search."""

import random

from collatio.llm import line_dedup

DOCS = "doc_id long, text string"


def brute(rows, min_words):
    """Delete every line that lies in a run of at least min_words words that occurs earlier."""
    docs = sorted(rows)
    lines = [[(k, x) for k, x in enumerate(t.split("\n")) if x.split()] for _, t in docs]
    seen, gone = {}, [set() for _ in docs]
    for d, found in enumerate(lines):
        for i in range(len(found)):
            for j in range(i + 1, len(found) + 1):
                run = tuple(x for _, x in found[i:j])
                if sum(len(x.split()) for x in run) < min_words:
                    continue
                if run in seen:
                    gone[d].update(k for k, _ in found[i:j])
                else:
                    seen[run] = (d, i)
                if sum(len(x.split()) for x in run[1:-1]) > 3 * min_words:
                    break
    return {doc: ("\n".join(x for k, x in enumerate(t.split("\n")) if k not in g), len(g)) for (doc, t), g in zip(docs, gone, strict=True)}


def test_equals_direct_search(spark):
    for seed in (1, 2, 3):
        rng = random.Random(seed)
        pool = [" ".join(f"{rng.choice('abcdefgh')}{i}" for _ in range(rng.randint(1, 6))) for i in range(40)]
        passages = [[rng.choice(pool) for _ in range(rng.randint(2, 14))] for _ in range(8)]
        rows = []
        for d in range(60):
            parts = []
            for _ in range(rng.randint(0, 5)):
                parts += rng.choice(passages) if rng.random() < 0.5 else [f"own {d} {rng.random()}", rng.choice(pool), ""]
            rows.append((d, "\n".join(parts)))
        got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, DOCS).repartition(3), min_words=10).collect()}
        assert got == brute(rows, 10)


def test_odd_rows(spark):
    long = "\n".join(f"line {i} of a long text" for i in range(400))
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, long), (5, long), (6, "x\n" * 200), (None, "a b"), (7, "own " * 60), (7, "own " * 60)]
    data = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], DOCS + ", n_lines_before int")
    got = {(r.doc_id, r.n_lines_before): r for r in line_dedup.drop_repeated_lines(data).collect()}
    assert len(got) == len(rows)
    assert got[(1, 0)].text is None and got[(1, 0)].n_lines == 0
    assert got[(2, 1)].text == "" and got[(3, 2)].text == "\n\n"
    assert got[(4, 3)].text == long and got[(5, 4)].text == "" and got[(5, 4)].n_removed == 400
    assert got[(6, 5)].text == "x\n" and got[(None, 6)].text == "a b"
    assert all(got[(7, i)].n_removed == 0 for i in (7, 8))


def test_empty(spark):
    assert line_dedup.drop_repeated_lines(spark.createDataFrame([], DOCS)).collect() == []


def test_without_a_floor_and_with_clashing_columns(spark, monkeypatch):
    """Every later copy of a line goes if runs may be of any length; columns of any name are left alone or give way."""
    rows = [(1, "a\nb\nc"), (2, "b\nd\n\na"), (3, "d\nd\ne")]
    data = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], DOCS + ", n_lines int, gone int, id_key int, text_hash int")
    for limit in (line_dedup.BROADCAST_BYTES, -1):
        monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", limit)
        got = line_dedup.drop_repeated_lines(data, min_words=1)
        assert got.columns == ["doc_id", "text", "gone", "id_key", "text_hash", "n_lines", "n_removed"]
        assert {r.doc_id: (r.text, r.n_removed, r.gone, r.id_key, r.text_hash) for r in got.collect()} == {1: ("a\nb\nc", 0, 2, 3, 4), 2: ("d\n", 2, 2, 3, 4), 3: ("e", 2, 2, 3, 4)} == {d: (*x, 2, 3, 4) for d, x in brute(rows, 1).items()}


def test_documents_longer_than_a_batch(spark):
    """Rows of a document that come in several batches are put together, and a batch may end where a document does."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rng = random.Random(5)
    passage = [f"p{i} said" for i in range(25)]
    rows = []
    for d in range(40):
        lo, hi = sorted((rng.randint(0, 25), rng.randint(0, 25)))
        rows.append((d, "\n".join([f"own {d}", *passage[lo:hi], *(["again and again"] * rng.randint(0, 9))])))
    for size in (1, 4, 7):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, DOCS).repartition(2), min_words=6).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        assert {r.doc_id: (r.text, r.n_removed) for r in got} == brute(rows, 6)
