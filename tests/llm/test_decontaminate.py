"""Benchmark windows against a direct scan."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from collatio.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault((n, tuple(w[i : i + n])), set()).add(str(item))
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {n for n, _ in windows}:
            for i in range(len(w) - n + 1):
                if ids := windows.get((n, tuple(w[i : i + n]))):
                    hit.update(range(i, i + n))
                    found |= ids
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def judged(spark, docs, items):
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return decontaminate.contamination(a.repartition(3), b)


def as_dict(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


@pytest.mark.parametrize("broadcast_rows", [decontaminate.BROADCAST_ROWS, 0])
def test_equals_direct_scan(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(4)
    some = [f"w{i}" for i in range(30)] + ["É", "é", "ΣΑΣ", "x"]
    items = [(i, " ".join(rng.choice(some) for _ in range(rng.choice([1, 2, 3, 7, 12, 13, 14, 30])))) for i in range(40)] + [(100, None), (101, "123 ?"), (102, "")]
    docs = []
    for d in range(200):
        parts = []
        for _ in range(rng.randint(0, 6)):
            item = rng.choice(items)[1] or ""
            lo, hi = sorted((rng.randint(0, 60), rng.randint(0, 60)))
            parts.append(rng.choice([item, item.upper(), item[lo:hi], ", ".join(item.split()), " ".join(rng.choice(some) for _ in range(15))]))
        docs.append((d, ". ".join(parts)))
    docs += [(900, None), (901, "")]
    assert as_dict(judged(spark, docs, items)) == brute(docs, items)


def test_odd_tables(spark):
    docs = [(1, "a b c"), (1, "a b c"), (None, "a b c")]
    assert sorted(as_dict(judged(spark, docs, [])).values()) == [(3, 0, 0, hashlib.sha256(b"").hexdigest(), False)] * 2
    assert judged(spark, docs, [(1, "b"), (1, "b"), (2, "B")]).collect()[0].n_items == 2
    assert judged(spark, docs, [(1, "b")]).count() == 3
    assert judged(spark, [], [(1, "b")]).collect() == []


def test_spans_are_removed(spark):
    df = spark.createDataFrame([("One, two three! Four 5 six.", [(1, 3)])], "text string, hits array<struct<lo:int,hi:int>>")
    assert df.select(decontaminate.remove_spans(F.col("text"), F.col("hits"))).first()[0] == "One! Four 5 six."


def test_main_path_has_no_python(spark):
    plan = judged(spark, [(1, "a")], [(1, "a")])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("broadcast_rows", [decontaminate.BROADCAST_ROWS, 0])
def test_clean_documents_keep_all_columns(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast_rows)
    long = "own " * 50_000
    rows = [(1, "a b c", 0, 1), (2, None, 0, 2), (3, f"{long} a b c", 0, 3), (None, "a b c", 0, 4), (1, "x", 0, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits int, id_key int")
    got = decontaminate.keep_clean(docs, spark.createDataFrame([(1, "A b c")], "item_id long, text string"))
    assert got.columns == docs.columns and sorted(r.id_key for r in got.collect()) == [2, 3, 5]
    judged = decontaminate.contamination(docs, spark.createDataFrame([(1, "b")], "item_id long, text string"), keep=("hits", "id_key"))
    assert judged.columns.count("hits") == 1 and "id_key" in judged.columns


@pytest.mark.parametrize("bytes_", [decontaminate.BROADCAST_BYTES, 0])
def test_a_passage_of_many_items_is_one_row(spark, monkeypatch, bytes_):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", bytes_)
    passage = " ".join(f"s{i}" for i in range(40))
    items = [(i, f"start{i} {passage} end{i}") for i in range(50)]
    docs = [(1, f"before {passage} after"), (2, "nothing of it"), (3, f"start7 {passage} end7")]
    runs, sizes = decontaminate.item_runs(spark.createDataFrame(items, "item_id long, text string"))
    inner = runs.where("array_position(i_block, 's17') = 4").collect()
    assert sizes == [7] and len(inner) == 1 and len(inner[0]["items"]) == 50
    assert as_dict(judged(spark, docs, items)) == brute(docs, items)
