"""The filter audit against applying every order to every document."""

import random
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from collatio.llm import filter_audit, queries

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def by_hand(docs, labels):
    """part -> order -> step -> counts, each order applied to the documents one after the other."""
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    label = {}
    for i, q, t in labels:
        if i is not None:
            good, toxic = label.get(i, (False, False))
            label[i] = (good or q == 1, toxic or t == 1)
    marked = []
    for i, text, lang in docs:
        text = text or ""
        words = text.encode().split()
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
            fails.add("C")
        if set(text) & set("#$%&*|"):
            fails.add("D")
        if i is not None and first[text] < i:
            fails.add("E")
        marked.append((lang or "", fails, *label.get(i, (False, False))))
    out, shapley = {}, Counter()
    for part in {m[0] for m in marked}:
        for order in map("".join, permutations("ABCDE")):
            left = [m for m in marked if m[0] == part]
            for step, f in enumerate(order, 1):
                gone, redundant = [m for m in left if f in m[1]], sum(m[0] == part and f in m[1] and bool(m[1] & set(order[: step - 1])) for m in marked)
                left = [m for m in left if f not in m[1]]
                unique = sum(m[0] == part and m[1] == {f} for m in marked)
                out[part, order, step] = [len(left), len(gone), redundant, unique, sum(m[2] for m in gone), sum(m[3] for m in gone)]
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, docs, labels, more=lambda df: df):
    found = filter_audit.audit(more(spark.createDataFrame(docs, DOCS)), spark.createDataFrame(labels, LABELS)).collect()
    assert len({r[:3] for r in found}) == len(found)
    return {tuple(r[:3]): tuple(r[3:]) for r in found}


def texts(rng):
    words = " ".join(rng.choice(["alpha", "beta", "NOW", "x1", "é", "漢字"]) + (str(rng.random()) if rng.random() < 0.85 else "") for _ in range(rng.choice([0, 5, 99, 100, 101, 140])))
    return rng.choice([None, "", words, words + " 100%", words.upper(), "\t\n\v\f\r ", words.replace(" ", " ")])


def test_every_order_by_hand(spark):
    rng = random.Random(3)
    pool = [texts(rng) for _ in range(25)]
    docs = [(rng.choice([None, *range(60)]), rng.choice(pool), rng.choice([None, "", "en", "de"])) for _ in range(120)]
    labels = [(rng.choice([None, *range(80)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(70)]
    docs += docs[:10]
    expected = by_hand(docs, labels)
    assert audited(spark, docs, labels) == expected and len(expected) % 600 == 0
    # Other columns, with names of the result and of what is computed inside, change nothing.
    assert audited(spark, docs, labels, lambda df: df.selectExpr("*", "'x' AS part", "1 AS mask", "2 AS n", "3 AS id", "4 AS kept", "5 AS step", "6 AS good")) == expected


def test_empty_tables(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    only = audited(spark, [(1, "a b", "en")], [])
    assert len(only) == 600 and only["en", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120) and only["en", "BCDEA", 1] == (1, 0, 0, 0, 0, 0, 0)


def test_long_text_and_many_copies(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    docs = [(i, long if i < 3 else "same", "en") for i in range(3000)]
    assert audited(spark, docs, []) == by_hand(docs, [])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 10**12), min_size=32, max_size=32), min_size=3, max_size=3))
def test_product_conserves_documents(rows):
    found = filter_audit.outcomes(np.array(rows, dtype=np.int64))
    total = sum(rows[0])
    for k, order in enumerate(filter_audit.ORDERS):
        kept, removed = found["kept"][0][5 * k : 5 * k + 5], found["removed"][0][5 * k : 5 * k + 5]
        assert list(total - np.cumsum(removed)) == list(kept) and kept[-1] == rows[0][0]
    # All orders together give each filter its Shapley value: they share what is lost in all.
    assert sum({f: s for o, f, s in zip(np.repeat(range(120), 5), "".join(filter_audit.ORDERS), found["shapley"][0], strict=True)}.values()) == 120 * (total - rows[0][0])


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    answer = con.execute(queries.OP11_SQL)
    names = [c[0] for c in answer.description]
    found = queries.op11_filter_audit(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, found.select(names).collect())) == sorted(answer.fetchall())
    assert dict(found.dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | {c: "bigint" for c in filter_audit.COUNTS}


def test_a_label_column_must_be_there(spark):
    with pytest.raises(Exception, match="toxic"):
        filter_audit.audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int")).collect()
