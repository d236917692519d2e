"""Fill-in-the-middle against units listed one by one."""

import hashlib
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from collatio.llm import fill_middle, queries

PATTERNS = {"code_points": r"(?s).", "words": r"[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", "lines": r"[^\n]*\n|[^\n]+"}
TEXT = st.text(alphabet=st.sampled_from(list("ab \n\t\r<>PSMé漢  ")), max_size=60)


@settings(max_examples=500, deadline=None)
@given(TEXT, st.sampled_from(sorted(PATTERNS)))
def test_ranks_are_those_of_listed_units(text, kind):
    units, found = re.findall(PATTERNS[kind], text), fill_middle.scan(text, kind)
    assert found.n == len(units) and found.sentinel == any(s in text for s in ("<P>", "<S>", "<M>"))
    at = 0
    for rank, unit in enumerate([*units, ""]):
        assert found.offset(rank, len(text)) == at
        at += len(unit)


def by_hand(doc_id, text, kind, seed=1, percent=90, spm=20):
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    text = text or ""
    units = re.findall(PATTERNS[kind], text)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= percent:
        return len(units), len(text), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < spm else "psm"
    return len(units), len(text), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("kind", sorted(PATTERNS))
def test_rows_by_hand_and_back(spark, kind):
    texts = [None, "", "a", "<P>", "x <S> y", "tail <", "<", "ab<P", "<<P", " \n\t", "é漢 \U0001f600 z\n" * 40, "word " * 50_000]
    rows = [(i, texts[i % len(texts)]) for i in range(240)] + [(None, "without an id"), (None, None), (5, "again"), (5, "again"), (2**62, "big id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS output", "1 AS form", "2 AS n")
    made = fill_middle.transform(docs, kind)
    found = made.withColumn("back", fill_middle.restored(made.output, made.form)).collect()
    assert sorted(map(repr, (tuple(r)[:7] for r in found))) == sorted(repr((i, *by_hand(i, t, kind))) for i, t in rows)
    assert sorted((str(r.doc_id), r.back) for r in found) == sorted((str(i), t or "") for i, t in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_rates_seed_and_empty_table(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "'some words here' AS text")
    assert {r.form for r in fill_middle.transform(docs, percent=0).collect()} == {"plain"}
    assert {r.form for r in fill_middle.transform(docs, percent=100, spm_percent=100).collect()} == {"spm"}
    assert fill_middle.transform(docs).collect() != fill_middle.transform(docs, seed=2).collect()
    share = sum(r.form != "plain" for r in fill_middle.transform(docs).collect()) / 2000
    assert 0.87 < share < 0.93
    assert fill_middle.transform(docs.limit(0)).collect() == []
    with pytest.raises(ValueError, match="units are one of"):
        fill_middle.transform(docs, "sentences")


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    answer = con.execute(queries.OP12_SQL)
    names = [c[0] for c in answer.description]
    found = queries.op12_fill_middle(spark, "/root/testdata/sf0.01")
    assert sorted(map(repr, map(tuple, found.select(names).collect()))) == sorted(map(repr, answer.fetchall()))
