"""Relational operators on small tables with ties, nulls, duplicates and no rows, whatever their partitions."""

import pytest
from pyspark.sql import functions as F

from collatio.operators import aggregates, filters, joins, projections, ranges, windows
from collatio.sources import sinks


@pytest.fixture
def table(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema).repartition(7)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_missing_and_members(table):
    known, seen = table([("a",), ("b",), (None,)], "k string"), table([("b",), ("c",), ("c",), (None,)], "k string")
    assert [r.k for r in joins.missing(known, seen, "k").collect()] == ["c"]
    assert joins.missing(known, known.limit(0), "k").count() == 0
    assert values(joins.differences(known, seen, "k").where("k is not null")) == [("a", "extra"), ("c", "missing")]
    assert values(joins.members(seen, known, "k")) == [("b",)]
    # Every row is either a member or missing.
    assert joins.members(seen, known, "k").select("k").union(seen.join(known, "k", "left_anti")).count() == seen.count()


def test_first_and_unique_rows(table):
    df = table([("x", 2, "b"), ("x", 1, "a"), ("y", 5, "c"), (None, 1, "n")], "k string, o int, v string")
    assert values(joins.first_rows(df, ["k"], F.col("o"))) == [("x", 1, "a"), ("y", 5, "c"), (None, 1, "n")]
    assert values(joins.unique_rows(df, ["k"])) == [("y", 5, "c"), (None, 1, "n")]
    assert values(joins.collisions(df, ["k"], "v")) == [("x", 1)]


def test_cascade_takes_the_first_that_hits(table):
    rows = table([(1, "a", "z"), (2, "q", "z"), (3, "q", "q"), (4, None, ""), (5, "a", None)], "id int, k1 string, k2 string")
    lookup = table([("one", "a", "A"), ("two", "z", "Z")], "kind string, key string, target string")
    got = joins.cascade(rows, "id", [("one", F.col("k1"), F.lit(True)), ("two", F.col("k2"), F.col("id") > 0)], lookup)
    assert values(got) == [(1, 0, "A"), (2, 1, "Z"), (5, 0, "A")]


def test_reconcile_and_flags(table):
    expected, stored = table([("a", 2), ("b", 2), ("c", 0), ("d", 0)], "k string, card_count int"), table([("a",), ("a",), ("b",), ("c",)], "k string")
    assert values(joins.reconciled(expected, stored, "k")) == [("a", 2, 2, 0, "up_to_date"), ("b", 2, 1, 1, "card_count_mismatch"), ("c", 0, 1, -1, "up_to_date"), ("d", 0, 0, 0, "not_scraped")]
    assert values(joins.flagged_absent(expected, stored, "k", "k", "_unreleased").select("k")) == [("a",), ("b",), ("c",), ("d_unreleased",)]


def test_projections(table):
    df = table([("", "x", None), ("n", "", "r"), (None, None, "")], "name string, other string, rarity string")
    assert values(projections.remapped(df, "t", cardName=("name", "other"), rarity=("rarity",), none=())) == [("t", "n", "r", None), ("t", "x", None, None), ("t", None, None, None)]
    kept = projections.backup(projections.backup(df, nameJP="name").withColumn("name", F.lit("EN")), nameJP="name")
    assert values(kept.select("nameJP")) == [("",), ("EN",), ("n",)]
    base, other = table([(1, "a", 5), (2, "b", 6), (3, "c", 7)], "id int, s string, n int"), table([(1, "", 9), (2, "B", None)], "id int, s string, n int")
    assert values(projections.overlay(base, other, "id", "s", "n")) == [(1, "a", 9), (2, "B", 6), (3, "c", 7)]
    assert values(projections.overwrite(base, other, "id", "s", "n")) == [(1, "", 9), (2, "B", None), (3, "c", 7)]
    assert values(projections.sides(base.select(F.col("id").alias("uid")), "uid", F.col("uid") == 2)) == [("1", None), ("2_b", "back"), ("2_f", "front"), ("3", None)]
    assert values(base.select(projections.default_fill(F.col("n") - 5, zero_too=True))) == [("-",), ("1",), ("2",)]
    assert projections.set_record(table([("OP07", "t")], "c string, t string"), "c", "t").first() == ("op07", "t", 1007, "expansion")


def test_aggregates(table):
    df = table([("b", 3), ("a", 1), ("b", 2), ("a", 4), ("c", 5), (None, 6)], "k string, o int")
    assert [tuple(r) for r in aggregates.top_k(df, "k", "o", 2).collect()] == [("a", 2, 1), ("b", 2, 2)]
    assert values(aggregates.last_written(df, "k", "o", "o")) == [("a", 4), ("b", 3), ("c", 5), (None, 6)]
    assert values(aggregates.histogram(df, F.col("o"), [1, 3, 6])) == [("1-3", 2), ("3-6", 3)]
    assert aggregates.counters(df, a=F.col("k") == "a", b=F.col("k").isNull()).first() == (2, 1)
    assert values(aggregates.deduplicated(df, ["k"], "o")) == [("a", 1), ("b", 2), ("c", 5), (None, 6)]
    assert values(aggregates.counts_and_total(df.where("k is not null"), "k")) == [("a", 2), ("b", 2), ("c", 1), (None, 5)]
    assert values(aggregates.unique_values(table([([1, 2],), ([2],), (None,)], "v array<int>"), "v")) == [(1,), (2,)]


def test_windows(table, monkeypatch):
    df = table([(i, "x" if i % 2 else "y") for i in range(1000)], "o long, k string")
    assert values(windows.row_numbers(df, "o").where("ordinal <> o")) == []
    assert values(windows.batches(df, "o", 12).where("batch <> floor(o / 12)")) == []
    assert values(windows.row_numbers(df.limit(0), "o")) == []
    assert windows.row_numbers(df, "o").columns == ["o", "k", "ordinal"]
    # Ranges of few rows each, over places that crowd together.
    monkeypatch.setattr(ranges, "BUCKETS", 4)
    monkeypatch.setattr(ranges, "ROWS", 7)
    crowded = df.selectExpr("case when o < 900 then o else o * 1000000 end as o", "o as place")
    assert values(windows.row_numbers(crowded, "o").where("ordinal <> place")) == []
    uids = windows.occurrence_ids(table([(3, "a"), (1, "a"), (2, "b"), (9, "a")], "o int, k string"), "k", "o")
    assert values(uids.select("o", "uid")) == [(1, "a"), (2, "b"), (3, "a_ALT"), (9, "a_ALT2")]
    lines = table([("d", 0, "intro"), ("d", 1, "1. one"), ("d", 2, "more"), ("d", 3, "2. two"), ("e", 0, "none")], "g string, o int, t string")
    assert values(windows.segments(lines, "g", "o", F.col("t").rlike(r"^\d+\. "), "t")) == [("d", 1, "1. one\nmore"), ("d", 2, "2. two")]
    carried = windows.carried_forward(lines, "g", "o", F.when(F.col("t").rlike(r"^\d"), F.col("t")), "head")
    assert [r.head for r in carried.where("g = 'd'").orderBy("o").collect()] == [None, "1. one", "1. one", "2. two"]
    pages = table([("g", i, n) for i, n in enumerate([3, 0, 2, 0, 0, 5])], "g string, o int, n int")
    assert [r.o for r in windows.until_empty(pages, "g", "o", F.col("n") == 0, 2).orderBy("o").collect()] == [0, 1, 2, 3]
    inside = windows.between_headers(lines, "g", "o", F.col("t") == "1. one", F.col("t") == "2. two")
    assert [r.t for r in inside.collect()] == ["more"]


def test_filters(table):
    df = table([("a-AP",), ("b_AP",), ("c",), (None,)], "k string")
    assert values(df.where(filters.without_marks(F.col("k"), "-AP", "_AP"))) == [("c",), (None,)]
    pages = table([("/wiki/Template:X",), ("/wiki/Main_Page",), ("/wiki/Category_List",), ("/wiki/Bolshack",)], "p string")
    assert values(pages.where(filters.allowed_page(F.col("p"), ("Main_Page",), ("Template",), ("category",)))) == [("/wiki/Bolshack",)]
    marks = table([(5, None), (5, 3), (3, 3), (None, 3), (None, None)], "ts int, w int")
    assert values(marks.where(filters.newer(F.col("ts"), F.col("w")))) == [(5, 3), (5, None), (None, None)]
    assert df.select(filters.same_folded(F.lit(" A"), F.lit("a ")), filters.same_folded(F.lit(None), F.lit(""))).first() == (True, True)


def test_updates_and_slices(table):
    df = table([(1, "a", "s"), (2, "b", "s"), (3, "c", "t")], "id int, v string, slice string")
    changes = table([(1, "a"), (2, "B"), (9, "z")], "id int, v string")
    assert values(sinks.updated(df, changes, "id")) == [(1, "a", "s"), (2, "B", "s"), (3, "c", "t")]
    assert sinks.update_report(df, changes, "id").first() == (3, 2, 1)
    new = table([(7, "n", "s")], "id int, v string, slice string")
    assert values(sinks.replaced_slices(df, new, "slice")) == [(3, "c", "t"), (7, "n", "s")]
    assert values(sinks.grown_manifest(df.select("id", "v"), table([(1, "x"), (4, "d"), (4, "d")], "id int, v string"), "id").select("id", "added")) == [(1, False), (2, False), (3, False), (4, True)]
