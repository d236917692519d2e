"""The keyed store and the versioned table: what is moved, what is rewritten, who wins."""

import os
import re
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from collatio.plans import history
from collatio.sources import versions
from collatio.sources.store import KeyedStore


@pytest.fixture
def store(spark, tmp_path):
    store = KeyedStore(spark, f"t{abs(hash(str(tmp_path)))}", f"{tmp_path}/store", "k", slices=32, buckets=4)
    store.create(spark.range(2000).selectExpr("concat('k', id) AS k", "id AS v", "'a' AS s").union(spark.sql("SELECT NULL, 1L, 'x'")))
    return store


def files(store):
    return {str(p): p.stat().st_mtime_ns for p in Path(store.path).rglob("*.parquet")}


def test_update_moves_and_rewrites_only_what_it_touches(spark, store):
    assert store.read().count() == 2000
    before = files(store)
    changes = spark.createDataFrame([("k5", 50, None), ("k6", None, "b"), ("nobody", 1, "z"), (None, 1, "z")], "k string, v long, s string")
    slices = store.update(changes)
    after = files(store)
    assert 0 < len(slices) <= 3
    touched = {f"_slice={s}" for s in slices}
    same = lambda x: {f for f in x if re.search(r"_slice=\d+", f)[0] not in touched}
    assert same(before) == same(after) and all(before[f] == after[f] for f in same(before))
    assert not {f for f in before if f not in same(before)} & set(after)
    rows = {r.k: (r.v, r.s) for r in store.read().collect()}
    assert len(rows) == 2000 and rows["k5"] == (50, "a") and rows["k6"] == (6, "b") and rows["k7"] == (7, "a")
    assert store.update(changes.limit(0)) == [] and store.update(changes.where("k IS NULL")) == []


@pytest.mark.parametrize("many", [3, 1500])
def test_stored_side_is_not_shuffled(spark, store, many):
    """No exchange stands above the store's scan, and only touched slices are listed, whether changes are few or many."""
    store.session.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    changes = spark.range(many).selectExpr("concat('k', id) AS k", "-id AS v")
    slices = store.touched(changes)
    stored = store.rows_of(slices)
    joined = stored.join(changes.withColumnRenamed("v", "n"), "k", "full_outer")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FullOuter") :]
    left = scan[: scan.index("FileScan")]
    assert "Exchange" not in left and "Bucketed: true" in scan and plan.count("Exchange hashpartitioning") == 1
    assert len(stored.inputFiles()) <= len(slices) * 4


def test_upsert_twice_changes_nothing_more(spark, tmp_path):
    old = spark.createDataFrame([("/a", {"1": (5, 1)}, "A", 1, 1), ("/b", {"1": (7, 1)}, "B", 1, 1)], f"product_link string, price_history map<string,{history.POINT}>, name string, created_at long, last_updated long")
    store = KeyedStore(spark, "twice", f"{tmp_path}/s", "product_link", 8, 2)
    store.create(old)
    run = history.snapshot_rows(spark.createDataFrame([("/a", 6, 2, "A2", 0), ("/c", 1, 1, "C", 1), (None, 1, 1, "N", 2)], "product_link string, price int, stock int, name string, ord int"), 2)
    seen = []
    for _ in range(2):
        store.upsert(run, lambda s, n: history.upserted(s, n, 2).drop("change"))
        seen.append(sorted((r.product_link, r.name, r.created_at, r.last_updated, sorted((t, tuple(p)) for t, p in r.price_history.items())) for r in store.read().collect()))
    assert seen[0] == seen[1] == [("/a", "A2", 1, 2, [("1", (5, 1)), ("2", (6, 2))]), ("/b", "B", 1, 1, [("1", (7, 1))]), ("/c", "C", 2, 2, [("2", (1, 1))])]


def test_points_late_repeated_and_withdrawn(spark, tmp_path):
    schema = "product_link string, ts long, price int, stock int, seq long"
    runs = [[("/a", 1, 5, 1, 1), ("/a", 2, 6, 1, 2), ("/b", 1, 9, 1, 3)], [("/a", 2, 7, 1, 5), ("/a", 3, 8, 1, 6), (None, 1, 1, 1, 7)], [("/a", 2, 1, 1, 4), ("/b", 1, None, None, 8)], [("/a", 2, 7, 1, 5)]]
    store = KeyedStore(spark, "points", f"{tmp_path}/s", "product_link", 8, 2)
    store.create(history.point_maps(spark.createDataFrame([], schema)))
    for run in runs:
        store.upsert(history.point_maps(spark.createDataFrame(run, schema)), history.with_points)
    assert sorted(tuple(r) for r in history.live_points(store.read()).collect()) == [("/a", 1, 5, 1), ("/a", 2, 7, 1), ("/a", 3, 8, 1)]


def test_one_of_two_writers_wins(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert versions.latest(path) == versions.NONE and versions.commit(spark.range(5), path, versions.NONE) == 0
    start, results = threading.Barrier(2), {}

    def write(n: int) -> None:
        rows = spark.createDataFrame([(i,) for i in range(100 * n, 100 * n + 50)], "id long").repartition(3)
        start.wait()
        try:
            results[n] = versions.commit(rows, path, 0)
        except Exception as e:
            results[n] = str(e)

    threads = [threading.Thread(target=write, args=(n,)) for n in (1, 2)]
    [t.start() for t in threads], [t.join() for t in threads]
    won = [n for n in results if results[n] == 1]
    lost = [results[n] for n in results if results[n] != 1]
    assert len(won) == 1 and len(lost) == 1 and "version 1 of" in lost[0], results
    assert sorted(r.id for r in versions.read(spark, path).collect()) == list(range(100 * won[0], 100 * won[0] + 50))
    # The loser's files are gone: those left are what the two versions name.
    named = {f for v in (0, 1) for f in versions.manifest(path, v)["files"]}
    assert set(os.listdir(f"{path}/data")) == named and versions.manifest(path)["rows"] == 50
    assert versions.read(spark, path, 0).count() == 5


def test_versions_of_odd_tables(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    empty = spark.createDataFrame([], "a int, b array<string>")
    assert versions.commit(empty, path, versions.NONE) == 0 and versions.read(spark, path).collect() == []
    assert versions.commit(spark.createDataFrame([(1, ["x", None]), (None, None)], empty.schema), path, 0) == 1
    opened = versions.read(spark, path)
    assert versions.commit(empty, path, 1) == 2
    assert sorted(map(repr, opened.collect())) == ["Row(a=1, b=['x', None])", "Row(a=None, b=None)"] and versions.read(spark, path).count() == 0
    with pytest.raises(Exception, match="no version"):
        versions.read(spark, f"{tmp_path}/none").collect()
    with pytest.raises(Exception, match="put_if_absent"):
        versions.commit(empty, "s3://b/t", versions.NONE)
    failing = spark.range(10).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        versions.commit(failing, f"{tmp_path}/f", versions.NONE)
    assert versions.latest(f"{tmp_path}/f") == versions.NONE and not list(Path(f"{tmp_path}/f").rglob("*.parquet"))
