"""Keyed state and page chains: stopped, resumed and compared with batches."""

import json
import time

import pytest
from pyspark.sql import functions as F

from collatio.sources import pages
from collatio.streaming import state, twins


def add(spark, rows, schema, path, parts=2):
    spark.createDataFrame(rows, schema).repartition(parts).write.mode("append").parquet(path)


def collected(spark, stream, at, name):
    twins.to_files(stream, f"{at}/checkpoint-{name}", f"{at}/{name}")
    return spark.read.parquet(f"{at}/{name}").collect()


def test_processed_ids_survive_restarts(spark, tmp_path):
    schema, at = "id string, v int", str(tmp_path)
    add(spark, [("a", 1), ("b", 2), ("a", 1), (None, 9)] + [("hot", 5)] * 500, schema, f"{at}/in")
    new = lambda: state.first_seen(twins.stream_of(spark, f"{at}/in", spark.read.parquet(f"{at}/in").schema), "id")
    assert sorted(tuple(r) for r in collected(spark, new(), at, "out")) == [("a", 1), ("b", 2), ("hot", 5)]
    add(spark, [("b", 2), ("c", 3), ("hot", 5)], schema, f"{at}/in")
    assert sorted(tuple(r) for r in collected(spark, new(), at, "out")) == [("a", 1), ("b", 2), ("c", 3), ("hot", 5)]
    assert len(collected(spark, new(), at, "out")) == 4


def test_processed_ids_are_forgotten(spark, tmp_path):
    """After its time a key counts as new, and its state is gone."""
    at = str(tmp_path)
    for n in range(2):
        add(spark, [("a", n)], "id string, v int", f"{at}/in", 1)
        state.run_until_read(state.first_seen(twins.stream_of(spark, f"{at}/in", spark.read.parquet(f"{at}/in").schema), "id", remember_ms=200), f"{at}/checkpoint", f"{at}/out")
        assert sorted(r.v for r in spark.read.parquet(f"{at}/out").collect()) == list(range(n + 1))
        time.sleep(0.5)


def test_last_times_never_move_back(spark, tmp_path):
    at, schema = str(tmp_path), "c string, t timestamp"
    moment = lambda s: __import__("datetime").datetime(2024, 1, 1, 0, 0, s)
    seen = []
    for rows in ([("x", moment(5)), ("x", moment(3)), ("y", moment(1)), (None, moment(9)), ("y", None)], [("x", moment(4)), ("y", moment(8))], [("x", moment(5))]):
        add(spark, rows, schema, f"{at}/in", 1)
        found = collected(spark, state.last_times(twins.stream_of(spark, f"{at}/in", spark.read.parquet(f"{at}/in").schema), "c", "t"), at, "out")
        seen.append(sorted(((r.category, None if r.previous is None else r.previous // 10**6 % 60, r.at // 10**6 % 60) for r in found), key=str))
    assert seen[0] == [("x", None, 5), ("y", None, 1)] and len(seen[1]) == len(seen[2]) == 3
    assert set(seen[1]) == set(seen[2]) == {("x", None, 5), ("y", None, 1), ("y", 1, 8)}


def land(folder, name, content):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(content))


def read(spark, at, folder, **options):
    pages.run_to_end(pages.items(pages.chain(spark, str(folder), **options), str(folder)), f"{at}/checkpoint", f"{at}/out")
    return sorted((r.page, r.pos, json.loads(r.item)) for r in spark.read.parquet(f"{at}/out").collect())


def test_numbered_pages_stop_and_go_on(spark, tmp_path):
    folder = tmp_path / "pages"
    for n, items in {1: [1, 2], 2: [], 3: [{"k": "é"}], 5: [5], 8: [8]}.items():
        land(folder, n, {"items": items})
    first = read(spark, tmp_path, folder, max_pages=2, per_batch=1)
    assert first == [("1", 0, 1), ("1", 1, 2)]
    # Resumed without that limit it goes on at page 3; 4 is one empty page, 6 and 7 are two and end it for good.
    rest = read(spark, tmp_path, folder, per_batch=2)
    assert rest == [*first, ("3", 0, {"k": "é"}), ("5", 0, 5)]
    other = tmp_path / "other"
    assert read(spark, other, folder, per_batch=2) == [("1", 0, 1), ("1", 1, 2), ("3", 0, {"k": "é"}), ("5", 0, 5)]
    land(folder, 6, {"items": [6]})
    assert read(spark, other, folder, per_batch=2)[-1] == ("5", 0, 5)


def test_a_stream_that_fails_halfway_loses_nothing(spark, tmp_path):
    folder = tmp_path / "pages"
    for n in range(1, 8):
        land(folder, n, {"items": [n]} if n != 4 else {"items": "broken", "bad": True})
    land(folder, 4, [])
    with pytest.raises(Exception):  # noqa: B017
        read(spark, tmp_path, folder, per_batch=1)
    land(folder, 4, {"items": [4]})
    assert [x[2] for x in read(spark, tmp_path, folder, per_batch=1)] == list(range(1, 8))


def test_linked_pages_end_where_they_come_back(spark, tmp_path):
    folder = tmp_path / "pages"
    for name, following in {"a": "b", "b": "c", "c": "b", "lonely": None, "to": "nowhere"}.items():
        land(folder, name, {"items": [name], "next": following})
    assert [x[2] for x in read(spark, tmp_path / "1", folder, first="a", per_batch=2)] == ["a", "b", "c"]
    assert [x[2] for x in read(spark, tmp_path / "2", folder, first="lonely")] == ["lonely"]
    assert [x[2] for x in read(spark, tmp_path / "3", folder, first="to")] == ["to"]
    pages.run_to_end(pages.chain(spark, str(folder), first="none"), f"{tmp_path}/4/checkpoint", f"{tmp_path}/4/out")
    assert spark.read.schema("page string").parquet(f"{tmp_path}/4/out").where(F.col("page").isNotNull()).count() == 0


def test_long_chains_take_few_batches(spark, tmp_path):
    """Batches grow, the offset doesn't, and a stream that goes on still knows where the chain comes back."""
    folder = tmp_path / "pages"
    for n in range(200):
        land(folder, f"p{n}", {"items": [n], "next": f"p{n + 1}" if n < 199 else "p3"})
    assert len(read(spark, tmp_path, folder, first="p0", per_batch=4, max_pages=20)) == 20
    assert [x[2] for x in sorted(read(spark, tmp_path, folder, first="p0", per_batch=4), key=lambda x: x[2])] == list(range(200))
    offsets = sorted((tmp_path / "checkpoint" / "offsets").glob("[0-9]*"), key=lambda p: int(p.name))
    assert len(offsets) < 12 and all(p.stat().st_size < 2000 for p in offsets)


def test_a_chain_goes_on_behind_pages_that_are_gone(tmp_path):
    for name, following in {"a": "b", "b": "c", "c": "d", "d": None}.items():
        land(tmp_path / "pages", name, {"items": [1], "next": following})
    (tmp_path / "pages" / "a.json").unlink()
    reader = pages.ChainReader({"folder": str(tmp_path / "pages"), "first": "a"})
    assert reader.walk({"at": "c", "empty": 0, "read": 2}, 9) == ([("c", 1), ("d", 1)], {"at": None, "empty": 0, "read": 4})
