"""Whole jobs: entity resolution, price history, incremental ingest, streams, readers and writers, and the edge."""

import json

import pytest
from pyspark.sql import functions as F

from collatio.plans import history, ingest, matching
from collatio.sources import edge, readers, sinks
from collatio.streaming import twins

FORM = "struct<name:string,name_jp:string,card_type:string,english_text:string,race:string,illustrator:string>"
WIKI = f"url string, ord int, is_twinpact boolean, cards array<{FORM}>"
CARD = "cardUid string, booster string, ord int, cardName string, cardNameJP string, cardName2JP string, cardName2 string, type string, effects string, race array<string>, wikiurl string, awaken array<struct<cardNameJP:string,cardName:string>>"


def form(name, jp, race="R1/R2"):
    return (name, jp, "Creature", "text", race, "")


def card(uid, ord_, jp, jp2=None, en=None, awaken=None, url=None):
    return (uid, "dm01", ord_, en, jp, jp2, None, "", None, None, url, awaken)


@pytest.fixture
def wiki(spark):
    rows = [
        ("/single", 0, None, [form("Bolshack", "ボルシャック")]),
        ("/twin", 1, True, [form("Bolshack", "ボルシャック"), form("Side B", "裏面")]),
        ("/metel", 2, False, [form("Metel", "メテル")]),
        ("/dup1", 3, False, [form("Same", "同一")]),
        ("/dup2", 4, False, [form("Same", "別")]),
        ("/meta", 5, False, []),
        ("/sword", 6, False, [form("Sword", "剣")]),
        ("/doubled", 7, True, [form("D", "重複面"), form("E", "重複面")]),
        ("/lonely", 8, False, [form("Lonely", "孤独 (x)")]),
    ]
    return spark.createDataFrame(rows, WIKI).repartition(3)


@pytest.fixture
def cards(spark):
    rows = [
        card("c0", 0, "ボルシャック (DM01 1/9)", awaken=[(None, "{次元の剣} Top"), (None, "無")]),
        card("c1", 1, "メテル GS"),
        card("c2", 2, "絵 [メテル]"),
        card("c3", 3, "METEL", en="metel (DM9)"),
        card("c4", 4, "SAME", en="Same"),
        card("c5", 5, "知らない", jp2="裏面 (DM1)"),
        card("c6", 6, None),
        card("c7", 7, "別名面 (DM2)", jp2="重複面"),
        card("c8", 8, "メテルP'S"),
    ]
    return spark.createDataFrame(rows, CARD).repartition(4)


def test_cascade_of_matches(cards, wiki):
    lookups = matching.lookups(matching.forms(wiki))
    found = {r.cardUid: (r.prio, r.match_url) for r in matching.matched(cards, lookups).collect()}
    assert found == {
        "c0": (0, "/twin"), "c1": (1, "/metel"), "c2": (3, "/metel"), "c3": (4, "/metel"), "c4": (None, None),
        "c5": (5, "/twin"), "c6": (None, None), "c7": (5, "/doubled"), "c8": (2, "/metel"),
    }
    report = matching.match_report(matching.matched(cards, lookups)).first()
    assert (report.cards, report.matched, report.prio_5, report.unmatched, report.rate) == (9, 7, 2, 2, 77.8)


def test_enriching_twice_changes_nothing_more(cards, wiki):
    once = matching.enriched(matching.matched(cards, matching.lookups(matching.forms(wiki))), wiki)
    again = matching.enriched(once.drop("prio", "match_url"), wiki, url="wikiurl")
    first = {r.cardUid: (r.cardName, r.cardName2, r.type, r.race, r.wikiurl) for r in once.collect()}
    assert first["c0"] == ("Bolshack", "Side B", "Creature", ["R1", "R2"], "/twin") and first["c6"] == (None, None, "", None, None)
    assert first == {r.cardUid: (r.cardName, r.cardName2, r.type, r.race, r.wikiurl) for r in again.collect()}


def test_awaken_repairs_sync_and_reverse(cards, wiki):
    forms = matching.forms(wiki)
    lookups = matching.lookups(forms)
    assert sorted((r.pos, r.match_url) for r in matching.awaken_matched(cards, lookups).collect()) == [(0, "/sword"), (1, None)]
    found = matching.matched(cards, lookups)
    assert [tuple(r) for r in matching.duplicate_repairs(found, wiki).collect()] == [("/doubled", "別名面")]
    linked = cards.where("cardUid in ('c0', 'c1')").withColumn("wikiurl", F.when(F.col("cardUid") == "c0", "/lonely").otherwise("/metel")).withColumn("cardNameJP", F.when(F.col("cardUid") == "c0", "孤 独").otherwise(F.col("cardNameJP")))
    assert [tuple(r) for r in matching.synced_names(linked, forms).collect()] == [("/lonely", 0, "孤 独")]
    assert sorted(r.url for r in matching.unmatched_documents(forms, cards).collect()) == ["/dup1", "/dup2", "/lonely", "/metel", "/sword"]
    renamed = wiki.where("url = '/doubled'").select(matching.renamed_form(F.col("cards"), F.lit("重複面"), F.lit("新")).alias("c")).first().c
    assert [x.name_jp for x in renamed] == ["新", "重複面"]


def test_best_matches_equal_the_nested_loop(spark):
    from difflib import SequenceMatcher

    left = [(i, i, w) for i, w in enumerate(["tide", "bolshack dragon", "metel", "a", "", "dragonmasters"])]
    right = [(i, i, w) for i, w in enumerate(["diet", "tied", "bolshak dragon", "metal", "b", "dragon master", "tides"])]
    schema = "id int, ord int, key string"
    got = {r.l_id: (r.r_id, r.similarity) for r in matching.best_matches(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), at_least=0.7).collect()}
    want = {}
    for i, _, a in left:
        for j, _, b in right:
            ratio = SequenceMatcher(None, a, b, autojunk=False).ratio() if a and b else 0
            if ratio >= 0.7 and (i not in want or ratio > want[i][1]):
                want[i] = (j, ratio)
    assert got == {i: (j, round(r, 3)) for i, (j, r) in want.items()}


def test_nested_and_sibling_updates(spark):
    from collatio.operators import joins, projections, windows

    cards = spark.createDataFrame([("a", [("x", 1), ("y", 2)]), ("b", []), ("c", None)], "id string, items array<struct<n:string,v:int>>")
    updates = spark.createDataFrame([("a", 1, "Y", None), ("b", 0, "no", 1), ("z", 0, "no", 1)], "id string, pos int, n string, v int")
    assert {r.id: r["items"] and [tuple(x) for x in r["items"]] for r in projections.set_nested(cards, updates, "id", "items", "pos", "n", "v").collect()} == {"a": [("x", 1), ("Y", 2)], "b": [], "c": None}
    rows = spark.createDataFrame([(1, "k", ""), (2, "k", None), (3, "k", "own"), (4, "n", ""), (5, None, "")], "id int, k string, v string")
    stored = spark.createDataFrame([(9, "k", "late"), (8, "k", "first")], "o int, k string, v string")
    assert {r.id: r.v for r in joins.reused(rows, stored, "k", "o", "v").collect()} == {1: "first", 2: "first", 3: "own", 4: "", 5: ""}
    changed = spark.createDataFrame([(2, "K", None)], "id int, k string, v string")
    assert sorted((r.id, r.k, r.v) for r in joins.merged_back(rows.where("id < 4"), changed, "id").collect()) == [(1, "k", ""), (2, "K", None), (3, "k", "own")]
    seen = spark.createDataFrame([("g", i, v) for i, v in enumerate([3, 2, 0, 5])], "g string, o int, v int")
    assert sorted(r.o for r in windows.until_old(seen, "g", "o", F.col("v") < 1).collect()) == [0, 1]


def test_lists_are_translated_in_batches(spark):
    class Picky:
        def translate(self, texts):
            if "bad" in texts:
                raise OSError("no")
            return [t.upper() for t in texts]

    df = spark.createDataFrame([(1, ["a", "", None, "b"], ["n"]), (2, ["a"], []), (3, None, None)], "id int, x array<string>, y array<string>").coalesce(1)
    got = {r.id: (r.x, r.y, r.xJP) for r in ingest.translated_lists(df, "id", ["x", "y"], Picky(), spark.createDataFrame([("n", "Name")], "jp string, en string")).collect()}
    assert got == {1: (["A", "", None, "B"], ["Name"], ["a", "", None, "b"]), 2: (["A"], [], ["a"]), 3: (None, None, None)}
    texts = spark.createDataFrame([(f"t{i}",) for i in range(30)] + [("bad",)], "original string").coalesce(1)
    written = {r.original: r.written for r in ingest._written(texts, Picky()).collect()}
    # A batch that fails takes twelve texts with it at most.
    assert len(written) == 31 and sum(k != v for k, v in written.items()) >= 31 - ingest.BATCH


def test_price_history(spark):
    old = spark.createDataFrame([("/a", {"1": (5, 1), "2": (6, 0)}, "A", 1, 2), ("/b", {"1": (7, 1)}, "B", 1, 1)], f"product_link string, price_history map<string,{history.POINT}>, name string, created_at long, last_updated long")
    listing = spark.createDataFrame([("/a", 9, 3, "A2", 0), ("/c", 1, 1, "C", 1), ("/c", 2, 2, "C2", 2)], "product_link string, price int, stock int, name string, ord int")
    new = history.snapshot_rows(listing, 2)
    rows = {r.product_link: r for r in history.upserted(old, new, 2).collect()}
    assert {k: r.change for k, r in rows.items()} == {"/a": "update", "/b": "keep", "/c": "insert"}
    assert {t: tuple(p) for t, p in rows["/a"].price_history.items()} == {"1": (5, 1), "2": (9, 3)}
    assert (rows["/a"].name, rows["/a"].created_at, rows["/a"].last_updated) == ("A2", 1, 2)
    assert tuple(rows["/c"].price_history["2"]) == (2, 2) and (rows["/b"].created_at, rows["/b"].last_updated) == (1, 1)
    # The same run again changes nothing.
    once = history.upserted(old, new, 2).drop("change")
    again = history.upserted(once, new, 2).drop("change").collect()
    assert {r.product_link: r.asDict(True) for r in again} == {r.product_link: r.asDict(True) for r in once.collect()}


def test_translation(spark):
    class Failing:
        def translate(self, texts):
            raise OSError("offline")

    df = spark.createDataFrame([(1, "火"), (2, "水"), (3, "火"), (4, ""), (5, None)], "id int, name string")
    got = {r.id: (r.name, r.nameJP) for r in ingest.translated_columns(df, ["name"], edge.DictionaryTranslator({"火": "Fire"})).collect()}
    assert got == {1: ("Fire", "火"), 2: ("水", "水"), 3: ("Fire", "火"), 4: ("", ""), 5: (None, None)}
    assert {r.name for r in ingest.translated_columns(df, ["name"], Failing()).collect()} == {"火", "水", "", None}


def test_streams(spark, tmp_path):
    rows = [(i % 5, i) for i in range(40)]
    spark.createDataFrame(rows, "k int, v int").repartition(4).write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = lambda: twins.stream_of(spark, f"{tmp_path}/in", schema)
    twins.to_files(twins.deduplicated(stream(), "k"), f"{tmp_path}/c1", f"{tmp_path}/out")
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 1, 2, 3, 4]
    # What was read stays read: a second run adds only new files' rows.
    spark.createDataFrame([(4, 1), (9, 1)], "k int, v int").write.mode("append").parquet(f"{tmp_path}/in")
    twins.to_files(twins.deduplicated(stream(), "k"), f"{tmp_path}/c1", f"{tmp_path}/out")
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 1, 2, 3, 4, 9]
    dated = spark.createDataFrame([(i % 3, f"2024-01-0{1 + i // 3}") for i in range(9)], "k int, day string").select("k", F.col("day").cast("timestamp").alias("ts"))
    dated.coalesce(1).write.parquet(f"{tmp_path}/dated")
    twins.to_files(twins.deduplicated(twins.stream_of(spark, f"{tmp_path}/dated", dated.schema), "k", "ts"), f"{tmp_path}/c3", f"{tmp_path}/once")
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/once").collect()) == [0, 1, 2]
    seen = []
    twins.run_to_end(stream(), f"{tmp_path}/c2", lambda batch, n: seen.append(batch.count()))
    assert sum(seen) == 42 and len(seen) > 1


def test_readers(spark, tmp_path):
    (tmp_path / "docs.json").write_text(json.dumps([{"a": "x", "m": {"1": 2}}, {"a": None}]))
    rows = readers.json_documents(spark, str(tmp_path / "docs.json"), "a string, m map<string,int>").collect()
    assert sorted((r.a or "", r.m) for r in rows) == [("", None), ("x", {"1": 2})]
    df = spark.createDataFrame([('{"content":"eyJhIjog\\nMX0=","sha":"s"}', '[" x ", 1, "", "y"]', "{}"), ("{}", "nothing", "no")], "body string, names string, map string")
    got = df.select(readers.contents_payload(F.col("body"), "a int").alias("p"), readers.string_list(F.col("names")).alias("s"), readers.mapping_or_empty(F.col("map")).alias("m")).collect()
    assert got[0].p.data.a == 1 and got[0].p.sha == "s" and got[0].s == ["x", "y"] and got[1].s == [] and got[0].m == {} == got[1].m
    ids = spark.range(1000).withColumnRenamed("id", "k")
    assert readers.find_all_in(ids, "k", list(range(500, 2000))).count() == 500 and readers.find_all_in(ids, "k", []).count() == 0
    files = spark.createDataFrame([("/x/p_2024.json",), ("/a/p_2025.json",)], "path string")
    assert readers.newest(files).first().path == "/a/p_2025.json" and readers.newest(files.limit(0)).count() == 0
    assert readers.first_that_exists(spark, str(tmp_path / "none"), str(tmp_path / "docs.json")) == str(tmp_path / "docs.json")
    assert readers.listing(spark, str(tmp_path)).count() == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, slice string")
    sinks.replace_slices(df, f"{tmp_path}/t", "slice")
    sinks.replace_slices(spark.createDataFrame([(9, "b")], "id int, slice string"), f"{tmp_path}/t", "slice")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [(1, "a"), (9, "b")]
    for _ in range(2):
        path = sinks.snapshot(df, str(tmp_path), "cards", "20240101_000000")
    assert spark.read.parquet(path).count() == 2
    assert sinks.write_state(df, f"{tmp_path}/state", -1) == 0
    with pytest.raises(Exception, match="version 0 of .* is there already"):
        sinks.write_state(df, f"{tmp_path}/state", -1)
    sinks.rebuild(df, f"{tmp_path}/r", "id")
    assert spark.read.parquet(f"{tmp_path}/r").count() == 2


def test_edge(spark):
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "done"

    assert edge.with_retries(flaky, sleep=waits.append) == "done" and waits == [1, 2]
    with pytest.raises(OSError):
        edge.with_retries(lambda: (_ for _ in ()).throw(OSError()), tries=1)
    pages = {1: [1, 2], 2: [], 3: [3], 4: [], 5: [], 6: [9]}
    assert list(edge.paged(lambda p: pages.get(p, []))) == [1, 2, 3]
    assert list(edge.linked("a", lambda u: ([u], {"a": "b", "b": "a"}[u]))) == ["a", "b"]
    landed = edge.land(spark, edge.MemoryFetcher({"u": "<p>"}), ["u", "v", "u"]).collect()
    assert [(r.url, r.body, bool(r.error)) for r in landed] == [("u", "<p>", False), ("v", None, True)]
    spark.dataSource.register(edge.PagedSource)
    assert sorted(r.page for r in spark.read.format("paged").option("pages", 3).option("base", "/x").load().collect()) == [1, 2, 3]
