"""Card records built from the driver's tables: strips, markup, projections, nested updates, orders, sinks and readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from collatio.catalog.entities import shared_path
from collatio.catalog.registry import query
from collatio.functions import html, scalars, text, udfs
from collatio.operators import aggregates, filters, joins, projections, sorts, windows
from collatio.plans import history, ingest, matching
from collatio.sources import readers, sinks, versions
from collatio.sources.edge import DictionaryTranslator
from collatio.sources.readers import table
from collatio.streaming import twins


def _said(*parts) -> Column:
    """Literals and columns (in Columns) run together."""
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _part() -> list[Column]:
    return [F.col(c) for c in ("p_name", "p_brand", "p_size", "p_type", "p_partkey")]


@query("SELECT p_partkey, p_name || ' (a)' AS less, p_name AS gs, p_name AS ps, p_name AS inside, p_name AS marks, CASE WHEN p_size % 2 = 0 THEN p_name || ' (DM1)' ELSE p_name END AS one, CASE WHEN p_size % 2 = 0 THEN p_brand || ' (DM1)' END AS two FROM part")
def name_strips(spark: SparkSession, d: str) -> DataFrame:
    """STR-04, STR-06, STR-07, STR-08, STR-10."""
    name, brand, size, typ, key = _part()
    one, two = text.split_two_sided(F.when(size % 2 == 0, _said(name, " / ", brand, " (DM1)")).otherwise(name))
    strips = {
        "less": text.strip_last_group(_said(name, " (a) (b)")), "gs": text.strip_gs(_said(name, " GS ")), "ps": text.strip_ps(_said(name, "P'S")), "inside": text.inner_bracket(_said("art [", name, "]")),
        "marks": text.strip_side_marks(_said("{", name, "} Top side B")), "one": one, "two": two,
    }
    return table(spark, d, "part").select("p_partkey", *[c.alias(n) for n, c in strips.items()])


@query(
    "SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, CASE WHEN regexp_matches(url, '/en/([0-9]+)') THEN regexp_extract(url, '/en/([0-9]+)', 1) ELSE url END AS code, '/go/' || page_id AS target, url || '.PNG' AS image, "
    "'P' || page_id AS base, CASE WHEN page_id % 2 = 0 THEN 'dm' || page_id || 'rp1' ELSE 'dmpcd' || lpad(CAST(page_id % 100 AS VARCHAR), 2, '0') END AS booster, url || '/%E7%81%AB%20a' AS quoted FROM pages"
)
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    """STR-15, STR-40, STR-45, STR-22, STR-23, STR-34, STR-41."""
    url, page = F.col("url"), F.col("page_id")
    image = F.when(page % 2 == 0, _said("/x/dm", page, "ex1/dm", page, "rp1.jpg")).otherwise(_said("/a/playsdeck", page % 100, ".jpg"))
    parts = {
        "host": text.first_match(url, r"^https?://([^/]+)"), "code": text.first_match(url, r"/en/([0-9]+)"), "target": text.first_match(_said("location.href='/go/", page, "'"), r"location\.href='([^']+)'"),
        "image": text.drop_image_query(_said(url, ".PNG?x=1")), "base": text.base_uid(_said("P", page, "_p2")), "booster": text.booster_of_image(image), "quoted": udfs.quoted(_said(url, "/火 a")),
    }
    return table(spark, d, "pages").select("page_id", *[c.alias(n) for n, c in parts.items()])


@query(
    "SELECT p_partkey, p_name AS plain, p_type AS target, p_name AS label, p_name || ' Fire' AS named, CASE WHEN p_size % 2 = 0 THEN 'Karasuno,1st Year' END AS school, p_name || chr(10) || 'x y' AS tidy, 'Fire' AS en, p_name AS jp, "
    "CAST(p_size AS VARCHAR) AS collector, p_brand AS set_number, CASE WHEN p_size % 2 = 0 THEN p_name || ' - ' || p_type ELSE p_name END AS full_name, '{Body X} ' || p_name AS glyph, '[x]' || p_name AS alt, '{\"a\": ' || p_size || '}' AS json FROM part"
)
def markup(spark: SparkSession, d: str) -> DataFrame:
    """STR-39, STR-30, STR-31, STR-32, STR-33, STR-37, STR-38, STR-24, STR-26, STR-44."""
    name, brand, size, typ, key = _part()
    linked = _said("'''[[", typ, "|", name, "]]''' {{x}}")
    link = text.wiki_links(linked)[0]
    en, jp = html.ruby_names(_said("Fire<br><ruby><rb>", name, "</rb><rt>h</rt></ruby>"))
    ids = text.identifier_parts(_said(size, " EN ", brand))
    found = {
        "plain": text.wiki_plain(linked), "target": link["target"], "label": link["label"],
        "named": text.substitute_names(_said(name, " 火"), F.array(F.struct(F.lit("火").alias("jp"), F.lit("Fire").alias("en")))),
        "school": F.array_join(text.affiliations(F.when(size % 2 == 0, "烏野·1年").otherwise("-")), ","),
        "tidy": html.tidy_text(_said("<p>", name, "</p><br>  x   <b>y</b>")), "en": en, "jp": jp, "collector": ids["collector_number"], "set_number": ids["set_number"],
        "full_name": text.full_name(name, F.when(size % 2 == 0, typ).otherwise("")), "glyph": udfs.glyphs_named(_said('<img src="/i/rune_body_x.svg"> ', name)), "alt": udfs.image_alts(_said('<img alt="x">', name)),
        "json": udfs.json_repaired(text.without_fence(_said('```json\n{"a": ', size, ",\n```"))),
    }
    return table(spark, d, "part").select("p_partkey", *[c.alias(n) for n, c in found.items()])


@query(
    "SELECT p_partkey, p_size % 3 <> 0 AS pictured, p_size % 5 = 0 AS lost, p_size % 4 <> 0 AS listed, p_size % 2 = 0 AS latin, p_size % 7 <> 0 AS filled, p_size % 3 = 1 AS unreleased, p_size % 2 = 0 AS told, p_type IN ('PROMO', 'ECONOMY') AS kind, p_size % 6 <> 0 AS shown FROM part"
)
def row_guards(spark: SparkSession, d: str) -> DataFrame:
    """FLT-03, FLT-04, FLT-05, FLT-08, FLT-10, FLT-13, FLT-15, FLT-16, FLT-19, FLT-20."""
    name, brand, size, typ, key = _part()
    dash = F.when(size % 5 == 0, "-").otherwise(name)
    parts = table(spark, d, "part").withColumns({"a": dash, "b": dash, "c": dash, "jp": F.when(size % 2 == 0, name).otherwise(""), "civ": brand})
    guards = {
        "pictured": filters.without_marks(F.when(size % 3 == 0, "/img/placeholder.png").otherwise(_said("/img/", name)), "placeholder"),
        "lost": filters.all_missing("a", "b", "c"), "listed": filters.allowed_page(F.when(size % 4 == 0, _said("/wiki/Template:", name)).otherwise(_said("/wiki/", name)), ("Main_Page",), ("User",), ("category",)),
        "latin": text.plain_latin(F.when(size % 2 == 0, name).otherwise(_said(name, "火"))), "filled": filters.has_items(F.when(size % 7 != 0, F.array(name))),
        "unreleased": F.when(size % 3 == 1, _said(typ, "_unreleased")).otherwise(typ).endswith("_unreleased"), "told": filters.all_present("jp", "p_type", "civ"), "kind": typ.isin("PROMO", "ECONOMY"),
        "shown": filters.without_marks(F.when(size % 6 == 0, "color:red; display: none").otherwise("color:red"), "display: none"),
    }
    return parts.select("p_partkey", *[c.alias(n) for n, c in guards.items()])


@query(
    "SELECT p_partkey, p_name AS \"nameJP\", CASE WHEN p_partkey % 3 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN p_type END ELSE p_name END AS p_name, 1705276800000 AS last_updated, 4 AS ratio, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '[\"' || p_brand || '\",\"' || p_type || '\"]' END AS kinds, "
    "'{\"$oid\":\"' || p_partkey || '\"}' AS oid, p_brand || ':' || p_size AS variant FROM part"
)
def projected(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-05, PRJ-07, PRJ-09, PRJ-10, PRJ-11, PRJ-12, PRJ-15."""
    name, brand, size, typ, key = _part()
    parts = table(spark, d, "part").withColumn("nameJP", name)
    other = table(spark, d, "part").where("p_partkey % 3 = 0").select("p_partkey", F.when(key % 2 == 0, typ).alias("p_name"))
    done = projections.stamped(projections.overwrite(parts, other, "p_partkey", "p_name"), 1705276800000, ratio=4)
    variants = projections.reprojected(F.array(F.struct(brand, size)), code="p_brand", n="p_size")[0]
    kinds = scalars.one_or_list(F.when(size % 2 == 0, F.array(brand)).otherwise(F.array(brand, typ)))
    return done.withColumns({"kinds": kinds, "oid": projections.object_id(key), "variant": _said(variants["code"], ":", variants["n"])}).drop("p_brand", "p_type", "p_size", "p_retailprice")


@query("SELECT DISTINCT 'op' || p_size AS pathname, 'Set ' || p_size AS alt, CAST('10' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS INTEGER) AS \"order\", 'expansion' AS category FROM part")
def set_records(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-14."""
    name, brand, size, typ, key = _part()
    sets = table(spark, d, "part").select(_said("OP", size).alias("code"), _said("Set ", size).alias("title")).distinct()
    return projections.set_record(sets, "code", "title")


@query("SELECT p_partkey, p_name || '+' || p_brand AS first_pair, p_type || '+none' AS last_pair, round_even(p_retailprice / 7, 3) AS third, CAST(length(p_name) AS VARCHAR) AS letters FROM part")
def paired_lists(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-20, MTH-03, MTH-04, ARR-01."""
    name, brand, size, typ, key = _part()
    pairs = scalars.zipped(F.array(name, typ), F.array(brand))
    both = lambda p: _said(p["a"], "+", p["b"])
    return table(spark, d, "part").select("p_partkey", both(pairs[0]).alias("first_pair"), both(F.element_at(pairs, -1)).alias("last_pair"), scalars.half_even(F.col("p_retailprice") / 7, 3).alias("third"), scalars.length_text(name).alias("letters"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'new ' || p_type ELSE p_name END AS first, CASE WHEN p_partkey % 2 = 0 THEN 'wiki ' || p_partkey ELSE p_brand END AS second, CASE WHEN p_size % 2 = 0 THEN 'renamed' ELSE p_name END AS form FROM part")
def nested_updates(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-08, JOIN-15: matches written onto single elements of a list, the first element of a name renamed."""
    name, brand, size, typ, key = _part()
    cards = table(spark, d, "part").withColumn("awaken", F.array(F.struct(name.alias("name"), typ.alias("kind")), F.struct(brand.alias("name"), typ.alias("kind"))))
    found = cards.where("p_partkey % 4 = 0").select("p_partkey", F.lit(0).alias("pos"), _said("new ", typ).alias("name"), F.lit(None).cast("string").alias("kind"))
    found = found.unionByName(cards.where("p_partkey % 2 = 0").select("p_partkey", F.lit(1).alias("pos"), _said("wiki ", key).alias("name"), F.lit("matched").alias("kind")))
    forms = matching.renamed_form(F.array(F.struct(name.alias("name_jp")), F.struct(brand.alias("name_jp"))), F.when(size % 2 == 0, name).otherwise("nobody"), F.lit("renamed"))
    return projections.set_nested(cards, found, "p_partkey", "awaken", "pos", "name", "kind").select("p_partkey", F.col("awaken")[0]["name"].alias("first"), F.col("awaken")[1]["name"].alias("second"), forms[0]["name_jp"].alias("form"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN 'done' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def merge_back(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-17: a transformed part of a table put back by id, its nulls included."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    changed = orders.where("o_orderstatus = 'P'").withColumns({"o_orderpriority": F.lit(None).cast("string"), "o_orderstatus": F.lit("done")})
    return joins.merged_back(orders, changed, "o_orderkey")


@query("SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 = 0 THEN coalesce((SELECT arg_min(q.p_brand, q.p_partkey) FROM part q WHERE q.p_name = p.p_name AND q.p_partkey % 3 <> 0), '') ELSE p_brand END AS p_brand FROM part p")
def sibling_attributes(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-18: what a row lacks from the first stored row of its name."""
    name, brand, size, typ, key = _part()
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    return joins.reused(parts.withColumn("p_brand", F.when(key % 3 == 0, "").otherwise(brand)), parts.where("p_partkey % 3 <> 0"), "p_name", "p_partkey", "p_brand")


@query("SELECT c_custkey, 'new' AS c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
def preserved_columns(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-19, Q-23: a rewritten state keeps the column that only the stored one has."""
    stored = table(spark, d, "customer").where("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_mktsegment")
    return joins.preserving(table(spark, d, "customer").select("c_custkey", F.lit("new").alias("c_name")), stored, "c_custkey")


@query("SELECT count(*) AS n, max(p_size) AS largest, CAST(sum(p_size) AS BIGINT) AS total, arg_min(p_size, p_partkey) AS first, arg_max(p_size, p_partkey) AS last FROM part")
def field_summary(spark: SparkSession, d: str) -> DataFrame:
    """AGG-01, AGG-09, AGG-10, AGG-20."""
    return aggregates.summary(table(spark, d, "part"), "p_size", "p_partkey")


@query("SELECT p_brand, p_partkey, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS r FROM part) WHERE r = 1")
def best_of_group(spark: SparkSession, d: str) -> DataFrame:
    """AGG-12: the row with the largest value, the first of equal ones."""
    name, brand, size, typ, key = _part()
    return joins.first_rows(table(spark, d, "part").select("p_brand", "p_partkey", "p_size"), ["p_brand"], -size, key)


@query("SELECT p_partkey, p_name AS effect, p_brand AS flavour, CASE WHEN p_size % 2 = 0 THEN p_type END AS source FROM part")
def marked_sections(spark: SparkSession, d: str) -> DataFrame:
    """WIN-09: a text cut at ordered labels."""
    name, brand, size, typ, key = _part()
    raw = F.when(size % 2 == 0, _said("x Effect: ", name, " Flavour: ", brand, " Source: ", typ)).otherwise(_said("Effect: ", name, " Flavour: ", brand))
    return table(spark, d, "part").select("p_partkey", text.section(raw, "Effect:", "Flavour:", "Source:").alias("effect"), text.section(raw, "Flavour:", "Source:").alias("flavour"), text.section(raw, "Source:").alias("source"))


@query(
    "SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY round_even(p_retailprice / 1000, 3) DESC, p_partkey) AS by_price, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size % 3 = 0 THEN '' ELSE p_type END, p_partkey) AS by_type, "
    "row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size % 2 = 0 THEN p_size ELSE 0 END, p_partkey) AS by_time, row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_partkey) AS by_length FROM part"
)
def settled_orders(spark: SparkSession, d: str) -> DataFrame:
    """SRT-01 to SRT-05: places within a brand."""
    name, brand, size, typ, key = _part()
    stamp = F.when(size % 2 == 0, _said("1970-01-01T00:00:", F.lpad(size.cast("string"), 2, "0"), "Z")).otherwise("soon")
    orders = {"by_price": sorts.best_first(F.col("p_retailprice") / 1000, key), "by_type": sorts.blank_first(F.when(size % 3 != 0, typ), key), "by_time": sorts.by_time(stamp, key), "by_length": sorts.longest_first(name, key)}
    place = lambda order: F.row_number().over(Window.partitionBy("p_brand").orderBy(*order)).cast("long")
    return table(spark, d, "part").select("p_partkey", *[place(o).alias(n) for n, o in orders.items()])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def full_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """SNK-05, SET-06: a target is written anew, whatever it held; in ranges, so that scans by the key skip files."""
    path = shared_path(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.rebuild(orders.drop("o_orderstatus"), path, "o_orderkey")
    sinks.rebuild(orders.where("o_orderstatus = 'F'").drop("o_orderstatus"), path, "o_orderkey")
    return spark.read.parquet(path)


@query("SELECT n_nationkey, n_name, n_regionkey % 2 = 0 AS done FROM nation UNION ALL SELECT n_nationkey + 100, n_name, NULL FROM nation")
def sink_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """SNK-01, SNK-06, SNK-07, SNK-08, SNK-11, SRC-14, SRC-15, SRT-07: appended, snapshot, written as JSON and state, and read back."""
    path = shared_path(spark)
    nations = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    sinks.append(nations, f"{path}/t")
    sinks.append(nations.withColumn("n_nationkey", F.col("n_nationkey") + 100), f"{path}/t")
    kept = spark.read.parquet(sinks.snapshot(spark.read.parquet(f"{path}/t"), path, "nations", "20240101_000000"))
    sinks.json_lines(kept, f"{path}/json")
    back = spark.read.schema(kept.schema).json(f"{path}/json")
    first = sinks.write_state(back.where("n_nationkey < 5").select("n_nationkey"), f"{path}/state", versions.NONE)
    sinks.write_state(back.where("n_nationkey < 100 and n_regionkey % 2 = 0").select("n_nationkey"), f"{path}/state", first)
    newest = readers.newest(readers.listing(spark, f"{path}/t", "*.parquet"))
    done = versions.read(spark, f"{path}/state").select("n_nationkey", F.lit(True).alias("d")).join(newest.select(F.lit(True).alias("there")).limit(1), F.lit(True))
    todo = sinks.unfinished(back, done, "n_nationkey").select("n_nationkey").withColumn("t", F.lit(True))
    flag = F.when(F.col("t").isNull(), True).when(F.col("n_nationkey") < 100, False)
    return back.join(todo, "n_nationkey", "left").select("n_nationkey", "n_name", flag.alias("done"))


@query("SELECT p_partkey, p_size AS a, 's' || p_partkey AS sha, p_name || '+' || p_brand AS names, p_type AS kind, p_size AS n FROM part")
def api_payloads(spark: SparkSession, d: str) -> DataFrame:
    """SRC-07, SRC-08, SRC-09, SRC-11: answers of interfaces that hold documents inside documents."""
    name, brand, size, typ, key = _part()
    inner = F.base64(F.encode(_said('{"a":', size, "}"), "UTF-8"))
    payload = readers.contents_payload(_said('{"sha":"s', key, '","content":"', inner, '"}'), "a int")
    names = readers.string_list(_said('[" ', name, ' ",1,"","', brand, '"]'))
    kind = readers.mapping_or_empty(_said('{"kind":"', typ, '"}'))
    cards = readers.nested_cards(_said('{"cards":[{"n":', size, "}]}"), "cards", "n: int")
    return table(spark, d, "part").select("p_partkey", payload["data"]["a"].alias("a"), payload["sha"].alias("sha"), F.array_join(names, "+").alias("names"), kind["kind"].alias("kind"), cards[0]["n"].alias("n"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'awaken' WHEN p_size % 3 = 1 THEN 'twinpact' ELSE 'single' END AS form, p_name AS section, p_brand AS race FROM part")
def card_pages(spark: SparkSession, d: str) -> DataFrame:
    """HTM-03, HTM-05."""
    name, brand, size, typ, key = _part()
    details, images = F.when(size % 3 == 2, 1).otherwise(2), F.when(size % 3 == 0, 2).otherwise(1)
    found = html.sections(_said("<table><tr><th>", name, "</th></tr><tr><td>Race:</td><td>", brand, "</td></tr></table>"), ("Race",))[0]
    parts = readers.spread(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size"), "p_partkey")
    return parts.select("p_partkey", html.card_form(details, images).alias("form"), found["name"].alias("section"), found["Race"].alias("race"))


@query("SELECT p_partkey, pos, p_brand AS rarity, 'UA' || p_size AS booster, 'C-' || pos AS card_id, p_name AS card_name, 1000 + p_size AS price, CASE WHEN pos = 0 THEN 20 ELSE p_size END AS stock FROM part, (VALUES (0), (1)) v(pos)")
def shop_pages(spark: SparkSession, d: str) -> DataFrame:
    """UDF-08: a page as a table of rows."""
    name, brand, size, typ, key = _part()

    def card(pos: int, stock) -> Column:
        return _said('<div class="card-product"><span class="d-block border border-dark">UA', size, f'/C-{pos}</span><a href="/p"><h4>', name, '</h4></a><strong class="text-end">1,0', F.lpad(size.cast("string"), 2, "0"), ' 円</strong><label class="zaiko">', stock, "</label></div>")

    page = _said('<div class="cards-list"><h3><span>', brand, "</span></h3>", card(0, "◯"), card(1, _said("残り", size, "点")), "</div>")
    parts = readers.spread(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size"), "p_partkey")
    return parts.select("p_partkey", F.posexplode(html.shop_rows(page)).alias("pos", "c")).select("p_partkey", "pos", "c.rarity", "c.booster", "c.card_id", "c.card_name", "c.price", "c.stock")


@query("SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' THEN 'First' ELSE p_brand END || ',' || CASE WHEN p_type = 'ECONOMY' THEN 'Cheap' ELSE p_type END AS kinds, p_brand || ',' || p_type AS was, p_name AS names FROM part")
def translated_lists(spark: SparkSession, d: str) -> DataFrame:
    """UDF-02 to UDF-06: lists of texts, each distinct text once; names that are settled before win over the translator."""
    name, brand, size, typ, key = _part()
    parts = table(spark, d, "part").select("p_partkey", F.array(brand, typ).alias("kinds"), F.array(name).alias("names"))
    settled = spark.createDataFrame([("Brand#1", "First")], "jp string, en string")
    done = ingest.translated_lists(parts, "p_partkey", ["kinds", "names"], DictionaryTranslator({"Brand#1": "One", "ECONOMY": "Cheap"}), settled)
    return done.select("p_partkey", F.array_join("kinds", ",").alias("kinds"), F.array_join("kindsJP", ",").alias("was"), F.array_join("names", ",").alias("names"))


@query("SELECT event_id, user_id FROM (SELECT *, max(CASE WHEN value < 20 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id DESC ROWS UNBOUNDED PRECEDING) AS old FROM events) WHERE old = 0")
def early_stop(spark: SparkSession, d: str) -> DataFrame:
    """STM-06: newest first, until the first row that is old."""
    events = table(spark, d, "events").select("event_id", "user_id", "value", (-F.col("event_id")).alias("o"))
    return windows.until_old(events, "user_id", "o", F.col("value") < 20).select("event_id", "user_id")


@query("SELECT user_id AS product_link, count(*) AS points, CAST(sum(price) AS BIGINT) AS total FROM (SELECT user_id, epoch_us(ts) // 1000 AS ts, CAST(arg_max(floor(value), event_id) AS INTEGER) AS price FROM events GROUP BY 1, 2) GROUP BY user_id")
def stream_history_equals_batch(spark: SparkSession, d: str) -> DataFrame:
    """STM-05, SNK-10: each micro-batch appends its points under its own number, so that one that comes twice counts once."""
    at = shared_path(spark)
    facts = table(spark, d, "events").select(F.col("user_id").alias("product_link"), scalars.epoch_ms(F.col("ts")).alias("ts"), F.floor("value").cast("int").alias("price"), F.lit(1).alias("stock"), F.col("event_id").alias("seq"))
    facts.repartition(4).write.parquet(f"{at}/in")
    twins.run_to_end(twins.stream_of(spark, f"{at}/in", facts.schema), f"{at}/checkpoint", lambda batch, n: batch.write.mode("overwrite").parquet(f"{at}/points/batch={n}"))
    maps = history.histories(spark.read.parquet(f"{at}/points").drop("batch"))
    return history.points(maps).groupBy("product_link").agg(F.count("*").alias("points"), F.sum("price").alias("total"))

