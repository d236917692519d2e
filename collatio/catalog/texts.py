"""String, date, number, JSON and page functions over columns of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.catalog.registry import query
from collatio.functions import html, pages, scalars, terms, text, udfs
from collatio.sources.readers import spread, table


@query(r"SELECT p_partkey, regexp_replace(p_name || ' (' || p_brand || ') (DM' || p_size || ')', '(\s*\([^)]*\))+\s*$', '') AS bare, regexp_replace(p_name || ' (' || p_brand || ') (DM' || p_size || ')', '\s*\([^)]*\)\s*$', '') AS one_less FROM part")
def strip_trailing_groups(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(") (DM"), "p_size", F.lit(")"))
    return table(spark, d, "part").select("p_partkey", text.strip_groups(name).alias("bare"), text.strip_set_serial(name).alias("one_less"))


@query("SELECT page_id, list_filter(list_transform(string_split(url, '/'), lambda x: trim(x)), lambda x: x <> '')[2] AS host, len(list_filter(list_transform(string_split(url, '/'), lambda x: trim(x)), lambda x: x <> '')) AS parts FROM pages")
def split_on_slash(spark: SparkSession, d: str) -> DataFrame:
    parts = text.split_slash(F.col("url"))
    return table(spark, d, "pages").select("page_id", F.try_element_at(parts, F.lit(2)).alias("host"), F.size(parts).cast("long").alias("parts"))


@query(r"SELECT o_orderkey, coalesce(TRY_CAST(nullif(replace(regexp_extract(format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) || ' yen', '([0-9]+(?:,[0-9]+)*)', 1), ',', ''), '') AS INTEGER), 0) AS price FROM orders")
def extract_int(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", text.leading_int(F.concat(F.format_number(F.floor("o_totalprice"), 0), F.lit(" yen"))).alias("price"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 20 WHEN p_size % 3 = 1 THEN 0 ELSE p_size END AS stock FROM part")
def stock_decode(spark: SparkSession, d: str) -> DataFrame:
    shown = F.when(F.col("p_size") % 3 == 0, "在庫 ◯").when(F.col("p_size") % 3 == 1, "×").otherwise(F.concat(F.lit("残り"), "p_size", F.lit("点")))
    return table(spark, d, "part").select("p_partkey", text.stock_level(shown).alias("stock"))


@query(r"SELECT page_id, regexp_replace(string_split(string_split(url, '?')[1], '/')[-1], '\.[^.]*$', '') AS uid, string_split(url, '/')[-2] AS parent FROM pages")
def uid_from_url(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.last_segment(F.col("url")).alias("uid"), text.parent_segment(F.col("url")).alias("parent"))


@query("SELECT o_orderkey, code, CASE WHEN prefix = '5560' THEN 'ST' || right(code, 2) WHEN prefix = '5561' THEN 'OP' || right(code, 2) WHEN prefix = '5562' THEN 'EB' || right(code, 2) WHEN prefix = '5563' THEN 'PRB' || right(code, 2) ELSE code END AS booster, code AS back FROM (SELECT *, left(code, 4) AS prefix FROM (SELECT o_orderkey, CAST(556000 + o_orderkey % 600 AS VARCHAR) AS code FROM orders))")
def code_prefix_map(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", (556000 + F.col("o_orderkey") % 600).cast("string").alias("code"))
    named = orders.withColumn("booster", text.series_code(F.col("code")))
    return named.withColumn("back", text.series_number(F.col("booster")))


@query("SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 1000 + p_size WHEN p_size % 4 = 1 THEN 2000 + p_size WHEN p_size % 4 = 2 THEN 3000 + p_size ELSE 9999 END AS o, CASE WHEN p_size % 4 = 0 THEN 'expansion' WHEN p_size % 4 = 1 THEN 'deck' WHEN p_size % 4 = 2 THEN 'extra' ELSE 'others' END AS category FROM part")
def series_order(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_size") % 4
    code = F.concat(F.when(n == 0, "OP").when(n == 1, "ST").when(n == 2, "EB").otherwise("FDS"), F.col("p_size").cast("string"))
    return table(spark, d, "part").select("p_partkey", text.series_order(code).alias("o"), text.series_category(code).alias("category"))


@query("SELECT c_custkey, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS segment FROM customer")
def capitalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", text.capitalized(F.col("c_mktsegment")).alias("segment"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN o_orderstatus || '_unreleased' ELSE o_orderstatus END AS marked, o_orderstatus AS plain FROM orders")
def suffix_toggle(spark: SparkSession, d: str) -> DataFrame:
    marked = table(spark, d, "orders").select("o_orderkey", text.add_suffix(F.col("o_orderstatus"), "_unreleased", F.col("o_totalprice") > 100000).alias("marked"))
    return marked.withColumn("plain", text.drop_suffix(F.col("marked"), "_unreleased"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'P' || p_size ELSE 'P' || p_size END AS base, CASE WHEN p_size % 3 = 0 THEN 'P' || p_size || '_ALT' WHEN p_size % 3 = 1 THEN 'P' || p_size || '_ALT2' ELSE 'P' || p_size END AS uid FROM part")
def variant_uid(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_size") % 3
    raw = F.concat(F.lit("P"), F.col("p_size").cast("string"), F.when(n == 0, "@1").when(n == 1, "@2").otherwise(""))
    base, uid = text.variant_uid(raw)
    return table(spark, d, "part").select("p_partkey", base.alias("base"), uid.alias("uid"))


@query("SELECT p_partkey, 'UA' || p_size AS booster, p_brand AS card_id, p_name AS card_name, 'SR' AS rarity FROM part")
def listing_tokens(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit(" UA"), F.col("p_size").cast("string"), F.lit("/"), "p_brand", F.lit("  "), "p_name", F.lit(" SR"))
    return table(spark, d, "part").select("p_partkey", *[c.alias(n) for n, c in text.listing_tokens(raw).items()])


@query("SELECT p_partkey, '1.' || (p_size + 1) AS version, 'AB-' || p_size AS hyphened FROM part")
def version_bump(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    return table(spark, d, "part").select("p_partkey", text.next_minor(F.concat(F.lit("1."), size)).alias("version"), text.with_hyphen(F.concat(F.lit("AB"), size)).alias("hyphened"))


@query("SELECT p_partkey, 'OGN-' || p_size || '/298' AS id, CASE WHEN p_size % 2 = 0 THEN '「' || p_name || '」' ELSE p_name END AS name FROM part")
def repaired_ids(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("OGN-"), F.col("p_size").cast("string"), F.lit("a/298"))
    name = F.when(F.col("p_size") % 2 == 0, F.concat("p_name", F.lit("」"))).otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", text.drop_variant_letter(raw).alias("id"), text.repair_brackets(name).alias("name"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name END AS found FROM part")
def labelled_section(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("x キーワード "), "p_name", F.lit(" アーツ y エクストラ z"))).otherwise(F.lit("nothing"))
    return table(spark, d, "part").select("p_partkey", text.section(raw, "キーワード", "エクストラ", "アーツ").alias("found"))


@query("SELECT p_partkey, '[Raid] [Blue] <' || p_name || '>' || chr(92) || 'nkeep' AS line FROM part")
def raid_lines(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("[Raid] on [Blue] or 〈"), "p_name", F.lit("〉 card\\nkeep"))
    return table(spark, d, "part").select("p_partkey", text.raid_lines(raw).alias("line"))


@query("SELECT page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title FROM pages")
def page_title(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", html.title(F.col("html")).alias("title"))


@query("""SELECT page_id, len(l) AS n, array_to_string(l, ' ') AS links FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1) AS l FROM pages)""")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    found = html.links(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.size(found).cast("long").alias("n"), F.array_join(found, " ").alias("links"))


@query("SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, count(*) AS n FROM pages GROUP BY 1")
def page_host(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").groupBy(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host")).agg(F.count("*").alias("n"))


@query("SELECT page_id, md5(regexp_replace(html, '<[^>]*>', '', 'g')) AS plain FROM pages")
def strip_tags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.md5(text.strip_tags(F.col("html"))).alias("plain"))


@query("SELECT page_id, md5(replace(replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '&lt;', '<'), '&gt;', '>')) AS body FROM pages")
def br_to_newline(spark: SparkSession, d: str) -> DataFrame:
    """No <br> of these pages stands before </div>, where the two rules differ; the look-ahead is covered by unit tests."""
    return table(spark, d, "pages").select("page_id", F.md5(text.breaks_to_newlines(F.col("html"))).alias("body"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_object_or_list(spark: SparkSession, d: str) -> DataFrame:
    wrapped = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", scalars.object_or_first(wrapped, "k: long")["k"].alias("k"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-01') AS month, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'soon' END AS shown FROM orders")
def parse_ymd(spark: SparkSession, d: str) -> DataFrame:
    when = F.col("o_orderdate")
    full = F.concat(F.year(when), F.lit("年"), F.month(when), F.lit("月"), F.day(when), F.lit("日"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.date_format(scalars.japanese_date(full), "yyyy-MM-dd").alias("day"),
        F.date_format(scalars.japanese_date(F.concat(F.year(when), F.lit("年"), F.month(when), F.lit("月"))), "yyyy-MM-dd").alias("month"),
        scalars.japanese_date_text(F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("発売日 "), full, F.lit("（金）"))).otherwise("soon")).alias("shown"),
    )


@query("SELECT event_id, epoch_us(ts) // 1000 AS ms, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000000 ELSE 0 END AS s FROM events")
def epoch_ms(spark: SparkSession, d: str) -> DataFrame:
    iso = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("soon")
    return table(spark, d, "events").select("event_id", scalars.epoch_ms(F.col("ts")).alias("ms"), scalars.epoch_seconds(iso).alias("s"))


@query("SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 2147483647 WHEN p_size % 4 = 1 THEN NULL ELSE p_size * 100 END AS power, CASE WHEN p_size % 4 IN (0, 1) THEN 0 ELSE p_size * 100 END AS digits FROM part")
def power_to_int(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_size") % 4
    number = (F.col("p_size") * 100).cast("string")
    raw = F.when(n == 0, "∞").when(n == 1, F.concat(number, F.lit("+"))).otherwise(number)
    return table(spark, d, "part").select("p_partkey", scalars.power_to_int(raw).alias("power"), scalars.digits_or_zero(raw).alias("digits"))


@query("SELECT doc_id, md5(CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' ELSE lang END || ',' || source) AS named FROM documents")
def array_translate(spark: SparkSession, d: str) -> DataFrame:
    named = scalars.mapped_or_same(F.array("lang", "source"), {"en": "English", "fr": "French"})
    return table(spark, d, "documents").select("doc_id", F.md5(F.array_join(named, ",")).alias("named"))


@query("SELECT p_partkey, replace(lower(p_name || '.' || p_brand), ' ', '') AS full, replace(lower(p_name || '.' || p_brand), ' ', '') AS medium, CASE WHEN p_size % 2 = 0 THEN '龍-' ELSE 'アδ' END || p_size AS folded FROM part")
def normalize_key(spark: SparkSession, d: str) -> DataFrame:
    """STR-01 and STR-02; of folded characters the SQL has those that are used here, unit tests have the others."""
    name = F.concat("p_name", F.lit(" ・"), "p_brand")
    folded = F.concat(F.when(F.col("p_size") % 2 == 0, "竜ー").otherwise("ぁデルタ"), "p_size", F.lit("__"))
    return table(spark, d, "part").select("p_partkey", udfs.normalized(name).alias("full"), udfs.normalized(name, full=False).alias("medium"), udfs.normalized(folded).alias("folded"))


@query("SELECT doc_id, md5(CASE WHEN doc_id % 2 = 0 THEN 'When deployed ' || text || ' Hand' ELSE text || chr(10) || 'Lost ' || source || ' Guts  Guts' END) AS english FROM (SELECT doc_id, source, 'x' || replace(text, '手', '') || 'x' AS text FROM documents)")
def term_replace_spacing(spark: SparkSession, d: str) -> DataFrame:
    """STR-29 over whole texts with terms in front and behind, beside letters, line ends and other terms."""
    said = F.concat(F.lit("x"), F.replace(F.col("text"), F.lit("手"), F.lit("")), F.lit("x"))
    whole = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("登場した時"), said, F.lit("手札"))).otherwise(F.concat(said, F.lit("\nロスト"), "source", F.lit("ガッツガッツ")))
    return table(spark, d, "documents").select("doc_id", F.md5(terms.replaced(whole)).alias("english"))


@query("SELECT p_partkey, p_name || CASE p_size % 6 WHEN 0 THEN ' [Serve Area] [Toss Area]' WHEN 1 THEN ' [One Touch 0' || p_size || ']' WHEN 2 THEN ' [Block Phase] [Receive Phase] [From Hand]' WHEN 3 THEN ' [icon_other]' WHEN 4 THEN ' [A Pass]' ELSE ' [Two Attack 02] [Serve Phase]' END AS said FROM part")
def icon_decode(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    icons = [F.lit("[icon_app_servetossarea]"), F.concat(F.lit("[icon_onetouch_0"), size, F.lit("]")), F.lit("[icon_blockreceivephase_tefuda]"), F.lit("[icon_other]"), F.lit("[icon_apass]"), F.lit("[icon_twoattack_02] [icon_serve_tefuda]")]
    return table(spark, d, "part").select("p_partkey", terms.decoded(F.concat("p_name", F.lit(" "), F.element_at(F.array(*icons), (size % 6 + 1).cast("int")))).alias("said"))


@query("SELECT p_partkey, p_name AS name, CAST(p_size AS VARCHAR) AS size FROM part")
def label_pairs(spark: SparkSession, d: str) -> DataFrame:
    page = F.concat(F.lit("<table><tr><th>Name</th><td>"), "p_name", F.lit("</td><th>Size</th><td>"), F.col("p_size").cast("string"), F.lit("</td></tr></table>"))
    found = html.labelled(page)
    return spread(table(spark, d, "part").select("p_partkey", "p_name", "p_size"), "p_partkey").select("p_partkey", found["Name"].alias("name"), found["Size"].alias("size"))


@query("SELECT page_id, nullif(trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)), '') AS title FROM pages")
def label_sections(spark: SparkSession, d: str) -> DataFrame:
    """STR-47 on whole pages: what stands between two labels of the markup."""
    return table(spark, d, "pages").select("page_id", text.blank_to_null(text.section(F.col("html"), "<title>", "</title>")).alias("title"))


#: HTM-02: the four layouts that the catalogue's sites use, each with its way to say a field.
LAYOUTS = (
    pages.Boxes(".cardDataRow .dataBox", ".dataTit", ".dataTxt", joined=True),
    pages.Boxes(".cardData .cardDataRow .cardDataCell", "h6", "div.data"),
    pages.Boxes(".status span.status-Item", "span.heading"),
    pages.Boxes(".info", "dt", "dd", each=True),
)


def _order_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page an order: a box a line, in the layout of its line number, rows of boxes nested to the depth of the quantity."""
    name, value = F.concat(F.lit("Line "), "l_linenumber"), F.concat(F.col("l_linestatus"), F.lit(" <b>&amp;</b> "), "l_partkey")
    icon = F.concat(F.lit('<img alt="'), "l_returnflag", F.lit('">'))
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    forms = (
        said('<div class="cardDataRow side"><div><dl class="dataBox"><dt class="dataTit">', name, '</dt><dd class="dataTxt wide">', value, icon, "</dd></dl></div></div>"),
        said('<div class="cardData"><div class="cardDataRow"><div class="cardDataCell"><h6>', name, '</h6><div class="data"> ', value, icon, "</div></div></div></div>"),
        said('<div class="status"><span class="status-Item"><span class="heading">', name, "</span> ", value, icon, "</span></div>"),
        said('<div class="info"><dl><dt>', name, "<dd>", value, icon, "<dt>Part<dd>", F.col("l_partkey").cast("string"), "</dl></div>"),
    )
    kind = F.col("l_linenumber") % 4
    box = F.when(kind == 0, forms[0]).when(kind == 1, forms[1]).when(kind == 2, forms[2]).otherwise(forms[3])
    depth = (F.col("l_quantity").cast("int") % 5).cast("int")
    wrapped = F.concat(F.repeat(F.lit("<div>"), depth), box, F.repeat(F.lit("</div>"), depth))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_extendedprice", wrapped.alias("box")))).alias("rows"))
    return rows.select("l_orderkey", F.concat(F.lit("<body>"), F.array_join(F.transform("rows", lambda r: r["box"]), "\n"), F.lit("</body>")).alias("html"))


@query(
    "WITH f AS (SELECT l_orderkey, 'Line ' || l_linenumber AS label, CASE WHEN l_linenumber % 4 = 0 THEN l_linestatus || '&' || l_partkey ELSE l_linestatus || ' & ' || l_partkey END AS value, l_returnflag AS icon, row(l_linenumber, l_partkey, l_extendedprice) AS o FROM lineitem "
    "UNION ALL SELECT l_orderkey, 'Part', CAST(l_partkey AS VARCHAR), '', row(l_linenumber, l_partkey, l_extendedprice) FROM lineitem WHERE l_linenumber % 4 = 3) SELECT l_orderkey, label, arg_max(value, o) AS value, arg_max(icon, o) AS icon FROM f GROUP BY l_orderkey, label"
)
def boxed_fields(spark: SparkSession, d: str) -> DataFrame:
    """HTM-02: labelled boxes of four layouts on one page; a label that comes twice counts as it comes last."""
    found = pages.boxes(F.col("html"), *LAYOUTS)
    rows = _order_pages(spark, d).select("l_orderkey", F.explode(found).alias("label", "box"))
    return rows.select("l_orderkey", "label", F.col("box.text").alias("value"), F.array_join("box.alts", ",").alias("icon"))


@query(
    "SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) - 1 AS INTEGER) AS pos, 'Part ' || l_partkey AS name, '部' || l_partkey AS name_jp, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS civilization, "
    "l_linestatus || chr(10) || 'x ' || CAST(l_quantity AS INTEGER) AS english_text, count(*) OVER (PARTITION BY l_orderkey) >= 2 AS is_twinpact FROM lineitem"
)
def wiki_tables(spark: SparkSession, d: str) -> DataFrame:
    """HTM-05: sections of a wiki table by header rows that are known by their style, with tables inside cells."""
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    key, mode = F.col("l_partkey").cast("string"), F.col("l_returnflag")
    head = said('<tr><th colspan="2"><div style="font-size: 1em; color: white;">Part ', key, "<br/><small><ruby><rb>部</rb><rp>(</rp><rt>ぶ</rt></ruby>", key, "</small></div></th></tr>")
    civ = F.when(F.col("l_linenumber") % 2 == 0, said("<tr><td>Civilization:</td><td><a>", mode, "</a> <small>(icon)</small></td></tr>")).otherwise("")
    text_row = said("<tr><td>Notes</td><td><table><tr><td>inner</td><td>English Tex</td></tr></table></td></tr><tr><td>English Text:</td><td>", F.col("l_linestatus"), "<br>x ", F.col("l_quantity").cast("int").cast("string"), "</td></tr>")
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_extendedprice", F.concat(head, civ, text_row).alias("rows")))).alias("r"))
    html_ = said('<table><tr><td>menu</td></tr></table><table class="wikitable">', F.array_join(F.transform("r", lambda x: x["rows"]), ""), "</table>")
    parsed = rows.select("l_orderkey", pages.sections(html_, ("Civilization", "English Text"), "table.wikitable").alias("s"))
    out = parsed.select("l_orderkey", F.posexplode("s").alias("pos", "x"), (F.size("s") >= 2).alias("is_twinpact"))
    return out.select("l_orderkey", "pos", F.col("x")["name"].alias("name"), F.col("x")["name_jp"].alias("name_jp"), F.try_element_at("x", F.lit("Civilization")).alias("civilization"), F.col("x")["English Text"].alias("english_text"), "is_twinpact")
