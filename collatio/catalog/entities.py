"""Price history, entity resolution, translation and streams over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.catalog.registry import query
from collatio.operators import filters, joins, similarity
from collatio.plans import history, ingest, matching
from collatio.plans.calls import Calls
from collatio.sources import pages, versions
from collatio.sources.edge import DictionaryTranslator
from collatio.sources.readers import table
from collatio.sources.store import KeyedStore
from collatio.streaming import state, twins

RUN = 1705276800000  # 2024-01-15


def _old_products(spark: SparkSession, d: str) -> DataFrame:
    """Products as an earlier run left them: one a user with events before the 15th."""
    seen = table(spark, d, "events").where("ts < timestamp_ntz'2024-01-15'")
    facts = seen.select(F.concat(F.lit("/p/"), "user_id").alias("product_link"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).alias("ts"), F.floor("value").cast("int").alias("price"), F.lit(1).alias("stock"), F.col("event_id").alias("seq"))
    return history.histories(facts).withColumns({"card_name": F.lit("old"), "created_at": F.lit(1).cast("long"), "last_updated": F.lit(2).cast("long")})


def _listing(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "events").where("ts >= timestamp_ntz'2024-01-15'")
    return seen.select(F.concat(F.lit("/p/"), "user_id").alias("product_link"), F.floor("value").cast("int").alias("price"), F.lit(2).alias("stock"), F.lit("new").alias("card_name"), F.col("event_id").alias("ord"))


def _after_run(spark: SparkSession, d: str) -> DataFrame:
    return history.upserted(_old_products(spark, d), history.snapshot_rows(_listing(spark, d), RUN), RUN)


SPLIT = "WITH o AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-15'), n AS (SELECT user_id, arg_max(floor(value), event_id) AS price FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1) "


@query(SPLIT + "SELECT '/p/' || coalesce(o.user_id, n.user_id) AS product_link, CASE WHEN o.user_id IS NULL THEN 'insert' WHEN n.user_id IS NULL THEN 'keep' ELSE 'update' END AS change, CASE WHEN o.user_id IS NULL THEN 1705276800000 ELSE 1 END AS created_at, CASE WHEN n.user_id IS NULL THEN 2 ELSE 1705276800000 END AS last_updated, CASE WHEN n.user_id IS NULL THEN 'old' ELSE 'new' END AS card_name FROM o FULL JOIN n ON o.user_id = n.user_id")
def upsert_split(spark: SparkSession, d: str) -> DataFrame:
    return _after_run(spark, d).select("product_link", "change", "created_at", "last_updated", "card_name")


@query(
    SPLIT + "SELECT '/p/' || user_id AS product_link, epoch_us(ts) // 1000 AS ts, CAST(arg_max(floor(value), event_id) AS INTEGER) AS price, 1 AS stock FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2 "
    "UNION ALL SELECT '/p/' || user_id, 1705276800000, CAST(price AS INTEGER), 2 FROM n"
)
def price_history_merge(spark: SparkSession, d: str) -> DataFrame:
    return history.points(_after_run(spark, d))


@query(
    SPLIT + "SELECT '/p/' || user_id AS product_link, epoch_us(ts) // 1000 AS ts, CAST(arg_max(floor(value), event_id) AS INTEGER) AS price, 1 AS stock FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2 "
    "UNION ALL SELECT '/p/' || user_id, 1705276800000, CAST(price AS INTEGER), 2 FROM n"
)
def store_upsert(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-16 on a keyed store: the run's products meet the stored ones without a shuffle of these, and only touched slices are written."""
    path = shared_path(spark)
    store = KeyedStore(spark, f"products_{path.rpartition('-')[2]}", f"{path}/store", "product_link", slices=64, buckets=8)
    store.create(_old_products(spark, d))
    history.snapshot_rows(_listing(spark, d), RUN).write.parquet(f"{path}/run")
    store.upsert(spark.read.parquet(f"{path}/run"), lambda stored, new: history.upserted(stored, new, RUN).drop("change"))
    return history.points(store.read())


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 AND o_orderstatus <> 'F' THEN 'U' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 3 = 0")
def store_update(spark: SparkSession, d: str) -> DataFrame:
    """SNK-02, SNK-03 on a keyed store: non-null fields are set where the key is stored; keys that aren't add nothing."""
    path = shared_path(spark)
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    store = KeyedStore(spark, f"orders_{path.rpartition('-')[2]}", f"{path}/store", "o_orderkey", slices=64, buckets=8)
    store.create(orders.where("o_orderkey % 3 = 0"))
    store.update(orders.where("o_orderkey % 10 = 0").select("o_orderkey", F.when(F.col("status") != "F", "U").alias("status"), (F.col("price") + 1).alias("price")))
    return store.read()


@query("SELECT '/p/' || user_id AS product_link, epoch_us(ts) // 1000 AS ts, CAST(arg_max(floor(value), event_id) AS INTEGER) AS price, 1 AS stock FROM events GROUP BY 1, 2")
def stream_store_equals_batch(spark: SparkSession, d: str) -> DataFrame:
    """STM-05, MAP-02: each micro-batch goes into the stored maps of its products; other slices stay as they are, and a repeated batch changes nothing."""
    path = shared_path(spark)
    facts = table(spark, d, "events").select(F.concat(F.lit("/p/"), "user_id").alias("product_link"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).alias("ts"), F.floor("value").cast("int").alias("price"), F.lit(1).alias("stock"), F.col("event_id").alias("seq"))
    facts.repartition(3).write.parquet(f"{path}/in")
    store = KeyedStore(spark, f"points_{path.rpartition('-')[2]}", f"{path}/store", "product_link", slices=64, buckets=8)
    store.create(history.point_maps(facts.limit(0)))

    def put(batch: DataFrame, n: int) -> None:
        new = history.point_maps(batch).persist()
        store.upsert(new, history.with_points)
        new.unpersist()

    twins.run_to_end(twins.stream_of(spark, f"{path}/in", facts.schema), f"{path}/checkpoint", put)
    return history.live_points(store.read())


@query("SELECT user_id AS product_link, epoch_us(max(ts)) // 1000 AS ts, arg_max(value, ts) AS price FROM events GROUP BY user_id")
def history_latest(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "events").select(F.col("user_id").alias("product_link"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).alias("ts"), F.col("value").alias("price"))
    return history.latest_points(facts)


@query("SELECT event_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS delta FROM events")
def history_delta(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    return table(spark, d, "events").select("event_id", (F.col("value") - F.lag("value").over(Window.partitionBy("user_id").orderBy("event_id"))).alias("delta"))


def _cards(spark: SparkSession, d: str) -> DataFrame:
    """Parts as cards: even ones named as the wiki has them with a serial, odd ones written in ways that need a fallback."""
    n = F.col("p_partkey") % 6
    base = F.concat(F.lit("カード"), "p_partkey")
    jp = F.when(n == 0, F.concat(base, F.lit(" (DM01 1/9)"))).when(n == 1, F.concat(base, F.lit(" GS"))).when(n == 2, F.concat(base, F.lit("P'S"))).when(n == 3, F.concat(F.lit("絵 ["), base, F.lit("]"))).when(n == 4, F.concat(F.lit("Card "), "p_partkey")).otherwise(F.lit("知らない"))
    return table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("cardUid"), F.col("p_brand").alias("booster"), F.col("p_partkey").alias("ord"), F.concat(F.lit("Card "), "p_partkey").alias("cardName"), jp.alias("cardNameJP"),
        F.when(n == 5, F.concat(F.lit("裏"), "p_partkey")).alias("cardName2JP"), F.lit("").alias("type"), F.lit(None).cast("string").alias("effects"), F.lit(None).cast("string").alias("wikiurl"),
        F.array(F.struct(F.lit(None).cast("string").alias("cardNameJP"), F.concat(F.lit("{次元の"), base, F.lit("} Top")).alias("cardName"))).alias("awaken"),
    )


def _wiki(spark: SparkSession, d: str) -> DataFrame:
    """A document a part but for every seventh; of those with p_partkey % 6 = 5 twinpacts whose second form is side B."""

    def form(name, jp):
        return F.struct(name.alias("name"), jp.alias("name_jp"), F.col("p_type").alias("card_type"), F.lit("text").alias("english_text"), F.lit("A/B").alias("race"), F.lit("").alias("illustrator"))

    one = form(F.concat(F.lit("Card "), "p_partkey"), F.concat(F.lit("カード"), "p_partkey"))
    two = form(F.concat(F.lit("Back "), "p_partkey"), F.concat(F.lit("裏"), "p_partkey"))
    twin = F.col("p_partkey") % 6 == 5
    return table(spark, d, "part").where("p_partkey % 7 <> 0").select(F.concat(F.lit("/wiki/"), "p_partkey").alias("url"), F.col("p_partkey").alias("ord"), twin.alias("is_twinpact"), F.when(twin, F.array(one, two)).otherwise(F.array(one)).alias("cards"), "p_type")


@query("SELECT CAST(p_partkey AS VARCHAR) AS \"cardUid\", CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_partkey % 6 AS INTEGER) END AS prio, CASE WHEN p_partkey % 7 <> 0 THEN '/wiki/' || p_partkey END AS match_url FROM part")
def match_cards(spark: SparkSession, d: str) -> DataFrame:
    found = matching.matched(_cards(spark, d), matching.lookups(matching.forms(_wiki(spark, d))))
    return found.select("cardUid", "prio", "match_url")


@query("SELECT count(*) AS cards, count(*) FILTER (p_partkey % 7 <> 0) AS matched, count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 6 = 0) AS prio_0, count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 6 = 1) AS prio_1, count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 6 = 2) AS prio_2, count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 6 = 3) AS prio_3, count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 6 = 4) AS prio_4, count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 6 = 5) AS prio_5, count(*) FILTER (p_partkey % 7 = 0) AS unmatched, round_even(100.0 * count(*) FILTER (p_partkey % 7 <> 0) / count(*), 1) AS rate FROM part")
def match_report(spark: SparkSession, d: str) -> DataFrame:
    return matching.match_report(matching.matched(_cards(spark, d), matching.lookups(matching.forms(_wiki(spark, d)))))


@query("SELECT CAST(p_partkey AS VARCHAR) AS \"cardUid\", CASE WHEN p_partkey % 7 <> 0 THEN p_type ELSE '' END AS type, CASE WHEN p_partkey % 7 <> 0 THEN 'text' END AS effects, CASE WHEN p_partkey % 7 <> 0 THEN '/wiki/' || p_partkey END AS wikiurl FROM part")
def enrich_cards(spark: SparkSession, d: str) -> DataFrame:
    wiki = _wiki(spark, d)
    found = matching.matched(_cards(spark, d), matching.lookups(matching.forms(wiki)))
    return matching.enriched(found, wiki).select("cardUid", "type", "effects", "wikiurl")


@query("SELECT CAST(p_partkey AS VARCHAR) AS \"cardUid\", '次元のカード' || p_partkey AS name, CASE WHEN p_partkey % 7 <> 0 THEN '/wiki/' || p_partkey END AS match_url FROM part")
def awaken_join(spark: SparkSession, d: str) -> DataFrame:
    return matching.awaken_matched(_cards(spark, d), matching.lookups(matching.forms(_wiki(spark, d)))).drop("pos")


@query("SELECT '/wiki/' || p_partkey AS url FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 6 IN (1, 2, 3, 4)")
def wiki_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return matching.unmatched_documents(matching.forms(_wiki(spark, d)), _cards(spark, d))


@query(
    "SELECT CAST(p_partkey AS VARCHAR) AS \"cardUid\", CASE WHEN p_size / 50.0 < 0.5 THEN 'below' WHEN p_partkey % 5 = 0 THEN 'english' WHEN p_partkey % 7 = 0 THEN 'missing_wiki' WHEN p_partkey % 3 = 0 THEN 'missing_card' ELSE 'applied' END AS outcome FROM part"
)
def apply_suggestions(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part")
    cards = _cards(spark, d).where("ord % 3 <> 0")
    suggestions = parts.select((F.col("p_size") / 50.0).alias("similarity"), F.concat(F.lit("/wiki/"), "p_partkey").alias("wiki_url"), F.col("p_partkey").cast("string").alias("cardUid"), F.when(F.col("p_partkey") % 5 == 0, "other").otherwise(F.lit(" NAME")).alias("wiki_name_en"), F.lit("name").alias("card_name_en"))
    return matching.applied(suggestions, cards, _wiki(spark, d), 0.5, require_english=True).select("cardUid", "outcome")


@query()
def fuzzy_best_match(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-12: every distinct part name against all others, written backwards word by word; difflib has no SQL twin."""
    names = table(spark, d, "part").groupBy(F.col("p_name").alias("key")).agg(F.min("p_partkey").alias("id")).select("id", F.col("id").alias("ord"), "key")
    turned = names.withColumn("key", F.array_join(F.reverse(F.split("key", " ")), " "))
    return matching.best_matches(names, turned, at_least=0.6)


@query()
def blocked_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-13: parts against parts of the same brand and size with another name spelling."""
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("ord"), F.col("p_name").alias("key"), "p_brand", "p_size")
    return matching.best_matches(parts, parts.withColumn("key", F.reverse("key")), blocks=["p_brand", "p_size"], at_least=0.4, junk=True)


@query()
def contained_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """JOIN-13 as the metadata pass has it: equal size, and one word of the left part's type among the right part's words."""
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("ord"), F.col("p_name").alias("key"), "p_size", F.split("p_type", " ").alias("words"))
    left = parts.withColumn("word", F.element_at("words", (F.lit(1) + F.col("id") % F.size("words")).cast("int")))
    return matching.best_matches(left, parts.withColumn("key", F.reverse("key")), blocks=["p_size"], contains=("word", "words"), at_least=0.6, junk=True)


@query(
    "WITH n AS (SELECT p_name AS k, min(p_partkey) AS id FROM part GROUP BY 1), c AS (SELECT id, any_value(length(k)) AS len, ch, count(*) AS n FROM (SELECT id, k, unnest(string_split(k, '')) AS ch FROM n) GROUP BY id, ch), "
    "p AS (SELECT a.id AS l_id, b.id AS r_id, CAST(2 * sum(least(a.n, b.n)) AS DOUBLE) / any_value(a.len + b.len) AS bound FROM c a JOIN c b USING (ch) GROUP BY 1, 2) SELECT l_id, r_id, bound FROM p WHERE l_id <> r_id AND bound >= 0.85"
)
def shared_characters(spark: SparkSession, d: str) -> DataFrame:
    """MTH-05's bound: all pairs of part names that share enough characters for a ratio of 0.85, by the index."""
    names = table(spark, d, "part").groupBy(F.col("p_name").alias("key")).agg(F.min("p_partkey").alias("id")).select("id", F.col("id").alias("ord"), "key")
    return similarity.candidates(names, names, 0.85).where("l_id <> r_id").select("l_id", "r_id", "bound")


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' ELSE lang END AS lang, lang AS \"langJP\", source, source AS \"sourceJP\" FROM documents")
def distinct_then_apply(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return ingest.translated_columns(docs, ["lang", "source"], DictionaryTranslator({"en": "English", "de": "German"}))


@query("SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def incremental_new(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    return ingest.new_rows(listed, table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@query("SELECT o_orderkey AS k, CASE WHEN coalesce(n, 0) = 0 THEN 'not_scraped' ELSE 'card_count_mismatch' END AS reason FROM (SELECT o_orderkey, CAST(o_custkey % 8 AS BIGINT) AS expected FROM orders) LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE coalesce(n, 0) = 0 OR (expected > 0 AND n <> expected)")
def watchlist(spark: SparkSession, d: str) -> DataFrame:
    expected = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 8).alias("card_count"))
    return ingest.watchlist(expected, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), "k", "card_count").select("k", "reason")


@query(
    "SELECT reason, count(*) AS n, CAST(sum(CAST(reason = 'not_scraped' AS INT)) AS BIGINT) AS retried FROM (SELECT CASE WHEN coalesce(n, 0) = 0 THEN 'not_scraped' WHEN expected > 0 AND n <> expected THEN 'card_count_mismatch' ELSE 'up_to_date' END AS reason "
    "FROM (SELECT o_orderkey, CAST(o_custkey % 8 AS BIGINT) AS expected FROM orders) LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linenumber > 1 GROUP BY 1) ON l_orderkey = o_orderkey) GROUP BY 1"
)
def reason_split(spark: SparkSession, d: str) -> DataFrame:
    """FLT-18: what is to be tried again, and the rest, of a reconciliation."""
    expected = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 8).alias("card_count"))
    found = joins.reconciled(expected, table(spark, d, "lineitem").where("l_linenumber > 1").select(F.col("l_orderkey").alias("k")), "k")
    again, rest = filters.split_by_reason(found, "reason", "not_scraped")
    both = again.select("reason", F.lit(1).alias("again")).unionByName(rest.select("reason", F.lit(0).alias("again")))
    return both.groupBy("reason").agg(F.count("*").alias("n"), F.sum("again").alias("retried"))


def shared_path(spark: SparkSession) -> str:
    """A new folder that driver and executors share; a temporary one is for a session on one machine that names none."""
    from tempfile import mkdtemp

    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = mkdtemp(prefix="streams-")
    return f"{base}/stream-{uuid.uuid4().hex}"


@query("SELECT user_id FROM events GROUP BY user_id")
def stream_dedupe_equals_batch(spark: SparkSession, d: str) -> DataFrame:
    at = shared_path(spark)
    events = table(spark, d, "events")
    events.select("user_id").repartition(4).write.parquet(f"{at}/in")
    twins.to_files(twins.deduplicated(twins.stream_of(spark, f"{at}/in", events.select("user_id").schema), "user_id"), f"{at}/checkpoint", f"{at}/out")
    return spark.read.parquet(f"{at}/out")


@query("SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last FROM events GROUP BY event_type")
def stream_watermark_equals_batch(spark: SparkSession, d: str) -> DataFrame:
    """STM-02 batch by batch: each micro-batch moves the state, a new version of which is written."""
    at = shared_path(spark)
    events = table(spark, d, "events").select("event_type", "ts")
    events.repartition(4).write.parquet(f"{at}/in")
    empty = spark.createDataFrame([], "event_type string, last timestamp_ntz")
    empty.write.parquet(f"{at}/state/version=-1")

    def move(batch: DataFrame, version: int) -> None:
        state = batch.sparkSession.read.parquet(f"{at}/state/version={version - 1}")
        ingest.advanced(state, batch, "event_type", "ts").coalesce(1).write.mode("overwrite").parquet(f"{at}/state/version={version}")

    twins.run_to_end(twins.stream_of(spark, f"{at}/in", events.schema), f"{at}/checkpoint", move)
    versions = spark.read.parquet(f"{at}/state").where("version >= 0")
    return versions.groupBy("event_type").agg(F.max("last").alias("last")).select("event_type", F.date_format("last", "yyyy-MM-dd HH:mm:ss").alias("last"))


@query("SELECT user_id FROM events GROUP BY user_id")
def stream_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """STM-03 with keyed state: users processed once over two runs of the stream, the second of which goes on where the first stopped."""
    path = shared_path(spark)
    users = table(spark, d, "events").select("user_id")
    for part in (0, 1):
        users.where(F.pmod(F.xxhash64("user_id"), F.lit(3)) != part).write.mode("append").parquet(f"{path}/in")
        twins.to_files(state.first_seen(twins.stream_of(spark, f"{path}/in", users.schema, 8), "user_id"), f"{path}/checkpoint", f"{path}/out")
    return spark.read.parquet(f"{path}/out")


@query("SELECT event_type AS category, epoch_us(max(ts)) AS at FROM events GROUP BY event_type")
def stream_last_times(spark: SparkSession, d: str) -> DataFrame:
    """STM-02 with keyed state: each category's last time moves on over two runs; the last row of each is where it stands."""
    path = shared_path(spark)
    events = table(spark, d, "events").select("event_type", "ts")
    for part in (0, 1):
        events.where((F.second("ts") % 2 == part)).write.mode("append").parquet(f"{path}/in")
        twins.to_files(state.last_times(twins.stream_of(spark, f"{path}/in", events.schema, 8), "event_type", "ts"), f"{path}/checkpoint", f"{path}/out")
    return spark.read.parquet(f"{path}/out").groupBy("category").agg(F.max("at").alias("at"))


@query("SELECT o_orderkey // 500 AS page, o_orderkey AS item FROM orders")
def paged_items(spark: SparkSession, d: str) -> DataFrame:
    """SRC-17 to SRC-19: orders landed as pages that lead to one another, read as a stream that stops halfway, goes on and ends by itself."""
    path = shared_path(spark)
    folder = versions.folder_of(path) + "/pages"
    listed = table(spark, d, "orders").groupBy(F.floor(F.col("o_orderkey") / 500).alias("page")).agg(F.collect_list("o_orderkey").alias("items"))
    last = listed.agg(F.max("page")).first()[0]
    pages.land(listed.select(F.col("page").cast("string").alias("name"), F.to_json("items").alias("items"), F.when(F.col("page") < last, (F.col("page") + 1).cast("string")).alias("next")), folder)
    for most in (15, 1_000_000):
        pages.run_to_end(pages.items(pages.chain(spark, folder, first="0", max_pages=most, per_batch=10), folder), f"{path}/checkpoint", f"{path}/out")
    return spark.read.parquet(f"{path}/out").select(F.col("page").cast("long").alias("page"), F.col("item").cast("long").alias("item"))


class Strict:
    """Answers in capitals, and fails on every batch that holds a name whose number ends in 77."""

    def translate(self, texts: list[str]) -> list[str]:
        if any(t.endswith("77") for t in texts):
            raise ValueError("a name that can't be answered")
        return [t.upper() for t in texts]


@query("SELECT c_name AS original, CASE WHEN c_name LIKE '%77' THEN NULL ELSE upper(c_name) END AS written, CASE WHEN c_name LIKE '%77' THEN 'ValueError: a name that can''t be answered' END AS error FROM (SELECT DISTINCT c_name FROM customer WHERE trim(c_name) <> '')")
def resumable_calls(spark: SparkSession, d: str) -> DataFrame:
    """UDF-04, UDF-05, UDF-07: a first run over half of the names, then one over all: batches that fail are cut, what fails alone is told."""
    calls = Calls(spark, shared_path(spark), wait=0.01)
    names = table(spark, d, "customer").select(F.col("c_name").alias("original"), "c_custkey")
    calls.plan(names.where("c_custkey % 2 = 0"))
    calls.round(Strict())
    calls.plan(names)
    calls.run(Strict())
    return calls.answers().select("original", "written", F.lit(None).cast("string").alias("error")).unionByName(calls.failed().select("original", F.lit(None).cast("string").alias("written"), "error"))
