"""Entity resolution between a card catalogue and a wiki catalogue.

Cards: cardUid, booster, ord, cardName, cardNameJP, cardName2JP, type, effects, race, wikiurl and so on. Wiki documents:
url, ord, is_twinpact, cards (a list of forms: name, name_jp, card_type, english_text, race, illustrator). The jobs are
whole-table joins in the order in which later steps read what earlier ones wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collatio.functions import text, udfs
from collatio.operators import joins, similarity

JP, EN, TWIN = "jp", "en", "twin"
PREFIX = "次元の"


def forms(wiki: DataFrame) -> DataFrame:
    """A row a form with its normalised Japanese key: (url, ord, is_twinpact, pos, name, name_jp, key)."""
    rows = wiki.select("url", "ord", F.coalesce("is_twinpact", F.lit(False)).alias("is_twinpact"), F.posexplode("cards").alias("pos", "form")).select("url", "ord", "is_twinpact", "pos", "form.name", "form.name_jp")
    return rows.withColumn("key", udfs.normalized(text.strip_groups(F.col("name_jp"))))


def lookups(wiki_forms: DataFrame) -> DataFrame:
    """JOIN-03, JOIN-04: (kind, key, target): by Japanese name with twinpacts first, by English name if only one document has it, by Japanese name of twinpacts."""
    named = wiki_forms.where("coalesce(key, '') <> ''")
    jp = joins.first_rows(named.select("key", "url", "is_twinpact", "ord", "pos"), ["key"], (~F.col("is_twinpact")).cast("int"), F.col("ord"), F.col("pos"))
    twin = joins.first_rows(named.where("is_twinpact").select("key", "url", "ord", "pos"), ["key"], F.col("ord"), F.col("pos"))
    english = wiki_forms.select(F.lower(F.trim("name")).alias("key"), "url").where("coalesce(key, '') <> ''").distinct()
    en = joins.unique_rows(english, ["key"])
    parts = [d.select(F.lit(kind).alias("kind"), "key", F.col("url").alias("target")) for kind, d in ((JP, jp), (EN, en), (TWIN, twin))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def matched(cards: DataFrame, wiki_lookups: DataFrame) -> DataFrame:
    """JOIN-02, JOIN-05: cards with `prio` (0 strict, 1 to 5 fallbacks, null unmatched) and `match_url`.

    Each fallback has its guard and counts only if its key differs from the strict one.
    """
    jp = text.strip_groups(F.coalesce("cardNameJP", F.lit("")))
    strict, gs, ps, art = (udfs.normalized(c) for c in (jp, text.strip_gs(jp), text.strip_ps(jp), text.inner_bracket(jp)))
    side_b = udfs.normalized(text.strip_groups(F.coalesce("cardName2JP", F.lit(""))))
    keyed = cards.select("cardUid", jp.alias("jp"), F.lower(F.trim(text.strip_set_serial(F.coalesce("cardName", F.lit(""))))).alias("en"), strict.alias("k0"), gs.alias("k1"), ps.alias("k2"), art.alias("k3"), side_b.alias("k5"))
    k0, col = F.col("k0"), F.col
    tries = [
        (JP, k0, F.lit(True)),
        (JP, col("k1"), col("jp").rlike(r"(?U)\s+GS\s*$") & (col("k1") != k0)),
        (JP, col("k2"), F.contains(col("jp"), F.lit("P'S")) & (col("k2") != k0)),
        (JP, col("k3"), F.contains(col("jp"), F.lit("[")) & F.contains(col("jp"), F.lit("]")) & (col("k3") != k0)),
        (EN, col("en"), text.plain_latin(col("jp"))),
        (TWIN, col("k5"), F.lit(True)),
    ]
    found = joins.cascade(keyed, "cardUid", tries, wiki_lookups).withColumnRenamed("target", "match_url")
    return cards.join(found, "cardUid", "left")


def enriched(cards: DataFrame, wiki: DataFrame, url: str = "match_url") -> DataFrame:
    """PRJ-06, JOIN-10: form 0 over the main fields and form 1 over the second ones where they are filled, and wikiurl; by URL it is the refresh pass."""
    w = wiki.where(F.size("cards") > 0).select(F.col("url").alias("_url"), F.col("cards")[0].alias("_f0"), F.try_element_at("cards", F.lit(2)).alias("_f1"))
    joined = cards.join(w, F.col(url) == F.col("_url"), "left")
    fields = {"cardName": ("_f0", "name"), "type": ("_f0", "card_type"), "effects": ("_f0", "english_text"), "cardName2": ("_f1", "name"), "type2": ("_f1", "card_type"), "effects2": ("_f1", "english_text")}
    new = {c: F.coalesce(F.nullif(F.col(f"{side}.{f}"), F.lit("")), F.col(c)) for c, (side, f) in fields.items() if c in cards.columns}
    for c, side in (("race", "_f0"), ("race2", "_f1")):
        if c in cards.columns:
            new[c] = F.when(F.coalesce(F.col(f"{side}.race"), F.lit("")) != "", text.split_slash(F.col(f"{side}.race"))).otherwise(F.col(c))
    return joined.withColumns({**new, "wikiurl": F.coalesce("_url", F.col("wikiurl"))}).drop("_url", "_f0", "_f1")


def awaken_matched(cards: DataFrame, wiki_lookups: DataFrame) -> DataFrame:
    """JOIN-09: (cardUid, pos, name, match_url) of nested forms: cleaned name, then the name without its prefix."""
    rows = cards.select("cardUid", F.posexplode("awaken").alias("pos", "a")).select("cardUid", "pos", text.strip_groups(text.strip_side_marks(F.coalesce(text.blank_to_null(F.col("a.cardNameJP")), F.col("a.cardName"), F.lit("")))).alias("name"))
    keyed = rows.select("*", F.struct("cardUid", "pos").alias("id"), udfs.normalized(F.col("name")).alias("k0"), udfs.normalized(F.regexp_replace("name", f"^{PREFIX}", "")).alias("k1"))
    found = joins.cascade(keyed, "id", [(JP, F.col("k0"), F.lit(True)), (JP, F.col("k1"), F.col("name").startswith(PREFIX))], wiki_lookups)
    return keyed.join(found, "id", "left").select("cardUid", "pos", "name", F.col("target").alias("match_url"))


def duplicate_repairs(cards: DataFrame, wiki: DataFrame) -> DataFrame:
    """AGG-17: (url, name_jp): for twinpacts whose forms share a Japanese name, side A of the first card matched by side B."""
    doubled = wiki.where((F.size("cards") >= 2) & (F.coalesce(F.col("cards")[0]["name_jp"], F.lit("")) != "") & (F.col("cards")[0]["name_jp"] == F.col("cards")[1]["name_jp"])).select(F.col("url").alias("match_url"))
    side_a = cards.where("prio = 5").select("match_url", "ord", text.strip_groups(F.col("cardNameJP")).alias("name_jp"))
    named = side_a.where((F.coalesce("name_jp", F.lit("")) != "") & ~text.plain_latin(F.col("name_jp")))
    return named.join(doubled, "match_url").groupBy(F.col("match_url").alias("url")).agg(F.min_by("name_jp", "ord").alias("name_jp"))


def synced_names(cards: DataFrame, wiki_forms: DataFrame) -> DataFrame:
    """AGG-16: (url, pos, name_jp): the last card's clean name for a form whose own name has the same key but is written differently."""
    sides = cards.select("wikiurl", "ord", F.posexplode(F.array("cardNameJP", "cardName2JP")).alias("pos", "raw")).withColumn("jp", text.strip_groups(F.col("raw"))).where("coalesce(jp, '') <> ''")
    keyed = sides.withColumn("key", udfs.normalized(F.col("jp")))
    met = keyed.join(wiki_forms.select(F.col("url").alias("wikiurl"), "pos", "key", "name_jp"), ["wikiurl", "pos", "key"])
    last = met.groupBy(F.col("wikiurl").alias("url"), "pos", "name_jp").agg(F.max_by("jp", "ord").alias("new"))
    return last.where("new <> name_jp").select("url", "pos", F.col("new").alias("name_jp"))


def unmatched_documents(wiki_forms: DataFrame, cards: DataFrame) -> DataFrame:
    """JOIN-11: documents none of whose forms has the key of any card side."""
    sides = cards.select(F.explode(F.array("cardNameJP", "cardName2JP")).alias("jp")).where("coalesce(jp, '') <> ''")
    return joins.unmatched_groups(wiki_forms.where("coalesce(key, '') <> ''"), "url", "key", sides.select(udfs.normalized(text.strip_groups(F.col("jp"))).alias("key")))


def best_matches(left: DataFrame, right: DataFrame, blocks: list[str] | None = None, at_least: float = 0.7, junk: bool = False, contains: tuple[str, str] | None = None) -> DataFrame:
    """JOIN-12, JOIN-13, AGG-12: for each row of left (id, ord, key) the row of right (id, ord, key) with the highest ratio, first one on ties.

    blocks: columns of both sides that must be equal (the type). contains: a column of left that a list column of right
    must hold (the civilization).
    """
    return similarity.best_matches(left, right, at_least, blocks, contains, junk)


def applied(suggestions: DataFrame, cards: DataFrame, wiki: DataFrame, at_least: float, require_english: bool = False) -> DataFrame:
    """JOIN-14, FLT-11, FLT-12: suggestions (similarity, wiki_url, cardUid, wiki_name_en, card_name_en) with `outcome`: below, english, missing_wiki, missing_card, no_change or applied."""
    w = wiki.where(F.size("cards") > 0).select(F.col("url").alias("wiki_url"), F.col("cards")[0]["name"].alias("new_name")).withColumn("_w", F.lit(True))
    c = cards.select("cardUid", F.col("cardName").alias("old_name"), F.col("wikiurl").alias("old_url")).withColumn("_c", F.lit(True))
    both = suggestions.join(w, "wiki_url", "left").join(c, "cardUid", "left")
    differs = F.lower(F.trim(F.coalesce("wiki_name_en", F.lit("")))) != F.lower(F.trim(F.coalesce("card_name_en", F.lit(""))))
    same = F.coalesce(F.nullif("new_name", F.lit("")), F.col("old_name")).eqNullSafe(F.col("old_name")) & F.col("wiki_url").eqNullSafe(F.col("old_url"))
    outcome = F.when(F.col("similarity") < at_least, "below").when(differs & F.lit(require_english), "english").when(F.col("_w").isNull(), "missing_wiki").when(F.col("_c").isNull(), "missing_card").when(same, "no_change").otherwise("applied")
    return both.withColumn("outcome", outcome).drop("_w", "_c")


def renamed_form(cards: Column, old: Column, new: Column) -> Column:
    """JOIN-15: the first form whose name_jp is `old` gets `new`."""
    at = F.array_position(F.transform(cards, lambda x: x["name_jp"]), old)
    return F.transform(cards, lambda x, i: F.when(i + 1 == at, x.withField("name_jp", new)).otherwise(x))


def match_report(cards: DataFrame) -> DataFrame:
    """AGG-05, AGG-13: counts by how a card was matched, and the rate."""
    n = F.count("*")
    hits = F.count("prio")
    return cards.agg(n.alias("cards"), hits.alias("matched"), *[F.count_if(F.col("prio") == i).alias(f"prio_{i}") for i in range(6)], (n - hits).alias("unmatched"), F.bround(100.0 * hits / F.greatest(n, F.lit(1)), 1).alias("rate"))

