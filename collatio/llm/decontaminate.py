"""Benchmark decontamination in DataFrame functions only.

A window is 13 consecutive words of an item (a shorter item is one window). Any 13 consecutive document words hold one
whole block of 7 words that starts at a multiple of 7, so only such blocks of a document are hashed and looked up
among the 7-word runs of the items: one lookup for 7 words instead of one for each. Each hit carries its neighbours;
comparing them word by word with the item's verifies it and says how far the windows reach. Items of m < 13 words use
blocks of (m + 1) // 2 words in the same way.

Texts are never shuffled unless they are asked for with `keep`; what is shuffled is a header a document and its
verified hits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collatio.llm.shared import durable, unused

#: A word, before A-Z is lowered: the class also admits A-Z, which lowering maps into it.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
#: Rows and bytes of benchmark word runs up to which they are broadcast; a larger benchmark is joined by a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 200_000_000
OUTPUT = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hits")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _gram(words: Column, at: Column, k: int) -> Column:
    """Hash of k words from `at` (0-based). Lowering more than A-Z only adds candidates; hits are compared exactly."""
    return F.xxhash64(F.lit(k), F.lower(F.array_join(F.slice(words, at + 1, k), " ")))


def _lowered(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, UPPER, LOWER))


def _around(words: Column, at: Column, k: int, reach: int) -> list[Column]:
    """The block, up to `reach` words before it (nearest first) and up to `reach` after it."""
    before = F.least(at, F.lit(reach))
    return [
        F.slice(words, at + 1, k).alias("block"),
        F.reverse(F.slice(words, at - before + 1, before)).alias("before"),
        F.slice(words, at + k + 1, reach).alias("after"),
    ]


def _look(words: Column, k: int, reach: int, own: Column) -> Callable[[Column], Column]:
    def look(block: Column) -> Column:
        at = block * k
        return F.struct(F.lit(k).alias("k"), _gram(words, at, k).alias("h"), at.alias("at"), *_around(words, at, k, reach), own.alias("own"))

    return look


def _agree(a: Column, b: Column) -> Column:
    """How many leading words two lists share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")


def item_runs(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> tuple[DataFrame, list[int]]:
    """Every run of k words of the items, with its neighbours, and the block sizes in use (at most (window + 1) // 2).

    Runs that have their neighbours in common too are one row with the ids of all their items, so a passage that many
    items hold is looked up as one.
    """
    items = (
        benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), _lowered(words_of(F.col(text_col))).alias("w"))
        .where(F.size("w") > 0)
        .groupBy("w")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .withColumn("span", F.least(F.size("w"), F.lit(window)))
        .withColumn("k", F.floor((F.col("span") + 1) / 2).cast("int"))
    )
    sizes = sorted(r[0] for r in items.select("k").distinct().collect())
    runs = None
    for k in sizes:
        reach = (window + 1) // 2
        at = items.where(F.col("k") == k).select("w", "items", "span", F.explode(F.sequence(F.lit(0), F.size("w") - k)).alias("at"))
        part = at.select(F.lit(k).alias("k"), _gram(F.col("w"), F.col("at"), k).alias("h"), "span", "items", *[c.alias(f"i_{n}") for c, n in zip(_around(F.col("w"), F.col("at"), k, reach), ("block", "before", "after"), strict=True)])
        runs = part if runs is None else runs.unionByName(part)
    if runs is not None:
        same = [c for c in runs.columns if c != "items"]
        runs = runs.groupBy(*same).agg(F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return runs, sizes


def _is_small(runs: DataFrame) -> bool:
    """Whether runs are few and short enough to be broadcast; bytes count strings with 16 each for their places in arrays."""
    held = sum((F.octet_length(F.array_join(c, "")) + 16 * F.size(c) for c in ("items", "i_block", "i_before", "i_after")), F.lit(64))
    rows, size = runs.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits (merged word spans), and the columns of `keep`.

    A document word inside any occurrence of a window is hit; contaminated if n_hit > 0 and 20 * n_hit >= n_words.
    Null texts have no words; items without words have no window; rows that repeat are judged one by one; ids of
    items with equal words all count. Without any item every document is clean. Columns of `keep` that have the name of
    one of the others give way to it; other columns of docs are ignored.
    """
    keep = tuple(c for c in keep if c.lower() not in OUTPUT)
    reach = (window + 1) // 2
    runs, sizes = item_runs(benchmark, window=window)
    small = runs is None or _is_small(runs)
    words = F.col("w")
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), *[F.col(c).alias(f"keep_{c}") for c in keep], words_of(F.col(text_col)).alias("w"))
    # A header, so that a document without hits has a row too. What is kept of a document goes with it alone.
    own = F.struct("doc_id", F.size("w").cast("long").alias("n_words"), *[f"keep_{c}" for c in keep])
    none = F.array().cast("array<string>")
    header = F.struct(F.lit(0).alias("k"), (F.lit(0).cast("long") if small else F.col("row")).alias("h"), F.lit(0).alias("at"), none.alias("block"), none.alias("before"), none.alias("after"), own.alias("own"))
    looks = [F.array(header)]
    for k in sizes:
        starts = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.floor(F.size(words) / k).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
        looks.append(F.transform(starts, _look(words, k, reach, F.when(F.lit(False), own))))
    seen = source.select("row", F.explode(F.concat(*looks)).alias("x")).select("row", "x.*")
    zero = docs.sparkSession.range(1).select(F.lit(0).alias("k"), F.lit(0).cast("long").alias("h"))
    known = zero if runs is None else zero.unionByName(runs, allowMissingColumns=True)
    if runs is None:
        known = known.select("k", "h", F.lit(None).cast("int").alias("span"), *[F.lit(None).cast("array<string>").alias(n) for n in ("items", "i_block", "i_before", "i_after")])
    # Headers meet the one row of zeros; where the join shuffles they go by their row's number and meet nothing.
    met = seen.join(F.broadcast(known), ["k", "h"]) if small else seen.join(runs, ["k", "h"], "left")
    left, right = F.least(_agree(_lowered(F.col("before")), F.col("i_before")), F.col("span") - F.col("k")), F.least(_agree(_lowered(F.col("after")), F.col("i_after")), F.col("span") - F.col("k"))
    met = met.withColumns({"left": F.when(F.col("k") > 0, left), "right": F.when(F.col("k") > 0, right)})
    true_hit = (_lowered(F.col("block")) == F.col("i_block")) & (F.col("left") + F.col("right") + F.col("k") >= F.col("span"))
    hit = F.when(true_hit, F.struct((F.col("at") - F.col("left")).alias("lo"), (F.col("at") + F.col("k") + F.col("right")).alias("hi")))
    per_doc = (
        met.where((F.col("k") == 0) | F.coalesce(true_hit, F.lit(False)))
        .groupBy("row")
        .agg(
            F.max("own").alias("d"),
            F.array_sort(F.collect_set(hit)).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(true_hit, F.col("items")))))).alias("items"),
        )
    )
    # Overlapping spans become one, in order: a fold over one document's own hits.
    empty = F.array().cast("array<struct<lo:int,hi:int>>")

    def fold(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], s["hi"]).alias("hi"))))
        return F.when((F.size(done) > 0) & (last["hi"] >= s["lo"]), joined).otherwise(F.concat(done, F.array(s)))

    merged = F.aggregate(F.col("spans"), empty, fold)
    out = per_doc.withColumn("hits", merged).withColumn("n_hit", F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"]))
    n_words = F.col("d.n_words")
    return out.select(
        "d.doc_id",
        n_words.alias("n_words"),
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= n_words)).alias("contaminated"),
        "hits",
        *[F.col(f"d.keep_{c}").alias(c) for c in keep],
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that contamination doesn't call contaminated, with all their columns, whatever their names.

    Texts don't go through the search: the keys of contaminated documents, id and hash of the text, are joined back.
    """
    k0, k1 = unused(docs, "id_key", "text_hash")
    keyed = docs.withColumns({k0: F.coalesce(F.col(id_col).cast("string"), F.lit("")), k1: F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})
    found = contamination(keyed.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text"), F.col(k0).alias("id_key"), F.col(k1).alias("text_hash")), benchmark, keep=("id_key", "text_hash"))
    gone = durable(found.where("contaminated").select(F.col("id_key").alias(k0), F.col("text_hash").alias(k1)).distinct())
    return keyed.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, [k0, k1], "left_anti").select(*docs.columns)


def remove_spans(text: Column, hits: Column) -> Column:
    """text without the words of the given spans, each going with the separators in front of it; the tail stays."""
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"{gap}*{WORD}|{gap}+"), F.lit(0))
    kept = F.filter(pieces, lambda p, i: ~F.exists(hits, lambda s: (i >= s["lo"]) & (i < s["hi"])))
    return F.array_join(kept, "")
