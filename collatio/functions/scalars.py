"""Native date, number, array, map and JSON functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX = 2147483647


def epoch_ms(c: Column) -> Column:
    """DT-01, DT-08: milliseconds since 1970 of a timestamp without zone, read as UTC."""
    return F.floor(F.unix_micros(c.cast("timestamp")) / 1000).cast("long")


def epoch_seconds(c: Column) -> Column:
    """DT-02: seconds since 1970 of an ISO-8601 text; 0 if it is null or none."""
    return F.coalesce(F.unix_seconds(F.try_to_timestamp(c)), F.lit(0).cast("long"))


def japanese_date(c: Column) -> Column:
    """DT-03: YYYY年M月D日 as a date, YYYY年M月 as the first of that month, else null."""
    day = F.regexp_extract(c, r"^(\d{4})年(\d{1,2})月(\d{1,2})日", 0)
    month = F.regexp_extract(c, r"^(\d{4})年(\d{1,2})月", 0)
    return F.coalesce(F.try_to_timestamp(F.nullif(day, F.lit("")), F.lit("yyyy'年'M'月'd'日'")), F.try_to_timestamp(F.nullif(month, F.lit("")), F.lit("yyyy'年'M'月'"))).cast("date")


def japanese_date_text(c: Column) -> Column:
    """DT-04: the same as YYYY-MM-DD, a weekday in brackets or a label before it left out; what can't be read stays."""
    found = F.regexp_extract(c, r"\d{4}年\d{1,2}月(?:\d{1,2}日)?", 0)
    return F.coalesce(F.date_format(japanese_date(found), "yyyy-MM-dd"), c)


def date_or(c: Column, fallback: Column) -> Column:
    """DT-05: the date of a text, else the run's."""
    return F.coalesce(japanese_date(c), fallback)


def stamp(c: Column) -> Column:
    """DT-06: yyyyMMdd_HHmmss, as file names have it."""
    return F.date_format(c, "yyyyMMdd_HHmmss")


def older_than(c: Column, now: Column, days: int) -> Column:
    """DT-07: strictly more than so many days before now."""
    return c < now - F.expr(f"INTERVAL {int(days)} DAYS")


def power_to_int(c: Column) -> Column:
    """MTH-01: infinity signs are the largest int; anything but a plain integer is null."""
    t = F.trim(c.cast("string"))
    return F.when(t.isin("∞", "infinity", "無制限"), INT_MAX).when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("int"))


def digits_or_zero(c: Column) -> Column:
    """MTH-02."""
    return F.when(c.rlike(r"^[0-9]+$"), F.coalesce(c.try_cast("int"), F.lit(0))).otherwise(0)


def half_even(c: Column, places: int) -> Column:
    """MTH-03: rounded as Python rounds."""
    return F.bround(c, places)


def percentage(part: Column, whole: Column) -> Column:
    """AGG-13: 100 * part / whole with one decimal, whole counting as 1 if it is 0."""
    return F.format_string("%.1f", (100.0 * part / F.greatest(whole, F.lit(1))).cast("double"))


def length_text(c: Column) -> Column:
    """MTH-04."""
    return F.length(c).cast("string")


def zipped(a: Column, b: Column, missing: str = "none") -> Column:
    """JOIN-20: pairs by place, `missing` where a list is short."""
    return F.zip_with(a, b, lambda x, y: F.struct(F.coalesce(x, F.lit(missing)).alias("a"), F.coalesce(y, F.lit(missing)).alias("b")))


def mapped_or_same(values: Column, table: dict[str, str]) -> Column:
    """ARR-03, JOIN-01: each element by a fixed table, itself if it isn't there."""
    m = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.transform(values, lambda x: F.coalesce(m[x], x))


def merged(old: Column, new: Column) -> Column:
    """AGG-15, SET-05, MAP-01: entries of both maps, the new ones winning; a null map is empty."""
    empty = F.map_filter(new, lambda k, v: F.lit(False))
    kept = F.map_filter(F.coalesce(old, empty), lambda k, v: ~F.map_contains_key(F.coalesce(new, empty), k))
    return F.map_concat(F.coalesce(kept, empty), F.coalesce(new, empty))


def object_or_first(c: Column, fields: str) -> Column:
    """JSON-02: a JSON object, or the first of a list of them."""
    return F.coalesce(F.when(F.ltrim(c).startswith("["), F.try_element_at(F.from_json(c, f"array<struct<{fields}>>"), F.lit(1))), F.when(F.ltrim(c).startswith("{"), F.from_json(c, f"struct<{fields}>")))


def one_or_list(values: Column) -> Column:
    """PRJ-11: the one value of a list, or the list as JSON."""
    return F.when(F.size(values) == 1, values[0]).otherwise(F.to_json(values))
