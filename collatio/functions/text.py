"""Native string functions. Each takes and gives a Column, passes null on, and notes the operator it stands for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

S = r"(?U)"  # \s, \d and \w as Unicode has them


def trimmed(c: Column) -> Column:
    """Without white space at both ends, ideographic spaces included."""
    return F.regexp_replace(c, S + r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip_groups(c: Column) -> Column:
    """STR-03: without any (...) groups at the end."""
    return trimmed(F.regexp_replace(c, S + r"(?:\s*\([^)]*\))+\s*$", ""))


def strip_last_group(c: Column) -> Column:
    """STR-04: without the last (...) group at the end."""
    return F.regexp_replace(c, S + r"\s*\([^)]*\)\s*$", "")


def strip_set_serial(c: Column) -> Column:
    """STR-05: without a trailing (DM...) group, in either case."""
    return trimmed(F.regexp_replace(c, r"(?iU)\s*\(DM[^)]*\)\s*$", ""))


def strip_gs(c: Column) -> Column:
    """STR-06: without a trailing GS that follows white space."""
    return trimmed(F.regexp_replace(c, S + r"\s+GS\s*$", ""))


def strip_ps(c: Column) -> Column:
    """STR-06: without a trailing P'S."""
    return trimmed(F.regexp_replace(c, S + r"P'S\s*$", ""))


def inner_bracket(c: Column) -> Column:
    """STR-07: what stands between the first [ and the last ], else all of it."""
    found = F.regexp_extract(c, r"\[(.+)\]", 1)
    return F.when(found != "", trimmed(found)).otherwise(c)


def strip_side_marks(c: Column) -> Column:
    """STR-08: without braces, then without trailing top, bottom and side X words."""
    return trimmed(F.regexp_replace(F.regexp_replace(c, r"[{}]", ""), r"(?iU)(?:\s*(?:top|bottom|side\s+[A-Z]))+\s*$", ""))


def split_slash(c: Column, drop_empty: bool = True) -> Column:
    """STR-09, ARR-02: parts between slashes, trimmed; null and "" give an empty list."""
    parts = F.transform(F.split(c, "/"), trimmed)
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.filter(parts, lambda x: x != "") if drop_empty else parts)


def split_two_sided(c: Column) -> tuple[Column, Column]:
    """STR-10: the names of a two-sided card, a serial at the end going to both; a second of null if it has one side."""
    pattern = S + r"^(.*?)\s*/\s*(.*?)(\([^()]*\))?$"
    one, two, serial = (F.regexp_extract(c, pattern, i) for i in (1, 2, 3))
    both = c.rlike(pattern) & ~F.contains(one, F.lit("("))
    return F.when(both, trimmed(F.concat_ws(" ", trimmed(one), trimmed(serial)))).otherwise(c), F.when(both, trimmed(F.concat_ws(" ", trimmed(two), trimmed(serial))))


def leading_int(c: Column) -> Column:
    """STR-11: the first integer, commas allowed between digits; 0 without one, or one that doesn't fit."""
    digits = F.replace(F.regexp_extract(c, r"([0-9]+(?:,[0-9]+)*)", 1), F.lit(","), F.lit(""))
    return F.coalesce(blank_to_null(digits).try_cast("int"), F.lit(0))


def stock_level(c: Column) -> Column:
    """STR-12: ◯ is 20, × is 0, else the first integer, else 0."""
    return F.when(F.contains(c, F.lit("◯")), 20).when(F.contains(c, F.lit("×")), 0).otherwise(F.coalesce(blank_to_null(F.regexp_extract(c, r"[0-9]+", 0)).try_cast("int"), F.lit(0)))


def at_slash(c: Column, default: str = "Unknown") -> tuple[Column, Column]:
    """STR-13: what stands before and after the first slash; the default for both without one."""
    parts, there = F.split(c, "/", 2), F.contains(c, F.lit("/"))
    return F.when(there, parts[0]).otherwise(default), F.when(there, parts[1]).otherwise(default)


def listing_tokens(c: Column) -> dict[str, Column]:
    """STR-14, FLT-14: booster, card_id, card_name and rarity of "booster/id name ... rarity"; null all if it has no slash or one word."""
    words = F.split(trimmed(c), S + r"\s+")
    whole = F.contains(c, F.lit("/")) & (F.size(words) >= 2)
    booster, card_id = at_slash(words[0])
    middle = F.array_join(F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0))), " ")
    return {n: F.when(whole, x) for n, x in {"booster": booster, "card_id": card_id, "card_name": middle, "rarity": F.element_at(words, -1)}.items()}


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """STR-15, STR-40, STR-45: a group of the first match, else the text itself."""
    found = F.regexp_extract(c, pattern, group)
    return F.when(found != "", found).otherwise(c)


def variant_uid(c: Column) -> tuple[Column, Column]:
    """STR-16: base id and uid of id@k: id_ALT for k = 1, else id_ALTk; both are the id without an @."""
    base, variant = F.substring_index(c, "@", 1), F.element_at(F.split(c, "@"), 2)
    has = F.contains(c, F.lit("@"))
    return base, F.when(~has, c).when(variant == "1", F.concat(base, F.lit("_ALT"))).otherwise(F.concat(base, F.lit("_ALT"), variant))


#: Series numbers and the codes they stand for; by whole number, then by first four digits.
SERIES = {
    "op": ({"556701": "FDS", "556801": "LIMITED", "556901": "PROMO"}, {"5560": "ST", "5561": "OP", "5562": "EB", "5563": "PRB"}),
    "fw": ({"583901": "PROMO"}, {"5831": "FS", "5830": "FB", "5832": "SD"}),
}


def series_code(c: Column, family: str = "op") -> Column:
    """STR-17: number to code; a number of no known series stays."""
    whole, prefixes = SERIES[family]
    out = None
    for number, code in whole.items():
        out = F.when(c == number, code) if out is None else out.when(c == number, code)
    for prefix, code in prefixes.items():
        out = out.when(F.substring(c, 1, 4) == prefix, F.concat(F.lit(code), F.right(c, F.lit(2))))
    return out.otherwise(c)


def series_number(c: Column, family: str = "op") -> Column:
    """STR-17: code to number; a code must be its prefix and two characters."""
    whole, prefixes = SERIES[family]
    out = None
    for number, code in whole.items():
        out = F.when(c == code, number) if out is None else out.when(c == code, number)
    for number, code in prefixes.items():
        out = out.when(c.startswith(code) & (F.length(c) == len(code) + 2), F.concat(F.lit(number), F.substring(c, len(code) + 1, 2)))
    return out.otherwise(c)


def zero_filled(c: Column, width: int) -> Column:
    """Left-padded with zeros, never cut."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def series_order(c: Column) -> Column:
    """STR-18: OP, ST and EB codes sort from 1000, 2000 and 3000; others last (9999)."""
    out = F.when(F.lit(False), 0)
    for code, base in (("OP", "10"), ("ST", "20"), ("EB", "30")):
        out = out.when(c.startswith(code) & (F.length(c) >= 3), F.concat(F.lit(base), zero_filled(F.substring(c, 3, 100), 2)).try_cast("int"))
    return F.coalesce(out, F.lit(9999))


def series_category(c: Column) -> Column:
    """STR-18."""
    return F.when(c.startswith("ST"), "deck").when(c.startswith("OP"), "expansion").when(c.startswith("EB"), "extra").otherwise("others")


def last_segment(c: Column) -> Column:
    """STR-19: the last path segment of a URL, without query and extension."""
    name = F.substring_index(F.substring_index(c, "?", 1), "/", -1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def parent_segment(c: Column) -> Column:
    """STR-20: the segment before the last; null without one."""
    return F.try_element_at(F.split(c, "/"), F.lit(-2))


def drop_variant_letter(c: Column) -> Column:
    """STR-21: OGN-030a/298 is OGN-030/298."""
    return F.regexp_replace(c, r"([A-Z]+)-(\d+)[a-z]*/(\d+)", r"$1-$2/$3")


def drop_image_query(c: Column) -> Column:
    """STR-22: an image URL without what follows its extension."""
    return F.regexp_replace(c, r"(?i)(\.(?:png|jpe?g|webp|gif))\?.*$", "$1")


def base_uid(c: Column) -> Column:
    """STR-23: what stands before _p."""
    return F.substring_index(c, "_p", 1)


def breaks_to_newlines(c: Column) -> Column:
    """STR-25: <br> is a new line unless </div> follows; &lt; and &gt; are decoded."""
    lines = F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>(?!\s*</div>)", "\n"), r"(?i)<br\s*/?>", "")
    return F.replace(F.replace(lines, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]*>", "")


def raid_lines(c: Column) -> Column:
    r"""STR-27, STR-48: of lines (parted by a written \n) that start with [Raid] keep [Raid], then all [x], then all <y>."""

    def line(x: Column) -> Column:
        rest = F.substring(x, 7, 100_000_000)
        marks = F.concat(F.array(F.lit("[Raid]")), F.regexp_extract_all(rest, F.lit(r"\[[^\]]+\]"), F.lit(0)), F.regexp_extract_all(rest, F.lit(r"<[^>]+>"), F.lit(0)))
        return F.when(x.startswith("[Raid]"), F.array_join(marks, " ")).otherwise(x)

    angled = F.translate(c, "〈〉", "<>")
    return F.array_join(F.transform(F.split(angled, r"\\n"), line), "\\n")


def substitute_names(c: Column, names: Column) -> Column:
    """STR-30: replace each name of an array of (jp, en) structs, in its order."""
    return F.aggregate(names, c, lambda text, n: F.when(F.coalesce(n["jp"], F.lit("")) == "", text).otherwise(F.replace(text, n["jp"], n["en"])))


def lookup(values: dict[str, str], key: Column) -> Column:
    """A fixed table as an expression: null for keys that it lacks."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[key]


#: Schools and school years.
AFFILIATIONS = {"烏野": "Karasuno", "音駒": "Nekoma", "青葉城西": "Aoba Johsai", "白鳥沢": "Shiratorizawa", "梟谷": "Fukurodani", "稲荷崎": "Inarizaki", "伊達工業": "Date Tech"}
YEARS = {"1年": "1st Year", "2年": "2nd Year", "3年": "3rd Year"}


def affiliations(c: Column) -> Column:
    """STR-31: "school·year,school·year" as a list of names that are known; null for none, blank and "-"."""
    parts = F.transform(F.filter(F.transform(F.split(c, ","), trimmed), lambda x: x != ""), lambda x: F.split(x, "·"))
    names = F.flatten(F.transform(parts, lambda p: F.array(lookup(AFFILIATIONS, trimmed(p[0])), lookup(YEARS, trimmed(F.try_element_at(p, F.lit(2)))))))
    known = F.filter(names, lambda x: x.isNotNull())
    return F.when((trimmed(c) != "-") & (F.size(known) > 0), known)


def booster_of_image(c: Column) -> Column:
    """STR-34: the right-most path segment that starts with dm; playsdeckN is dmpcd and N in two digits; "" without."""
    names = F.transform(F.reverse(F.split(F.regexp_replace(c, r"^/+|/+$", ""), "/")), lambda x: F.substring_index(x, ".", 1))
    deck = F.try_element_at(F.filter(names, lambda x: F.contains(x, F.lit("playsdeck"))), F.lit(1))
    number = F.coalesce(F.replace(deck, F.lit("playsdeck"), F.lit("")).try_cast("int"), F.lit(1)).cast("string")
    plain = F.try_element_at(F.filter(names, lambda x: x.startswith("dm")), F.lit(1))
    return F.coalesce(F.when(F.contains(c, F.lit("playsdeck")), F.concat(F.lit("dmpcd"), zero_filled(number, 2))).otherwise(plain), F.lit(""))


def without_hyphens(c: Column) -> Column:
    """STR-35."""
    return F.replace(c, F.lit("-"), F.lit(""))


def with_hyphen(c: Column, after: int = 2) -> Column:
    """STR-35: a hyphen behind the first characters."""
    return F.concat(F.left(c, F.lit(after)), F.lit("-"), F.substring(c, after + 1, 100_000_000))


def capitalized(c: Column) -> Column:
    """STR-36: the first character upper, all others lower."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 100_000_000)))


def rarity_label(c: Column) -> Column:
    """STR-36: a starred rarity is ALT."""
    return F.when(F.contains(c, F.lit("★")), "ALT").otherwise(capitalized(c))


def identifier_parts(c: Column) -> dict[str, Column]:
    """STR-37: "collector lang set", missing parts empty."""
    parts = F.split(c, " ")
    return {n: F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit("")) for i, n in enumerate(("collector_number", "lang", "set_number"), 1)}


def full_name(name: Column, subtitle: Column) -> Column:
    """STR-38."""
    return F.when(F.coalesce(subtitle, F.lit("")) != "", F.concat(name, F.lit(" - "), subtitle)).otherwise(name)


def wiki_links(c: Column) -> Column:
    """STR-39: (target, label) of every [[target|label]]."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"\[\[([^\]]+)\]\]"), F.lit(1)), lambda x: F.struct(trimmed(F.substring_index(x, "|", 1)).alias("target"), trimmed(F.substring_index(x, "|", -1)).alias("label")))


def wiki_plain(c: Column) -> Column:
    """STR-39: text without link brackets, templates and bold marks."""
    linked = F.regexp_replace(c, r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", "$1")
    return trimmed(F.regexp_replace(F.regexp_replace(linked, r"\{\{[^}]*\}\}", ""), r"'{2,}", ""))


def add_suffix(c: Column, suffix: str, condition: Column) -> Column:
    """STR-42, JOIN-22."""
    return F.when(condition, F.concat(c, F.lit(suffix))).otherwise(c)


def drop_suffix(c: Column, suffix: str) -> Column:
    """STR-42."""
    return F.when(c.endswith(suffix), F.left(c, F.length(c) - len(suffix))).otherwise(c)


def next_minor(c: Column) -> Column:
    """STR-43: a.b becomes a.(b + 1)."""
    parts = F.split(c, r"\.")
    return F.concat(parts[0], F.lit("."), (parts[1].try_cast("int") + 1).cast("string"))


def without_fence(c: Column) -> Column:
    """STR-44: without a code fence around it."""
    return trimmed(F.regexp_replace(F.regexp_replace(c, r"^\s*```(?:json)?\s*", ""), r"\s*```\s*$", ""))


def repair_brackets(c: Column, opener: str = "「", closer: str = "」") -> Column:
    """STR-46: if closers outnumber openers, each closed part without an opener gets one in front."""
    parts = F.split(c, closer)
    last = F.size(parts) - 1
    fixed = F.array_join(F.transform(parts, lambda x, i: F.when((i < last) & ~F.contains(x, F.lit(opener)), F.concat(F.lit(opener), x)).otherwise(x)), closer)
    return F.when(F.regexp_count(c, F.lit(opener)) < F.regexp_count(c, F.lit(closer)), fixed).otherwise(c)


def section(c: Column, start: str, *ends: str) -> Column:
    """STR-47, WIN-09: what follows the first `start` up to the first of `ends` or the end; null without `start`."""
    at = F.instr(c, start)
    rest = F.substr(c, at + len(start))
    until = F.lit(None).cast("int")
    for end in ends:
        until = F.least(until, F.nullif(F.instr(rest, end), F.lit(0)))
    return F.when(at > 0, trimmed(F.substr(rest, F.lit(1), F.coalesce(until - 1, F.length(rest)))))


def plain_latin(c: Column) -> Column:
    """FLT-13: whether a text is not empty and has ASCII and white space only."""
    return F.coalesce(c.rlike(S + r"^[\x00-\x7F\s]+$"), F.lit(False))
