"""Arrow-batched UDFs, for what SQL functions can't say. Each keeps nulls."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from difflib import SequenceMatcher
from urllib.parse import quote as url_quote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Characters that name normalising takes for one another.
KANJI = {"竜": "龍"}
GREEK = {"デルタ": "Δ", "アルファ": "Α", "ベータ": "Β", "ガンマ": "Γ", "カイ": "Χ", "イプシロン": "Ε", "ゼータ": "Ζ"}
SMALL_KANA = str.maketrans("ァィゥェォャュョヮぁぃぅぇぉゃゅょゎ", "アイウエオヤユヨワあいうえおやゆよわ")
TO_KATAKANA = {c: c + 0x60 for c in range(0x3041, 0x3097)}
QUOTES = str.maketrans("“”‘’", "\"\"''")


def normal_name(name: str, full: bool = True) -> str:
    """STR-01 (full) and STR-02 (medium): one key for the spellings of a name. The order of the steps matters."""
    s = unicodedata.normalize("NFKC", name)
    if full:
        for table in (KANJI, GREEK):
            for written, meant in table.items():
                s = s.replace(written, meant)
        s = re.sub(r"_+$", "", s)
    s = s.replace("〜", "~").translate(QUOTES)
    if full:
        s = re.sub(r"[\"'`]", "", s)
    s = re.sub(r"[・·•]", ".", s)
    if full:
        s = re.sub(r"[ー~\-–—]", "-", s).translate(SMALL_KANA).translate(TO_KATAKANA)
    return re.sub(r"[ 　]", "", s).casefold()


def _each(f: Callable, returns: str = "string"):
    """A UDF that applies f to every distinct text of a batch once."""

    @F.pandas_udf(returns)
    def apply(texts: pd.Series) -> pd.Series:
        known = {t: None if t is None else f(t) for t in texts.unique()}
        return texts.map(known).astype(object) if len(texts) else texts

    return apply


def normalized(c: Column, full: bool = True) -> Column:
    return _each(lambda t: normal_name(t, full))(c)


def _glyph(found: re.Match) -> str:
    name = found[1].removeprefix("rune_").replace("_", " ")
    return "{" + " ".join(w.capitalize() for w in name.split()) + "}"


def glyphs_named(c: Column) -> Column:
    """STR-24: <img src=".../rune_x_y.svg"> as {X Y}."""
    return _each(lambda t: re.sub(r'<img[^>]*src="[^"]*/([a-z0-9_]+)\.svg"[^>]*>', _glyph, t))(c)


def image_alts(c: Column, names: dict[str, str] | None = None) -> Column:
    """STR-26: <img alt="x"> as its mapped tag or [x]; an image without alt goes."""
    table = names or {}

    def alt(found: re.Match) -> str:
        text = re.search(r'alt="([^"]*)"', found[0])
        return table.get(text[1], f"[{text[1]}]") if text and text[1] else ""

    return _each(lambda t: re.sub(r"<img\b[^>]*>", alt, t))(c)


def quoted(c: Column) -> Column:
    """STR-41: a URL path quoted, slashes and what is quoted already left alone."""
    return _each(lambda t: url_quote(t, safe="/%:?=&#"))(c)


def repair_json(text: str) -> str | None:
    """STR-44: the text as JSON, else with an unfinished end cut, else its first object; null if nothing helps."""
    tries = [text, re.sub(r",\s*[}\]]*\s*$", "}", text)]
    if found := re.search(r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}", text):
        tries.append(found[0])
    for t in tries:
        try:
            return json.dumps(json.loads(t), ensure_ascii=False, sort_keys=True)
        except ValueError:
            continue
    return None


def json_repaired(c: Column) -> Column:
    return _each(repair_json)(c)


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """MTH-05: Ratcliff-Obershelp similarity without junk, a being the first sequence; null beside null."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def ratio_junk(a: pd.Series, b: pd.Series) -> pd.Series:
    """MTH-05 with the popular-element heuristic, which only texts of 200 characters or more meet (Q-15)."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")
