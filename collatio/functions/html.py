"""Parsing of catalogue pages: native where patterns do, the element tree of `pages` where structure counts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from collatio.functions import pages, text


def title(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))


def links(html: Column) -> Column:
    """HTM-06: href values in page order."""
    return F.regexp_extract_all(html, F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1))


def option_values(html: Column) -> Column:
    """HTM-04: values of options in page order, empty ones left out."""
    return F.filter(F.regexp_extract_all(html, F.lit(r'<option\s[^>]*?value="([^"]*)"'), F.lit(1)), lambda x: x != "")


def card_form(n_details: Column, n_images: Column) -> Column:
    """HTM-03: awaken, twinpact or single, by the numbers of detail tables and images."""
    return F.when((n_details > 1) & (n_images == n_details), "awaken").when((n_details == 2) & (n_images == 1), "twinpact").otherwise("single")


def labelled(html: str | Column) -> Column:
    """HTM-01: label -> value of table rows and definition lists."""
    return pages.of_pages(lambda h: list(pages.label_rows(h).items()), pa.map_(pa.string(), pa.string()))(html)


sections = pages.sections


def ruby_names(c: Column) -> tuple[Column, Column]:
    """STR-33: English and Japanese name of a header "English<br>Japanese", of ruby only the base."""
    base = F.regexp_replace(F.regexp_replace(c, r"(?is)<r[tp]\b[^>]*>.*?</r[tp]>", ""), r"(?i)</?r(?:uby|b)\b[^>]*>", "")
    parts = F.transform(F.split(base, r"(?i)<br\s*/?>"), lambda x: F.trim(F.regexp_replace(x, r"<[^>]*>", "")))
    return parts[0], F.try_element_at(parts, F.lit(2))


def tidy_text(c: Column) -> Column:
    """STR-32: lines without tags, runs of blanks as one, empty lines left out."""
    lines = F.split(F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>|</p>|</div>", "\n"), r"<[^>]*>", ""), "\n")
    return F.array_join(F.filter(F.transform(lines, lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " "))), lambda x: x != ""), "\n")


def shop_rows(c: Column) -> Column:
    """UDF-08: the cards of a shop's listing page: rarity (of the section they stand in), booster, card_id, card_name, product_link, price, stock.

    Sections without a header row are left out; what a card lacks is Unknown, N/A or 0.
    """

    def found(x: Column, pattern: str, default: str) -> Column:
        said = F.trim(F.regexp_replace(F.regexp_extract(x, pattern, 1), r"<[^>]*>", ""))
        return F.coalesce(text.blank_to_null(said), F.lit(default))

    def card(x: Column, rarity: Column) -> Column:
        raw = found(x, r'(?s)<span[^>]*border-dark[^>]*>(.*?)</span>', "Unknown")
        booster, after = text.at_slash(raw)
        return F.struct(
            rarity.alias("rarity"),
            booster.alias("booster"),
            F.when(F.contains(raw, F.lit("/")), after).otherwise(raw).alias("card_id"),
            found(x, r"(?s)<h4[^>]*>(.*?)</h4>", "Unknown").alias("card_name"),
            found(x, r'(?s)<a\s[^>]*href="([^"]*)"[^>]*>\s*<h4', "N/A").alias("product_link"),
            text.leading_int(found(x, r"(?s)<strong[^>]*text-end[^>]*>(.*?)</strong>", "")).alias("price"),
            text.stock_level(found(x, r"(?s)<label[^>]*zaiko[^>]*>(.*?)</label>", "")).alias("stock"),
        )

    def section(x: Column) -> Column:
        rarity = found(F.regexp_extract(x, r"(?s)<h3[^>]*>(.*?)</h3>", 1), r"(?s)<span[^>]*>(.*?)</span>", "Unknown")
        cards = F.split(x, r'<div[^>]*class="[^"]*card-product')
        return F.transform(F.slice(cards, 2, F.size(cards)), lambda k: card(k, rarity))

    parts = F.split(c, r'<div[^>]*class="[^"]*cards-list')
    headed = F.filter(F.slice(parts, 2, F.size(parts)), lambda x: x.rlike(r"<h3[\s>]"))
    return F.flatten(F.transform(headed, section))
