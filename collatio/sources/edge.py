"""Interfaces to what lies outside Spark: pages, translations, mail. Tests and offline runs use the in-memory ones.

Pages are landed by whoever fetches them and read as a table (url, body), so nothing here opens a connection.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Protocol, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

T = TypeVar("T")


class Fetcher(Protocol):
    """SRC-10, SRC-13, SRC-20: gives the body of a page, or raises."""

    def get(self, url: str) -> str: ...


@dataclass
class MemoryFetcher:
    pages: dict[str, str]
    asked: list[str] = field(default_factory=list)

    def get(self, url: str) -> str:
        self.asked.append(url)
        return self.pages[url]


def with_retries(call: Callable[[], T], tries: int = 3, sleep: Callable[[float], None] = time.sleep) -> T:
    """UDF-07: waits 1, 2, 4, ... seconds between tries; the last error is raised."""
    for attempt in range(tries):
        try:
            return call()
        except Exception:
            if attempt == tries - 1:
                raise
            sleep(2**attempt)
    raise ValueError("tries must be positive")


def paged(fetch: Callable[[int], list[T]], max_pages: int | None = None, empty_pages: int = 2) -> Iterator[T]:
    """SRC-18, SRC-19: items of pages 1, 2, ... until so many in a row are empty, or max_pages."""
    empty, page = 0, 1
    while empty < empty_pages and (max_pages is None or page <= max_pages):
        items = fetch(page)
        empty = 0 if items else empty + 1
        yield from items
        page += 1


def linked(first: str, fetch: Callable[[str], tuple[list[T], str | None]]) -> Iterator[T]:
    """SRC-17: items of a page and of those its next links lead to; a page that was there already ends it."""
    seen: set[str] = set()
    at: str | None = first
    while at and at not in seen:
        seen.add(at)
        items, at = fetch(at)
        yield from items


def land(spark: SparkSession, fetcher: Fetcher, urls: Iterable[str]) -> DataFrame:
    """A (url, body, error) table of few pages that the driver fetches; an error takes one page with it, not the run."""
    rows = []
    for url in dict.fromkeys(urls):
        try:
            rows.append((url, fetcher.get(url), None))
        except Exception as error:
            rows.append((url, None, f"{type(error).__name__}: {error}"))
    return spark.createDataFrame(rows, "url string, body string, error string")


class PagedSource(DataSource):
    """SRC-10 as a Spark source: format("paged"), one partition per page; options pages and base.

    The reader yields (page, url) rows, so that fetching can be a mapInPandas over them on the executors.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page int, url string"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.pages, self.base = int(options.get("pages", 1)), options.get("base", "")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in range(1, self.pages + 1)]

    def read(self, partition: InputPartition):
        yield partition.value, f"{self.base}?page={partition.value}"


class Translator(Protocol):
    """UDF-01: translates texts of a batch, in order; runs on executors, so it must pickle."""

    def translate(self, texts: list[str]) -> list[str]: ...


@dataclass
class DictionaryTranslator:
    words: dict[str, str]

    def translate(self, texts: list[str]) -> list[str]:
        return [self.words.get(t, t) for t in texts]


@dataclass
class Outbox:
    """SNK-14: mail that a run would send."""

    sent: list[tuple[str, str]] = field(default_factory=list)

    def send(self, subject: str, body: str) -> None:
        self.sent.append((subject, body))
