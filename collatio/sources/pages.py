"""Pages that lead to one another as a stream, format("page_chain"): SRC-17, SRC-18, SRC-19.

Pages are landed as JSON files of a folder that driver and executors share: {"items": [...], "next": name or null}; pages
without "next" are numbers that count up. The offset is where the chain stands, so a stream that is stopped goes on
there (also behind a max_pages that has been raised), and one that has come to the chain's end has no more data. The driver looks at one page after the other, for
what comes next; the items are read by tasks (`items`). A batch has per_batch pages, or as many as were read before it, so a
chain of any length takes few of them; the names behind it, which tell where it comes back, are in the driver's memory and not in the offset.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from collatio.sources.readers import spread
from collatio.sources.versions import folder_of


class ChainReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.first = folder_of(options["folder"]), options.get("first", "1")
        self.empty_pages, self.max_pages = int(options.get("empty_pages", 2)), int(options["max_pages"]) if "max_pages" in options else None
        self.per_batch = int(options.get("per_batch", 50))
        self.behind: list[str] = []
        self.known: set[str] = set()

    def initialOffset(self) -> dict:
        return {"at": self.first, "empty": 0, "read": 0}

    def recall(self, start: dict) -> None:
        """Make the names behind an offset those known: a stream that goes on walks them once more, one that runs has them."""
        if len(self.behind) > start["read"]:
            self.known.difference_update(self.behind[start["read"] :])
            del self.behind[start["read"] :]
        while len(self.behind) < start["read"]:
            at = self.following(self.behind[-1], self.page(self.behind[-1])) if self.behind else self.first
            if at is None:  # a page that has been taken away since hides those in front of the offset
                self.behind += [""] * (start["read"] - len(self.behind))
                return
            self.behind.append(at)
            self.known.add(at)

    def following(self, at: str, found: dict | None) -> str | None:
        """The name that a page leads to, if any."""
        if found is not None and "next" in found:
            return found["next"]
        return None if found is None and not at.isdigit() else str(int(at) + 1)

    def page(self, name: str) -> dict | None:
        path = f"{self.folder}/{name}.json"
        if not os.path.exists(path):
            return None
        with open(path) as f:
            return json.load(f)

    def walk(self, start: dict, pages: int) -> tuple[list[tuple], dict]:
        """Up to so many pages from an offset on, and the offset behind them. A page that isn't there ends a chain of links and is an empty one among numbers."""
        self.recall(start)
        at, empty, n = start["at"], start["empty"], start["read"]
        out: list[tuple] = []
        while at is not None and len(out) < pages and (self.max_pages is None or n < self.max_pages):
            found = self.page(at)
            linked = found is not None and "next" in found
            if found is None and not at.isdigit():
                at = None
                break
            items = found["items"] if found else []
            out.append((at, len(items)))
            n, empty = n + 1, 0 if items else empty + 1
            self.behind.append(at)
            self.known.add(at)
            at = self.following(at, found)
            if empty >= self.empty_pages or linked and at in self.known:
                at = None
        return out, {"at": at, "empty": empty, "read": n}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        out, end = self.walk(start, max(self.per_batch, start["read"]))
        return iter(out), end if out else start

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """The pages between two offsets once more, after a failure."""
        return iter(self.walk(start, end["read"] - start["read"])[0])


class PageChain(DataSource):
    """Options: folder; first ("1"); empty_pages in a row that end it (2); max_pages; per_batch (50). Rows: page, n_items."""

    @classmethod
    def name(cls) -> str:
        return "page_chain"

    def schema(self) -> str:
        return "page string, n_items int"

    def simpleStreamReader(self, schema) -> ChainReader:
        return ChainReader(self.options)


def chain(spark: SparkSession, folder: str, **options: str | int) -> DataFrame:
    """The stream of a chain's pages."""
    spark.dataSource.register(PageChain)
    return spark.readStream.format("page_chain").options(folder=folder, **{k: str(v) for k, v in options.items()}).load()


def items(pages: DataFrame, folder: str) -> DataFrame:
    """(page, pos, item) of a stream or table of pages, item being JSON: each page is opened by the task that has its row."""
    at = folder_of(folder)

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name in part["page"]:
                if os.path.exists(f"{at}/{name}.json"):
                    with open(f"{at}/{name}.json") as f:
                        found = json.load(f)["items"]
                    if found:
                        yield pd.DataFrame({"page": name, "pos": range(len(found)), "item": [json.dumps(x, ensure_ascii=False, sort_keys=True) for x in found]})

    # A batch of the chain is one split, so its pages are dealt out.
    return spread(pages, "page").mapInPandas(read, "page string, pos int, item string")


def land(listed: DataFrame, folder: str) -> None:
    """Write pages (name, items as a JSON list, next) as files of a folder, each by the task that has its row; next null ends a chain of links."""
    at = folder_of(folder)

    def write(rows: Iterator) -> None:
        os.makedirs(at, exist_ok=True)
        for row in rows:
            # Under a name of its own first, so that no reader sees half a page.
            with open(f"{at}/.{row['name']}.{os.getpid()}", "w") as f:
                f.write(json.dumps({"items": json.loads(row["items"]), "next": row["next"]}, ensure_ascii=False))
            os.replace(f.name, f"{at}/{row['name']}.json")

    listed.foreachPartition(write)


def run_to_end(stream: DataFrame, checkpoint: str, path: str) -> None:
    """Append a stream's rows to files until its source has no more for now, then stop: a chain at its end has none."""
    query = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("parquet").start(path)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
