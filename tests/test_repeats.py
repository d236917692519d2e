"""Catalogue queries over tables whose values repeat, as those of larger data sets do."""

import duckdb
import pytest

import __spark_entry__  # noqa: F401 (its import registers the queries)
from collatio.catalog.registry import QUERIES, SQL


def test_pages_of_one_url_are_assets_of_their_own(spark, tmp_path):
    pages = [(i, f"https://a.example/{i % 4}", "x" * i) for i in range(12)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["manifest_increment"](spark, str(tmp_path))
    want = duckdb.sql(SQL["manifest_increment"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and got.columns == ["url", "size", "added"]


@pytest.mark.parametrize("name", ["label_pairs", "card_pages", "shop_pages"])
def test_one_split_of_parts_is_dealt_over_the_cores(spark, name):
    """Parts are one row group and so one task's work as they are read."""
    assert QUERIES[name](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
