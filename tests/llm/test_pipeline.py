"""The stages of the pipeline against brute force, each on what its predecessor kept."""

import pytest
from test_decontaminate import brute as contamination
from test_line_dedup import brute as repeated_lines
from test_near_dedup import brute as near_groups

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What comes out of each stage, by its name."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["start"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(kept):
    for name, df in kept.items():
        assert name == "pack" or sorted(df.columns) == sorted(corpus_pipeline.COLUMNS)


def test_language_keeps_what_has_letters(kept):
    before, after = texts(kept["start"]), texts(kept["language_id"])
    assert set(after) <= set(before) and all(after[d] == before[d] for d in after)
    assert len(after) >= 0.99 * len(before) and all(any(map(str.isalpha, before[d] or "")) for d in after)


def test_lines_equal_direct_search(kept):
    want = repeated_lines([(d, t or "") for d, t in texts(kept["language_id"]).items()], 50)
    assert texts(kept["line_dedup"]) == {d: t for d, (t, removed) in want.items() if not removed or t.strip()}


def test_one_of_each_group_stays(kept):
    groups = near_groups(sorted(texts(kept["line_dedup"]).items()), 5, 80)
    assert set(texts(kept["near_dedup"])) == {d for d, (size, least) in groups.items() if d == least}


def test_contaminated_documents_go(spark, kept):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = contamination(list(texts(kept["near_dedup"]).items()), items)
    assert set(texts(kept["decontaminate"])) == {d for d, row in judged.items() if not row[-1]}


def test_all_that_is_left_is_packed(kept):
    packed = kept["pack"].collect()
    assert {r.doc_id for r in packed} == set(texts(kept["decontaminate"]))
    assert all(r.offset + r.length <= 1024 for r in packed)
