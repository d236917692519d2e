"""Near-duplicates against all pairs, and the cases that rows can bring."""

import random
import re

import pytest

from collatio.llm import near_dedup
from collatio.llm.components import components

DOCS = "doc_id long, text string"


def brute(rows, n, percent):
    """component_id by comparing every pair of word sets."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return {doc: (len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)}


def corpus(seed, groups, size, edits):
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(3000)]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, size)):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 100_003, " ".join(text)))
    return rows


@pytest.mark.parametrize("ngram,seed", [(2, 1), (5, 2)])
def test_equals_all_pairs(spark, ngram, seed):
    rows = corpus(seed, 40, 12, 8)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(5), ngram=ngram).collect()}
    assert got == brute(rows, ngram, 80)


def test_one_crowded_group_with_strays(spark):
    """Copies of one text with so many edits that many link with few others; blocks must find every link."""
    rng, base = random.Random(5), [f"b{i}" for i in range(100)]
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.randint(2, 9)):
            text[rng.randrange(100)] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(text)))
    result = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3), ngram=2)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in result.collect()} == brute(rows, 2, 80)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "É one"), (7, "é one"), (None, "one"), (8, "x " * 30_000), (8, "x " * 30_000)]
    extra = spark.createDataFrame([(*r, "k") for r in rows], DOCS + ", key string")
    got = sorted(near_dedup.near_duplicates(extra, ngram=2).collect(), key=str)
    assert [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id in (1, 2, 3)] == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]
    assert {(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id in (4, 5, None)} == {(4, 4, True), (5, 4, False), (None, 4, False)}
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id in (6, 7)} == {(6, 6), (7, 7)}
    assert sorted(r.kept for r in got if r.doc_id == 8) == [False, True]


def test_empty(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 500 for i in range(500, 560)}}


@pytest.mark.parametrize("most", [near_dedup.BROADCAST_ROWS, -1])
def test_one_of_each_group_is_kept_with_its_columns(spark, monkeypatch, most):
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", most)
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (2, text + " x"), (3, "own words here"), (3, "own words here"), (4, None), (4, None), (None, text)]
    data = spark.createDataFrame([(*r, i, i, i) for i, r in enumerate(rows)], DOCS + ", kept int, id_key int, _k0 int")
    got = near_dedup.keep_one(data)
    assert got.columns == data.columns and sorted((r.doc_id, r.text) for r in got.collect()) == [(1, text), (3, "own words here"), (4, None), (4, None)]
