"""The similarity join against the nested loop, and what it saves."""

import random
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from collatio.operators import similarity

WORDS = st.lists(st.text(alphabet="abcdß漢 é", max_size=12), min_size=1, max_size=12)


def shared(a, b):
    return 2.0 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b))


def ratio(a, b, junk=False):
    return SequenceMatcher(None, a, b, autojunk=junk).ratio()


def nested_loop(left, right, at_least, met=lambda a, b: True, junk=False):
    """What the operator says, pair by pair: id -> (id, similarity). Rows are (id, ord, key, ...)."""
    best = {}
    for a in left:
        for b in right:
            if a[2] and b[2] and met(a, b) and (r := ratio(a[2], b[2], junk)) >= at_least:
                best[a[0]] = max(best.get(a[0], (-1,)), (r, -a[1], -b[1], b[0]))
    return {k: (v[3], round(v[0], 3)) for k, v in best.items()}


def found(df):
    return {r.l_id: (r.r_id, r.similarity) for r in df.collect()}


@settings(max_examples=200, deadline=None)
@given(WORDS, WORDS)
def test_bounds_hold(left, right):
    pairs = [(a, b) for a in left for b in right if a and b]
    if not pairs:
        return
    given_bounds = np.array([shared(a, b) for a, b in pairs])
    bounds = similarity.subsequence_bounds([a for a, _ in pairs], [b for _, b in pairs], given_bounds)
    for (a, b), low, high in zip(pairs, bounds, given_bounds, strict=True):
        assert ratio(a, b) <= low + 1e-12 and low <= high


def test_long_and_odd_keys_keep_their_bound():
    keys = ["a" * 65, "ab" * 40, "a\0b", "ab", "漢字" * 32, "x" * 300]
    pairs = [(a, b) for a in keys for b in keys]
    bounds = similarity.subsequence_bounds([a for a, _ in pairs], [b for _, b in pairs], np.array([shared(a, b) for a, b in pairs]))
    assert all(ratio(a, b) <= x + 1e-12 <= shared(a, b) + 1e-9 for (a, b), x in zip(pairs, bounds, strict=True))


def random_rows(rng, n, blocks=3):
    keys = ["".join(rng.choices("abcdefgh ", k=rng.randint(0, 14))) for _ in range(n // 2)]
    keys += ["".join(c if rng.random() < 0.8 else rng.choice("xyz") for c in rng.choice(keys)) for _ in range(n - len(keys))]
    return [(i, (7 * i) % n, k if rng.random() < 0.97 else None, rng.choice([None, *range(blocks)]), rng.sample(range(blocks), rng.randint(0, blocks))) for i, k in enumerate(keys)]


SCHEMA = "id int, ord int, key string, block int, list array<int>"


@pytest.mark.parametrize("at_least", [0.3, 0.6, 0.85, 1.0])
def test_candidates_are_the_pairs_of_the_bound(spark, at_least):
    """No pair is scored that the shared characters exclude, and none that they allow is lost."""
    rng = random.Random(1)
    left, right = random_rows(rng, 90), random_rows(rng, 110)
    got = similarity.candidates(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA).repartition(3), at_least).collect()
    want = {(a[0], b[0]): shared(a[2], b[2]) for a in left for b in right if a[2] and b[2] and shared(a[2], b[2]) >= at_least}
    assert {(r.l_id, r.r_id): r.bound for r in got} == want and len(got) == len(want) < 90 * 110


@pytest.mark.parametrize(("at_least", "junk", "small"), [(0.3, False, 256), (0.6, True, 0), (0.6, False, 20), (0.9, False, 0)])
def test_best_matches_equal_the_nested_loop(spark, monkeypatch, at_least, junk, small):
    monkeypatch.setattr(similarity, "SMALL_BLOCK", small)
    rng = random.Random(at_least)
    left, right = random_rows(rng, 80), random_rows(rng, 90)
    left += [(1000, 1, "hot key", 1, []), (1000, 0, "hot kez", 1, []), (None, 0, "no id", 1, [1])]
    right += [(2000 + i, 200 - i, "hot key", 1, [1, 1, 2]) for i in range(60)] + [(None, 9, "no id at all", 1, None)]
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    assert found(similarity.best_matches(a, b, at_least, junk=junk)) == nested_loop(left, right, at_least, junk=junk)
    same = lambda x, y: x[3] is not None and x[3] == y[3]
    assert found(similarity.best_matches(a, b, at_least, ["block"], junk=junk)) == nested_loop(left, right, at_least, same, junk)
    held = lambda x, y: x[3] is not None and x[3] in (y[4] or [])
    assert found(similarity.best_matches(a, b, at_least, contains=("block", "list"), junk=junk)) == nested_loop(left, right, at_least, held, junk)
    both = lambda x, y: same(x, y) and held(x, y)
    assert found(similarity.best_matches(a, b, at_least, ["block"], ("block", "list"), junk)) == nested_loop(left, right, at_least, both, junk)


def test_few_ratios_are_taken(spark, monkeypatch, tmp_path):
    """Of 40,000 pairs of names most are excluded by shared characters, most of the rest by their order or a better partner."""
    rng = random.Random(4)
    words = ["almond", "antique", "aquamarine", "azure", "beige", "bisque", "black", "blanched", "blue", "blush", "brown", "burlywood", "chiffon", "coral", "cornflower", "cream"]
    names = [" ".join(rng.sample(words, 3)) for _ in range(200)]
    left = [(i, i, n) for i, n in enumerate(names)]
    right = [(i, i, n[:-1] + "x") for i, n in enumerate(names)]
    a, b = (spark.createDataFrame(x, "id int, ord int, key string") for x in (left, right))
    pairs = similarity.candidates(a, b, 0.7).count()
    rows = similarity.scored(similarity.candidates(a, b, 0.7), 0.7).count()
    assert pairs < 20_000 and 200 <= rows < 600
    assert found(similarity.best_matches(a, b, 0.7)) == nested_loop(left, right, 0.7)


def test_long_keys_with_junk(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("ab", k=rng.choice([150, 199, 200, 260]))) for _ in range(8)]
    rows = [(i, i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, ord int, key string")
    other = spark.createDataFrame([(i, i, t[::-1]) for i, _, t in rows], "id int, ord int, key string")
    for junk in (False, True):
        assert found(similarity.best_matches(df, other, 0.2, junk=junk)) == nested_loop(rows, [(i, i, t[::-1]) for i, _, t in rows], 0.2, junk=junk)


def test_empty_tables_and_thresholds(spark):
    none = spark.createDataFrame([], "id int, ord int, key string")
    one = spark.createDataFrame([(1, 1, "a"), (2, 2, "")], "id int, ord int, key string")
    assert found(similarity.best_matches(none, one, 0.5)) == found(similarity.best_matches(one, none, 0.5)) == {}
    assert found(similarity.best_matches(one, one, 1.0)) == {1: (1, 1.0)}
    with pytest.raises(ValueError, match="at_least"):
        similarity.candidates(one, one, 0)


def test_equal_keys_pair_once_a_block(spark, monkeypatch):
    """Copies on both sides are found by the row that stands for them, through no broadcast of rows that grow by their tokens."""
    left = [(i, (5 * i) % 600, f"name {i % 3}", i % 2, [0, 1]) for i in range(600)] + [(1, -1, "name 2", 1, []), (None, 0, "name 1", 0, [])]
    right = [(i, -i, f"nome {i % 3}", i % 2, [i % 2, i % 2]) for i in range(600)]
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    pairs = []
    whole = similarity.scored

    def counted(met, *rest):
        pairs.append(met.count())
        assert "BroadcastHashJoin" not in met._jdf.queryExecution().executedPlan().toString()
        return whole(met, *rest)

    monkeypatch.setattr(similarity, "scored", counted)
    same = lambda x, y: x[3] == y[3]
    assert found(similarity.best_matches(a, b, 0.5, ["block"])) == nested_loop(left, right, 0.5, same)
    held = lambda x, y: x[3] in y[4]
    assert found(similarity.best_matches(a, b, 0.5, contains=("block", "list"))) == nested_loop(left, right, 0.5, held)
    assert pairs == [18, 18]
