"""Two-level scans against plain loops, on groups that are cut into many ranges."""

import random

import pytest
from pyspark.sql import functions as F

from collatio.operators import windows
from collatio.operators.scans import Scan

SCHEMA = "g string, o long, t string, v int"


def rows(seed, n=1500):
    rng = random.Random(seed)
    orders = rng.sample(range(10 * n), n)
    # A third of all rows is one group, null is one too, others are small; some orders lie far apart.
    return [(rng.choice(["hot", "hot", "x", "y", None, f"s{rng.randint(0, 40)}"]), o if rng.random() < 0.95 else o + 10**12, rng.choice(["# h", "line", "", None]), rng.choice([0, 0, 1, 2, 3, None])) for o in orders]


def grouped(data):
    found = {}
    for r in sorted(data, key=lambda r: r[1]):
        found.setdefault(r[0], []).append(r)
    return found


def same(df, expected):
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, expected))


@pytest.mark.parametrize("size", [7, 60, 10**6])
def test_scans_equal_loops(spark, size):
    data = rows(size)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    carried, numbered, before, inside, young = [], {}, [], [], []
    for g, members in grouped(data).items():
        head, segment, run, stopped, open_, old = None, 0, 0, False, False, False
        for r in members:
            start = r[2] == "# h"
            head = r[1] if start else head
            carried.append((*r, head))
            segment += start
            if segment:
                numbered.setdefault((g, segment), []).append(r[2])
            run = run + 1 if r[3] == 0 else 0
            stopped = stopped or run >= 3
            before += [] if stopped else [r]
            if start:
                open_ = True
            elif r[2] == "":
                open_ = False
            inside += [r] if open_ and not start else []
            old = old or r[3] == 3
            young += [] if old else [r]
    same(windows.carried_forward(df, "g", "o", F.when(F.col("t") == "# h", F.col("o")), "head", size), carried)
    same(windows.segments(df, "g", "o", F.col("t") == "# h", "t", size), [(*k, "\n".join(t for t in v if t is not None)) for k, v in numbered.items()])
    same(windows.until_empty(df, "g", "o", F.col("v") == 0, 3, size), before)
    same(windows.between_headers(df.fillna("-", ["t"]), "g", "o", F.col("t") == "# h", F.col("t") == "", size), [(*r[:2], "-" if r[2] is None else r[2], r[3]) for r in inside])
    same(windows.until_old(df, "g", "o", F.col("v") == 3, size), young)


def test_one_group_of_all_rows_is_cut(spark):
    """No range holds much more than it aims at, and no window but that over summaries has a whole group."""
    df = spark.range(20_000).selectExpr("'all' AS g", "id * id AS o", "id % 97 = 0 AS start")
    scan = Scan(df, "g", "o", 100)
    sizes = [r["count"] for r in scan.df.groupBy("_key", "_range").count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) >= 200 and max(sizes) <= 200
    out = scan.total(F.when(F.col("start"), 1).otherwise(0), "n").done()
    assert out.agg(F.max("n")).first()[0] == 207 and out.columns == ["g", "o", "start", "n"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 2
    assert Scan(df.limit(0), "g", "o", 1).last(F.col("o"), "x").done().collect() == []
