import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, k=5):
    good = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, label, [math.floor(256 * x) for x in v]))
    out = []
    for i, label, v in {(i, label, tuple(v)) for i, label, v in good if i % every == 0}:
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in good if j != i and len(w) == len(v)]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:k]:
            far = sorted(x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s)[:k]
            out += [(i, j, n, b, -s, -t) for n, (t, b, _) in enumerate(far, 1)]
    return sorted(out)


def make(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "v", "dim", "block", "pack", "group", "top", "score", "rank", "id", "vector"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def f32(x):
    return float(np.float32(x))


def check(spark, rows, **kwargs):
    got = sorted(tuple(r) for r in negatives.mine(make(spark, rows).repartition(3), **kwargs).collect())
    assert got == brute(rows, **{"every": kwargs.get("every", 100)})
    return got


@pytest.mark.parametrize("dim", [40, 3])
def test_every_window(spark, monkeypatch, dim):
    monkeypatch.setattr(negatives, "BYTES", 4 * dim * 37)
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    monkeypatch.setattr(negatives, "HELD", 2)
    rng = random.Random(dim)
    centres = [[rng.gauss(0, 0.2) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(600):
        c = rng.randrange(4)
        rows.append((i, [f32(x + rng.gauss(0, 0.1)) for x in centres[c]], rng.choice([c, c, 7])))
    # A third of all rows are one vector, under two labels.
    rows += [(i, rows[0][1], i % 2) for i in range(600, 900)]
    assert len(check(spark, rows, every=50)) > 100


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (None, [1.0, 1.0], 1), (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [0.5, 0.5], 2), (1, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.9, 1.0], 2),
        (3, None, 1), (4, [None, 1.0], 2), (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (7, [1.0, 0.9], None), (8, [], 1), (100, [], 2), (9, [], 1), (10, [], 2),
        (200, [1.0], 1), (11, [2.0], 1), (12, [1.75], 3), (300, [-1.0, -0.1], 3), (13, [1.0, 0.0], 3), (14, [1.0, 0.1], 1), (400, [0.0, 0.0], 3),
        (500, [0.001] * 5_000, 1), (15, [1.0] * 5_000, 1), (16, [0.99] * 5_000, 2), (600, [300_000.0] * 40, 1), (17, [300_000.0] * 40, 1), (18, [299_999.0] * 40, 2),
    ]
    assert check(spark, rows)


def test_scaled_components_beyond_the_limit_take_no_part(spark):
    rows = [(0, [1.0], 1), (1, [1e30], 1), (2, [1.0], 2), (3, [1.0], 1)]
    assert [tuple(r) for r in negatives.mine(make(spark, rows)).collect()] == [(0, 3, 1, 2, 65536, 65536)]


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(100, [1.0], 1)], [(100, [1.0], 1), (1, [1.0], 2)], [(100, None, None)]])
def test_few_rows(spark, rows):
    assert negatives.mine(make(spark, rows)).count() == 0


def test_scan_reads_less_than_all_dimensions():
    rng = np.random.default_rng(3)
    data = np.round(rng.normal(0, 5, (64, 2_000)))
    anchor = np.round(256 * 0.9 ** np.arange(64.0)) * rng.choice([-1, 1], 64)
    best, sizes = negatives.Nearest({"id": -1, "label": 0, "key": "k"}, 5), []

    def open_(least, greatest):
        alive = best.open_(least, greatest)
        sizes.append(int(alive.sum()))
        return alive

    at, score = negatives.scan(anchor, data, data.min(axis=1), data.max(axis=1), np.arange(2_000), open_)
    exact = anchor @ data
    assert set(np.argsort(-exact)[:5]) <= set(at) and (score == exact[at]).all()
    assert sizes[-1] < 20 and sizes[2] < 1_000


def test_copies_of_the_anchors_are_not_broadcast(spark):
    rows = make(spark, [(i, [f32(i % 7), f32(i % 5)], i % 3) for i in range(200)])
    table = negatives.stored(negatives.blocks(rows, "vec_id", F.col("label"), "embedding", 256), "blocks")
    found = negatives._scans(table, negatives.stored(negatives.anchors(table, 100), "anchors"), lambda x: negatives.Nearest(x, 5))
    assert found.count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [group" in plan and "BroadcastHashJoin [group" not in plan
    # each side is dealt out once
    assert plan.split("Initial Plan")[-1].count("hashpartitioning(group") == 2
