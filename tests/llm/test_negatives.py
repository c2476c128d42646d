"""Hard negatives against a brute-force search."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tillstar.llm import negatives

ROWS = "vec_id bigint, embedding array<double>, label int, rid string, score int, anchor int"


def brute(rows, every=3, k=5, m=3, low=50, high=95):
    fit = []
    for vec_id, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fit.append((vec_id, [math.floor(256 * x) for x in v], label))
    cut = lambda s: max(-(2**63), min(2**63 - 1, s))
    wide = lambda s: max(1 - 10**38, min(10**38 - 1, s))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for i, (a, v, label) in enumerate(fit):
        if a is None or a % every:
            continue
        scored = [
            (wide(sum(x * y for x, y in zip(v, w))), b, of) for j, (b, w, of) in enumerate(fit) if j != i and len(w) == len(v)
        ]
        near = sorted((r for r in scored if r[2] == label), key=order)[:k]
        for s, b, _ in near:
            hard = sorted((r for r in scored if r[2] != label and low * s <= 100 * r[0] <= high * s), key=order)[:m]
            out += [(a, b, n, c, cut(s), cut(t)) for n, (t, c, _) in enumerate(hard, 1)]
    return sorted(out, key=repr)


def mined(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    got = negatives.hard_negatives(df, anchor=F.col("vec_id") % 3 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()), key=repr)


def row(vec_id, v, label):
    return vec_id, v, label, "r", 1, 2


@pytest.fixture()
def small_blocks(monkeypatch):
    """More blocks than one, also within a label."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 16)


def test_random_vectors(spark, small_blocks):
    rng = random.Random(3)
    rows = [row(i, [rng.gauss(0, 0.2) for _ in range(6)], rng.choice([0, 0, 0, 1, 2])) for i in range(150)]
    assert mined(spark, rows) == brute(rows) and brute(rows)


def test_ties_and_repeated_rows(spark, small_blocks):
    rng = random.Random(8)
    rows = [row(i % 40, [rng.choice([-0.25, 0.0, 0.25, 0.5]) for _ in range(3)], i % 2) for i in range(90)]
    rows += [row(3, [0.5, 0.5, 0.5], 0)] * 40 + [row(9, [0.5, 0.25, 0.5], 1)] * 30
    assert mined(spark, rows) == brute(rows) and brute(rows)


def test_odd_rows(spark):
    rng = random.Random(5)
    some = [row(i, [rng.uniform(-1, 1) for _ in range(4)], i % 3) for i in range(60)]
    odd = [
        row(3, None, 1), row(6, [1.0, None, 0.0, 0.0], 1), row(9, [float("nan"), 1.0, 1.0, 1.0], 1), row(12, [float("inf")] * 4, 1),
        row(15, [1.0] * 4, None), row(None, [0.5, 0.1, 0.2, -0.2], 0), row(None, [0.5, 0.1, 0.2, -0.3], 1), row(18, [], 0), row(21, [], 0),
        row(22, [], 1), row(24, [0.5, 0.5], 1), row(25, [0.5, 0.25], 1), row(26, [0.25, 0.5], 2), row(27, [0.0] * 4, 1), row(-30, [0.3] * 4, -7),
        row(33, [1e30, 2.0, -3.0, 1e-9], 0), row(36, [-1e30, 2e12, 3.0, 0.0], 1), row(39, [1e12, -1e11, 0.0, 0.0], 0),
    ]
    assert mined(spark, some + odd) == brute(some + odd)


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [row(1, None, 1)]) == []


def test_walk_stops_early_with_whole_results():
    import numpy as np

    rng = np.random.default_rng(1)
    v = np.floor(rng.normal(size=(2000, 2)) * 200)
    lists = negatives.Lists(v, np.arange(2000), np.arange(2000), np.zeros(2000, dtype=bool), np.zeros(2000, dtype=np.int64))
    anchor, accept = np.array([150.0, -90.0]), np.ones(2000, dtype=bool)
    met = 0
    for new, _, threshold in lists.walk(anchor):
        met += len(new)
        if threshold is not None and threshold < np.sort(v @ anchor)[-5]:
            break
    assert met < 600
    scores = sorted(((-int(s), i) for i, s in enumerate(v @ anchor)))
    [best] = lists.best(anchor, accept, [(None, None)], 5)
    assert best == [(-s, i, i) for s, i in scores[:5]]
    low, high = -scores[60][0], -scores[30][0]
    [best] = lists.best(anchor, accept, [(low, high)], 3)
    assert best == [(-s, i, i) for s, i in [x for x in scores if low <= -x[0] <= high][:3]]
