"""Hard negatives over R-trees against all inner products."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from early_warning.llm import negatives as ng

SCHEMA = "vec_id long, embedding array<float>, label int"
MOST = (1 << 63) - 1


def brute_rows(rows):
    out = set()
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(v is None or not math.isfinite(v) for v in vector):
            continue
        out.add((vec_id, label, tuple(min(MOST, max(-MOST - 1, math.floor(256 * float(np.float32(v))))) for v in vector)))
    return out


def brute(rows, modulus=50, n_pos=5, n_neg=3):
    own = brute_rows(rows)
    out = []
    clip = lambda v: min(MOST, max(-MOST - 1, v))
    for a in own:
        if a[0] % modulus:
            continue
        scored = [(-clip(sum(x * y for x, y in zip(a[2], b[2]))), b[0], b[1]) for b in own if b[0] != a[0]]
        scored.sort()
        for p in [s for s in scored if s[2] == a[1]][:n_pos]:
            fit = [s for s in scored if s[2] != a[1] and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]][:n_neg]
            out += [(a[0], p[1], i, n[1], -p[0], -n[0]) for i, n in enumerate(fit, 1)]
    return sorted(out)


def check(spark, rows, modulus=50, extra=()):
    df = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit(f"own {c}").alias(c) for c in extra))
    found = ng.mine_negatives(ng.integer_rows(df), F.col("id") % modulus == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(tuple(r) for r in found.collect())
    assert got == brute(rows, modulus)
    return got


def clustered(rng, n, dims, labels):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    return [(i, [c + rng.gauss(0, .3) for c in rng.choice(centres)], rng.randrange(labels)) for i in range(n)]


def test_small_trees_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(ng, "TREE_ROWS", 40)
    monkeypatch.setattr(ng, "LEAF_ROWS", 4)
    monkeypatch.setattr(ng, "FAN_OUT", 3)
    monkeypatch.setattr(ng, "BOX_BLOCK", 5)
    monkeypatch.setattr(ng, "ROUND_TREES", 2)
    assert len(check(spark, clustered(random.Random(5), 600, 6, 4), 20)) > 300


def test_ties_copies_and_repeated_rows(spark, monkeypatch):
    """A third of the rows hold one vector; scores and ids tie everywhere; rows repeat; ids stand twice."""
    monkeypatch.setattr(ng, "TREE_ROWS", 32)
    monkeypatch.setattr(ng, "LEAF_ROWS", 4)
    rng = random.Random(6)
    rows = [(i, [1.0, 2.0, 0.5], i % 3) if i % 3 == 0 else (i, [rng.choice([0.0, 1.0, 1.5, 2.0]) for _ in range(3)], rng.randrange(3))
            for i in range(240)]
    rows += rows[:40] + [(100, [2.0, 2.0, 2.0], 1), (7, [1.0, 1.0, 1.0], 2)]
    assert check(spark, rows, 25)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.1], 1), (2, [0.7, 1.0], 0), (3, [0.9, 1.0, 5.0], 0), (4, [], 1), (5, None, 1),
            (None, [1.0, 1.0], 0), (6, [1.0, nan], 0), (7, [inf, 1.0], 0), (8, [None, 1.0], 0), (9, [1.0, 1.0], None),
            (50, [-1.0, -1.0], 0), (-50, [0.5, 0.5, 0.5], 2), (100, [3.0], 1), (101, [2.0], 0), (150, [], 2)]
    assert check(spark, rows, extra=("id", "x", "block", "anchor", "tree", "query"))
    assert check(spark, []) == []
    assert check(spark, [(0, [1.0], 1)]) == []


def test_huge_components_are_exact(spark):
    rng = random.Random(7)
    rows = [(i, [rng.uniform(0, 1) * 4e6, rng.uniform(0, 1), 1e6], rng.randrange(2)) for i in range(60)]
    assert check(spark, rows, 10)
    far = [(i, [1e30 if i % 4 else 1e-3, -1.0], i % 2) for i in range(20)]
    found = ng.mine_negatives(ng.integer_rows(spark.createDataFrame(far, SCHEMA)), F.col("id") % 10 == 0)
    assert found.count() >= 0


@pytest.mark.parametrize("kind", [float, object])
def test_boxes_hold_all_products(kind):
    rng = np.random.default_rng(2)
    x = rng.integers(-100, 100, (200, 5)).astype(kind)
    a = rng.integers(-100, 100, (7, 5)).astype(kind)
    least, most = ng._intervals(a, x.min(0)[None], x.max(0)[None])
    scores = a @ x.T
    assert (least[:, 0] <= scores.min(1)).all() and (scores.max(1) <= most[:, 0]).all()


def test_packing_keeps_all_rows():
    rng = np.random.default_rng(3)
    for shape in ((1, 3), (1000, 2), (777, 40), (300, 0)):
        order, ends = ng.str_order(rng.integers(0, 9, shape))
        assert sorted(order.tolist()) == list(range(shape[0]))
        assert ends[0] == 0 and ends[-1] == shape[0] and np.diff(ends).max() <= ng.LEAF_ROWS and np.diff(ends).min() > 0
