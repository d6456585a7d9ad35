"""Curves in score ranges against a sweep over all scores."""
import random

import pytest

from early_warning.operators import metrics


def sweep(rows):
    """(threshold, tp, fp) from the highest score down, and the area under the curve."""
    out, area, tp, fp = [], 0.0, 0, 0
    total = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    for p in sorted({p for p, _ in rows}, reverse=True):
        pos, neg = sum(1 for q, y in rows if q == p and y), sum(1 for q, y in rows if q == p and not y)
        if all(total):
            area += neg / total[1] * (2 * tp + pos) / total[0] / 2
        tp, fp = tp + pos, fp + neg
        out.append((p, tp, fp))
    return out, area if all(total) else None


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(4)
    return {
        "spread": [(rng.random(), rng.randrange(2)) for _ in range(400)],
        "ties": [(rng.choice([0.0, 0.1, 0.1, 0.9, 1.0]), rng.randrange(2)) for _ in range(300)],
        "one class": [(rng.random(), 0) for _ in range(40)],
        "one score": [(0.5, 1), (0.5, 0)],
        "skewed": [(10 ** -rng.uniform(0, 9), int(rng.random() < .1)) for _ in range(300)],
    }


@pytest.mark.parametrize("n_ranges", [1, 3, 256])
def test_curve_and_area(spark, groups, n_ranges):
    df = spark.createDataFrame([(g, p, y) for g, rows in groups.items() for p, y in rows], "g string, p double, y int")
    got = {}
    for r in metrics.curve_points(df, ["g"], n_ranges=n_ranges).collect():
        got.setdefault(r.g, []).append((r.threshold, r.tp, r.fp))
        assert (r.P, r.N) == (sum(y for _, y in groups[r.g]), sum(1 - y for _, y in groups[r.g]))
    areas = {r.g: r.auc for r in metrics.roc_auc(df, ["g"], n_ranges=n_ranges).collect()}
    for g, rows in groups.items():
        points, area = sweep(rows)
        assert sorted(got[g], reverse=True) == points
        assert areas[g] == area if area is None else abs(areas[g] - area) < 1e-12


def test_no_window_over_a_whole_group(spark, groups):
    df = spark.createDataFrame([("a", p, y) for p, y in groups["spread"]], "g string, p double, y int")
    plan = metrics.curve_points(df, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "p#" in line.split("windowspecdefinition")[-1]:
            assert "_range#" in line


def test_grid_counts_each_row_once(spark, groups):
    df = spark.createDataFrame([("a", p, y) for p, y in groups["ties"] + groups["spread"]], "g string, p double, y int")
    grid = spark.createDataFrame([(0, 0.1), (1, 0.5), (2, 0.5), (3, 0.9)], "k long, t double")
    rows = groups["ties"] + groups["spread"]
    for r in metrics.threshold_search(df, ["g"], grid).collect():
        tp = sum(1 for p, y in rows if p > r.t and y)
        fp = sum(1 for p, y in rows if p > r.t and not y)
        fn = sum(1 for p, y in rows if p <= r.t and y)
        assert abs(r.class1_f1 - 2 * tp / (2 * tp + fp + fn)) < 1e-12
