"""Forests and boosted trees over binned features."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from early_warning.operators import models, trees
from early_warning.operators.store import Store


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 25, (400, 5)).astype(float)
    y = (x[:, 0] + x[:, 1] * x[:, 2] / 10 + rng.normal(0, 6, 400) > 30).astype(float)
    rows = [(k % 7, "test" if k % 5 == 0 else "train", k, float(y[k]), x[k].tolist()) for k in range(400)]
    df = spark.createDataFrame(rows, "series_id long, split string, idx long, label double, x array<double>")
    return models.written(df.select("series_id", "split", "idx", "label", array_to_vector("x").alias("features_raw")))


def _p(df):
    return {r.idx: r.p for r in df.collect()}


def test_a_tree_parts_the_classes_and_its_first_split_is_the_best():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 32, (3, 500)).astype("uint8"), rng.integers(0, 2, 500).astype("uint8")
    y[x[1] > 20] = 1

    def gini(part):
        return len(part) * (1 - np.mean(part) ** 2 - np.mean(1 - part) ** 2) if len(part) else 0.0
    for w in (None, rng.poisson(1.0, 500).astype("float64")):
        t = trees.grow_tree(x, y, w, 3, 30, rng)
        k = np.arange(500) if w is None else np.repeat(np.arange(500), w.astype(int))
        best = min((gini(y[k][x[f, k] <= c]) + gini(y[k][x[f, k] > c]), f, c) for f in range(3) for c in range(31))
        cut = gini(y[k][x[t[0][0], k] <= t[1][0]]) + gini(y[k][x[t[0][0], k] > t[1][0]])
        assert cut == pytest.approx(best[0])
        assert ((trees.leaf_values(t, x[:, k]) > 0.5) == y[k]).mean() > 0.98


def test_sorted_and_counted_nodes_agree(monkeypatch):
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 32, (6, 800)).astype("uint8"), rng.integers(0, 2, 800).astype("uint8")
    for w in (None, rng.poisson(1.0, 800).astype("float64")):
        monkeypatch.setattr(trees, "WIDTHS", (4, 8, 16))
        a = trees.grow_tree(x, y, w, 6, 9, rng)
        monkeypatch.setattr(trees, "WIDTHS", (1,))
        b = trees.grow_tree(x, y, w, 6, 9, rng)
        assert np.allclose(trees.leaf_values(a, x).mean(), trees.leaf_values(b, x).mean(), atol=0.02)
        assert a[0][:3].tolist() == b[0][:3].tolist() and abs(len(a[0]) - len(b[0])) < 0.1 * len(b[0])


@pytest.mark.parametrize("bootstrap", [True, False])
def test_groups_of_trees_are_tasks_and_score_as_one(spark, frame, monkeypatch, bootstrap):
    train = frame.where("split = 'train'")
    m = trees.fit_forest(train, "features_raw", train.count(), 5, trees=9, bootstrap=bootstrap, max_depth=6)
    assert m.trees.count() == 9 and m.trees.select("grp").distinct().count() > 1
    assert len(m.trees.inputFiles()) > 1  # not one task after the other
    at_once = _p(trees.score(m, frame, "features_raw"))
    monkeypatch.setattr(trees, "PASS_NODES", 0)
    grouped = _p(trees.score(m, frame, "features_raw"))
    assert len(at_once) == 400 and all(0 <= v <= 1 for v in at_once.values())
    assert at_once == pytest.approx(grouped)


def test_boosted_trees_are_those_of_spark_ml(frame, monkeypatch):
    train = frame.where("split = 'train'")
    ml = GBTClassifier(featuresCol="features_raw", maxIter=6, maxDepth=3, stepSize=0.1, seed=1).fit(train)
    want = _p(ml.transform(frame).select("idx", vector_to_array("probability")[1].alias("p")))
    monkeypatch.setattr(trees, "SHARE_ROWS", 100)
    size = ("features_raw", train.count(), 5)
    m = trees.fit_boosted(train, *size, rounds=6, depth=3, rate=0.1)
    assert _p(trees.score(m, frame, "features_raw")) == pytest.approx(want, abs=1e-9)
    # a share that is lost in between
    whole, lost = trees._round, []

    def once(sums, r, *rest):
        if r == 3 and not lost:
            lost.append(r)
            raise trees._Lost("share")
        return whole(sums, r, *rest)
    monkeypatch.setattr(trees, "_round", once)
    again = trees.fit_boosted(train, *size, rounds=6, depth=3, rate=0.1)
    assert lost and _p(trees.score(again, frame, "features_raw")) == pytest.approx(want, abs=1e-9)


def test_drawn_rows_and_features(frame):
    train = frame.where("split = 'train'")
    m = trees.fit_boosted(train, "features_raw", train.count(), 5, rounds=8, depth=4, rate=0.3, rows_share=0.8, share=0.8)
    got = trees.score(m, train, "features_raw").agg(F.avg(((F.col("p") > 0.5).cast("int") == F.col("label")).cast("int"))).first()[0]
    assert got > 0.85


def test_tree_models_are_stored(spark, frame, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    train = frame.where("split = 'train'")
    fitted = models.FittedModel("rf", trees=trees.fit_forest(train, "features_raw", 320, 5, trees=4, bootstrap=True))
    store.save_model("rf", fitted)
    want = _p(models.score(fitted, frame, "rf"))
    assert _p(models.score(store.load_model("rf"), frame, "rf")) == want and len(want) == 400
