"""Kernel model against an exact solver, the store of fitted objects, scorers of the user's own."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from early_warning.operators import models
from early_warning.operators.store import Store


def _frame(spark, n=80, seed=5):
    """Two rings: no line parts them."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        r, a = (1.0 if k % 2 else 3.0) + rng.normal(0, 0.3), rng.uniform(0, 2 * np.pi)
        rows.append(("s", "train" if k % 4 else "test", k, float(k % 2), [float(r * np.cos(a)), float(r * np.sin(a))]))
    df = spark.createDataFrame(rows, "series_id string, split string, idx long, label double, x array<double>")
    for c in ("features_raw", "features_tf", "features_seq"):
        df = df.withColumn(c, array_to_vector("x"))
    return models.written(df), rows


def _exact_margins(x, y, gamma, at, steps=20000):
    """Support vectors with C = 1 by the most violating pair of the dual."""
    kern = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    q, a = kern * np.outer(y, y), np.zeros(len(x))
    g = -np.ones(len(x))
    for _ in range(steps):
        up = ((y > 0) & (a < 1)) | ((y < 0) & (a > 0))
        low = ((y > 0) & (a > 0)) | ((y < 0) & (a < 1))
        i = max(np.flatnonzero(up), key=lambda k: -y[k] * g[k])
        j = min(np.flatnonzero(low), key=lambda k: -y[k] * g[k])
        if -y[i] * g[i] + y[j] * g[j] < 1e-6:
            break
        step = (-y[i] * g[i] + y[j] * g[j]) / max(kern[i, i] + kern[j, j] - 2 * kern[i, j], 1e-12)
        step = min(step, (1 - a[i]) if y[i] > 0 else a[i], a[j] if y[j] > 0 else (1 - a[j]))
        a[i] += y[i] * step
        a[j] -= y[j] * step
        g += (q[:, i] * y[i] - q[:, j] * y[j]) * step
    b = ((-y[i] * g[i]) + (-y[j] * g[j])) / 2
    return np.exp(-gamma * ((at[:, None] - x[None]) ** 2).sum(-1)) @ (a * y) + b


def test_kernel_features_give_the_kernel_and_exact_margins(spark):
    frame, rows = _frame(spark)
    train = [r for r in rows if r[1] == "train"]
    test = sorted((r for r in rows if r[1] == "test"), key=lambda r: r[2])
    x, y = np.array([r[4] for r in train]), np.array([1.0 if r[3] else -1.0 for r in train])
    model = models.fit(frame, "svm")
    k = model.kernel
    assert len(k.landmarks) == len(train)  # all training rows: the map is exact
    assert k.gamma == pytest.approx(1 / (2 * x.var()))
    z = np.exp(-k.gamma * ((x[:, None] - k.landmarks[None]) ** 2).sum(-1)) @ k.whiten
    assert np.allclose(z @ z.T, np.exp(-k.gamma * ((x[:, None] - x[None]) ** 2).sum(-1)), atol=1e-6)
    got = models.score(model, frame.where("split = 'test'"), "svm").orderBy("idx").collect()
    margins = np.array([np.log(r.p / (1 - r.p)) for r in got])
    want = _exact_margins(x, y, k.gamma, np.array([r[4] for r in test]))
    assert np.abs(margins - want).max() < 0.1
    assert all((m > 0) == bool(r[3]) for m, r in zip(margins, test) if abs(m) > 0.1)


def test_few_landmarks_bound_the_map(spark):
    frame, rows = _frame(spark, n=200)
    k = models.kernel_map(frame.where("split = 'train'"), landmarks=20)
    assert len(k.landmarks) == 20 and k.whiten.shape[0] == 20 and k.whiten.shape[1] <= 20


def test_store_round_trip_in_a_new_session(spark, tmp_path):
    frame, _ = _frame(spark)
    store = Store(spark, str(tmp_path / "store"))
    svm, lr = models.fit(frame, "svm"), models.fit(frame, "lr")
    assert store.save_model("svm", svm) == 1 and store.save_model("lr", lr) == 1
    assert store.save_model("lr", lr) == 2
    store.save_table("thresholds", spark.createDataFrame([("lr", 0.45)], "model_id string, t double"))
    again = Store(spark.newSession(), store.root)
    for name, fitted in (("svm", svm), ("lr", lr)):
        loaded = again.load_model(name)
        assert loaded.model_id == name
        want = models.score(fitted, frame, name).orderBy("idx").collect()
        assert models.score(loaded, frame, name).orderBy("idx").collect() == want
    assert [r.version for r in again.versions("lr").orderBy("version").collect()] == [1, 2]
    assert again.load_table("thresholds").collect() == [("lr", 0.45)]
    assert again.available(["xgb", "lr"]) == ["lr"]
    assert models.fallback_model("xgb", again.available(["xgb", "lr"]), "lr") == "lr"


def test_store_shows_committed_versions_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    one = spark.createDataFrame([(1,)], "a int")
    one.write.parquet(store._folder("scaler"))  # a writer that died before its record
    with pytest.raises(LookupError):
        store.load_table("scaler")
    store.save_table("scaler", one)
    store.save_table("scaler", spark.createDataFrame([(2,)], "a int"))
    assert store.load_table("scaler").first().a == 2 and store.load_table("scaler", 1).first().a == 1
    for wrong in (lambda: store.load_table("scaler", 3), lambda: store.load_model("scaler"), lambda: store.load_model("none")):
        with pytest.raises(LookupError):
            wrong()
    with pytest.raises(ValueError):
        store.save_table("../out", one)


def test_external_scorer_gives_a_probability_per_window(spark):
    frame, rows = _frame(spark)

    def load():
        def margins(x):
            assert x.shape[1:] == (2, 1)
            return 5.0 - 2.0 * np.sqrt((x[:, :, 0] ** 2).sum(axis=1))
        return margins
    got = models.external_score(frame, "ring", load, "x", (2, 1), logits=True, batch_rows=7).orderBy("idx").collect()
    assert len(got) == len(rows) and all(0 <= r.p <= 1 and r.model_id == "ring" for r in got)
    assert all(r.p == pytest.approx(1 / (1 + np.exp(-(5 - 2 * np.hypot(*r.x))))) for r in got)
    short = frame.withColumn("x", F.when(F.col("idx") > 3, F.col("x")))
    assert models.external_score(short, "ring", load, "x", (2, 1)).count() == len(rows) - 4
