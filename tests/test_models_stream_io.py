"""Model comparison with a missing model; JSON sample decoding."""

from pyspark.sql import functions as F

from early_warning import fixtures as fx
from early_warning.operators import models
from early_warning.streaming import jobs


def test_compare_marks_missing_models_unavailable(spark, sf_dir):
    frame = models.model_frame(fx.readings(spark, sf_dir), fx.CHANNELS).persist()
    lr = models.fit(frame, "lr")
    reg = spark.createDataFrame([("lr", "Linear"), ("rf", "Tree")], "model_id string, family string")
    out = {r.model_id: r for r in models.compare(frame.where(F.col("split") == "test"), {"lr": lr}, reg).collect()}
    assert out["rf"].unavailable and not out["lr"].unavailable
    assert out["lr"].total_windows == frame.where(F.col("split") == "test").count()
    assert 0.0 <= out["lr"].peak_prob <= 1.0
    assert models.fallback_model("transformer", ["xgb", "lr"], "xgb") == "xgb"
    frame.unpersist()


def test_decode_samples_json(spark):
    raw = spark.createDataFrame(
        [(1, '{"timestamp": "2024-01-01 00:00:01", "sensors": {"ch1": 1.5, "ch2": 2, "extra": 9}}'),
         (2, '{"timestamp": "bad", "sensors": {"ch1": 3.0}}')], "seq long, value string")
    rows = {r.seq: r for r in jobs.decode_samples(raw, ["ch1", "ch2"]).collect()}
    assert rows[1].ch1 == 1.5 and rows[1].ch2 == 2.0 and rows[1].ts is not None
    assert rows[2].ch2 is None and rows[2].ts is None


def test_sweep_two_configs_and_selection(spark, sf_dir):
    from early_warning.functions import scalars
    from early_warning.operators import metrics
    frame = models.model_frame(fx.readings(spark, sf_dir), fx.CHANNELS).persist()
    cfgs = scalars.sweep_configs(spark).where("config_no IN (0, 53)")
    res = models.sweep(frame, cfgs, metrics.threshold_grid(spark), max_iter=20)
    assert res.count() == 2
    best = metrics.select_best(res, "val_score").first()
    assert best.config_no in (0, 53) and 0.45 <= best.best_t <= 0.75 + 1e-9
    frame.unpersist()
