"""Edge cases of windows, labels, runs and summaries (hand-made rows)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from early_warning.operators import metrics, runs, windows

T0 = dt.datetime(2024, 1, 1)


def _series(spark, n, labels=None):
    rows = [(1, k, T0 + dt.timedelta(seconds=k), float(k), (labels or {}).get(k, 0.0)) for k in range(n)]
    df = spark.createDataFrame(rows, "series_id long, src_row long, ts timestamp, ch1 double, anomaly double")
    return windows.series_index(df, "series_id", ["ts", "src_row"])


@pytest.mark.parametrize("n,expected", [(29, 0), (30, 1), (31, 2)])
def test_window_count(spark, n, expected):
    w = windows.sliding_windows(_series(spark, n), ["ch1"])
    assert w.count() == expected
    if expected:
        first = w.orderBy("idx").first()
        assert len(first.win) == 20 and first.win[0].i == 0 and first.idx == 0


def test_nan_and_null_labels_are_not_anomalies(spark):
    df = _series(spark, 40, {25: float("nan")}).withColumn(
        "anomaly", F.when(F.col("i") == 26, F.lit(None)).otherwise(F.col("anomaly")))
    y = windows.horizon_label(df).where(F.col("i") == 19).first().y
    assert y == 0
    df2 = _series(spark, 40, {25: 1.0})
    assert windows.horizon_label(df2).where(F.col("i") == 19).first().y == 1
    assert windows.horizon_label(df2).where(F.col("i") == 25).first().y == 0


def _scores(spark, ps):
    return spark.createDataFrame([(1, "m", k, p, 0) for k, p in enumerate(ps)],
                                 "series_id long, model_id string, idx long, p double, y int")


def test_runs_and_peak_ties(spark):
    s = _scores(spark, [0.1, 0.6, 0.9, 0.2, 0.9, 0.7, 0.1])
    r = sorted((x.start_idx, x.end_idx, x.peak_prob) for x in runs.anomaly_runs(s).collect())
    assert r == [(1, 2, 0.9), (4, 5, 0.9)]
    summ = runs.score_summary(s).first()
    assert summ.peak_idx == 2 and summ.fault_windows == 4


def test_all_flagged_is_one_run(spark):
    r = runs.anomaly_runs(_scores(spark, [0.7] * 5)).collect()
    assert [(x.start_idx, x.end_idx) for x in r] == [(0, 4)]


def test_no_positives_gives_zero_metrics(spark):
    m = metrics.prf(_scores(spark, [0.1, 0.2]), ["series_id"]).first()
    assert (m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0)


def test_runs_across_chunks_equal_one_chunk(spark):
    import random
    rng = random.Random(3)
    rows = []
    for s in range(4):
        for k in range(rng.randint(5, 120)):
            rows.append((s, "m", k, round(rng.random(), 3), 0))
    df = spark.createDataFrame(rows, "series_id long, model_id string, idx long, p double, y int")
    one = {(r.series_id, r.idx, r.start_idx) for r in runs.run_members(df, chunk=10_000).collect()}
    for chunk in (1, 2, 7):
        assert {(r.series_id, r.idx, r.start_idx) for r in runs.run_members(df, chunk=chunk).collect()} == one


def test_rows_without_a_time_keep_their_place(spark):
    from pyspark.sql import functions as F

    from early_warning.operators import windows
    rows = [(1, None if k == 3 else f"2024-01-01 0{k // 3}:0{k % 3}:00", k) for k in range(10)] + [(2, None, 0)]
    df = spark.createDataFrame(rows, "series_id long, ts string, src_row long").withColumn("ts", F.col("ts").cast("timestamp"))
    plain = windows.series_index(df).collect()
    bucketed = windows.series_index(df, bucket=F.date_trunc("hour", "ts")).select(plain[0].__fields__).collect()
    assert sorted(plain, key=repr) == sorted(bucketed, key=repr) and len(plain) == 11
