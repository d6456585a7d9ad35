"""Scalar helpers."""

import datetime as dt

from pyspark.sql import functions as F

from early_warning.functions import scalars


def test_sweep_configs_and_names(spark):
    rows = scalars.sweep_configs(spark).orderBy("config_no").collect()
    assert len(rows) == 54
    assert rows[0].name == "TransformerFusionLite_L2_D32_H4_FF64_DO003"
    assert rows[-1].name == "TransformerFusionLite_L2_D64_H8_FF160_DO01"
    assert any(r.name == "TransformerFusionLite_L2_D32_H8_FF64_DO018" for r in rows)


def test_durations_clock_and_scalars(spark):
    t0, t1 = dt.datetime(2024, 1, 1, 10, 0, 0, 500000), dt.datetime(2024, 1, 1, 10, 0, 12, 100000)
    df = spark.createDataFrame([(t0, t1)], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(scalars.run_duration_seconds(F.col("a"), F.col("b")).alias("d"),
                  scalars.run_clock(F.col("a"), F.col("b")).alias("c"),
                  scalars.sigmoid(F.lit(0.0)).alias("s"),
                  scalars.out_of_range(F.lit(10.0), F.lit(0.0), F.lit(10.0)).alias("o"),
                  scalars.replay_time(F.col("a"), F.lit(3)).alias("rt")).first()
    assert r.d == 12 and r.c.start_clock == "2024-01-01 10:00:00" and r.c.end_clock == "10:00:12"
    assert r.s == 0.5 and r.o is False and r.rt == dt.datetime(2024, 1, 1, 10, 0, 3, 500000)
