"""Scalar functions (F1-F13) as Column builders, in one place.

Most live next to the operator that uses them and are re-exported here; the
rest are defined here. All are native expressions (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators.alerts import band_for, state_name  # noqa: F401  (F1)
from ..operators.live import warm_up  # noqa: F401  (F13)
from ..operators.report import risk_level, z_score  # noqa: F401  (F3, F4)
from ..operators.validate import normalise_name, parse_time  # noqa: F401  (F7, F8)


def sigmoid(x: Column) -> Column:
    """F2: 1 / (1 + exp(-x)), the score of a margin-only model."""
    return 1 / (1 + F.exp(-x))


def run_duration_seconds(start_ts: Column, end_ts: Column) -> Column:
    """whole seconds between the first and last reading of a run, + 1."""
    us = F.unix_micros(end_ts.cast("timestamp")) - F.unix_micros(start_ts.cast("timestamp"))
    return (F.floor(us / 1e6) + 1).cast("bigint")


def run_clock(start_ts: Column, end_ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` for the start and ``HH:mm:ss`` for the end."""
    return F.struct(F.date_format(start_ts, "yyyy-MM-dd HH:mm:ss").alias("start_clock"),
                    F.date_format(end_ts, "HH:mm:ss").alias("end_clock"))


def replay_time(first_ts: Column, idx: Column) -> Column:
    """replay clock, the first timestamp in file order plus ``idx`` seconds."""
    return F.timestamp_add("SECOND", idx, first_ts)


def display_time(ts: Column) -> Column:
    """sub-seconds trimmed for display."""
    return F.date_trunc("second", ts)


def out_of_range(v: Column, lo: Column, hi: Column) -> Column:
    """strictly outside [lo, hi] (the bounds themselves are allowed)."""
    return (v < lo) | (v > hi)


def deviation_direction(z: Column) -> Column:
    """which side of the file mean the peak window sits on."""
    return F.when(z > 0, F.lit("above")).otherwise(F.lit("below"))


def config_name(layers: Column, d_model: Column, heads: Column, ff: Column, dropout: Column) -> Column:
    """``TransformerFusionLite_L2_D32_H8_FF64_DO018`` style names (the
    dropout's decimal text without its point)."""
    return F.format_string("TransformerFusionLite_L%d_D%d_H%d_FF%d_DO%s", layers, d_model, heads, ff,
                           F.replace(dropout.cast("string"), F.lit("."), F.lit("")))


def sweep_configs(spark: SparkSession) -> DataFrame:
    """The 48 + 6 configurations of the sequence-model sweep, numbered
    in sweep order, with their names (a parameter table)."""
    rows = [(config.SWEEP_MAIN_LAYERS, d, h, ff, do)
            for d in config.SWEEP_MAIN_D_MODEL for h in config.SWEEP_MAIN_HEADS
            for ff in config.SWEEP_MAIN_FF for do in config.SWEEP_MAIN_DROPOUT]
    rows += [(config.SWEEP_MAIN_LAYERS, config.SWEEP_EXTRA_D_MODEL, h, ff, config.SWEEP_EXTRA_DROPOUT)
             for h in config.SWEEP_EXTRA_HEADS for ff in config.SWEEP_EXTRA_FF]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)],
                               "config_no long, layers int, d_model int, heads int, ff int, dropout double")
    return df.withColumn("name", config_name(F.col("layers"), F.col("d_model"), F.col("heads"),
                                             F.col("ff"), F.col("dropout")))
