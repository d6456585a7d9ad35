"""Flagged-window runs and per-series score summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALERT_THRESHOLD, TOP_RUNS

KEYS = ("series_id", "model_id")


def flagged(p: str = "p", threshold: float = ALERT_THRESHOLD):
    """Inference flags with ``p >= threshold``."""
    return F.col(p) >= F.lit(float(threshold))


RUN_CHUNK = 65_536


def run_members(scores: DataFrame, threshold: float = ALERT_THRESHOLD,
                keys: Sequence[str] = KEYS, chunk: int = RUN_CHUNK) -> DataFrame:
    """Flagged windows with the start index of the run they belong to.

    A run starts at a flagged window whose predecessor is not flagged; a
    window's run start is the latest start at or before it. Both are computed
    inside chunks of ``chunk`` windows (the predecessor of a chunk's first
    window rides along as a one-row halo), and a chunk without a start of its
    own inherits the latest start of the chunks before it, a running maximum
    over the small chunk table. No window partition holds a whole key.
    """
    keys = list(keys)
    flag = flagged("p", threshold)
    home = F.floor(F.col("idx") / chunk).cast("bigint")
    copies = F.when(F.pmod(F.col("idx"), F.lit(chunk)) == chunk - 1, F.array(F.lit(0), F.lit(1))) \
              .otherwise(F.array(F.lit(0)))
    t = (scores.withColumn("_f", flag).withColumn("_s", F.explode(copies))
               .withColumn("_c", home + F.col("_s")))
    w = Window.partitionBy(*keys, "_c").orderBy("idx")
    t = t.withColumn("_start", F.when(F.col("_f") & ~F.coalesce(F.lag("_f").over(w), F.lit(False)),
                                      F.col("idx")))
    t = t.where(F.col("_s") == 0)
    t = t.withColumn("_local", F.max("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    last = t.groupBy(*keys, "_c").agg(F.max("_start").alias("_last"))
    carry = last.select(*keys, "_c", F.max("_last").over(
        Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    out = t.where(F.col("_f")).join(carry, [*keys, "_c"])
    return (out.withColumn("start_idx", F.coalesce("_local", "_carry").cast("bigint"))
               .drop("_f", "_s", "_c", "_start", "_local", "_carry"))


def anomaly_runs(scores: DataFrame, threshold: float = ALERT_THRESHOLD,
                 keys: Sequence[str] = KEYS) -> DataFrame:
    """Maximal runs of consecutive flagged windows (start, inclusive
    end, peak probability, length), from the run membership above."""
    keys = list(keys)
    m = run_members(scores, threshold, keys)
    return (m.groupBy(*keys, "start_idx")
             .agg(F.max("idx").cast("bigint").alias("end_idx"),
                  F.max("p").alias("peak_prob"),
                  F.count(F.lit(1)).cast("bigint").alias("n_windows")))


def top_runs(runs: DataFrame, n: int = TOP_RUNS, keys: Sequence[str] = KEYS) -> DataFrame:
    """The ``n`` runs with the highest peak (earlier start wins ties),
    re-ordered by start and numbered from 1."""
    keys = list(keys)
    by_peak = Window.partitionBy(*keys).orderBy(F.col("peak_prob").desc(), F.col("start_idx"))
    kept = runs.withColumn("_r", F.row_number().over(by_peak)).where(F.col("_r") <= n)
    by_start = Window.partitionBy(*keys).orderBy("start_idx")
    return (kept.drop("_r")
                .withColumn("run_no", F.row_number().over(by_start).cast("bigint")))


def score_summary(scores: DataFrame, threshold: float = ALERT_THRESHOLD,
                  keys: Sequence[str] = KEYS) -> DataFrame:
    """Total windows, flagged windows, peak probability and the first
    index at which the peak occurs. One partial/final aggregate."""
    keys = list(keys)
    return (scores.groupBy(*keys)
            .agg(F.count(F.lit(1)).cast("bigint").alias("total_windows"),
                 F.count_if(flagged("p", threshold)).cast("bigint").alias("fault_windows"),
                 F.max("p").alias("peak_prob"),
                 F.max_by("idx", F.struct(F.col("p"), -F.col("idx"))).cast("bigint")
                 .alias("peak_idx")))
