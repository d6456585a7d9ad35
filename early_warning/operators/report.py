"""Report tables: what the PDF report shows, as DataFrames (P1-P7, A7, A16,
T3, J6-J8, F3-F6, F11).

Joins against readings are equi-joins on (series, position): the rows of a
run are exactly the last readings of its flagged windows (``i = idx + W-1``),
and a peak's neighbourhood is a bounded list of positions exploded before
the join. No range join, no per-series loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (ALERT_THRESHOLD, NEIGHBOURHOOD_ROWS, RISK_HIGH_FAULT_SHARE, RISK_HIGH_PEAK,
                      RISK_LOW_PEAK, WINDOW, Z_EPSILON)
from .runs import KEYS, flagged, run_members


def channel_stats(readings: DataFrame, channels: Sequence[str], series: str = "series_id") -> DataFrame:
    """Per series and channel, mean, population std, min, max.

    Aggregated wide (one partial aggregate per series), then unpivoted, so
    the readings are never multiplied by the channel count.
    """
    aggs = []
    for c in channels:
        aggs += [F.avg(c).alias(f"mean__{c}"), F.stddev_pop(c).alias(f"std__{c}"),
                 F.min(c).alias(f"min__{c}"), F.max(c).alias(f"max__{c}")]
    wide = readings.groupBy(series).agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(k).alias("ch_pos"), F.lit(c).alias("channel"),
                 F.col(f"mean__{c}").alias("mean"), F.col(f"std__{c}").alias("std"),
                 F.col(f"min__{c}").alias("min"), F.col(f"max__{c}").alias("max"))
        for k, c in enumerate(channels)]))
    return wide.select(series, rows.alias("r")).select(series, "r.*")


def z_score(mean_part: Column, mean_all: Column, std_all: Column) -> Column:
    """deviation in units of the file's population std (+epsilon)."""
    return (mean_part - mean_all) / (std_all + F.lit(Z_EPSILON))


def _long(df: DataFrame, keys: Sequence[str], channels: Sequence[str]) -> DataFrame:
    rows = F.explode(F.array(*[
        F.struct(F.lit(k).alias("ch_pos"), F.lit(c).alias("channel"), F.col(c).alias("value"))
        for k, c in enumerate(channels)]))
    return df.select(*keys, rows.alias("r")).select(*keys, "r.*")


def peak_sensor(z: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The channel with the largest |z| (the first channel on ties)."""
    keys = list(keys)
    return z.groupBy(*keys).agg(F.max_by(
        F.struct(F.col("channel").alias("peak_sensor"), F.col("z").alias("peak_z")),
        F.struct(F.abs("z"), -F.col("ch_pos"))).alias("b")).select(*keys, "b.*")


def run_timeline(scores: DataFrame, readings: DataFrame, channels: Sequence[str],
                 threshold: float = ALERT_THRESHOLD, window: int = WINDOW,
                 keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per run: number (by start), clock span, duration in
    whole seconds + 1, peak probability, and the channel whose run mean
    deviates most from the series mean (with its z).

    One pass: the flagged windows carry their run (one island computation),
    meet their last reading by an equi-join on (series, i) and are
    aggregated per run; the run table is that aggregate, not a second plan.
    When ``scores`` already carries ``ts`` and the channels of the window's
    last reading (a tick is that reading), no join with the readings is made.
    """
    keys = list(keys)
    series = keys[0]
    f = run_members(scores, threshold, keys)
    if all(c in scores.columns for c in ("ts", *channels)):
        rows = f
    else:
        rows = f.select(*keys, "idx", "p", "start_idx").withColumn("i", F.col("idx") + (window - 1)).join(
            readings.select(series, "i", "ts", *channels), [series, "i"])
    per_run = rows.groupBy(*keys, "start_idx").agg(
        F.max("idx").cast("bigint").alias("end_idx"), F.max("p").alias("peak_prob"),
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"),
        *[F.avg(c).alias(c) for c in channels])
    stats = channel_stats(readings, channels, series)
    z = (_long(per_run, [*keys, "start_idx"], channels).join(stats, [series, "channel", "ch_pos"])
         .withColumn("z", z_score(F.col("value"), F.col("mean"), F.col("std"))))
    top = peak_sensor(z, [*keys, "start_idx"])
    by_start = Window.partitionBy(*keys).orderBy("start_idx")
    return (per_run.join(top, [*keys, "start_idx"])
                   .select(*keys, F.row_number().over(by_start).cast("bigint").alias("run_no"),
                           "start_idx", "end_idx", "start_ts", "end_ts",
                           (F.floor((F.unix_micros(F.col("end_ts").cast("timestamp"))
                                     - F.unix_micros(F.col("start_ts").cast("timestamp"))) / 1e6) + 1)
                           .cast("bigint").alias("duration_s"),
                           "peak_prob", "peak_sensor", "peak_z"))


def peak_rows(summary: DataFrame, readings_n: DataFrame, half: int, window: int = WINDOW,
              keys: Sequence[str] = KEYS) -> DataFrame:
    """Positions around each peak: ``[peak_row-half, peak_row+half]`` clipped
    to the series, with ``peak_row = W-1 + peak_idx``; bounded per peak."""
    keys = list(keys)
    series = keys[0]
    s = summary.join(readings_n, series).withColumn(
        "peak_row", F.least(F.greatest(F.col("peak_idx") + (window - 1), F.lit(0)), F.col("n") - 1))
    lo = F.greatest(F.col("peak_row") - half, F.lit(0))
    hi = F.least(F.col("peak_row") + half, F.col("n") - 1)
    return s.select(*keys, "peak_row", F.explode(F.sequence(lo, hi)).alias("i"))


def _series_lengths(readings: DataFrame, series: str) -> DataFrame:
    return readings.groupBy(series).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def peak_neighbourhood(summary: DataFrame, readings: DataFrame, channels: Sequence[str],
                       half: int = NEIGHBOURHOOD_ROWS, window: int = WINDOW,
                       keys: Sequence[str] = KEYS) -> DataFrame:
    """Long-form traces of every channel within ``half`` rows of the
    peak, flagging the rows of the peak window."""
    keys = list(keys)
    series = keys[0]
    pr = peak_rows(summary, _series_lengths(readings, series), half, window, keys)
    j = pr.join(readings.select(series, "i", *channels), [series, "i"])
    j = j.withColumn("offset", F.col("i") - F.col("peak_row")).withColumn(
        "in_peak_window", F.col("i").between(F.col("peak_row") - (window - 1), F.col("peak_row")))
    return _long(j, [*keys, "i", "offset", "in_peak_window"], channels)


def sensor_deepdive(summary: DataFrame, readings: DataFrame, channels: Sequence[str],
                    window: int = WINDOW, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per channel, file mean/min/max, peak-window mean and its z."""
    keys = list(keys)
    series = keys[0]
    pr = peak_rows(summary, _series_lengths(readings, series), 0, window, keys)
    win = pr.select(*keys, F.explode(F.sequence(
        F.greatest(F.col("peak_row") - (window - 1), F.lit(0)), F.col("peak_row"))).alias("i"))
    wm = win.join(readings.select(series, "i", *channels), [series, "i"]) \
            .groupBy(*keys).agg(*[F.avg(c).alias(c) for c in channels])
    long = _long(wm, keys, channels).withColumnRenamed("value", "peak_window_mean")
    stats = channel_stats(readings, channels, series)
    return (long.join(stats, [series, "channel", "ch_pos"])
                .select(*keys, "ch_pos", "channel", F.col("mean").alias("file_mean"),
                        F.col("min").alias("file_min"), F.col("max").alias("file_max"),
                        "peak_window_mean",
                        z_score(F.col("peak_window_mean"), F.col("mean"), F.col("std")).alias("z")))


def risk_level(fault_windows: Column, total_windows: Column, peak_prob: Column) -> Column:
    """LOW / MEDIUM / HIGH."""
    share = fault_windows / F.greatest(total_windows, F.lit(1))
    return (F.when((fault_windows == 0) | (peak_prob < RISK_LOW_PEAK), "LOW")
             .when((share >= RISK_HIGH_FAULT_SHARE) | (peak_prob >= RISK_HIGH_PEAK), "HIGH")
             .otherwise("MEDIUM"))


def executive_summary(summary: DataFrame, readings: DataFrame, threshold: float = ALERT_THRESHOLD,
                      keys: Sequence[str] = KEYS) -> DataFrame:
    """Verdict, risk, recommended action, rows analysed, threshold."""
    keys = list(keys)
    series = keys[0]
    risk = risk_level(F.col("fault_windows"), F.col("total_windows"), F.col("peak_prob"))
    verdict = F.when(F.col("fault_windows") == 0, F.lit("Pump operating normally")).otherwise(
        F.format_string("%d anomaly window(s) detected", F.col("fault_windows")))
    action = (F.when((F.col("risk") == "LOW") & (F.col("fault_windows") == 0), "No action required")
               .when(F.col("risk") == "LOW", "Low concern")
               .when(F.col("risk") == "MEDIUM", "Inspection recommended")
               .otherwise("Inspect immediately"))
    s = summary.join(_series_lengths(readings, series).withColumnRenamed("n", "rows_analysed"), series)
    s = s.withColumn("risk", risk)
    return s.select(*keys, verdict.alias("verdict"), "risk", action.alias("action"),
                    "rows_analysed", F.lit(float(threshold)).alias("threshold"),
                    "total_windows", "fault_windows", "peak_prob", "peak_idx")


def model_compare(summary: DataFrame, metrics: DataFrame, registry: DataFrame, series: DataFrame,
                  selected: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Every series x registry model; a model without scores comes
    back ``unavailable`` instead of failing. The registry is broadcast."""
    keys = list(keys)
    s = series.crossJoin(F.broadcast(registry))
    j = (s.join(summary, keys, "left").join(metrics.select(*keys, "f1"), keys, "left"))
    unavailable = F.col("total_windows").isNull()
    return j.select(*keys, "name", "family", (F.col("model_id") == selected).alias("selected"),
                    unavailable.alias("unavailable"),
                    F.col("fault_windows").alias("flags"), "peak_prob",
                    F.col("f1").alias("f1_here"), "test_f1")


def agreement(compare: DataFrame, series: str = "series_id") -> DataFrame:
    """How many available models flag at least one window; the silent
    ones by name (registry order); none / all / partial."""
    avail = compare.where(~F.col("unavailable"))
    silent = F.filter(F.array_sort(F.collect_list(
        F.struct("model_id", F.when(F.col("flags") == 0, F.col("name")).alias("name")))),
        lambda x: x["name"].isNotNull())
    a = avail.groupBy(series).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_available"),
        F.count_if(F.col("flags") > 0).cast("bigint").alias("n_flagging"),
        silent.alias("_s"))
    return a.select(series, "n_available", "n_flagging",
                    F.array_join(F.transform("_s", lambda x: x["name"]), ", ").alias("silent_models"),
                    F.when(F.col("n_flagging") == 0, "none")
                     .when(F.col("n_flagging") == F.col("n_available"), "all")
                     .otherwise("partial").alias("agreement"))


def prob_series(scores: DataFrame, threshold: float = ALERT_THRESHOLD,
                keys: Sequence[str] = KEYS) -> DataFrame:
    """Probability per window with the threshold and the run it shades."""
    keys = list(keys)
    m = run_members(scores, threshold, keys).select(*keys, "idx", F.col("start_idx").alias("run_start_idx"))
    j = scores.join(m, [*keys, "idx"], "left")
    return j.select(*keys, "idx", "p", F.lit(float(threshold)).alias("threshold"),
                    flagged("p", threshold).alias("flagged"), "run_start_idx")


def sample_series(readings: DataFrame, channel: str, label: str = "anomaly",
                  series: str = "series_id") -> DataFrame:
    """One channel's trace with the anomaly points marked (the EDA plot
    data; the channel is the first numeric sensor, V13)."""
    return readings.select(series, "i", "ts", F.col(channel).alias("value"),
                           (F.col(label) == 1).alias("is_anomaly"))


def provenance(readings: DataFrame, registry: DataFrame, model_id: str, threshold: float,
               window: int = WINDOW, horizon: int = 10, series: str = "series_id",
               label: str = "anomaly") -> DataFrame:
    """Per input file, what was read and with which model and settings.
    The registry (one row per model) is broadcast."""
    f = readings.groupBy(series).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows_ingested"),
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"),
        F.bool_or(F.col(label).isNotNull()).alias("has_label"))
    m = F.broadcast(registry.where(F.col("model_id") == model_id).select("model_id", "family"))
    return f.crossJoin(m).select(series, "rows_ingested", "start_ts", "end_ts", "has_label", "model_id",
                                 "family", F.lit(float(threshold)).alias("threshold"),
                                 F.lit(window).alias("window_size"), F.lit(horizon).alias("horizon"))
