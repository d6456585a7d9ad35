"""Standard scalers fitted on training windows (M1, M2) and applied (M3).

Both use the population deviation and a scale of 1 for a constant feature,
the convention of the scalers the models were trained with (Spark ML's own
``StandardScaler`` uses the sample deviation, so it is not used here).
Neither fit materialises windows:

* M1, one (mean, scale) per window position and channel: the reading at
  position ``i`` of an ``n``-row series sits at window slot ``t`` for every
  ``t`` in ``[max(0, i+W+H-n), min(W-1, i)]``; a reading is expanded into
  those slots right before a partial aggregate, so the shuffle carries only
  W x C partial states per task.
* M2, one pair per channel, over windows flattened to rows: the reading counts
  once per window that holds it, a closed-form weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HORIZON, WINDOW


def _scale(std: Column) -> Column:
    return F.when((std.isNull()) | (std == 0), F.lit(1.0)).otherwise(std)


def fit_position_scaler(train: DataFrame, channels: Sequence[str], window: int = WINDOW,
                        horizon: int = HORIZON) -> DataFrame:
    """M1: rows (pos, t, channel, mean, std, scale); pos = t*C + f."""
    lo = F.greatest(F.lit(0), F.col("i") + (window + horizon) - F.col("n"))
    hi = F.least(F.lit(window - 1), F.col("i"))
    slots = (train.where(lo <= hi)
             .select(F.explode(F.sequence(lo, hi)).alias("t"), *channels))
    agg = []
    for c in channels:
        agg += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    per_t = slots.groupBy("t").agg(*agg)
    n_ch = len(channels)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(k).alias("f"), F.lit(c).alias("channel"),
                 F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std"))
        for k, c in enumerate(channels)]))
    long = per_t.select("t", stacked.alias("x")).select("t", "x.*")
    return long.select(
        (F.col("t") * n_ch + F.col("f")).cast("bigint").alias("pos"),
        F.col("t").cast("bigint").alias("t"), "channel", "mean", "std",
        _scale(F.col("std")).alias("scale"))


def window_weight(window: int = WINDOW, horizon: int = HORIZON) -> Column:
    """Number of labelled windows holding reading ``i`` of an ``n``-row series."""
    return F.greatest(
        F.lit(0),
        F.least(F.col("i") + (window - 1), F.col("n") - (horizon + 1))
        - F.greatest(F.col("i"), F.lit(window - 1)) + 1)


def fit_channel_scaler(train: DataFrame, channels: Sequence[str], window: int = WINDOW,
                       horizon: int = HORIZON) -> DataFrame:
    """M2: one row per channel (f, channel, mean, std, scale), window-weighted.

    Two passes over the training readings: weighted means, then weighted
    squared deviations from them (stable, unlike sum-of-squares).
    """
    w = train.select(window_weight(window, horizon).cast("double").alias("w"), *channels) \
             .where(F.col("w") > 0)
    means = w.agg(F.sum("w").alias("sw"),
                  *[(F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(f"m_{c}") for c in channels])
    dev = w.crossJoin(F.broadcast(means)).agg(
        F.first("sw").alias("sw"),
        *[F.first(f"m_{c}").alias(f"m_{c}") for c in channels],
        *[F.sum(F.col("w") * (F.col(c) - F.col(f"m_{c}")) ** 2).alias(f"q_{c}") for c in channels])
    rows = F.explode(F.array(*[
        F.struct(F.lit(k).alias("f"), F.lit(c).alias("channel"),
                 F.col(f"m_{c}").alias("mean"),
                 F.sqrt(F.col(f"q_{c}") / F.col("sw")).alias("std"))
        for k, c in enumerate(channels)]))
    out = dev.select(rows.alias("x")).select("x.*")
    return out.select(F.col("f").cast("bigint").alias("f"), "channel", "mean", "std",
                      _scale(F.col("std")).alias("scale"))


def channel_scaler_row(scaler: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Pivot the 8-row channel scaler to one row of ``mu_c``/``sd_c`` columns."""
    return scaler.agg(*[
        F.first(F.when(F.col("channel") == c, F.col(k)), ignorenulls=True).alias(f"{p}_{c}")
        for c in channels for k, p in (("mean", "mu"), ("scale", "sd"))])


def apply_channel_scaler(df: DataFrame, scaler: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Replace each channel by ``(x - mean) / scale``. The scaler is one row,
    broadcast; the readings are not shuffled."""
    row = channel_scaler_row(scaler, channels)
    j = df.crossJoin(F.broadcast(row))
    for c in channels:
        j = j.withColumn(c, (F.col(c) - F.col(f"mu_{c}")) / F.col(f"sd_{c}"))
    return j.drop(*[f"{p}_{c}" for c in channels for p in ("mu", "sd")])


def position_scaler_arrays(scaler: DataFrame) -> DataFrame:
    """One row: ``mu`` and ``sd`` arrays ordered by position."""
    s = scaler.agg(F.array_sort(F.collect_list(F.struct("pos", "mean", "scale"))).alias("a"))
    return s.select(F.transform("a", lambda x: x["mean"]).alias("mu"),
                    F.transform("a", lambda x: x["scale"]).alias("sd"))


def apply_position_scaler(df: DataFrame, scaler: DataFrame, features: str = "features",
                          out: str = "features_scaled") -> DataFrame:
    """M1 applied: element-wise ``(x - mu[k]) / sd[k]`` on a flat array."""
    arr = position_scaler_arrays(scaler).select(F.arrays_zip("mu", "sd").alias("_ms"))
    j = df.crossJoin(F.broadcast(arr))
    scaled = F.zip_with(F.col(features), F.col("_ms"), lambda x, m: (x - m["mu"]) / m["sd"])
    return j.withColumn(out, scaled).drop("_ms")
