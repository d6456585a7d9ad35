"""Burst augmentation and cyclic re-indexing (X11, X12), the data effect of the
live simulator as DataFrame operators.

A burst is (series, start, duration, intensity); its envelope is
``sin(pi * progress) * intensity`` with ``progress = (i - start) / duration``.
Bursts are expanded to their positions (bounded by the duration) and
equi-joined to the readings, so no range join is needed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: jitter and burst response of the simulator.
JITTER_SCALE = 0.015
BURST_SCALE_GAIN = {"Accelerometer1RMS": 2.0, "Accelerometer2RMS": 2.0, "Current": 0.8, "Pressure": 0.4}
BURST_ADD_CHANNEL = "Temperature"
BURST_ADD = 4.0


def hash_uniform(seed: int) -> Callable[[Column, Column, Column], Column]:
    """A reproducible uniform [0, 1) draw per (series, position, channel)."""
    def u(series: Column, i: Column, ch_pos: Column) -> Column:
        h = F.xxhash64(F.lit(seed), series, i, ch_pos)
        return F.pmod(h, F.lit(1_000_000)).cast("double") / 1_000_000
    return u


def inject_bursts(readings: DataFrame, bursts: DataFrame, channels: Sequence[str],
                  gains: Mapping[str, float] = BURST_SCALE_GAIN, add_channel: str = BURST_ADD_CHANNEL,
                  add: float = BURST_ADD, jitter: float = JITTER_SCALE,
                  uniform: Callable[[Column, Column, Column], Column] | None = None,
                  series: str = "series_id") -> DataFrame:
    """X11: multiplicative jitter on every channel, then inside bursts
    ``x * (1 + gain * e)`` on the gain channels and ``x + add * e`` on the
    additive one, ``e`` being the burst envelope at that row."""
    uniform = uniform or hash_uniform(42)
    pos = bursts.select(series, "start_i", "dur", "intensity",
                        F.explode(F.sequence(F.col("start_i"), F.col("start_i") + F.col("dur") - 1)).alias("i"))
    prog = F.least(F.greatest((F.col("i") - F.col("start_i")) / F.greatest(F.col("dur"), F.lit(1)), F.lit(0.0)),
                   F.lit(1.0))
    env = pos.select(series, "i", (F.sin(prog * math.pi) * F.col("intensity")).alias("envelope"))
    j = readings.join(env, [series, "i"], "left")
    e = F.coalesce(F.col("envelope"), F.lit(0.0))
    out = []
    for k, c in enumerate(channels):
        x = F.col(c) * (1.0 + (uniform(F.col(series), F.col("i"), F.lit(k)) * 2 - 1) * jitter)
        if c in gains:
            x = x * (1.0 + gains[c] * e)
        if c == add_channel:
            x = x + add * e
        out.append(x.alias(c))
    keep = [c for c in readings.columns if c not in channels]
    return j.select(*keep, *out, e.alias("envelope"))


def cyclic_shift(readings: DataFrame, offset: Column, series: str = "series_id") -> DataFrame:
    """Replay a series from ``offset`` and wrap around:
    new position = (i - offset) mod n."""
    return readings.withColumn("source_i", F.col("i")) \
                   .withColumn("i", F.pmod(F.col("i") - offset, F.col("n")))
