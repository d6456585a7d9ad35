"""Statistical window features (W5) and flat feature vectors.

The ten statistics per channel are window aggregates over the same ROWS frame
as the windows themselves, so they never materialise the 20x8 window. Order is
statistic-major: all channels' means, then all stds, and so on (10 x C).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HORIZON, SERIES_CHUNK_ROWS, WINDOW
from .windows import _home_only, _partition, chunk_with_halo, series_frame, series_order, window_bounds

STATS = ["mean", "std", "max", "min", "last", "first", "last_first",
         "diff_mean", "diff_std", "absmax"]


def stat_columns(channels: Sequence[str]) -> list[str]:
    return [f"{s}_{c}" for s in STATS for c in channels]


def stat_features(readings: DataFrame, channels: Sequence[str], window: int = WINDOW,
                  horizon: int | None = HORIZON, series: str = "series_id",
                  chunk_rows: int = SERIES_CHUNK_ROWS) -> DataFrame:
    """W5 on every full window: adds ``{stat}_{channel}`` columns and ``idx``.

    Sample deviations (``stddev_samp``) as in the reference's tensor maths;
    the mean of the 19 consecutive differences telescopes to
    ``(last - first) / (window - 1)``. Readings that are already in halo
    chunks of ``window - 1`` rows back are taken as they are.
    """
    keys = _partition(series)
    full = series_frame(-(window - 1), 0, keys)
    diffs = series_frame(-(window - 2), 0, keys)
    order = series_order(keys)
    out = readings if "_chunk" in readings.columns else chunk_with_halo(readings, window - 1, 0, chunk_rows)
    for c in channels:
        out = out.withColumn(f"_d_{c}", F.col(c) - F.lag(c).over(order))
    cols = {}
    for c in channels:
        x = F.col(c)
        first = F.first(x).over(full)
        cols.update({
            f"mean_{c}": F.avg(x).over(full),
            f"std_{c}": F.stddev_samp(x).over(full),
            f"max_{c}": F.max(x).over(full),
            f"min_{c}": F.min(x).over(full),
            f"last_{c}": x,
            f"first_{c}": first,
            f"last_first_{c}": x - first,
            f"diff_mean_{c}": (x - first) / F.lit(float(window - 1)),
            f"diff_std_{c}": F.stddev_samp(F.col(f"_d_{c}")).over(diffs),
            f"absmax_{c}": F.max(F.abs(x)).over(full),
        })
    out = out.select("*", *[cols[k].alias(k) for k in stat_columns(channels)])
    out = out.drop(*[f"_d_{c}" for c in channels])
    return _home_only(out.where(window_bounds(window, horizon))
                         .withColumn("idx", F.col("i") - (window - 1)))


def stats_vector(channels: Sequence[str]):
    """The statistic-major feature array for model input."""
    return F.array(*[F.col(k) for k in stat_columns(channels)])
