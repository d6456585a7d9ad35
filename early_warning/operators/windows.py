"""Position, sliding windows and future-horizon labels.

Every frame here is a ROWS frame on one window spec,
``partitionBy(series).orderBy(i)``, so one shuffle and one sort feed all of
them. Gaps in time do not shorten a window; the sampling profile warns instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import HISTORY_CAP, HORIZON, SERIES_CHUNK_ROWS, WINDOW


#: Positions of a chunk whose readings are held as one array while its windows are cut.
SLICE_ROWS = 256


def series_order(series: str | Sequence[str] = "series_id", order: str | Sequence[str] = "i"):
    keys = [series] if isinstance(series, str) else list(series)
    cols = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*cols)


def series_frame(lo: int, hi: int, series="series_id", order="i"):
    return series_order(series, order).rowsBetween(lo, hi)


def series_index(df: DataFrame, series: str = "series_id",
                 order: Sequence[str] = ("ts", "src_row"), bucket: Column | None = None) -> DataFrame:
    """``i`` = 0-based position in time order (ties broken by the later
    order columns) and ``n`` = series length.

    With ``bucket`` (a coarse key that never decreases along the order, e.g.
    the hour of ``ts``) no task holds a whole series: rows are numbered inside
    (series, bucket) and shifted by the row count of the series' earlier
    buckets, a prefix sum over the small (series, bucket) count table.
    """
    if bucket is None:
        w = series_order(series, list(order))
        return (df.withColumn("i", (F.row_number().over(w) - 1).cast("bigint"))
                  .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(series)).cast("bigint")))
    d = df.withColumn("_bk", bucket)
    counts = d.groupBy(series, "_bk").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(series).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(series, "_bk", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                         F.sum("_c").over(Window.partitionBy(series)).cast("bigint").alias("n"))
    w = Window.partitionBy(series, "_bk").orderBy(*order)
    # A row without a time has a NULL bucket, which comes first in the order
    # as its rows do; the join must keep it.
    o = offs.select(F.col(series).alias("_s"), F.col("_bk").alias("_b"), "_off", "n")
    return (d.join(o, F.col(series).eqNullSafe(F.col("_s")) & F.col("_bk").eqNullSafe(F.col("_b")))
             .withColumn("i", (F.col("_off") + F.row_number().over(w) - 1).cast("bigint"))
             .drop("_bk", "_off", "_s", "_b"))


def chunk_with_halo(df: DataFrame, back: int, fwd: int, chunk_rows: int, order: str = "i") -> DataFrame:
    """Split every series into chunks of ``chunk_rows`` positions. A row keeps
    its home chunk (``_home``) and is copied, as halo, into the next chunk
    when it is among its chunk's last ``back`` rows and into the previous one
    when among the first ``fwd``; ROWS frames reaching ``back`` rows back and
    ``fwd`` rows forward are then complete inside (series, chunk)."""
    if back > chunk_rows or fwd > chunk_rows:
        raise ValueError("halo wider than a chunk")
    home = F.floor(F.col(order) / chunk_rows).cast("bigint")
    pos = F.pmod(F.col(order), F.lit(chunk_rows))
    # one pass over the input: 0 = home, +1 = halo of the next chunk,
    # -1 = halo of the previous chunk
    shifts = F.array(F.lit(0))
    if back > 0:
        shifts = F.when(pos >= chunk_rows - back, F.concat(shifts, F.array(F.lit(1)))).otherwise(shifts)
    if fwd > 0:
        shifts = F.when((pos < fwd) & (home > 0), F.concat(shifts, F.array(F.lit(-1)))).otherwise(shifts)
    return (df.withColumn("_shift", F.explode(shifts))
              .withColumn("_chunk", home + F.col("_shift"))
              .withColumn("_home", F.col("_shift") == 0).drop("_shift"))


def _partition(series: str) -> list[str]:
    return [series, "_chunk"]


def _home_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("_home")).drop("_chunk", "_home")


def label_flag(label: str = "anomaly") -> Column:
    """1 only for a label equal to 1; NULL and NaN never count as anomaly."""
    return F.when(F.col(label) == 1, 1).otherwise(0)


def horizon_label(readings: DataFrame, horizon: int = HORIZON, label: str = "anomaly",
                  series: str = "series_id", chunk_rows: int = SERIES_CHUNK_ROWS) -> DataFrame:
    """``y`` = 1 when any of the next ``horizon`` readings is an anomaly.
    ``chunk_rows`` splits long series into halo chunks (same result)."""
    df = chunk_with_halo(readings, 0, horizon, chunk_rows)
    fut = F.max(label_flag(label)).over(series_frame(1, horizon, _partition(series)))
    return _home_only(df.withColumn("y", F.coalesce(fut, F.lit(0)).cast("int")))


def window_bounds(window: int = WINDOW, horizon: int | None = HORIZON) -> Column:
    """Positions that end a full window; with a horizon the last ``horizon``
    readings are dropped too (n - window - horizon + 1 windows per series)."""
    cond = F.col("i") >= window - 1
    if horizon is not None:
        cond = cond & (F.col("i") < F.col("n") - horizon)
    return cond


def sliding_windows(readings: DataFrame, channels: Sequence[str], window: int = WINDOW,
                    horizon: int | None = HORIZON, series: str = "series_id",
                    chunk_rows: int = SERIES_CHUNK_ROWS) -> DataFrame:
    """One row per window end ``i`` with ``idx = i - (window-1)`` and
    ``win`` = the last ``window`` readings as an array of structs (oldest
    first). ``horizon=None`` keeps the tail (the live path's batch twin).
    ``chunk_rows`` splits long series into halo chunks (same result); a chunk
    of at most ``SLICE_ROWS`` positions is sorted into one array, and its
    windows are slices of it."""
    item = F.struct(F.col("i").alias("i"), *[F.col(c).alias(c) for c in channels])
    return sliced_windows(readings, {"win": item}, window, horizon, series, chunk_rows)


def sliced_windows(readings: DataFrame, items: dict[str, Column], window: int = WINDOW,
                   horizon: int | None = HORIZON, series: str = "series_id",
                   chunk_rows: int = SERIES_CHUNK_ROWS) -> DataFrame:
    """Every full window with one array per name of ``items``: the expression's
    values (never NULL) over the window's readings, oldest first."""
    kept = readings.columns
    df = chunk_with_halo(readings, window - 1, 0, max(window - 1, min(chunk_rows, SLICE_ROWS)))
    # the readings' own columns and the window bounds stand only on rows that end a window
    own = F.when(F.col("_home") & window_bounds(window, horizon), F.struct(*[F.col(c).alias(c) for c in kept]))
    row = F.struct(F.col("i").alias("i"), F.struct(own.alias("own"), *[v.alias(k) for k, v in items.items()]).alias("r"))
    held = df.groupBy(*_partition(series)).agg(F.collect_list(row).alias("_a"))
    held = held.sortWithinPartitions(*_partition(series))  # windows come out by series and position
    held = held.select(F.transform(F.array_sort("_a", lambda a, b: (a["i"] - b["i"]).cast("int")), lambda x: x["r"]).alias("_a"))
    held = held.select(F.col("_a.own").alias("_own"), *[F.col(f"_a.{k}").alias(f"_v_{k}") for k in items])
    cut = F.transform("_own", lambda own, k: F.when(own.isNotNull(), F.struct(
        own.alias("own"), *[F.slice(f"_v_{n}", F.greatest(k - (window - 2), F.lit(1)), F.least(k + 1, F.lit(window))).alias(n)
                            for n in items])))
    out = held.select(F.explode(F.filter(cut, lambda w: w.isNotNull())).alias("_w"))
    return out.select(*[F.col("_w.own")[c].alias(c) for c in kept], *[F.col("_w")[n].alias(n) for n in items]) \
              .withColumn("idx", F.col("i") - (window - 1))


def flatten_window(win: str = "win", channels: Sequence[str] = ()) -> Column:
    """(t, f) -> position t*len(channels)+f, time-major."""
    return F.flatten(F.transform(F.col(win), lambda r: F.array(*[r[c] for c in channels])))


def interval_seconds(ts: str = "ts", series: str = "series_id", order: str = "i") -> Column:
    """Seconds since the previous reading of the series (NULL first)."""
    prev = F.lag(ts).over(series_order(series, order))
    return (F.unix_micros(F.col(ts).cast("timestamp"))
            - F.unix_micros(prev.cast("timestamp"))) / F.lit(1e6)


def history_tail(df: DataFrame, cap: int = HISTORY_CAP, series: str = "series_id",
                 order: str = "i") -> DataFrame:
    """The latest ``cap`` rows of every series."""
    w = Window.partitionBy(series).orderBy(F.col(order).desc())
    return df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= cap).drop("_rk")
