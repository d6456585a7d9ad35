"""Live monitor, batch twin (J10, X1, X2 with X7 resets, A18).

A live stream is a sequence of samples in arrival order. Its batch twin:

* J10 – the configuration (model, threshold) in force when each sample
  arrives: config rows are resolved (NULL = leave as is), cut into
  intervals, and joined to the samples as of their arrival time;
* X1 – a tick for every sample from the ``window``-th on whose last
  ``window`` samples all carry every channel (no horizon bound: the live
  path scores the newest window);
* X7 – a model switch starts a new state-machine segment (probabilities
  cleared, NORMAL); a threshold change does not. The tick counter runs on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALERT_THRESHOLD, HISTORY_CAP, WINDOW
from . import alerts

SERIES = "series_id"


def resolve_config(config: DataFrame, default_model: str, default_threshold: float = ALERT_THRESHOLD,
                   at: str = "at_s") -> DataFrame:
    """Effective (model, threshold) from each change on, with the interval
    ``[at_s, next_s)`` it holds for and the state-machine segment number
    (incremented on every effective model change)."""
    w = Window.orderBy(at)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    c = config.select(
        at, F.lead(at).over(w).alias("next_s"),
        F.coalesce(F.last("model_id", ignorenulls=True).over(run), F.lit(default_model)).alias("model_id"),
        F.coalesce(F.last("threshold", ignorenulls=True).over(run), F.lit(float(default_threshold)))
        .alias("threshold"))
    changed = F.when(F.col("model_id") != F.coalesce(F.lag("model_id").over(w), F.lit(default_model)), 1) \
               .otherwise(0)
    return c.withColumn("segment", F.sum(changed).over(run).cast("bigint"))


def config_as_of(samples: DataFrame, resolved: DataFrame, arrival: str = "arrival_s",
                 bucket_s: float = 3600.0) -> DataFrame:
    """Attach the resolved configuration in force at each sample's
    arrival time (``at_s <= arrival < next_s``). Samples before the first
    change get no row here (callers coalesce to the defaults).

    Each interval is expanded to the time buckets it covers and joined on the
    bucket (equi-join), then filtered exactly; the open last interval is one
    row and is broadcast. One plan, whatever the size of the configuration.
    """
    a = F.col(arrival)
    cond = (a >= F.col("at_s")) & (F.col("next_s").isNull() | (a < F.col("next_s")))
    cfg = resolved.select("at_s", "next_s", "model_id", "threshold", "segment")
    hi = F.coalesce(F.col("next_s"), F.col("at_s"))
    b = cfg.withColumn("_b", F.explode(F.sequence(F.floor(F.col("at_s") / bucket_s).cast("bigint"),
                                                  F.floor(hi / bucket_s).cast("bigint"))))
    open_end = cfg.where(F.col("next_s").isNull())
    s = samples.withColumn("_b", F.floor(a / bucket_s).cast("bigint"))
    closed = s.join(b.where(F.col("next_s").isNotNull()), "_b").where(cond).drop("_b")
    last = s.join(F.broadcast(open_end), a >= F.col("at_s")).drop("_b")
    matched = closed.unionByName(last)
    unmatched = s.drop("_b").join(matched.select(SERIES, "i"), [SERIES, "i"], "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def live_ticks(samples: DataFrame, channels: Sequence[str], resolved: DataFrame,
               score: Callable[[DataFrame], DataFrame], window: int = WINDOW,
               default_model: str = "m1", default_threshold: float = ALERT_THRESHOLD,
               arrival: str = "arrival_s", chunk: int = 64) -> DataFrame:
    """X1 + X2 + X7: ticks with probability, alert status and the threshold flag.

    ``score(df)`` adds ``p`` for the model named in ``model_id`` to rows that
    carry the window (here: ``win``, the last ``window`` samples).
    """
    frame = Window.partitionBy(SERIES).orderBy("i").rowsBetween(-(window - 1), 0)
    complete = F.lit(True)
    for c in channels:
        complete = complete & (F.count(c).over(frame) == window)
    s = config_as_of(samples, resolved, arrival)
    s = (s.withColumn("model_id", F.coalesce("model_id", F.lit(default_model)))
          .withColumn("threshold", F.coalesce("threshold", F.lit(float(default_threshold))))
          .withColumn("segment", F.coalesce("segment", F.lit(0).cast("bigint")))
          .withColumn("_complete", complete & (F.count(F.lit(1)).over(frame) == window)))
    ticks = score(s.where(F.col("_complete")).drop("_complete"))
    order = Window.partitionBy(SERIES).orderBy("i")
    ticks = ticks.withColumn("tick", F.row_number().over(order).cast("bigint"))
    seg = Window.partitionBy(SERIES, "segment").orderBy("i")
    ticks = ticks.withColumn("k", (F.row_number().over(seg) - 1).cast("bigint"))
    st = alerts.alert_states(ticks, [SERIES, "segment"], order="k", chunk=chunk)
    return st.withColumn("in_anomaly_window", F.col("p") >= F.col("threshold"))


def live_status(samples: DataFrame, ticks: DataFrame, open_issues: DataFrame,
                cap: int = HISTORY_CAP) -> DataFrame:
    """Per series, samples buffered, ticks emitted, current status, model,
    threshold and the sorted active quality keys (``kind:target``)."""
    buf = samples.groupBy(SERIES).agg(F.least(F.count(F.lit(1)), F.lit(cap)).cast("bigint").alias("buffered"))
    last = ticks.groupBy(SERIES).agg(
        F.count(F.lit(1)).cast("bigint").alias("ticks_emitted"),
        F.max_by(F.struct("status", "model_id", "threshold"), F.col("i")).alias("l"))
    kind = F.create_map(F.lit("FROZEN_SENSOR"), F.lit("frozen"), F.lit("OUT_OF_RANGE"), F.lit("range"),
                        F.lit("UNEVEN_SAMPLING"), F.lit("uneven"))
    key = F.concat(kind[F.col("warning")], F.lit(":"), F.coalesce("channel", F.lit("ingest")))
    issues = open_issues.groupBy(SERIES).agg(F.array_sort(F.collect_list(key)).alias("_k"))
    return (buf.join(last, SERIES, "left").join(issues, SERIES, "left")
               .select(SERIES, "buffered", F.coalesce("ticks_emitted", F.lit(0)).cast("bigint").alias("ticks_emitted"),
                       F.coalesce(F.col("l.status"), F.lit("NORMAL")).alias("current_status"),
                       F.col("l.model_id").alias("model_id"), F.col("l.threshold").alias("threshold"),
                       F.array_join(F.coalesce("_k", F.array().cast("array<string>")), ",")
                       .alias("active_quality_issues")))


def warm_up(buffered: Column, window: int = WINDOW) -> Column:
    """samples still needed before the first tick."""
    return F.greatest(F.lit(window) - buffered, F.lit(0))
