"""Live data-quality rules, batch twins.

The live buffer judges every arriving sample; here the same judgement runs
over a recorded sample stream (rows of ``series``, in arrival order ``i``).
A rule yields a flag per sample and channel; an event is a change of flag
between consecutive judgements (``lag``), so only transitions are emitted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import FROZEN_LOOKBACK, INTERVAL_LOOKBACK, STALE_AFTER_SECONDS, UNEVEN_STD_THRESHOLD

SERIES = "series_id"

# FIXED VALUES: quality codes (raised, cleared) per rule.
CODES = {
    "frozen": ("FROZEN_SENSOR", "FROZEN_CLEARED"),
    "range": ("OUT_OF_RANGE", "OUT_OF_RANGE_CLEARED"),
    "uneven": ("UNEVEN_SAMPLING", "EVEN_SAMPLING_RESTORED"),
}


def _long(samples: DataFrame, channels: Sequence[str], order: str) -> DataFrame:
    cells = F.explode(F.array(*[
        F.struct(F.lit(k).alias("ch_pos"), F.lit(c).alias("channel"), F.col(c).alias("value"))
        for k, c in enumerate(channels)]))
    return samples.select(SERIES, order, cells.alias("x")).select(SERIES, order, "x.*")


def _transitions(flags: DataFrame, keys: Sequence[str], order: str, rule: str) -> DataFrame:
    """Events where ``flag`` differs from the previous judgement (first
    judgement compares with 'not active')."""
    w = Window.partitionBy(*keys).orderBy(order)
    prev = F.coalesce(F.lag("flag").over(w), F.lit(False))
    raised, cleared = CODES[rule]
    ev = flags.withColumn("_prev", prev).where(F.col("flag") != F.col("_prev"))
    return ev.select(*keys, order,
                     F.when(F.col("flag"), F.lit(raised)).otherwise(F.lit(cleared)).alias("code"),
                     F.when(F.col("flag"), F.lit("warning")).otherwise(F.lit("info")).alias("severity"))


def frozen_flags(samples: DataFrame, channels: Sequence[str], order: str = "i",
                 lookback: int = FROZEN_LOOKBACK) -> DataFrame:
    """A channel is frozen when its last ``lookback`` present readings are
    all equal. Absent readings are skipped (they do not enter the ring)."""
    long = _long(samples, channels, order).where(F.col("value").isNotNull())
    w = Window.partitionBy(SERIES, "channel").orderBy(order).rowsBetween(-(lookback - 1), 0)
    return long.select(SERIES, order, "ch_pos", "channel",
                       ((F.count("value").over(w) >= lookback)
                        & (F.min("value").over(w) == F.max("value").over(w))).alias("flag"))


def frozen_events(samples: DataFrame, channels: Sequence[str], order: str = "i") -> DataFrame:
    """FROZEN_SENSOR when a channel freezes, FROZEN_CLEARED when it moves."""
    return _transitions(frozen_flags(samples, channels, order), [SERIES, "channel"], order, "frozen")


def range_flags(samples: DataFrame, ranges: DataFrame, channels: Sequence[str],
                order: str = "i") -> DataFrame:
    """only the newest sample is judged; bounds are allowed; an absent
    reading is not out of range. The range table has one row per channel
    (bounded by the schema) and is broadcast."""
    long = _long(samples, channels, order)
    j = long.join(F.broadcast(ranges), "channel")
    v = F.col("value")
    return j.select(SERIES, order, "ch_pos", "channel", "value",
                    F.coalesce(v.isNotNull() & ((v < F.col("lo")) | (v > F.col("hi"))),
                               F.lit(False)).alias("flag"))


def range_events(samples: DataFrame, ranges: DataFrame, channels: Sequence[str],
                 order: str = "i") -> DataFrame:
    """OUT_OF_RANGE raised / OUT_OF_RANGE_CLEARED."""
    return _transitions(range_flags(samples, ranges, channels, order), [SERIES, "channel"], order, "range")


def cadence_flags(samples: DataFrame, arrival: str = "arrival_s", order: str = "i",
                  lookback: int = INTERVAL_LOOKBACK, limit: float = UNEVEN_STD_THRESHOLD) -> DataFrame:
    """Population std of the last ``lookback`` positive inter-arrival
    intervals above ``limit`` (needs ``lookback`` of them). Non-positive
    intervals never enter the ring, so the flag only changes on positive ones."""
    w = Window.partitionBy(SERIES).orderBy(order)
    d = samples.select(SERIES, order, (F.col(arrival) - F.lag(arrival).over(w)).alias("dt")) \
               .where(F.col("dt") > 0)
    ring = Window.partitionBy(SERIES).orderBy(order).rowsBetween(-(lookback - 1), 0)
    std = F.stddev_pop("dt").over(ring)
    return d.select(SERIES, order, std.alias("interval_std"),
                    ((F.count("dt").over(ring) >= lookback) & (std > limit)).alias("flag"))


def cadence_events(samples: DataFrame, arrival: str = "arrival_s", order: str = "i") -> DataFrame:
    """UNEVEN_SAMPLING raised / EVEN_SAMPLING_RESTORED (no channel)."""
    return _transitions(cadence_flags(samples, arrival, order), [SERIES], order, "uneven") \
        .withColumn("channel", F.lit(None).cast("string"))


def quality_events(samples: DataFrame, ranges: DataFrame, channels: Sequence[str],
                   arrival: str = "arrival_s", order: str = "i") -> DataFrame:
    """All change-only quality events of a sample stream."""
    cols = [SERIES, order, "code", "channel", "severity"]
    return (frozen_events(samples, channels, order).select(*cols)
            .unionByName(range_events(samples, ranges, channels, order).select(*cols))
            .unionByName(cadence_events(samples, arrival, order).select(*cols)))


def open_warnings(events: DataFrame, order: str = "i") -> DataFrame:
    """Per (code family, channel), the latest event; open when it is a raise."""
    raised_of = F.create_map(*[x for r, c in CODES.values() for x in (F.lit(c), F.lit(r))])
    fam = F.coalesce(raised_of[F.col("code")], F.col("code"))
    e = events.withColumn("warning", fam).withColumn("_ch", F.coalesce("channel", F.lit("")))
    last = e.groupBy(SERIES, "warning", "_ch").agg(
        F.max_by(F.struct(order, "code", "channel"), F.col(order)).alias("l"))
    return (last.where(F.col("l.code") == F.col("warning"))
                .select(SERIES, "warning", F.col("l.channel").alias("channel"),
                        F.col(f"l.{order}").alias(f"since_{order}")))


def stale_gaps(ticks: DataFrame, arrival: Column, order: str = "i",
               limit: float = STALE_AFTER_SECONDS) -> DataFrame:
    """Ticks followed by more than ``limit`` seconds without a tick."""
    w = Window.partitionBy(SERIES).orderBy(order)
    t = ticks.withColumn("_a", arrival)
    g = t.withColumn("gap_s", F.lead("_a").over(w) - F.col("_a"))
    return g.where(F.col("gap_s") > limit).select(SERIES, order, "gap_s")
