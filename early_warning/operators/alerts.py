"""Four-level alert state with hysteresis.

The state after each tick is a sequential fold, but every tick acts as a
function on the four states that depends only on its probability and the two
before it (W8). Functions compose associatively, so the fold becomes:

1. per tick, the 4-entry transition map (built inside its chunk's array);
2. per chunk of ``chunk`` ticks, the composed map (a higher-order
   ``aggregate`` over the chunk's sorted ticks);
3. per chunk, the composed map of all earlier chunks by two-level prefix
   doubling (``lag`` steps over the chunk table, then the group table);
4. per chunk, its entry state pushed through its own ticks.

Everything is built from native expressions: no Python worker, and no
group or window partition that grows with one key's length.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALERT_THRESHOLD, BAND_LOWER, DEMOTION_STREAK, PROMOTION_STREAK_WARNING, STATES
from ..session import ensure_checkpoint_dir

KEYS = ("series_id", "model_id")


def band_for(p: Column) -> Column:
    """3 ALERT, 2 WARNING, 1 WATCH, 0 NORMAL by the band lower bounds."""
    return (F.when(p >= BAND_LOWER[3], 3).when(p >= BAND_LOWER[2], 2)
             .when(p >= BAND_LOWER[1], 1).otherwise(0))


def state_name(code: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STATES]), code.cast("int") + 1)


def _tick_map(p: Column, mn: Column, mx: Column, cnt: Column) -> Column:
    """Next state for each previous state 0..3 after one tick (W8 tails)."""
    b = band_for(p)
    out = []
    for s in range(4):
        if s == 0:
            up = F.lit(1)                      # WATCH needs one reading in band
        elif s == 1:
            up = F.when((cnt >= PROMOTION_STREAK_WARNING) & (mn >= BAND_LOWER[2]), 2).otherwise(1)
        else:
            up = F.lit(s)                      # only ALERT is above, and it is instant
        down = (F.when((cnt >= DEMOTION_STREAK) & (mx < BAND_LOWER[s]), s - 1).otherwise(s)
                if s > 0 else F.lit(0))
        out.append(F.when(b == 3, 3).when(b > s, up).when(b < s, down).otherwise(s))
    return F.array(*out)


def tick_maps(scores: DataFrame, keys: Sequence[str] = KEYS, order: str = "idx",
              p: str = "p") -> DataFrame:
    """Adds ``tmap``: the tick's transition map (array of 4 ints)."""
    w3 = Window.partitionBy(*keys).orderBy(order).rowsBetween(-2, 0)
    return scores.withColumn("tmap", _tick_map(
        F.col(p), F.min(p).over(w3), F.max(p).over(w3), F.count(p).over(w3)))


def _compose(first: Column, then: Column) -> Column:
    """The map 'apply ``first``, then ``then``'."""
    return F.transform(first, lambda s: then[s])


IDENTITY = [0, 1, 2, 3]


def _identity() -> Column:
    return F.array(*[F.lit(s) for s in IDENTITY])


def _inclusive_prefix(df: DataFrame, part: Sequence[str], order: str, col: str, steps: int) -> DataFrame:
    """Adds ``pre``: the composition of ``col`` over all earlier rows of the
    partition and this one (prefix doubling, ``steps`` lag passes)."""
    w = Window.partitionBy(*part).orderBy(order)
    df = df.withColumn("pre", F.col(col))
    for j in range(steps):
        earlier = F.lag("pre", 2 ** j).over(w)
        df = df.withColumn("pre", F.when(earlier.isNull(), F.col("pre")).otherwise(_compose(earlier, F.col("pre"))))
    return df


def alert_states(scores: DataFrame, keys: Sequence[str] = KEYS, order: str = "idx",
                 chunk: int = 64, group: int = 1024) -> DataFrame:
    """``state`` (0..3) and ``status`` for every tick, starting NORMAL.

    ``order`` must number the ticks of a key 0, 1, 2, ... without gaps. No
    step holds a whole key, so one key with a third of all ticks still
    spreads over many tasks:

    1. ticks are grouped in chunks of ``chunk`` (plus the two ticks before
       the chunk as halo, for the 3-tick tails) and each tick's transition
       map is built from its sorted chunk array;
    2. the chunk's composed map folds its ticks;
    3. chunk maps get their prefix inside groups of ``group`` chunks
       (doubling over (key, group)), group maps get theirs over the key
       (doubling over ``ticks / (chunk*group)`` rows);
    4. each chunk pushes its entry state through its own ticks.
    """
    if chunk < 2:
        raise ValueError("chunk must hold at least the 2-tick halo")
    keys = list(keys)
    c = F.floor(F.col(order) / chunk).cast("bigint")
    other = [x for x in scores.columns if x not in (*keys, order)]
    item = F.struct(F.col(order).alias("_o"), F.col("_halo"), *[F.col(x) for x in other])
    # one pass: every tick once at home, the last two of a chunk once more
    # as halo of the next chunk
    copies = F.when(F.pmod(F.col(order), F.lit(chunk)) >= chunk - 2, F.array(F.lit(False), F.lit(True))) \
              .otherwise(F.array(F.lit(False)))
    t = scores.withColumn("_halo", F.explode(copies)) \
              .withColumn("_c", c + F.when(F.col("_halo"), 1).otherwise(0))
    g = t.groupBy(*keys, "_c").agg(F.array_sort(F.collect_list(item)).alias("_a"))

    def tmap(x, j):
        arr = F.col("_a")
        p1, p2 = F.get(arr, j - 1)["p"], F.get(arr, j - 2)["p"]
        cnt = F.lit(1) + F.when(p1.isNotNull(), 1).otherwise(0) + F.when(p2.isNotNull(), 1).otherwise(0)
        return F.struct(x.alias("t"), _tick_map(x["p"], F.least(x["p"], p1, p2),
                                                F.greatest(x["p"], p1, p2), cnt).alias("m"))
    g = g.withColumn("_t", F.filter(F.transform("_a", tmap), lambda e: ~e["t"]["_halo"])).drop("_a")
    g = g.withColumn("_cmap", F.aggregate("_t", _identity(), lambda acc, e: _compose(acc, e["m"])))
    # Doubling steps are sized from the longest key: the chunk table is
    # checkpointed (written once to the session's shared checkpoint folder,
    # which also cuts the lineage for recovery) and the bound is read from it.
    ensure_checkpoint_dir(g.sparkSession)
    g = g.checkpoint(eager=True)
    n_chunks = (g.agg(F.max("_c")).first()[0] or 0) + 1
    # level 2: prefix of chunk maps inside each group of chunks
    g = g.withColumn("_g", F.floor(F.col("_c") / group).cast("bigint"))
    per_group = min(group, n_chunks)
    g = _inclusive_prefix(g, [*keys, "_g"], "_c", "_cmap",
                          math.ceil(math.log2(per_group)) if per_group > 1 else 0)
    wg = Window.partitionBy(*keys, "_g").orderBy("_c")
    g = g.withColumn("_excl_c", F.coalesce(F.lag("pre", 1).over(wg), _identity())).withColumnRenamed("pre", "_pre_c")
    # level 3: prefix of group maps over the key
    gm = g.groupBy(*keys, "_g").agg(F.max_by("_pre_c", "_c").alias("_gmap"))
    n_groups = max(1, math.ceil(n_chunks / group))
    gm = _inclusive_prefix(gm, keys, "_g", "_gmap", max(0, math.ceil(math.log2(n_groups))) if n_groups > 1 else 0)
    wk = Window.partitionBy(*keys).orderBy("_g")
    gm = gm.select(*keys, "_g", F.coalesce(F.lag("pre", 1).over(wk), _identity()).alias("_excl_g"))
    g = g.join(gm, [*keys, "_g"])
    g = g.withColumn("_entry", F.col("_excl_c")[F.col("_excl_g")[0]])
    walked = g.withColumn("_walk", F.aggregate(
        "_t", F.struct(F.col("_entry").alias("s"), F.array().cast("array<int>").alias("out")),
        lambda acc, e: F.struct(e["m"][acc["s"]].alias("s"),
                                F.concat(acc["out"], F.array(e["m"][acc["s"]])).alias("out"))))
    z = walked.select(*keys, F.explode(F.arrays_zip(F.col("_t"), F.col("_walk.out"))).alias("z"))
    out = z.select(*keys, "z._t.t.*", F.col("z.out").alias("state"))
    out = out.withColumnRenamed("_o", order).drop("_halo")
    return out.withColumn("status", state_name(F.col("state")))


def tick_map(tail: Sequence[float]) -> np.ndarray:
    """The transition map of one tick outside a plan, from the key's last probabilities (newest last).

    The numpy counterpart of ``_tick_map``, for streams that carry a key's state themselves.
    """
    bounds, held = np.asarray(BAND_LOWER), np.arange(len(STATES))
    band = int(np.searchsorted(bounds[1:], tail[-1], side="right"))
    if band == held[-1]:
        return np.full_like(held, band)
    climbs = np.zeros_like(held)
    climbs[0] = 1
    climbs[1] = len(tail) >= PROMOTION_STREAK_WARNING and min(tail[-PROMOTION_STREAK_WARNING:]) >= bounds[2]
    falls = (max(tail[-DEMOTION_STREAK:]) < bounds) & (len(tail) >= DEMOTION_STREAK) & (held > 0)
    return held + climbs * (band > held) - falls * (band < held)


def alert_transitions(states: DataFrame, keys: Sequence[str] = KEYS, order: str = "idx") -> DataFrame:
    """Ticks where the state rises into WARNING/ALERT (``chime``), enters
    ALERT (``alert_on``) or leaves it (``alert_off``). The state before the
    first tick is NORMAL."""
    w = Window.partitionBy(*keys).orderBy(order)
    prev = F.coalesce(F.lag("state").over(w), F.lit(0))
    s = states.withColumn("prev_state", prev)
    ev = F.filter(F.array(
        F.when((F.col("state") > F.col("prev_state")) & (F.col("state") >= 2), F.lit("chime")),
        F.when((F.col("state") == 3) & (F.col("prev_state") != 3), F.lit("alert_on")),
        F.when((F.col("state") != 3) & (F.col("prev_state") == 3), F.lit("alert_off"))),
        lambda x: x.isNotNull())
    return (s.select(*keys, order, state_name(F.col("prev_state")).alias("from_status"),
                     F.col("status").alias("to_status"), F.explode(ev).alias("event")))


def monitor_counters(ticks: DataFrame, keys: Sequence[str] = KEYS, order: str = "idx",
                     threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Running windows seen, windows at or above the threshold, peak."""
    run = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return ticks.select(*keys, order,
                        F.count(F.lit(1)).over(run).cast("bigint").alias("seen"),
                        F.sum(F.when(F.col("p") >= threshold, 1).otherwise(0)).over(run)
                        .cast("bigint").alias("above"),
                        F.greatest(F.max("p").over(run), F.lit(0.0)).alias("peak"))
