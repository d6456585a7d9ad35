"""Alert ladder: transition maps against the rules, and composed maps == sequential fold."""

import random

import pytest
from pyspark.sql import functions as F

from early_warning.config import STATES
from early_warning.operators import alerts

BOUNDS = [0.0, 0.3, 0.5, 0.8]  # lower bounds of the bands, by state
STREAK = 3


def step(state, tail):
    """The rules as sentences: the last reading's band decides the direction, streaks decide whether to move."""
    reading, streak = tail[-1], tail[-STREAK:]
    if reading >= BOUNDS[3]:
        return 3  # an alert is immediate
    rises = state < 3 and reading >= BOUNDS[state + 1]
    sinks = reading < BOUNDS[state]
    if rises and state == 0:
        return 1  # watching needs one reading
    if rises and len(streak) == STREAK and all(x >= BOUNDS[state + 1] for x in streak):
        return state + 1
    if sinks and len(streak) == STREAK and all(x < BOUNDS[state] for x in streak):
        return state - 1
    return state


def generated_tails():
    """Tails of 1 to 4 readings on, just under and just over every bound."""
    readings = sorted({round(b + d, 4) for b in BOUNDS[1:] for d in (-1e-4, 0.0, 1e-4)} | {0.0, 1.0})
    rng = random.Random(0)
    for n in range(1, 5):
        for last in readings:
            for _ in range(12):
                yield [rng.choice(readings) for _ in range(n - 1)] + [last]
            yield [last] * n


def test_transition_maps_follow_the_rules(spark):
    tails = list(generated_tails())
    for tail in tails:
        assert alerts.tick_map(tail).tolist() == [step(s, tail) for s in range(4)], tail
    rows = [(k, i, p) for k, tail in enumerate(tails) for i, p in enumerate(tail)]
    maps = alerts.tick_maps(spark.createDataFrame(rows, "k long, idx long, p double"), ["k"])
    for r in maps.collect():
        assert r.tmap == [step(s, tails[r.k][:r.idx + 1]) for s in range(4)], (tails[r.k], r.idx)


@pytest.mark.parametrize("p,band", [(0.3, 1), (0.5, 2), (0.8, 3), (0.2999, 0), (0.0, 0), (1.0, 3)])
def test_band_edges(spark, p, band):
    got = spark.range(1).select(alerts.band_for(F.lit(p)).alias("b")).first().b
    assert got == band


@pytest.mark.parametrize("chunk,group", [(2, 2), (3, 4), (16, 2), (64, 1024)])
def test_composed_maps_equal_fold(spark, chunk, group):
    rng = random.Random(chunk)
    rows, want = [], {}
    for s in range(6):
        n = rng.randint(1, 150)
        ps = [round(rng.choice([rng.random(), rng.uniform(0.25, 0.85)]), 3) for _ in range(n)]
        for k, p in enumerate(ps):
            rows.append((s, "m", k, p))
        state = 0
        for k in range(n):
            state = step(state, ps[:k + 1])
            want[(s, k)] = STATES[state]
    df = spark.createDataFrame(rows, "series_id long, model_id string, idx long, p double")
    got = {(r.series_id, r.idx): r.status for r in alerts.alert_states(df, chunk=chunk, group=group).collect()}
    assert got == want
