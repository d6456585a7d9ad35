"""Keyed stateful live monitor (X1-X7, X9) for ``transformWithStateInPandas``.

A key is a series. Its rows are samples and configuration changes; a change takes effect at its own time, for the
samples that arrive from then on, whichever micro-batch brings it. Typed states hold what the rules need: the last
``window - 1`` samples, a ring per channel for the frozen test, the ring of intervals, the ring of probabilities, the
raised flags, the changes that late samples may still ask for, and one row of counters. Each is bounded by a ring
size or by the lateness allowed, so a key's state never grows with its stream. A processing-time timer, set anew with
every batch, tells of a stream that has become stale (X9).

A key's micro-batch, bounded by what the source admits at a time, is handled as arrays: the carried rings are put
before the new samples, quality flags of all samples are computed at once, the scorer is called per model on blocks
of windows, and only the alert state is stepped through. Ticks come before the quality frames of the same sample;
only changes of quality flags are emitted.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..config import (ALERT_THRESHOLD, FROZEN_LOOKBACK, INTERVAL_LOOKBACK, LIVE_PROB_RING, STATES,
                      UNEVEN_STD_THRESHOLD, WINDOW)
from ..operators.alerts import tick_map
from ..operators.quality import CODES

# (model id, windows of shape (n, window, channels)) -> n probabilities
Scorer = Callable[[str, np.ndarray], np.ndarray]

#: Windows handed to the scorer at a time.
SCORE_WINDOWS = 4096


def input_schema(channels: Sequence[str]) -> str:
    """Samples (``kind`` sample) and configuration changes (``kind`` config, ``arrival_s`` is when they take effect)."""
    return ("series_id long, kind string, seq long, ts timestamp, arrival_s double, "
            + ", ".join(f"{c} double" for c in channels) + ", model_id string, threshold double")


def output_schema(channels: Sequence[str]) -> str:
    """Frames of a series: ticks with the newest sample, quality frames with a message, applied changes."""
    return ("series_id long, seq long, kind string, ts timestamp, tick long, p double, status string, "
            "in_anomaly_window boolean, threshold double, model_id string, code string, channel string, "
            "severity string, message string, " + ", ".join(f"{c} double" for c in channels))


def _message(code: str, channel: str | None) -> str:
    return {
        "FROZEN_SENSOR": f"{channel}: the last {FROZEN_LOOKBACK} values are all the same; the sensor may be stuck or unplugged.",
        "FROZEN_CLEARED": f"{channel}: values vary again.",
        "OUT_OF_RANGE": f"{channel}: the value lies outside the physical range; check sensor, unit and wiring.",
        "OUT_OF_RANGE_CLEARED": f"{channel}: values are within the physical range again.",
        "UNEVEN_SAMPLING": f"The last {INTERVAL_LOOKBACK} intervals between samples vary too much; windows span uneven times.",
        "EVEN_SAMPLING_RESTORED": "Samples arrive evenly again.",
        "STALE_DATA": "No sample has arrived for longer than the limit.",
    }[code]


def _frozen(ring: list[float], values: np.ndarray) -> tuple[np.ndarray, list[float]]:
    """Per sample: were the channel's last ``FROZEN_LOOKBACK`` present values all equal? And the new ring."""
    present = ~np.isnan(values)
    seen = np.concatenate([np.asarray(ring, dtype=float), values[present]])
    place = np.arange(len(seen))
    starts = np.ones(len(seen), dtype=bool)
    starts[1:] = seen[1:] != seen[:-1]
    same = place - np.maximum.accumulate(np.where(starts, place, 0)) + 1
    last = np.cumsum(present) + len(ring) - 1
    flags = np.zeros(len(values), dtype=bool)
    if len(seen):
        flags = (last >= 0) & (same[np.maximum(last, 0)] >= FROZEN_LOOKBACK)
    return flags, seen[-FROZEN_LOOKBACK:].tolist()


def _uneven(ring: list[float], last: float | None, arrivals: np.ndarray) -> tuple[np.ndarray, list[float], float | None]:
    """Per sample: is the spread of the last ``INTERVAL_LOOKBACK`` positive intervals too wide? Ring, last arrival."""
    known = ~np.isnan(arrivals)
    times = arrivals[known] if last is None else np.concatenate([[last], arrivals[known]])
    steps = np.diff(times)
    used = np.concatenate([np.asarray(ring, dtype=float), steps[steps > 0]])
    counted = np.zeros(len(arrivals), dtype=int)
    counted[np.flatnonzero(known)[0 if last is not None else 1:]] = steps > 0
    n = np.cumsum(counted) + len(ring)
    flags = np.zeros(len(arrivals), dtype=bool)
    if len(used) >= INTERVAL_LOOKBACK:
        wide = sliding_window_view(used, INTERVAL_LOOKBACK).std(axis=1) > UNEVEN_STD_THRESHOLD
        flags = (n >= INTERVAL_LOOKBACK) & wide[np.maximum(n - INTERVAL_LOOKBACK, 0)]
    return flags, used[-INTERVAL_LOOKBACK:].tolist(), float(times[-1]) if len(times) else last


def resolve_changes(base: tuple, changes: Sequence[tuple]) -> list[tuple]:
    """(at_s, model, threshold, segment) from ``base`` on; in ``changes`` (at_s, model, threshold) None leaves as is.

    The segment counts the changes of the model, to another one or back (X7).
    """
    out = [base]
    for at_s, model, threshold in changes:
        _, old, limit, segment = out[-1]
        model = old if model is None else model
        out.append((at_s, model, limit if threshold is None else threshold, segment + (model != old)))
    return out


class LiveMonitor(StatefulProcessor):
    """The processor of one series; see the module."""

    def __init__(self, channels: Sequence[str], scorer: Scorer, ranges: Mapping[str, tuple[float, float]],
                 window: int = WINDOW, default_model: str = "m1", default_threshold: float = ALERT_THRESHOLD,
                 stale_ms: int | None = None, lateness_s: float = 3600.0, available: Collection[str] | None = None,
                 fallback: str | None = None):
        self.channels, self.scorer, self.ranges, self.window = list(channels), scorer, dict(ranges), window
        self.base = (float("-inf"), default_model, default_threshold, 0)
        self.stale_ms, self.lateness_s = stale_ms, lateness_s
        self.available, self.fallback = available, fallback
        self.bounded = [c for c in self.channels if c in self.ranges]
        self.flags = ([("frozen", c) for c in self.channels] + [("range", c) for c in self.bounded] + [("uneven", None)])
        self.columns = [f.split()[0] for f in output_schema(self.channels).split(", ")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.samples = handle.getListState("samples", ", ".join(f"{c} double" for c in self.channels))
        self.rings = handle.getMapState("rings", "channel string", "seen array<double>")
        self.intervals = handle.getListState("intervals", "step double")
        self.probs = handle.getListState("probs", "p double")
        self.raised = handle.getListState("raised", "flag int")
        self.changes = handle.getListState("changes", "at_s double, model_id string, threshold double")
        self.monitor = handle.getValueState(
            "monitor", "status int, segment long, tick long, last_arrival double, newest double, base_at double, "
                       "base_model string, base_threshold double, base_segment long")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        sent = batch[batch["kind"] == "config"].sort_values("arrival_s", kind="stable", ignore_index=True)
        batch = batch[batch["kind"] == "sample"].sort_values("seq", kind="stable", ignore_index=True)
        st = self._load()
        plan = self._plan(st, sent, batch["arrival_s"])
        values = batch[self.channels].to_numpy(dtype=float)
        made = [self._ticks(st, batch, values, plan), self._quality(st, batch, values)] if len(batch) else []
        if len(sent):
            now = plan[-1]
            made.insert(0, pd.DataFrame({"at": -1, "kind": "config", "model_id": [now[1]], "threshold": [now[2]]}))
        self._save(st)
        if self.stale_ms and len(batch):
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.stale_ms)
        made = [m for m in made if len(m)]
        if made:
            yield self._frames(int(key[0]), batch, pd.concat(made, ignore_index=True))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stale = {"at": -1, "kind": "quality", "code": "STALE_DATA", "severity": "warning"}
        yield self._frames(int(key[0]), pd.DataFrame(), pd.DataFrame([stale]))

    # --- state

    def _load(self) -> dict:
        status, segment, tick, last, newest, *base = self.monitor.get() or (0, 0, 0, None, None, *self.base)
        return {
            "samples": [list(r) for r in self.samples.get()], "intervals": [r[0] for r in self.intervals.get()],
            "rings": {c: list(self.rings.getValue((c,))[0]) if self.rings.containsKey((c,)) else [] for c in self.channels},
            "probs": [r[0] for r in self.probs.get()], "raised": {r[0] for r in self.raised.get()},
            "changes": [tuple(r) for r in self.changes.get()], "status": status, "segment": segment, "tick": tick,
            "last": last, "newest": newest, "base": tuple(base)}

    def _save(self, st: dict) -> None:
        for state, rows in ((self.samples, [tuple(r) for r in st["samples"]]), (self.intervals, [(x,) for x in st["intervals"]]),
                            (self.probs, [(x,) for x in st["probs"]]), (self.raised, [(x,) for x in sorted(st["raised"])]),
                            (self.changes, st["changes"])):
            if rows:
                state.put(rows)
            else:
                state.clear()
        for c, seen in st["rings"].items():
            self.rings.updateValue((c,), (seen,))
        self.monitor.update((st["status"], st["segment"], st["tick"], st["last"], st["newest"], *st["base"]))

    # --- rules

    def _plan(self, st: dict, sent: pd.DataFrame, arrivals: pd.Series) -> list[tuple]:
        """The configuration in force from each time on; changes that no sample can ask for any more join the base."""
        none = lambda v: None if pd.isna(v) else v
        new = [(float(r.arrival_s), none(r.model_id), none(r.threshold)) for r in sent.itertuples()]
        st["changes"] = sorted([*st["changes"], *new], key=lambda c: c[0])
        plan = resolve_changes(st["base"], st["changes"])
        newest = arrivals.max()
        st["newest"] = st["newest"] if pd.isna(newest) else float(newest) if st["newest"] is None else max(st["newest"], float(newest))
        if st["newest"] is not None:
            old = sum(c[0] <= st["newest"] - self.lateness_s for c in st["changes"])
            st["base"], st["changes"] = plan[old], st["changes"][old:]
        return plan

    def _ticks(self, st: dict, batch: pd.DataFrame, values: np.ndarray, plan: list[tuple]) -> pd.DataFrame:
        """One row per tick; moves the window, the alert state and the counter on."""
        window, carried = self.window, np.asarray(st["samples"], dtype=float).reshape(-1, len(self.channels))
        rows = np.concatenate([carried, values])
        st["samples"] = rows[max(0, len(rows) - window + 1):].tolist()
        if len(rows) < window:
            return pd.DataFrame(columns=["at"])
        full = sliding_window_view(~np.isnan(rows).any(axis=1), window).all(axis=1)
        ends = np.flatnonzero(full)
        at = ends + window - 1 - len(carried)
        ends, at = ends[at >= 0], at[at >= 0]
        frames = sliding_window_view(rows, window, axis=0).swapaxes(1, 2)
        times = np.array([c[0] for c in plan[1:]], dtype=float)
        force = np.searchsorted(times, batch["arrival_s"].to_numpy(dtype=float)[at], side="right")
        models = np.array([self._usable(c[1]) for c in plan], dtype=object)[force]
        p = np.empty(len(at))
        for model in pd.unique(models):
            own = np.flatnonzero(models == model)
            for k in range(0, len(own), SCORE_WINDOWS):
                part = own[k:k + SCORE_WINDOWS]
                p[part] = self.scorer(model, frames[ends[part]])
        status = []
        for x, segment in zip(p.tolist(), np.array([c[3] for c in plan])[force].tolist()):
            if segment != st["segment"]:  # X7: a model switch starts anew, also one that was switched back
                st["segment"], st["probs"], st["status"] = segment, [], 0
            st["probs"] = [*st["probs"], x][-LIVE_PROB_RING:]
            st["status"] = int(tick_map(st["probs"])[st["status"]])
            status.append(STATES[st["status"]])
        first, st["tick"] = st["tick"] + 1, st["tick"] + len(at)
        limits = np.array([c[2] for c in plan], dtype=float)[force]
        newest = pd.DataFrame(values[at], columns=self.channels)
        return pd.DataFrame({
            "at": at, "kind": "tick", "tick": np.arange(first, first + len(at)), "p": p, "status": status,
            "in_anomaly_window": p >= limits, "threshold": limits, "model_id": models}).join(newest)

    def _usable(self, model: str) -> str:
        """The fallback model where the one asked for is not there."""
        return model if self.available is None or model in self.available or self.fallback is None else self.fallback

    def _quality(self, st: dict, batch: pd.DataFrame, values: np.ndarray) -> pd.DataFrame:
        """One row per flag that changed at a sample."""
        flags = np.zeros((len(values) + 1, len(self.flags)), dtype=bool)
        flags[0, sorted(st["raised"])] = True
        for k, c in enumerate(self.channels):
            flags[1:, k], st["rings"][c] = _frozen(st["rings"][c], values[:, k])
        for k, c in enumerate(self.bounded):
            lo, hi = self.ranges[c]
            x = values[:, self.channels.index(c)]
            flags[1:, len(self.channels) + k] = (x < lo) | (x > hi)
        flags[1:, -1], st["intervals"], st["last"] = _uneven(
            st["intervals"], st["last"], batch["arrival_s"].to_numpy(dtype=float))
        st["raised"] = set(np.flatnonzero(flags[-1]).tolist())
        at, which = np.nonzero(flags[1:] != flags[:-1])
        up = flags[at + 1, which]
        return pd.DataFrame({
            "at": at, "kind": "quality", "code": [CODES[self.flags[w][0]][0 if u else 1] for w, u in zip(which, up)],
            "channel": [self.flags[w][1] for w in which], "severity": np.where(up, "warning", "info")})

    def _frames(self, series: int, batch: pd.DataFrame, out: pd.DataFrame) -> pd.DataFrame:
        out = out.sort_values("at", kind="stable", ignore_index=True).reindex(columns=["at", *self.columns])
        out["series_id"] = series
        if len(batch):
            for c in ("seq", "ts"):
                out[c] = batch[c].reindex(out["at"]).to_numpy()  # -1, a frame without a sample, gets none
        coded = out["code"].notna()
        out["message"] = [_message(c, ch) if k else None for c, ch, k in zip(out["code"], out["channel"], coded)]
        out = out[self.columns]
        out = out.astype(object).where(out.notna(), None)
        kinds = {"seq": "Int64", "tick": "Int64", "p": float, "threshold": float, "ts": "datetime64[ns]"} | {c: float for c in self.channels}
        return out.astype(kinds)


def fixture_scorer(models: Mapping[str, tuple[float, float]], channel_pos: int = 0) -> Scorer:
    """The fixture stand-in model: sigmoid of the window's ch1 sum in cents."""
    def score(model: str, windows: np.ndarray) -> np.ndarray:
        slope, bias = models[model]
        cents = np.round(windows[:, :, channel_pos] * 100).sum(axis=1)
        return np.round(1.0 / (1.0 + np.exp(-(slope * (cents / 2000.0 - 50) + bias))), 6)
    return score
