"""Forests and boosted trees over binned features.

Values become one byte each: the number of the first of at most 31 cut points that is no less (cut points from the
value counts of a sample of rows, as Spark ML takes them). A tree works on bytes only, so a window is as many bytes as
it has values, and a tree node is one feature, one byte and the place of its left child (the right one is next).

* Forest (gini, a feature subset a node, nodes down to one class): trees do not depend on each other. A task grows a
  group of trees; it takes the binned rows into a file of its own that is mapped, one line a feature, and grows level
  by level, all nodes of a level at once. No histogram of a node leaves its task, and the driver sees no node.
* Boosted trees (variance of the log loss residuals, as Spark ML's): rounds depend on each other. The binned rows are
  dealt into shares, mapped files of the executors; a level is one job over them that gives the sums a node, feature
  and bin. Of two children only the smaller one is counted, the other is the rest of its parent; features are counted
  in pairs. Jobs run where the files are; if a share is gone, all are made again and the trees so far replayed.

Trees are rows of a table. Few nodes score in place, in one pass; many in groups of trees, whose sums meet by row.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import suppress
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import RDD, SparkFiles
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, written

BINS = 32
#: Rows that the cut points are taken from, as in Spark ML.
CUT_ROWS = 10000
#: Nodes of a level whose splits are found together.
NODES = 8192
#: Rows of a node that is sorted and not counted, by the width that it is held in.
WIDTHS = (4, 8, 16)
#: Trees times rows of a group of trees.
GROUP_ROWS = 1 << 24
#: Models of at most so many nodes score in one pass.
PASS_NODES = 1 << 21
#: Rows counted together, and rows of a share of the boosted rows at least.
CHUNK, SHARE_ROWS = 1 << 17, 1000
#: Times that shares are made again without a new tree in between.
LOSSES = 5
UNION = "spark.sql.unionOutputPartitioning"
TREE = "tree int, grp int, weight double, nodes long, feature binary, cut binary, left binary, value binary"


@dataclass(frozen=True)
class TreeModel:
    """``cuts`` a feature and the table of trees (``TREE``); ``boosted`` sums are margins, others shares of class 1."""

    cuts: list[list[float]]
    trees: DataFrame
    boosted: bool

    def head(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.cuts, self.boosted)], "cuts array<array<double>>, boosted boolean")

    @classmethod
    def of(cls, head: DataFrame, trees: DataFrame) -> TreeModel:
        (h,) = head.collect()
        return cls([list(c) for c in h.cuts], trees, h.boosted)


def cut_points(values: np.ndarray) -> list[float]:
    """At most BINS - 1 cut points between the distinct values: all of them, or those nearest to equal counts."""
    v, counts = np.unique(values, return_counts=True)
    if len(v) <= BINS:
        return ((v[:-1] + v[1:]) / 2).tolist()
    upto, stride, out = np.cumsum(counts), len(values) / BINS, []
    want = stride
    for k in range(1, len(v)):
        if abs(upto[k - 1] - want) < abs(upto[k] - want):
            out.append(float((v[k - 1] + v[k]) / 2))
            want += stride
    return out[:BINS - 1]


def fit_cuts(train: DataFrame, features: str, n: int, seed: int = 1) -> list[list[float]]:
    x = train.select(vector_to_array(features).alias("x"))
    got = (x if n <= CUT_ROWS else x.sample(min(1.0, CUT_ROWS / n), seed)).toPandas()["x"]
    if not len(got):
        got = x.limit(CUT_ROWS).toPandas()["x"]
    return [cut_points(c[~np.isnan(c)]) for c in np.stack(got.to_numpy()).T]


def _side_by_side(parts: Sequence[DataFrame], name: str) -> DataFrame:
    """The parts, each of one task, written as one table. Spark 4.1 would run parts that are all in one partition in
    one task, one after the other."""
    conf = parts[0].sparkSession.conf
    was = conf.get(UNION, None)
    conf.set(UNION, "false")
    try:
        return written(reduce(DataFrame.unionAll, parts), name)
    finally:
        conf.unset(UNION) if was is None else conf.set(UNION, was)


def _codes(x: pd.Series, cuts: list[np.ndarray]) -> np.ndarray:
    values = np.stack(x.to_numpy())
    return np.stack([np.searchsorted(c, values[:, k]) for k, c in enumerate(cuts)], axis=1).astype("uint8")


def binned(frame: DataFrame, features: str, cuts: Sequence[Sequence[float]], keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and ``x``, one byte a feature."""
    at = [np.array(c) for c in cuts]

    def fn(batches):
        for b in batches:
            if len(b):
                yield b.assign(x=[r.tobytes() for r in _codes(b["x"], at)])
    df = frame.select(*keep, vector_to_array(features).alias("x"))
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.mapInPandas(fn, f"{kinds}, x binary")


def _bytes(rows) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "uint8").reshape(len(rows), -1)


def _lines(n: int, width: int, dtype: str) -> np.ndarray:
    """A matrix of one line a feature in a mapped file that has no name."""
    if not n:
        return np.zeros((width, 0), dtype)
    with tempfile.TemporaryFile() as f:
        return np.memmap(f, dtype, "w+", shape=(width, n))


# ------------------------------------------------------------------ forest --

def _best_counted(flat, n, rows, sizes, y, w, tot, feats):
    """Per node the best split of its features by counts of the bins: (feature, last bin that goes left, class counts
    left); without one that parts the classes better than none, feature -1."""
    nodes = len(sizes)
    base = np.repeat(np.arange(nodes) * (2 * BINS), sizes) + BINS * y[rows].astype("int64")
    wr = None if w is None else w[rows]
    t0, t1 = tot[:, :1], tot[:, 1:]
    whole = tot.sum(axis=1, keepdims=True)
    top = ((t0 * t0 + t1 * t1) / whole)[:, 0] * (1 + 1e-12)
    of, at, left = np.full(nodes, -1, "int16"), np.zeros(nodes, "uint8"), np.zeros((nodes, 2))
    line = np.arange(nodes)
    for j in range(feats.shape[1]):
        key = flat[np.repeat(feats[:, j] * n, sizes) + rows] + base
        held = np.bincount(key, wr, 2 * BINS * nodes).reshape(nodes, 2, BINS).cumsum(axis=2, dtype="float64")
        l0, l1 = held[:, 0], held[:, 1]
        nl = l0 + l1
        nr = whole - nl
        r0, r1 = t0 - l0, t1 - l1
        score = (l0 * l0 + l1 * l1) / np.maximum(nl, 1) + (r0 * r0 + r1 * r1) / np.maximum(nr, 1)
        score[(nl == 0) | (nr == 0)] = -1
        s = score.argmax(axis=1)
        v = score[line, s]
        better = v > top
        top = np.where(better, v, top)
        of[better], at[better] = feats[better, j], s[better]
        left[better] = held[line[better], :, s[better]]
    return of, at, left


def _best_sorted(flat, n, rows, start, sizes, width, y, w, tot, feats):
    """As ``_best_counted``, for nodes of at most ``width`` rows: their bins are sorted."""
    nodes, m = feats.shape
    there = np.arange(width) < sizes[:, None]
    of_node = rows[np.minimum(start[:, None] + np.arange(width), len(rows) - 1)]
    low = 128 * y[of_node].astype("uint16") + (1 if w is None else w[of_node].astype("uint16"))  # draws are few
    key = flat[feats[:, :, None] * n + of_node[:, None, :]].astype("uint16") * 256 + low[:, None, :]
    key[np.broadcast_to(~there[:, None, :], key.shape)] = 65408  # last, no draw
    key.sort(axis=2)
    drawn = (key & 127).astype("float32")
    nl = drawn.cumsum(axis=2)
    l1 = np.where(key & 128, drawn, 0).cumsum(axis=2)
    t1, whole = tot[:, 1, None, None].astype("float32"), tot.sum(axis=1)[:, None, None].astype("float32")
    l0, r1, nr = nl - l1, t1 - l1, whole - nl
    r0 = nr - r1
    score = (l0 * l0 + l1 * l1) / np.maximum(nl, 1) + (r0 * r0 + r1 * r1) / np.maximum(nr, 1)
    bins = key >> 8
    score[:, :, :-1][bins[:, :, :-1] == bins[:, :, 1:]] = -1
    score[nr <= 0] = -1
    score = score.reshape(nodes, -1)
    best, line = score.argmax(axis=1), np.arange(nodes)
    j, k = best // width, best % width
    found = score[line, best] > (tot * tot).sum(axis=1) / tot.sum(axis=1) * (1 + 1e-5)
    return (np.where(found, feats[line, j], -1).astype("int16"), bins[line, j, k].astype("uint8"),
            np.stack([l0[line, j, k], l1[line, j, k]], axis=1).astype("float64"))


def _best_splits(flat, n, rows, sizes, y, w, tot, n_features, m, rng):
    """The best split among ``m`` features of each node whose ``sizes`` rows stand together."""
    nodes = len(sizes)
    feats = (rng.random((nodes, n_features)).argpartition(m - 1, axis=1)[:, :m] if m < n_features
             else np.broadcast_to(np.arange(m), (nodes, m)))
    of, at, left = np.full(nodes, -1, "int16"), np.zeros(nodes, "uint8"), np.zeros((nodes, 2))
    start, least = np.cumsum(sizes) - sizes, 0
    for width in WIDTHS:
        at_node = np.flatnonzero((sizes > least) & (sizes <= width))
        least = width
        for lo in range(0, len(at_node), NODES // width):
            k = at_node[lo:lo + NODES // width]
            of[k], at[k], left[k] = _best_sorted(flat, n, rows, start[k], sizes[k], width, y, w, tot[k], feats[k])
    k = np.flatnonzero(sizes > least)
    if len(k):
        of[k], at[k], left[k] = _best_counted(flat, n, rows[np.repeat(sizes > least, sizes)], sizes[k], y, w, tot[k], feats[k])
    return of, at, left, of >= 0


def grow_tree(x: np.ndarray, y: np.ndarray, w: np.ndarray | None, m: int, max_depth: int, rng) -> tuple:
    """(feature, cut, left child, share of class 1) of all nodes, level by level; a leaf has feature -1. ``x`` has a
    line of bytes a feature, ``w`` how often a row is drawn."""
    n_features, n = x.shape
    flat = x.reshape(-1)
    rows = np.arange(n) if w is None else np.flatnonzero(w)
    tot = np.bincount(y[rows], None if w is None else w[rows], 2).astype("float64")[None, :]
    sizes, active, done, depth, levels = np.array([len(rows)]), np.arange(1), 0, 0, []
    if tot.min() == 0 or max_depth == 0:
        active, sizes = active[:0], sizes[:0]
    while True:
        k = len(tot)
        feature, cut, child = np.full(k, -1, "int16"), np.zeros(k, "uint8"), np.zeros(k, "int32")
        levels.append((feature, cut, child, tot[:, 1] / np.maximum(tot.sum(axis=1), 1)))
        done += k
        if not len(active):
            break
        ends = np.cumsum(sizes)
        found = [_best_splits(flat, n, rows[ends[lo] - sizes[lo]:ends[min(lo + NODES, len(active)) - 1]],
                              sizes[lo:lo + NODES], y, w, tot[active[lo:lo + NODES]], n_features, m, rng)
                 for lo in range(0, len(active), NODES)]
        of, at, left, ok = (np.concatenate(c) for c in zip(*found))
        split = active[ok]
        feature[split], cut[split], child[split] = of[ok], at[ok], done + 2 * np.arange(len(split))
        if not len(split):
            break
        rows, sizes = rows[np.repeat(ok, sizes)], sizes[ok]
        of, at, left = of[ok].astype("int64"), at[ok], left[ok]
        right = tot[split] - left
        tot = np.stack([left, right], axis=1).reshape(-1, 2)
        depth += 1
        # rows of a node stay together: first those that go left
        goes = flat[np.repeat(of * n, sizes) + rows] > np.repeat(at, sizes)
        start = np.cumsum(sizes) - sizes
        before = np.cumsum(~goes) - ~goes  # that went left before this row
        lefts = np.add.reduceat(~goes, start, dtype="int64")
        rank = before - np.repeat(before[start], sizes)
        place = np.repeat(start, sizes) + np.where(goes, np.repeat(lefts - start, sizes) + np.arange(len(rows)) - rank, rank)
        moved = np.empty_like(rows)
        moved[place] = rows
        sizes = np.stack([lefts, sizes - lefts], axis=1).reshape(-1)
        open_ = (tot.min(axis=1) > 0) & (depth < max_depth)
        rows, sizes, active = moved[np.repeat(open_, sizes)], sizes[open_], np.flatnonzero(open_)
    return tuple(np.concatenate(c) for c in zip(*levels))


def _tree_row(no: int, grp: int, weight: float, tree: tuple) -> dict:
    feature, cut, child, value = tree
    return {"tree": no, "grp": grp, "weight": weight, "nodes": len(feature), "feature": feature.astype("int16").tobytes(),
            "cut": cut.astype("uint8").tobytes(), "left": child.astype("int32").tobytes(),
            "value": value.astype("float64").tobytes()}


def _tree_of(r) -> tuple:
    return (np.frombuffer(r.feature, "int16"), np.frombuffer(r.cut, "uint8"), np.frombuffer(r.left, "int32"),
            np.frombuffer(r.value, "float64"))


def _grower(trees: Sequence[int], grp: int, n: int, n_features: int, m: int, bootstrap: bool, max_depth: int, seed: int):
    def fn(batches):
        x, y, at = _lines(n, n_features, "uint8"), np.zeros(n, "uint8"), 0
        for b in batches:
            if len(b):
                x[:, at:at + len(b)] = _bytes(b["x"]).T
                y[at:at + len(b)] = b["y"]
                at += len(b)
        for no in trees:
            rng = np.random.default_rng([seed, no])
            w = rng.poisson(1.0, n).astype("float64") if bootstrap else None
            if w is not None and not w.any():
                w[rng.integers(n)] = 1
            yield pd.DataFrame([_tree_row(no, grp, 1.0, grow_tree(x, y, w, m, max_depth, rng))])
    return fn


def fit_forest(train: DataFrame, features: str, n: int, n_features: int, trees: int, bootstrap: bool,
               max_depth: int = 30, seed: int = 1) -> TreeModel:
    """A forest over ceil(sqrt(features)) features a node; the binned rows and the trees are written once."""
    cuts = fit_cuts(train, features, n, seed)
    rows = written(binned(train.withColumn("y", F.col("label").cast("tinyint")), features, cuts, ["y"]), "bins")
    m = int(np.ceil(np.sqrt(n_features)))
    groups = min(trees, max(2 * train.sparkSession.sparkContext.defaultParallelism, -(-trees * n // GROUP_ROWS)))
    parts = [rows.coalesce(1).mapInPandas(
        _grower(range(g, trees, groups), g, n, n_features, m, bootstrap, max_depth, seed), TREE) for g in range(groups)]
    return TreeModel(cuts, _side_by_side(parts, "trees"), False)


# ----------------------------------------------------------- boosted trees --

def _counted(pairs, n_features, rows, slot, slots, g):
    """Rows and sum of ``g`` by slot, feature and bin."""
    cells = slots * BINS * BINS
    c, s = np.zeros((len(pairs), cells), "int64"), np.zeros((len(pairs), cells))
    for lo in range(0, len(rows), CHUNK):
        i = rows[lo:lo + CHUNK]
        base, gi = slot[lo:lo + CHUNK] * (BINS * BINS), g[i]
        for p in range(len(pairs)):
            key = base + pairs[p][i]
            c[p] += np.bincount(key, None, cells)
            s[p] += np.bincount(key, gi, cells)
    out = []
    for h in (c, s):
        h = h.reshape(len(pairs), slots, BINS, BINS)
        by = np.stack([h.sum(axis=3), h.sum(axis=2)], axis=1).reshape(2 * len(pairs), slots, BINS)
        out.append(np.ascontiguousarray(by[:n_features].transpose(1, 0, 2)))
    return out[0].astype("int32"), out[1]


def _best_cuts(c, s, share, rng):
    """Per node (feature, last bin that goes left, rows and sum left, found) by the variance that a split removes."""
    nodes, n_features, _ = c.shape
    nl, sl = c.cumsum(axis=2, dtype="float64"), s.cumsum(axis=2)
    n, t = nl[:, :, -1:], sl[:, :, -1:]
    nr = n - nl
    score = sl * sl / np.maximum(nl, 1) + (t - sl) ** 2 / np.maximum(nr, 1)
    score[(nl == 0) | (nr == 0)] = -np.inf
    if share < 1:
        m = max(1, int(np.ceil(share * n_features)))
        out = rng.random((nodes, n_features)).argpartition(m - 1, axis=1)[:, m:]
        np.put_along_axis(score, np.repeat(out[:, :, None], BINS, axis=2), -np.inf, axis=1)
    score = score.reshape(nodes, -1)
    best = score.argmax(axis=1)
    f, b, line = best // BINS, best % BINS, np.arange(nodes)
    none = (t * t / np.maximum(n, 1))[:, 0, 0]
    return f, b, nl[line, f, b], sl[line, f, b], score[line, best] > none * (1 + 1e-10) + 1e-12


@dataclass(frozen=True)
class _Share:
    """Files of one share on its executor: feature pairs, signs of the labels and, by round, scores and nodes."""

    name: str
    n_features: int
    no: int

    def path(self, what: str) -> str:
        return os.path.join(SparkFiles.getRootDirectory(), f"{self.name}-{self.no}-{what}")

    def put(self, what: str, a: np.ndarray) -> None:
        part = self.path(f"{what}-{uuid.uuid4().hex}")
        a.tofile(part)
        os.replace(part, self.path(what))

    def get(self, what: str, dtype: str) -> np.ndarray:
        return np.fromfile(self.path(what), dtype)

    def drop(self, *whats: str) -> None:
        for what in whats:
            if os.path.exists(self.path(what)):
                os.remove(self.path(what))

    def pairs(self, m: int) -> np.ndarray:
        width = -(-self.n_features // 2)
        return np.memmap(self.path("pairs"), "uint16", "r", shape=(width, m)) if m else np.zeros((width, 0), "uint16")

    def fill(self, blocks, grown: Sequence[tuple[float, tuple]]) -> None:
        """The share's rows, and their score after the trees grown so far."""
        sign = []
        with tempfile.TemporaryFile() as held:
            for b in blocks:
                held.write(b.x)
                sign.append(2 * np.frombuffer(b.y, "int8") - 1)
            held.flush()
            sign = np.concatenate(sign) if sign else np.zeros(0, "int8")
            m = len(sign)
            score = np.zeros(m)
            if m:
                x = np.memmap(held, "uint8", "r", shape=(m, self.n_features))
                pairs = np.memmap(self.path("pairs"), "uint16", "w+", shape=(-(-self.n_features // 2), m))
                for lo in range(0, m, CHUNK):
                    lines = np.ascontiguousarray(x[lo:lo + CHUNK].T)
                    pairs[:, lo:lo + CHUNK] = lines[0::2].astype("uint16") * BINS
                    pairs[:self.n_features // 2, lo:lo + CHUNK] += lines[1::2]
                    for weight, tree in grown:
                        score[lo:lo + CHUNK] += weight * leaf_values(tree, lines)
                pairs.flush()
        self.put("sign", sign)
        self.put(f"score{len(grown)}", score)

    def routed(self, pairs: np.ndarray, node: np.ndarray, splits) -> np.ndarray:
        """The nodes of all rows after ``splits``: parents, features, last bins that go left, first children."""
        parents, f, b, first = splits
        m, flat, out = len(node), pairs.reshape(-1), node.copy()
        if not len(parents):
            return out
        here = np.full(max(int(parents.max()), int(node.max(initial=0))) + 1, -1)
        here[parents] = np.arange(len(parents))
        for lo in range(0, m, CHUNK):
            at = here[node[lo:lo + CHUNK]]
            i = np.flatnonzero(at >= 0)
            k = at[i]
            v = flat[(f[k] // 2) * m + lo + i]
            out[lo + i] = first[k] + (np.where(f[k] % 2 == 0, v // BINS, v % BINS) > b[k])
        return out

    def level(self, r: int, level: int, splits, value, weight: float, slot_of, slots: int, rows_share: float, seed: int):
        """Sums of the share by slot, feature and bin. A level's files are made from those of the level before and
        not changed, so a task may run twice."""
        sign = self.get("sign", "int8")
        m = len(sign)
        pairs = self.pairs(m)
        if level == 0:
            if not os.path.exists(self.path(f"score{r}")):
                node = self.routed(pairs, self.get(f"node{r - 1}", "int16"), splits)
                self.put(f"score{r}", self.get(f"score{r - 1}", "float64") + weight * value[node])
            self.drop(f"score{r - 2}", f"node{r - 2}", *(f"node{r - 2}-{k}" for k in range(16)))
            node = np.zeros(m, "int16")
        else:
            node = self.routed(pairs, self.get(f"node{r}-{level - 1}", "int16"), splits)
        self.put(f"node{r}-{level}", node)
        self.put(f"node{r}", node)
        score = self.get(f"score{r}", "float64")
        g = 4 * sign / (1 + np.exp(2 * sign * score)) if r else sign.astype("float64")
        rows = np.arange(m)
        if rows_share < 1:
            rows = rows[np.random.default_rng([seed, r, self.no]).random(m) < rows_share]
        slot = slot_of[node[rows]]
        if slot_of.min() < 0:
            rows, slot = rows[slot >= 0], slot[slot >= 0]
        return _counted(pairs, self.n_features, rows, slot, slots, g)


class _Lost(Exception):
    """A share's files are not where its task ran."""


def _sums(shares: RDD, name: str, n_features: int, *call) -> tuple[np.ndarray, np.ndarray]:
    def work(no, held):
        list(held)  # a worker that leaves input is not used again
        try:
            return [_Share(name, n_features, no).level(*call)]
        except FileNotFoundError:
            return [None]
    got = shares.mapPartitionsWithIndex(work, preservesPartitioning=True).collect()
    if any(h is None for h in got):
        raise _Lost(name)
    return sum(h[0].astype("int64") for h in got), sum(h[1] for h in got)


def _round(sums, r: int, before, depth: int, share: float, rows_share: float, seed: int):
    """One tree, with the splits that its rows have still to follow."""
    rng = np.random.default_rng([seed, r])
    c, s = sums(r, 0, *before, np.zeros(1, "int64"), 1, rows_share, seed)
    tot = np.array([[c[0, 0].sum(), s[0, 0].sum()]])
    feature, cut, child, value = [-1], [0], [0], [tot[0, 1] / max(tot[0, 0], 1)]
    active, splits = np.arange(1), (np.zeros(0, "int64"),) * 4
    for level in range(depth):
        f, b, nl, sl, ok = _best_cuts(c, s, share, rng)
        if not ok.any():
            splits = (np.zeros(0, "int64"),) * 4
            break
        f, b, nl, sl, tot, parents, c, s = f[ok], b[ok], nl[ok], sl[ok], tot[ok], active[ok], c[ok], s[ok]
        first = len(feature) + 2 * np.arange(len(parents))
        splits = (parents, f, b, first)
        for k, p in enumerate(parents):
            feature[p], cut[p], child[p] = int(f[k]), int(b[k]), int(first[k])
        left = np.stack([nl, sl], axis=1)
        tot = np.stack([left, tot - left], axis=1).reshape(-1, 2)
        feature += [-1] * len(tot)
        cut += [0] * len(tot)
        child += [0] * len(tot)
        value += (tot[:, 1] / np.maximum(tot[:, 0], 1)).tolist()
        if level == depth - 1:
            break
        small = np.where(tot[0::2, 0] <= tot[1::2, 0], 0, 1)
        slot_of = np.full(len(feature), -1)
        slot_of[first + small] = np.arange(len(parents))
        sc, ss = sums(r, level + 1, splits, None, 0.0, slot_of, len(parents), rows_share, seed)
        lefts = (small == 0)[:, None, None]
        c = np.stack([np.where(lefts, sc, c - sc), np.where(lefts, c - sc, sc)], axis=1).reshape(-1, *c.shape[1:])
        s = np.stack([np.where(lefts, ss, s - ss), np.where(lefts, s - ss, ss)], axis=1).reshape(-1, *s.shape[1:])
        active = (first[:, None] + np.arange(2)).reshape(-1)
    return (np.array(feature), np.array(cut), np.array(child), np.array(value)), splits


def _blocks(batches):
    for b in batches:
        if len(b):
            yield pd.DataFrame({"y": [b["y"].to_numpy("int8").tobytes()], "x": [b"".join(b["x"])]})


def fit_boosted(train: DataFrame, features: str, n: int, n_features: int, rounds: int, depth: int, rate: float,
                rows_share: float = 1.0, share: float = 1.0, seed: int = 1) -> TreeModel:
    """Boosted trees; the first one fits the labels -1 and 1 and has weight 1, as in Spark ML."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    cuts = fit_cuts(train, features, n, seed)
    rows = train.withColumns({"y": F.col("label").cast("tinyint"), "row": F.monotonically_increasing_id()})
    rows = written(binned(rows, features, cuts, ["row", "y"]), "bins")
    parts = max(1, min(spark.sparkContext.defaultParallelism, n // SHARE_ROWS))
    blocks = rows.repartition(parts).sortWithinPartitions("row").mapInPandas(_blocks, "y binary, x binary").rdd
    grown, losses = [], 0
    while len(grown) < rounds:
        name, done = f"boost-{uuid.uuid4().hex}", list(grown)

        def fill(no, held, name=name, done=done):
            _Share(name, n_features, no).fill(held, done)
            yield no
        shares = blocks.mapPartitionsWithIndex(fill).persist()
        shares.checkpoint()  # or every task would carry the plan of the rows
        shares.count()
        before = ((np.zeros(0, "int64"),) * 4, None, 0.0)
        try:
            for r in range(len(grown), rounds):
                tree, splits = _round(lambda *call: _sums(shares, name, n_features, *call), r, before, depth, share,
                                      rows_share, seed)
                weight = rate if r else 1.0
                grown.append((weight, tree))
                before, losses = (splits, tree[3], weight), 0
        except _Lost:
            losses += 1
            if losses > LOSSES:
                raise
        finally:
            def clear(no, held, name=name):
                list(held)
                root = SparkFiles.getRootDirectory()
                for f in os.listdir(root):
                    if f.startswith(name):
                        with suppress(FileNotFoundError):  # shares of one executor clear the same folder
                            os.remove(os.path.join(root, f))
                return []
            shares.mapPartitionsWithIndex(clear).collect()
            shares.unpersist()
    table = spark.createDataFrame(pd.DataFrame([_tree_row(r, 0, w, t) for r, (w, t) in enumerate(grown)]), TREE)
    return TreeModel(cuts, written(table, "trees"), True)


# ----------------------------------------------------------------- scoring --

def leaf_values(tree: tuple, x: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """The value of the leaf that each column of ``x`` (a line of bytes a feature) ends in."""
    feature, cut, child, value = tree
    n = x.shape[1]
    flat, out = x.reshape(-1), np.empty(n)
    for lo in range(0, n, block):
        node = np.zeros(min(block, n - lo), "int64")
        on = np.flatnonzero(feature[node] >= 0)
        while len(on):
            at = node[on]
            node[on] = child[at] + (flat[feature[at].astype("int64") * n + lo + on] > cut[at])
            on = on[feature[node[on]] >= 0]
        out[lo:lo + block] = value[node]
    return out


def _group_scorer(n: int, n_features: int, grp: int):
    def fn(batches):
        x, ids, trees, at = _lines(n, n_features, "uint8"), np.zeros(n, "int64"), [], 0
        for b in batches:
            t = b["tree"].notna()
            trees += list(b[t].itertuples())
            rows = b[~t]
            if len(rows):
                x[:, at:at + len(rows)] = _bytes(rows["x"]).T
                ids[at:at + len(rows)] = rows["row"]
                at += len(rows)
        total = np.zeros(n)
        for r in sorted(trees, key=lambda r: r.tree):
            total += r.weight * leaf_values(_tree_of(r), x)
        for lo in range(0, n, 10000):
            yield pd.DataFrame({"row": ids[lo:lo + 10000], "part": grp, "total": total[lo:lo + 10000]})
    return fn


def score(model: TreeModel, frame: DataFrame, features: str) -> DataFrame:
    """Adds ``p``, the probability of class 1, to the columns of ``frame`` but ``features``."""
    keep = [c for c in frame.columns if c != features]
    f = model.trees.agg(F.count(F.lit(1)).alias("trees"), F.sum("nodes").alias("nodes"),
                        F.sort_array(F.collect_set("grp")).alias("grps")).first()

    def prob(total):
        return 1 / (1 + F.exp(-2 * total)) if model.boosted else total / f.trees
    if f.nodes <= PASS_NODES:
        held = [(r.weight, _tree_of(r)) for r in model.trees.orderBy("tree").collect()]
        at = [np.array(c) for c in model.cuts]

        @F.pandas_udf("double")
        def sums(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="float64")
            lines = np.ascontiguousarray(_codes(x, at).T)
            total = np.zeros(len(x))
            for weight, tree in held:
                total += weight * leaf_values(tree, lines)
            return pd.Series(total)
        return frame.select(*keep, sums(vector_to_array(features)).alias("_t")).select(*keep, prob(F.col("_t")).alias("p"))
    rows = written(binned(frame.withColumn("row", F.monotonically_increasing_id()), features, model.cuts, ["row", *keep]),
                   "score-bins")
    n = rows.count()
    parts = []
    for g in f.grps:
        both = rows.select("row", "x").unionByName(model.trees.where(F.col("grp") == g), allowMissingColumns=True)
        parts.append(both.coalesce(1).mapInPandas(_group_scorer(n, len(model.cuts), g), "row long, part int, total double"))
    sums = _side_by_side(parts, "score-sums").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("part", "total"))).alias("s"))
    sums = sums.select("row", F.aggregate("s", F.lit(0.0), lambda a, e: a + e["total"]).alias("_t"))
    return rows.drop("x").join(sums, "row").select(*keep, prob(F.col("_t")).alias("p"))
