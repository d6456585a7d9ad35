"""Exact evaluation: precision/recall/F1, confusion, class report, ROC/PR,
threshold search, class weights, best-configuration selection (A9-A15, T5).

Curves never sort the scored windows: scores are first reduced to one row per
(group, distinct probability) with positive/negative counts (a partial
aggregate), and the running sums run over those rows only. For probabilities
rounded to 6 decimals that is at most 1,000,001 rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALERT_THRESHOLD, GRID_COUNT, GRID_START, GRID_STEP


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (zero_division=0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def predicted(p: str = "p", threshold: float = ALERT_THRESHOLD, strict: bool = False) -> Column:
    t = F.lit(float(threshold))
    return (F.col(p) > t) if strict else (F.col(p) >= t)


def confusion_counts(scores: DataFrame, keys: Sequence[str], threshold: float = ALERT_THRESHOLD,
                     strict: bool = False, label: str = "y") -> DataFrame:
    pred = predicted("p", threshold, strict)
    pos = F.col(label) == 1
    return scores.groupBy(*keys).agg(
        F.count_if(pos & pred).cast("bigint").alias("tp"),
        F.count_if(~pos & pred).cast("bigint").alias("fp"),
        F.count_if(pos & ~pred).cast("bigint").alias("fn"),
        F.count_if(~pos & ~pred).cast("bigint").alias("tn"))


def prf(scores: DataFrame, keys: Sequence[str], threshold: float = ALERT_THRESHOLD,
        has_label: Column | None = None) -> DataFrame:
    """Precision, recall, F1 of class 1 (``p >= threshold``); 0 on zero
    division; NULL when the input carries no label."""
    c = confusion_counts(scores, keys, threshold)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    cols = {"precision": _div0(tp, tp + fp), "recall": _div0(tp, tp + fn),
            "f1": _div0(2 * tp, 2 * tp + fp + fn)}
    if has_label is not None:
        cols = {k: F.when(has_label, v) for k, v in cols.items()}
    return c.select(*keys, "tp", "fp", "fn", *[v.alias(k) for k, v in cols.items()])


def confusion(scores: DataFrame, keys: Sequence[str], threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """A10: the four cells (y, pred, n), zero cells included."""
    c = confusion_counts(scores, keys, threshold)
    cells = F.explode(F.array(
        F.struct(F.lit(0).alias("y"), F.lit(0).alias("pred"), F.col("tn").alias("n")),
        F.struct(F.lit(0).alias("y"), F.lit(1).alias("pred"), F.col("fp").alias("n")),
        F.struct(F.lit(1).alias("y"), F.lit(0).alias("pred"), F.col("fn").alias("n")),
        F.struct(F.lit(1).alias("y"), F.lit(1).alias("pred"), F.col("tp").alias("n"))))
    return c.select(*keys, cells.alias("c")).select(*keys, "c.*")


def _report_from_counts(c: DataFrame, keys: Sequence[str]) -> DataFrame:
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    p1, r1, f1 = _div0(tp, tp + fp), _div0(tp, tp + fn), _div0(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _div0(tn, tn + fn), _div0(tn, tn + fp), _div0(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    tot = s0 + s1

    def row(label, p, r, f, s):
        return F.struct(F.lit(label).alias("label"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.cast("bigint").alias("support"))
    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, tot),
        row("weighted avg", _div0(p0 * s0 + p1 * s1, tot), _div0(r0 * s0 + r1 * s1, tot),
            _div0(f0 * s0 + f1 * s1, tot), tot),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"),
            _div0(tp + tn, tot), tot))
    return c.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def class_report(scores: DataFrame, keys: Sequence[str], threshold: float = ALERT_THRESHOLD,
                 strict: bool = True) -> DataFrame:
    """Per class, macro and weighted averages, and accuracy (in ``f1``)."""
    return _report_from_counts(confusion_counts(scores, keys, threshold, strict), keys)


def _distinct_p(scores: DataFrame, keys: Sequence[str], label: str = "y") -> DataFrame:
    return scores.groupBy(*keys, "p").agg(
        F.count_if(F.col(label) == 1).cast("bigint").alias("pos"),
        F.count_if(F.col(label) != 1).cast("bigint").alias("neg"))


#: Score ranges of a group that the curves are computed in.
CURVE_RANGES = 256


def _in_ranges(d: DataFrame, keys: Sequence[str], n_ranges: int) -> DataFrame:
    """``d`` with ``_range``: each group's scores cut at its quantiles, the highest scores first.

    The cuts are one row of a fixed number of values per group, so they come by a join that Spark may broadcast if they
    are few, and split on a hot group if not.
    """
    if n_ranges < 2:
        return d.withColumn("_range", F.lit(0))
    cuts = d.groupBy(*keys).agg(F.percentile_approx(
        "p", [k / n_ranges for k in range(1, n_ranges)], 4 * n_ranges).alias("_cuts"))
    return d.join(cuts, list(keys)).withColumn("_range", F.size(F.filter("_cuts", lambda c: c > F.col("p")))).drop("_cuts")


def curve_points(scores: DataFrame, keys: Sequence[str], label: str = "y", n_ranges: int = CURVE_RANGES) -> DataFrame:
    """Cumulative counts for ``p >= threshold`` at every distinct threshold, and the counts at it.

    Two levels of prefix sums: over the ranges of a group (a row for each), then over the scores inside a range. No
    task holds all distinct scores of a group.
    """
    keys = list(keys)
    d = _in_ranges(_distinct_p(scores, keys, label), keys, n_ranges)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    ranges = d.groupBy(*keys, "_range").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg")).select(
        *keys, "_range", F.coalesce(F.sum("_pos").over(before), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum("_neg").over(before), F.lit(0)).alias("_fp"),
        F.sum("_pos").over(whole).alias("P"), F.sum("_neg").over(whole).alias("N"))
    inside = Window.partitionBy(*keys, "_range").orderBy(F.col("p").desc()).rowsBetween(Window.unboundedPreceding, 0)
    own = d.select(*keys, "_range", F.col("p").alias("threshold"), "pos", "neg", F.sum("pos").over(inside).alias("_in_tp"),
                   F.sum("neg").over(inside).alias("_in_fp"))
    return own.join(ranges, [*keys, "_range"]).select(
        *keys, "threshold", (F.col("_tp") + F.col("_in_tp")).alias("tp"),
        (F.col("_fp") + F.col("_in_fp")).alias("fp"), "P", "N", "pos", "neg")


def roc_curve(scores: DataFrame, keys: Sequence[str], label: str = "y") -> DataFrame:
    """A12 points: (threshold, fpr, tpr) at every distinct score, plus the
    (0, 0) origin at threshold +inf. No intermediate point is dropped."""
    keys = list(keys)
    c = curve_points(scores, keys, label)
    pts = c.select(*keys, "threshold", _div0(F.col("fp"), F.col("N")).alias("fpr"),
                   _div0(F.col("tp"), F.col("P")).alias("tpr"))
    origin = c.select(*keys).distinct().select(
        *keys, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(pts)


def roc_auc(scores: DataFrame, keys: Sequence[str], label: str = "y", n_ranges: int = CURVE_RANGES) -> DataFrame:
    """Exact area under the ROC curve (trapezoids from the origin);
    NULL AUC for a group without both classes. The point before a point has
    its counts less those at the point, so no order is needed any more."""
    keys = list(keys)
    c = curve_points(scores, keys, label, n_ranges)
    area = _div0(F.col("neg"), F.col("N")) * (_div0(F.col("tp"), F.col("P")) + _div0(F.col("tp") - F.col("pos"), F.col("P"))) / 2
    a = c.groupBy(*keys).agg(F.sum(area).alias("auc"), (F.count(F.lit(1)) + 1).cast("bigint").alias("n_points"),
                             F.max("P").alias("P"), F.max("N").alias("N"))
    return a.select(*keys, F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("auc")).alias("auc"), "n_points")


def best_f1_threshold(scores: DataFrame, keys: Sequence[str], label: str = "y") -> DataFrame:
    """Over the precision-recall sweep (``p >= threshold`` at each
    distinct score), the threshold with the highest F1, the lowest one on
    ties. Groups without a positive label are skipped."""
    keys = list(keys)
    c = curve_points(scores, keys, label).where(F.col("P") > 0)
    prec = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div0(F.col("tp"), F.col("P"))
    f1 = _div0(2 * prec * rec, prec + rec)
    c = c.select(*keys, "threshold", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))
    return c.groupBy(*keys).agg(
        F.max_by(F.struct("threshold", "precision", "recall", "f1"),
                 F.struct(F.col("f1"), -F.col("threshold"))).alias("b")).select(*keys, "b.*")


def threshold_grid(spark, start: float = GRID_START, step: float = GRID_STEP,
                   count: int = GRID_COUNT) -> DataFrame:
    """The candidate thresholds ``start + k*step`` as doubles (k, t)."""
    return spark.range(count).select(F.col("id").alias("k"),
                                     (F.lit(start) + F.col("id") * F.lit(step)).alias("t"))


def threshold_search(scores: DataFrame, keys: Sequence[str], grid: DataFrame,
                     label: str = "y") -> DataFrame:
    """Class-1, macro and weighted F1 at every grid threshold with
    ``p > t``. A row is counted once, under the number of thresholds below its
    score; the thresholds (one row of the fixed-size grid) then sum up at most
    one count more than there are thresholds per group."""
    keys = list(keys)
    steps = grid.groupBy().agg(F.collect_list("t").alias("_grid"))
    below = F.size(F.filter("_grid", lambda t: F.col("p") > t))
    d = scores.crossJoin(F.broadcast(steps)).groupBy(*keys, below.alias("_below")).agg(
        F.count_if(F.col(label) == 1).cast("bigint").alias("pos"), F.count_if(F.col(label) != 1).cast("bigint").alias("neg"))
    rank = F.rank().over(Window.orderBy("t")) - 1
    j = d.crossJoin(F.broadcast(grid.withColumn("_rank", rank)))
    pred = F.col("_below") > F.col("_rank")
    c = j.groupBy(*keys, "k", "t").agg(
        F.sum(F.when(pred, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(pred, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~pred, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(~pred, F.col("neg")).otherwise(0)).alias("tn"))
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    f1 = _div0(2 * tp, 2 * tp + fp + fn)
    f0 = _div0(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    return c.select(*keys, "k", "t", f1.alias("class1_f1"), ((f0 + f1) / 2).alias("macro_f1"),
                    _div0(f0 * s0 + f1 * s1, s0 + s1).alias("weighted_f1"))


def best_threshold(grid_scores: DataFrame, keys: Sequence[str], metric: str = "weighted_f1") -> DataFrame:
    """First strict maximum along the grid (lowest threshold on ties)."""
    keys = list(keys)
    return grid_scores.groupBy(*keys).agg(
        F.max_by(F.struct(F.col("t").alias("best_t"), F.col(metric).alias("best_score")),
                 F.struct(F.col(metric), -F.col("k"))).alias("b")).select(*keys, "b.*")


def class_weight(windows: DataFrame, keys: Sequence[str] = (), label: str = "y") -> DataFrame:
    """Negatives / positives of the training labels (NULL without positives)."""
    keys = list(keys)
    c = windows.groupBy(*keys).agg(F.count_if(F.col(label) == 1).cast("bigint").alias("n_pos"),
                                   F.count_if(F.col(label) != 1).cast("bigint").alias("n_neg"))
    return c.withColumn("pos_weight", F.when(F.col("n_pos") > 0,
                                             F.col("n_neg") / F.col("n_pos")))


def select_best(results: DataFrame, metric: str, order_key: str = "config_no") -> DataFrame:
    """T5: the row with the highest ``metric``, the earliest on ties."""
    return results.groupBy().agg(
        F.max_by(F.struct(*results.columns), F.struct(F.col(metric), -F.col(order_key))).alias("b")
    ).select("b.*")
