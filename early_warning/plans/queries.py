"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, reads the driver tables, derives the
fixture views with Spark and runs one operator over all of them. The
matching DuckDB SQL (``ORACLES``) is written independently, from the
specification, over the same base tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import runs, windows
from ..config import SERIES_CHUNK_ROWS, WINDOW
from .oracle import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- windows --

@register("series_index", with_views(["base"], """
SELECT series_id, event_id, i, n FROM base"""))
def q_series_index(spark, sf_dir):
    return fx.base(spark, sf_dir).select("series_id", "event_id", "i", "n")


@register("horizon_label", with_views(["readings"], """
SELECT series_id, i,
       CAST(COALESCE(MAX(CASE WHEN anomaly = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY series_id ORDER BY i
            ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING), 0) AS BIGINT) AS y
FROM readings"""))
def q_horizon_label(spark, sf_dir):
    r = windows.horizon_label(fx.readings(spark, sf_dir), chunk_rows=SERIES_CHUNK_ROWS)
    return r.select("series_id", "i", F.col("y").cast("bigint").alias("y"))


@register("sliding_windows", with_views(["windows"], f"""
SELECT w.series_id, CAST(w.idx AS BIGINT) AS idx, w.i, CAST(r.i - w.idx AS BIGINT) AS t, r.i AS slot_i,
       {", ".join(f"r.{c}" for c in fx.CHANNELS)}
FROM windows w JOIN readings r ON r.series_id = w.series_id AND r.i BETWEEN w.idx AND w.i"""))
def q_sliding_windows(spark, sf_dir):
    """Every window with all its cells, one row per slot ``t``."""
    w = windows.sliding_windows(fx.readings(spark, sf_dir), fx.CHANNELS, chunk_rows=SERIES_CHUNK_ROWS)
    w = w.select("series_id", "idx", "i", F.posexplode("win").alias("t", "r"))
    return w.select(
        "series_id", F.col("idx").cast("bigint").alias("idx"), "i", F.col("t").cast("bigint").alias("t"),
        F.col("r.i").cast("bigint").alias("slot_i"), *[F.col(f"r.{c}").alias(c) for c in fx.CHANNELS])


# ------------------------------------------------------------------- runs --

@register("score_windows", with_views(["scores"], """
SELECT series_id, model_id, CAST(idx AS BIGINT) AS idx, CAST(y AS BIGINT) AS y, p FROM scores"""))
def q_score_windows(spark, sf_dir):
    s = fx.scores(spark, sf_dir)
    return s.select("series_id", "model_id", F.col("idx").cast("bigint").alias("idx"),
                    F.col("y").cast("bigint").alias("y"), "p")


RUNS_CTE = ("runs", """
  SELECT series_id, model_id, CAST(MIN(idx) AS BIGINT) AS start_idx, CAST(MAX(idx) AS BIGINT) AS end_idx,
         MAX(p) AS peak_prob, CAST(COUNT(*) AS BIGINT) AS n_windows
  FROM (SELECT *, idx - ROW_NUMBER() OVER (PARTITION BY series_id, model_id ORDER BY idx) AS g
        FROM scores WHERE p >= 0.5) f
  GROUP BY series_id, model_id, g""")


@register("anomaly_runs", with_views(["scores"], """
SELECT series_id, model_id, start_idx, end_idx, peak_prob, n_windows FROM runs""", extra=[RUNS_CTE]))
def q_anomaly_runs(spark, sf_dir):
    return runs.anomaly_runs(fx.scores(spark, sf_dir)).select(
        "series_id", "model_id", "start_idx", "end_idx", "peak_prob", "n_windows")


@register("score_summary", with_views(["scores"], """
SELECT s.series_id, s.model_id, total_windows, fault_windows, peak_prob, peak_idx
FROM (SELECT series_id, model_id, CAST(COUNT(*) AS BIGINT) AS total_windows,
             CAST(COUNT(*) FILTER (WHERE p >= 0.5) AS BIGINT) AS fault_windows, MAX(p) AS peak_prob
      FROM scores GROUP BY series_id, model_id) s
JOIN (SELECT series_id, model_id, CAST(MIN(idx) AS BIGINT) AS peak_idx
      FROM scores x WHERE p = (SELECT MAX(p) FROM scores y WHERE y.series_id = x.series_id AND y.model_id = x.model_id)
      GROUP BY series_id, model_id) k
  ON s.series_id = k.series_id AND s.model_id = k.model_id"""))
def q_score_summary(spark, sf_dir):
    return runs.score_summary(fx.scores(spark, sf_dir))


@register("top_runs", with_views(["scores"], """
SELECT series_id, model_id, CAST(ROW_NUMBER() OVER (PARTITION BY series_id, model_id ORDER BY start_idx) AS BIGINT) AS run_no,
       start_idx, end_idx, peak_prob
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id, model_id ORDER BY peak_prob DESC, start_idx) AS r
      FROM runs) t
WHERE r <= 3""", extra=[RUNS_CTE]))
def q_top_runs(spark, sf_dir):
    t = runs.top_runs(runs.anomaly_runs(fx.scores(spark, sf_dir)))
    return t.select("series_id", "model_id", "run_no", "start_idx", "end_idx", "peak_prob")


# --------------------------------------------------------------- features --

CH = fx.CHANNELS


def _r6(c):
    return F.round(c, 6)


N_FEATURES = WINDOW * len(CH)


@register("flat_features", with_views(["readings"], f"""
SELECT series_id, idx, CAST({N_FEATURES} AS BIGINT) AS n_feat, {", ".join(f"f{k}" for k in range(N_FEATURES))} FROM (
  SELECT series_id, i, n, i - {WINDOW - 1} AS idx,
         {", ".join(f"LAG({CH[k % len(CH)]}, {WINDOW - 1 - k // len(CH)}) OVER w AS f{k}" for k in range(N_FEATURES))}
  FROM readings WINDOW w AS (PARTITION BY series_id ORDER BY i)) x
WHERE i >= {WINDOW - 1} AND i < n - 10"""))
def q_flat_features(spark, sf_dir):
    """All 160 positions of the flat window, one column each."""
    w = windows.sliding_windows(fx.readings(spark, sf_dir), CH, chunk_rows=SERIES_CHUNK_ROWS)
    flat = w.select("series_id", "idx", windows.flatten_window("win", CH).alias("f"))
    return flat.select("series_id", F.col("idx").cast("bigint").alias("idx"),
                       F.size("f").cast("bigint").alias("n_feat"),
                       *[F.col("f")[k].alias(f"f{k}") for k in range(N_FEATURES)])


def _unpivot_sql(src: str, cols: list[str], keep: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT {keep}, {k} AS f, '{c}' AS channel, {c} AS x FROM {src}" for k, c in enumerate(cols))


# Train windows x their 20 readings, long by channel: the explicit form the
# closed-form Spark fits are checked against.
_TRAIN_SLOTS = ("train_slots", f"""
  SELECT t, f, channel, x FROM (
    {_unpivot_sql("(SELECT r.*, r.i - (w.i - 19) AS t FROM windows w JOIN readings r ON r.series_id = w.series_id AND r.i BETWEEN w.i - 19 AND w.i WHERE w.split = 'train') s", CH, "t")}) u""")
_SCALER_TF = ("scaler_tf", """
  SELECT CAST(t * 8 + f AS BIGINT) AS pos, CAST(t AS BIGINT) AS t, channel, AVG(x) AS mean, STDDEV_POP(x) AS std,
         CASE WHEN STDDEV_POP(x) = 0 OR STDDEV_POP(x) IS NULL THEN 1.0 ELSE STDDEV_POP(x) END AS scale
  FROM train_slots GROUP BY t, f, channel""")
_SCALER_F = ("scaler_f", """
  SELECT CAST(f AS BIGINT) AS f, channel, AVG(x) AS mean, STDDEV_POP(x) AS std,
         CASE WHEN STDDEV_POP(x) = 0 OR STDDEV_POP(x) IS NULL THEN 1.0 ELSE STDDEV_POP(x) END AS scale
  FROM train_slots GROUP BY f, channel""")


def _train(spark, sf_dir):
    return fx.readings(spark, sf_dir).where(F.col("split") == "train")


@register("scaler_tf", with_views(["windows"], """
SELECT pos, t, channel, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std, ROUND(scale, 6) AS scale
FROM scaler_tf""", extra=[_TRAIN_SLOTS, _SCALER_TF]))
def q_scaler_tf(spark, sf_dir):
    from ..operators import scaling
    s = scaling.fit_position_scaler(_train(spark, sf_dir), CH)
    return s.select("pos", "t", "channel", _r6(F.col("mean")).alias("mean"),
                    _r6(F.col("std")).alias("std"), _r6(F.col("scale")).alias("scale"))


@register("scaler_f", with_views(["windows"], """
SELECT f, channel, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std, ROUND(scale, 6) AS scale
FROM scaler_f""", extra=[_TRAIN_SLOTS, _SCALER_F]))
def q_scaler_f(spark, sf_dir):
    from ..operators import scaling
    s = scaling.fit_channel_scaler(_train(spark, sf_dir), CH)
    return s.select("f", "channel", _r6(F.col("mean")).alias("mean"),
                    _r6(F.col("std")).alias("std"), _r6(F.col("scale")).alias("scale"))


def _scaled_readings_sql() -> str:
    cols = ", ".join(
        f"(r.{c} - (SELECT mean FROM scaler_f WHERE channel = '{c}')) / "
        f"(SELECT scale FROM scaler_f WHERE channel = '{c}') AS {c}" for c in CH)
    return f"SELECT r.series_id, r.i, r.n, r.split, {cols} FROM readings r"


# The position scaler, one row per slot with every channel's mean and scale.
_SLOT_SCALER = ("slot_scaler", "SELECT t, " + ", ".join(
    f"MAX(mean) FILTER (WHERE channel = '{c}') AS mu_{c}, MAX(scale) FILTER (WHERE channel = '{c}') AS sd_{c}"
    for c in CH) + " FROM scaler_tf GROUP BY t")


@register("scaled_windows", with_views(["windows"], f"""
SELECT w.series_id, CAST(w.idx AS BIGINT) AS idx, p.t,
       {", ".join(f"ROUND((r.{c} - p.mu_{c}) / p.sd_{c}, 6) AS tf_{c}" for c in CH)},
       {", ".join(f"ROUND(s.{c}, 6) AS fs_{c}" for c in CH)}
FROM windows w
JOIN readings r ON r.series_id = w.series_id AND r.i BETWEEN w.idx AND w.i
JOIN scaled s ON s.series_id = r.series_id AND s.i = r.i
JOIN slot_scaler p ON p.t = r.i - w.idx""", extra=[_TRAIN_SLOTS, _SCALER_TF, _SCALER_F,
                                                   ("scaled", _scaled_readings_sql()), _SLOT_SCALER]))
def q_scaled_windows(spark, sf_dir):
    """M3: every cell of every window under both scalers (by position, by channel), one row per slot ``t``."""
    from ..operators import scaling
    r = fx.readings(spark, sf_dir)
    train = r.where(F.col("split") == "train")
    tf = scaling.fit_position_scaler(train, CH)
    fs = scaling.fit_channel_scaler(train, CH)
    # the channel-scaled values depend on the reading alone: scaled and rounded once, not once a window
    fs_cols = [f"fs_{c}" for c in CH]
    scaled = scaling.apply_channel_scaler(r.withColumns({f"x_{c}": F.col(c) for c in CH}), fs, CH)
    scaled = scaled.select("series_id", "i", "n", *[F.col(f"x_{c}").alias(c) for c in CH],
                           *[_r6(F.col(c)).alias(f"fs_{c}") for c in CH])
    w = windows.sliding_windows(scaled, [*CH, *fs_cols])
    flat = w.select("series_id", "idx", "win", windows.flatten_window("win", CH).alias("features"))
    flat = scaling.apply_position_scaler(flat, tf)
    flat = flat.select("series_id", "idx", F.posexplode("win").alias("t", "r"), "features_scaled")
    return flat.select("series_id", F.col("idx").cast("bigint").alias("idx"), F.col("t").cast("bigint").alias("t"),
                       *[_r6(F.get("features_scaled", F.col("t") * len(CH) + k)).alias(f"tf_{c}") for k, c in enumerate(CH)],
                       *[F.col("r")[c].alias(c) for c in fs_cols])


def _stat_sql() -> str:
    from ..operators.features import stat_columns
    exprs = []
    for c in CH:
        exprs += [
            f"AVG({c}) OVER w AS mean_{c}", f"STDDEV_SAMP({c}) OVER w AS std_{c}",
            f"MAX({c}) OVER w AS max_{c}", f"MIN({c}) OVER w AS min_{c}",
            f"{c} AS last_{c}", f"FIRST_VALUE({c}) OVER w AS first_{c}",
            f"{c} - FIRST_VALUE({c}) OVER w AS last_first_{c}",
            f"({c} - FIRST_VALUE({c}) OVER w) / 19.0 AS diff_mean_{c}",
            f"STDDEV_SAMP(d_{c}) OVER wd AS diff_std_{c}",
            f"MAX(ABS({c})) OVER w AS absmax_{c}"]
    diffs = ", ".join(f"{c} - LAG({c}) OVER (PARTITION BY series_id ORDER BY i) AS d_{c}" for c in CH)
    outs = ", ".join(f"ROUND({k}, 6) AS {k}" for k in stat_columns(CH))
    return f"""
SELECT series_id, idx, {outs} FROM (
  SELECT series_id, i, n, i - 19 AS idx, {", ".join(exprs)}
  FROM (SELECT *, {diffs} FROM scaled) d
  WINDOW w AS (PARTITION BY series_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
         wd AS (PARTITION BY series_id ORDER BY i ROWS BETWEEN 18 PRECEDING AND CURRENT ROW)) x
WHERE i >= 19 AND i < n - 10"""


@register("stat_features", with_views(["windows"], _stat_sql(), extra=[
    _TRAIN_SLOTS, _SCALER_F, ("scaled", _scaled_readings_sql())]))
def q_stat_features(spark, sf_dir):
    from ..operators import features, scaling
    r = fx.readings(spark, sf_dir)
    fs = scaling.fit_channel_scaler(r.where(F.col("split") == "train"), CH)
    st = features.stat_features(scaling.apply_channel_scaler(r, fs, CH), CH, chunk_rows=SERIES_CHUNK_ROWS)
    return st.select("series_id", F.col("idx").cast("bigint").alias("idx"),
                     *[_r6(F.col(k)).alias(k) for k in features.stat_columns(CH)])


# ------------------------------------------------------------- evaluation --

def div0(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


def _test_scores(spark, sf_dir):
    return fx.scores(spark, sf_dir).where(F.col("split") == "test")


_COUNTS = ("counts", """
  SELECT model_id,
         COUNT(*) FILTER (WHERE y = 1 AND p {op} 0.5) AS tp, COUNT(*) FILTER (WHERE y <> 1 AND p {op} 0.5) AS fp,
         COUNT(*) FILTER (WHERE y = 1 AND NOT p {op} 0.5) AS fn, COUNT(*) FILTER (WHERE y <> 1 AND NOT p {op} 0.5) AS tn
  FROM scores WHERE split = 'test' GROUP BY model_id""")


@register("prf", with_views(["scores"], f"""
SELECT series_id, model_id, tp, fp, fn,
       ROUND({div0("tp", "tp + fp")}, 6) AS precision, ROUND({div0("tp", "tp + fn")}, 6) AS recall,
       ROUND({div0("2 * tp", "2 * tp + fp + fn")}, 6) AS f1
FROM (SELECT series_id, model_id,
             CAST(COUNT(*) FILTER (WHERE y = 1 AND p >= 0.5) AS BIGINT) AS tp,
             CAST(COUNT(*) FILTER (WHERE y <> 1 AND p >= 0.5) AS BIGINT) AS fp,
             CAST(COUNT(*) FILTER (WHERE y = 1 AND p < 0.5) AS BIGINT) AS fn
      FROM scores GROUP BY series_id, model_id) c"""))
def q_prf(spark, sf_dir):
    from ..operators import metrics
    m = metrics.prf(fx.scores(spark, sf_dir), ["series_id", "model_id"])
    return m.select("series_id", "model_id", "tp", "fp", "fn",
                    *[_r6(F.col(k)).alias(k) for k in ("precision", "recall", "f1")])


@register("confusion", with_views(["scores"], """
SELECT model_id, CAST(y AS BIGINT) AS y, CAST(pred AS BIGINT) AS pred, CAST(n AS BIGINT) AS n FROM (
  SELECT model_id, 0 AS y, 0 AS pred, tn AS n FROM counts UNION ALL
  SELECT model_id, 0, 1, fp FROM counts UNION ALL
  SELECT model_id, 1, 0, fn FROM counts UNION ALL
  SELECT model_id, 1, 1, tp FROM counts) x""", extra=[(_COUNTS[0], _COUNTS[1].format(op=">="))]))
def q_confusion(spark, sf_dir):
    from ..operators import metrics
    c = metrics.confusion(_test_scores(spark, sf_dir), ["model_id"])
    return c.select("model_id", F.col("y").cast("bigint").alias("y"),
                    F.col("pred").cast("bigint").alias("pred"), F.col("n").cast("bigint").alias("n"))


@register("class_report", with_views(["scores"], f"""
SELECT model_id, label, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM (
  SELECT model_id, '0' AS label, {div0("tn", "tn + fn")} AS precision, {div0("tn", "tn + fp")} AS recall,
         {div0("2 * tn", "2 * tn + fn + fp")} AS f1, tn + fp AS support FROM counts UNION ALL
  SELECT model_id, '1', {div0("tp", "tp + fp")}, {div0("tp", "tp + fn")}, {div0("2 * tp", "2 * tp + fp + fn")}, tp + fn FROM counts UNION ALL
  SELECT model_id, 'macro avg', ({div0("tn", "tn + fn")} + {div0("tp", "tp + fp")}) / 2,
         ({div0("tn", "tn + fp")} + {div0("tp", "tp + fn")}) / 2,
         ({div0("2 * tn", "2 * tn + fn + fp")} + {div0("2 * tp", "2 * tp + fp + fn")}) / 2, tp + fp + fn + tn FROM counts UNION ALL
  SELECT model_id, 'weighted avg',
         {div0(f"{div0('tn', 'tn + fn')} * (tn + fp) + {div0('tp', 'tp + fp')} * (tp + fn)", "tp + fp + fn + tn")},
         {div0(f"{div0('tn', 'tn + fp')} * (tn + fp) + {div0('tp', 'tp + fn')} * (tp + fn)", "tp + fp + fn + tn")},
         {div0(f"{div0('2 * tn', '2 * tn + fn + fp')} * (tn + fp) + {div0('2 * tp', '2 * tp + fp + fn')} * (tp + fn)", "tp + fp + fn + tn")},
         tp + fp + fn + tn FROM counts UNION ALL
  SELECT model_id, 'accuracy', NULL, NULL, {div0("tp + tn", "tp + fp + fn + tn")}, tp + fp + fn + tn FROM counts) r""",
    extra=[(_COUNTS[0], _COUNTS[1].format(op=">"))]))
def q_class_report(spark, sf_dir):
    from ..operators import metrics
    r = metrics.class_report(_test_scores(spark, sf_dir), ["model_id"])
    return r.select("model_id", "label", *[_r6(F.col(k)).alias(k) for k in ("precision", "recall", "f1")],
                    "support")


_CURVE = ("curve", """
  SELECT model_id, p AS threshold,
         SUM(pos) OVER (PARTITION BY model_id ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         SUM(neg) OVER (PARTITION BY model_id ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
         SUM(pos) OVER (PARTITION BY model_id) AS P, SUM(neg) OVER (PARTITION BY model_id) AS N
  FROM (SELECT model_id, p, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y <> 1) AS neg
        FROM scores WHERE split = 'test' GROUP BY model_id, p) d""")
_ROC = ("roc", f"""
  SELECT model_id, CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr FROM (SELECT DISTINCT model_id FROM curve) o
  UNION ALL SELECT model_id, threshold, {div0("fp", "N")}, {div0("tp", "P")} FROM curve""")


@register("roc_curve", with_views(["scores"], """
SELECT model_id, threshold, ROUND(fpr, 6) AS fpr, ROUND(tpr, 6) AS tpr FROM roc""", extra=[_CURVE, _ROC]))
def q_roc_curve(spark, sf_dir):
    from ..operators import metrics
    r = metrics.roc_curve(_test_scores(spark, sf_dir), ["model_id"])
    return r.select("model_id", "threshold", _r6(F.col("fpr")).alias("fpr"), _r6(F.col("tpr")).alias("tpr"))


@register("roc_auc", with_views(["scores"], """
SELECT model_id, ROUND(SUM(area), 6) AS auc, CAST(COUNT(*) AS BIGINT) AS n_points FROM (
  SELECT model_id, (fpr - COALESCE(LAG(fpr) OVER w, 0)) * (tpr + COALESCE(LAG(tpr) OVER w, 0)) / 2 AS area
  FROM roc WINDOW w AS (PARTITION BY model_id ORDER BY threshold DESC)) s
GROUP BY model_id""", extra=[_CURVE, _ROC]))
def q_roc_auc(spark, sf_dir):
    from ..operators import metrics
    a = metrics.roc_auc(_test_scores(spark, sf_dir), ["model_id"])
    return a.select("model_id", _r6(F.col("auc")).alias("auc"), "n_points")


@register("best_f1_threshold", with_views(["scores"], f"""
SELECT model_id, threshold, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1 FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY model_id ORDER BY f1 DESC, threshold) AS r FROM (
    SELECT model_id, threshold, precision, recall, {div0("2 * precision * recall", "precision + recall")} AS f1 FROM (
      SELECT model_id, threshold, {div0("tp", "tp + fp")} AS precision, {div0("tp", "P")} AS recall
      FROM curve WHERE P > 0) a) b) c
WHERE r = 1""", extra=[_CURVE]))
def q_best_f1_threshold(spark, sf_dir):
    from ..operators import metrics
    b = metrics.best_f1_threshold(_test_scores(spark, sf_dir), ["model_id"])
    return b.select("model_id", "threshold", *[_r6(F.col(k)).alias(k) for k in ("precision", "recall", "f1")])


def _grid_sql(split: str) -> str:
    return f"""
  SELECT model_id, k, t, {div0("2 * tp", "2 * tp + fp + fn")} AS class1_f1,
         ({div0("2 * tn", "2 * tn + fn + fp")} + {div0("2 * tp", "2 * tp + fp + fn")}) / 2 AS macro_f1,
         {div0(f"{div0('2 * tn', '2 * tn + fn + fp')} * (tn + fp) + {div0('2 * tp', '2 * tp + fp + fn')} * (tp + fn)", "tp + fp + fn + tn")} AS weighted_f1
  FROM (SELECT s.model_id, g.k, g.t,
               COUNT(*) FILTER (WHERE s.y = 1 AND s.p > g.t) AS tp, COUNT(*) FILTER (WHERE s.y <> 1 AND s.p > g.t) AS fp,
               COUNT(*) FILTER (WHERE s.y = 1 AND s.p <= g.t) AS fn, COUNT(*) FILTER (WHERE s.y <> 1 AND s.p <= g.t) AS tn
        FROM scores s CROSS JOIN (SELECT k, 0.45::DOUBLE + k * 0.01::DOUBLE AS t FROM range(31) r(k)) g
        WHERE s.split = '{split}' GROUP BY s.model_id, g.k, g.t) c"""


@register("threshold_grid", with_views(["scores"], """
SELECT model_id, CAST(k AS BIGINT) AS k, ROUND(t, 2) AS t, ROUND(class1_f1, 6) AS class1_f1,
       ROUND(macro_f1, 6) AS macro_f1, ROUND(weighted_f1, 6) AS weighted_f1 FROM grid""",
    extra=[("grid", _grid_sql("val"))]))
def q_threshold_grid(spark, sf_dir):
    from ..operators import metrics
    s = fx.scores(spark, sf_dir).where(F.col("split") == "val")
    g = metrics.threshold_search(s, ["model_id"], metrics.threshold_grid(spark))
    return g.select("model_id", F.col("k").cast("bigint").alias("k"), F.round("t", 2).alias("t"),
                    *[_r6(F.col(c)).alias(c) for c in ("class1_f1", "macro_f1", "weighted_f1")])


@register("pos_weight", with_views(["windows"], """
SELECT split, n_pos, n_neg, ROUND(CASE WHEN n_pos > 0 THEN CAST(n_neg AS DOUBLE) / n_pos END, 6) AS pos_weight
FROM (SELECT split, CAST(COUNT(*) FILTER (WHERE y = 1) AS BIGINT) AS n_pos,
             CAST(COUNT(*) FILTER (WHERE y <> 1) AS BIGINT) AS n_neg FROM windows GROUP BY split) c"""))
def q_pos_weight(spark, sf_dir):
    from ..operators import metrics
    c = metrics.class_weight(fx.windows(spark, sf_dir), ["split"])
    return c.select("split", "n_pos", "n_neg", _r6(F.col("pos_weight")).alias("pos_weight"))


@register("best_config", with_views(["scores"], """
SELECT selection, model_id, ROUND(best_t, 2) AS best_t, ROUND(val_score, 6) AS val_score,
       ROUND(test_score, 6) AS test_score FROM (
  SELECT 'by_val' AS selection, * FROM (SELECT * FROM res ORDER BY val_score DESC, config_no LIMIT 1) a
  UNION ALL
  SELECT 'by_test', * FROM (SELECT * FROM res ORDER BY test_score DESC, config_no LIMIT 1) b) x""",
    extra=[("vgrid", _grid_sql("val")), ("tgrid", _grid_sql("test")),
           ("vbest", """
  SELECT model_id, k, t AS best_t, weighted_f1 AS val_score FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY model_id ORDER BY weighted_f1 DESC, k) AS r FROM vgrid) x WHERE r = 1"""),
           ("res", """
  SELECT CAST(SUBSTR(v.model_id, 2) AS BIGINT) AS config_no, v.model_id, v.best_t, v.val_score, t.weighted_f1 AS test_score
  FROM vbest v JOIN tgrid t ON t.model_id = v.model_id AND t.k = v.k""")]))
def q_best_config(spark, sf_dir):
    """T5 over a results table: each fixture model is one configuration; its
    threshold is chosen on validation, then scored on test."""
    from ..operators import metrics
    s = fx.scores(spark, sf_dir)
    grid = metrics.threshold_grid(spark)
    keys = ["model_id"]
    val = metrics.threshold_search(s.where(F.col("split") == "val"), keys, grid)
    test = metrics.threshold_search(s.where(F.col("split") == "test"), keys, grid)
    vbest = (val.groupBy("model_id")
                .agg(F.max_by(F.struct("k", "t", "weighted_f1"),
                              F.struct(F.col("weighted_f1"), -F.col("k"))).alias("b"))
                .select("model_id", "b.k", F.col("b.t").alias("best_t"),
                        F.col("b.weighted_f1").alias("val_score")))
    res = (vbest.join(test.select("model_id", "k", F.col("weighted_f1").alias("test_score")),
                      ["model_id", "k"])
                .select(F.substring("model_id", 2, 10).cast("bigint").alias("config_no"),
                        "model_id", "best_t", "val_score", "test_score"))
    by_val = metrics.select_best(res, "val_score").withColumn("selection", F.lit("by_val"))
    by_test = metrics.select_best(res, "test_score").withColumn("selection", F.lit("by_test"))
    out = by_val.unionByName(by_test)
    return out.select("selection", "model_id", F.round("best_t", 2).alias("best_t"),
                      _r6(F.col("val_score")).alias("val_score"), _r6(F.col("test_score")).alias("test_score"))


# ----------------------------------------------------------------- alerts --

_BAND_SQL = "CASE WHEN p >= 0.8 THEN 'ALERT' WHEN p >= 0.5 THEN 'WARNING' WHEN p >= 0.3 THEN 'WATCH' ELSE 'NORMAL' END"

# The recursive fold, one tick after another: the oracle for the composed
# transition maps.
_STATES_CTES = [("b", """
  SELECT series_id, model_id, idx, p,
         MIN(p) OVER w AS mn, MAX(p) OVER w AS mx, COUNT(*) OVER w AS c,
         CASE WHEN p >= 0.8 THEN 3 WHEN p >= 0.5 THEN 2 WHEN p >= 0.3 THEN 1 ELSE 0 END AS bd
  FROM scores
  WINDOW w AS (PARTITION BY series_id, model_id ORDER BY idx ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
    ("r", """
  SELECT series_id, model_id, idx, CASE WHEN bd = 3 THEN 3 WHEN bd >= 1 THEN 1 ELSE 0 END AS st FROM b WHERE idx = 0
  UNION ALL
  SELECT b.series_id, b.model_id, b.idx,
         CASE WHEN b.bd = 3 THEN 3
              WHEN b.bd > r.st THEN CASE WHEN r.st = 0 THEN 1 WHEN r.st = 1 AND b.c = 3 AND b.mn >= 0.5 THEN 2 ELSE r.st END
              WHEN b.bd < r.st THEN CASE WHEN b.c = 3 AND b.mx < CASE r.st WHEN 3 THEN 0.8 WHEN 2 THEN 0.5 ELSE 0.3 END THEN r.st - 1 ELSE r.st END
              ELSE r.st END
  FROM r JOIN b ON b.series_id = r.series_id AND b.model_id = r.model_id AND b.idx = r.idx + 1"""),
    ("st", """
  SELECT series_id, model_id, CAST(idx AS BIGINT) AS idx, st,
         CASE st WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'WATCH' WHEN 2 THEN 'WARNING' ELSE 'ALERT' END AS state FROM r""")]


@register("band_for", with_views(["scores"], f"""
SELECT series_id, model_id, CAST(idx AS BIGINT) AS idx, {_BAND_SQL} AS band FROM scores"""))
def q_band_for(spark, sf_dir):
    from ..operators import alerts
    s = fx.scores(spark, sf_dir)
    return s.select("series_id", "model_id", F.col("idx").cast("bigint").alias("idx"),
                    alerts.state_name(alerts.band_for(F.col("p"))).alias("band"))


def _states(spark, sf_dir):
    from ..operators import alerts
    return alerts.alert_states(fx.scores(spark, sf_dir))


@register("alert_states", with_views(["scores"], """
SELECT series_id, model_id, idx, state FROM st""", extra=_STATES_CTES, recursive=True))
def q_alert_states(spark, sf_dir):
    s = _states(spark, sf_dir)
    return s.select("series_id", "model_id", F.col("idx").cast("bigint").alias("idx"),
                    F.col("status").alias("state"))


@register("alert_transitions", with_views(["scores"], """
SELECT series_id, model_id, idx, from_status, to_status, event FROM (
  SELECT series_id, model_id, idx,
         CASE pst WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'WATCH' WHEN 2 THEN 'WARNING' ELSE 'ALERT' END AS from_status,
         state AS to_status, st, pst FROM (
    SELECT *, COALESCE(LAG(st) OVER (PARTITION BY series_id, model_id ORDER BY idx), 0) AS pst FROM st) a) x,
  (SELECT 'chime' AS event UNION ALL SELECT 'alert_on' UNION ALL SELECT 'alert_off') e
WHERE (e.event = 'chime' AND st > pst AND st >= 2)
   OR (e.event = 'alert_on' AND st = 3 AND pst <> 3)
   OR (e.event = 'alert_off' AND st <> 3 AND pst = 3)""", extra=_STATES_CTES, recursive=True))
def q_alert_transitions(spark, sf_dir):
    from ..operators import alerts
    t = alerts.alert_transitions(_states(spark, sf_dir))
    return t.select("series_id", "model_id", F.col("idx").cast("bigint").alias("idx"),
                    "from_status", "to_status", "event")


@register("replay_ticks", with_views(["scores"], """
SELECT st.series_id, st.model_id, st.idx, s.p, st.state,
       st.state IN ('WARNING', 'ALERT') AS in_anomaly_window,
       f.ts0 + st.idx * INTERVAL 1 SECOND AS replay_ts,
       r.ts AS window_end_ts, r.ch1, r.ch2, r.ch3, r.ch4, r.ch5, r.ch6, r.ch7, r.ch8
FROM st
JOIN scores s ON s.series_id = st.series_id AND s.model_id = st.model_id AND s.idx = st.idx
JOIN readings r ON r.series_id = st.series_id AND r.i = st.idx + 19
JOIN (SELECT series_id, arg_min(ts, event_id) AS ts0 FROM readings GROUP BY series_id) f ON f.series_id = st.series_id""",
    extra=_STATES_CTES, recursive=True))
def q_replay_ticks(spark, sf_dir):
    """Ordered ticks with state, the window's last reading and the replay
    clock (first timestamp in file order + idx seconds)."""
    from ..operators import alerts
    r = fx.readings(spark, sf_dir)
    st = alerts.alert_states(fx.scores(spark, sf_dir, fx.windows(spark, sf_dir, r)))
    first = r.groupBy("series_id").agg(F.min_by("ts", "event_id").alias("ts0"))
    ticks = (st.join(r.select("series_id", "i", F.col("ts").alias("window_end_ts"), *CH), ["series_id", "i"])
               .join(first, "series_id"))
    return ticks.select(
        "series_id", "model_id", F.col("idx").cast("bigint").alias("idx"), "p",
        F.col("status").alias("state"),
        F.col("status").isin("WARNING", "ALERT").alias("in_anomaly_window"),
        F.timestamp_add("SECOND", F.col("idx"), F.col("ts0")).alias("replay_ts"),
        "window_end_ts", *CH)


@register("monitor_counters", with_views(["scores"], """
SELECT series_id, model_id, CAST(idx AS BIGINT) AS idx,
       CAST(COUNT(*) OVER w AS BIGINT) AS seen,
       CAST(SUM(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS above,
       GREATEST(MAX(p) OVER w, 0.0) AS peak
FROM scores WINDOW w AS (PARTITION BY series_id, model_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def q_monitor_counters(spark, sf_dir):
    from ..operators import alerts
    c = alerts.monitor_counters(fx.scores(spark, sf_dir))
    return c.withColumn("idx", F.col("idx").cast("bigint"))


# ----------------------------------------------------------------- report --

def _unpivot_cols_sql(src: str, keys: str, cols: list[str], value: str = "value") -> str:
    return "\n  UNION ALL ".join(
        f"SELECT {keys}, {k} AS ch_pos, '{c}' AS channel, {c} AS {value} FROM {src}"
        for k, c in enumerate(cols))


_STATS_CTE = ("cstats", f"""
  SELECT series_id, ch_pos, channel, AVG(value) AS mean, STDDEV_POP(value) AS std, MIN(value) AS min, MAX(value) AS max
  FROM ({_unpivot_cols_sql("readings", "series_id", CH)}) u
  GROUP BY series_id, ch_pos, channel""")

_SUMMARY_CTE = ("summary", """
  SELECT s.series_id, s.model_id, total_windows, fault_windows, peak_prob, peak_idx
  FROM (SELECT series_id, model_id, CAST(COUNT(*) AS BIGINT) AS total_windows,
               CAST(COUNT(*) FILTER (WHERE p >= 0.5) AS BIGINT) AS fault_windows, MAX(p) AS peak_prob
        FROM scores GROUP BY series_id, model_id) s
  JOIN (SELECT series_id, model_id, CAST(MIN(idx) AS BIGINT) AS peak_idx
        FROM scores x WHERE p = (SELECT MAX(p) FROM scores y WHERE y.series_id = x.series_id AND y.model_id = x.model_id)
        GROUP BY series_id, model_id) k
    ON s.series_id = k.series_id AND s.model_id = k.model_id""")

_PEAK_ROW_CTE = ("peaks", """
  SELECT s.*, LEAST(GREATEST(s.peak_idx + 19, 0), l.n - 1) AS peak_row, l.n
  FROM summary s JOIN (SELECT series_id, COUNT(*) AS n FROM readings GROUP BY series_id) l ON l.series_id = s.series_id""")


def _summary(spark, sf_dir):
    return runs.score_summary(fx.scores(spark, sf_dir))


@register("channel_stats", with_views(["readings"], """
SELECT series_id, CAST(ch_pos AS BIGINT) AS ch_pos, channel, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std, min, max
FROM cstats""", extra=[_STATS_CTE]))
def q_channel_stats(spark, sf_dir):
    from ..operators import report
    s = report.channel_stats(fx.readings(spark, sf_dir), CH)
    return s.select("series_id", F.col("ch_pos").cast("bigint").alias("ch_pos"), "channel",
                    _r6(F.col("mean")).alias("mean"), _r6(F.col("std")).alias("std"), "min", "max")


_MEMBERS_CTE = ("members", """
  SELECT series_id, model_id, idx, MIN(idx) OVER (PARTITION BY series_id, model_id, g) AS start_idx
  FROM (SELECT *, idx - ROW_NUMBER() OVER (PARTITION BY series_id, model_id ORDER BY idx) AS g
        FROM scores WHERE p >= 0.5) f""")


@register("run_timeline", with_views(["scores"], """
SELECT ru.series_id, ru.model_id,
       CAST(ROW_NUMBER() OVER (PARTITION BY ru.series_id, ru.model_id ORDER BY ru.start_idx) AS BIGINT) AS run_no,
       ru.start_idx, ru.end_idx, pr.start_ts, pr.end_ts,
       CAST(FLOOR((epoch_us(pr.end_ts) - epoch_us(pr.start_ts)) / 1e6) + 1 AS BIGINT) AS duration_s,
       ru.peak_prob, t.channel AS peak_sensor, ROUND(t.z, 6) AS peak_z
FROM runs ru
JOIN per_run pr ON pr.series_id = ru.series_id AND pr.model_id = ru.model_id AND pr.start_idx = ru.start_idx
JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id, model_id, start_idx ORDER BY ABS(z) DESC, ch_pos) AS rk
      FROM zs) t ON t.series_id = ru.series_id AND t.model_id = ru.model_id AND t.start_idx = ru.start_idx AND t.rk = 1""",
    extra=[RUNS_CTE, _MEMBERS_CTE, _STATS_CTE,
           ("per_run", f"""
  SELECT m.series_id, m.model_id, m.start_idx, MIN(r.ts) AS start_ts, MAX(r.ts) AS end_ts,
         {", ".join(f"AVG(r.{c}) AS {c}" for c in CH)}
  FROM members m JOIN readings r ON r.series_id = m.series_id AND r.i = m.idx + 19
  GROUP BY m.series_id, m.model_id, m.start_idx"""),
           ("zs", f"""
  SELECT u.series_id, u.model_id, u.start_idx, u.ch_pos, u.channel,
         (u.value - c.mean) / (c.std + 1e-9) AS z
  FROM ({_unpivot_cols_sql("per_run", "series_id, model_id, start_idx", CH)}) u
  JOIN cstats c ON c.series_id = u.series_id AND c.channel = u.channel""")]))
def q_run_timeline(spark, sf_dir):
    from ..operators import report
    r = fx.readings(spark, sf_dir)
    s = fx.scores(spark, sf_dir, fx.windows(spark, sf_dir, r, keep=["ts", *CH]))
    t = report.run_timeline(s, r, CH)
    return t.withColumn("peak_z", _r6(F.col("peak_z")))


@register("peak_neighbourhood", with_views(["scores"], f"""
SELECT p.series_id, p.model_id, r.i, r.i - p.peak_row AS offset,
       r.i BETWEEN p.peak_row - 19 AND p.peak_row AS in_peak_window,
       CAST(u.ch_pos AS BIGINT) AS ch_pos, u.channel, u.value
FROM peaks p
JOIN readings r ON r.series_id = p.series_id AND r.i BETWEEN GREATEST(p.peak_row - 30, 0) AND LEAST(p.peak_row + 30, p.n - 1)
JOIN ({_unpivot_cols_sql("readings", "series_id, i", CH)}) u ON u.series_id = r.series_id AND u.i = r.i""",
    extra=[_SUMMARY_CTE, _PEAK_ROW_CTE]))
def q_peak_neighbourhood(spark, sf_dir):
    from ..operators import report
    r = fx.readings(spark, sf_dir)
    summ = runs.score_summary(fx.scores(spark, sf_dir, fx.windows(spark, sf_dir, r)))
    out = report.peak_neighbourhood(summ, r, CH)
    return out.select("series_id", "model_id", "i", "offset", "in_peak_window",
                      F.col("ch_pos").cast("bigint").alias("ch_pos"), "channel", "value")


_DEEP_CTE = ("deep", f"""
  SELECT w.series_id, w.model_id, c.ch_pos, c.channel, c.mean AS file_mean, c.min AS file_min, c.max AS file_max,
         w.value AS peak_window_mean, (w.value - c.mean) / (c.std + 1e-9) AS z
  FROM ({_unpivot_cols_sql("wmean", "series_id, model_id", CH)}) w
  JOIN cstats c ON c.series_id = w.series_id AND c.channel = w.channel""")
_WMEAN_CTE = ("wmean", f"""
  SELECT p.series_id, p.model_id, {", ".join(f"AVG(r.{c}) AS {c}" for c in CH)}
  FROM peaks p JOIN readings r ON r.series_id = p.series_id AND r.i BETWEEN GREATEST(p.peak_row - 19, 0) AND p.peak_row
  GROUP BY p.series_id, p.model_id""")


@register("sensor_deepdive", with_views(["scores"], """
SELECT series_id, model_id, CAST(ch_pos AS BIGINT) AS ch_pos, channel, ROUND(file_mean, 6) AS file_mean,
       file_min, file_max, ROUND(peak_window_mean, 6) AS peak_window_mean, ROUND(z, 6) AS z
FROM deep""", extra=[_SUMMARY_CTE, _PEAK_ROW_CTE, _STATS_CTE, _WMEAN_CTE, _DEEP_CTE]))
def q_sensor_deepdive(spark, sf_dir):
    from ..operators import report
    r = fx.readings(spark, sf_dir)
    summ = runs.score_summary(fx.scores(spark, sf_dir, fx.windows(spark, sf_dir, r)))
    d = report.sensor_deepdive(summ, r, CH)
    return d.select("series_id", "model_id", F.col("ch_pos").cast("bigint").alias("ch_pos"), "channel",
                    _r6(F.col("file_mean")).alias("file_mean"), "file_min", "file_max",
                    _r6(F.col("peak_window_mean")).alias("peak_window_mean"), _r6(F.col("z")).alias("z"))


@register("peak_sensor", with_views(["scores"], """
SELECT series_id, model_id, channel AS peak_sensor, ROUND(z, 6) AS peak_z,
       CASE WHEN z > 0 THEN 'above' ELSE 'below' END AS direction
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id, model_id ORDER BY ABS(z) DESC, ch_pos) AS rk FROM deep) d
WHERE rk = 1""", extra=[_SUMMARY_CTE, _PEAK_ROW_CTE, _STATS_CTE, _WMEAN_CTE, _DEEP_CTE]))
def q_peak_sensor(spark, sf_dir):
    """T3 + F11: the most deviant channel of the peak window and its direction."""
    from ..operators import report
    r = fx.readings(spark, sf_dir)
    summ = runs.score_summary(fx.scores(spark, sf_dir, fx.windows(spark, sf_dir, r)))
    d = report.sensor_deepdive(summ, r, CH)
    p = report.peak_sensor(d, ["series_id", "model_id"])
    return p.select("series_id", "model_id", "peak_sensor", _r6(F.col("peak_z")).alias("peak_z"),
                    F.when(F.col("peak_z") > 0, "above").otherwise("below").alias("direction"))


_RISK_SQL = """CASE WHEN fault_windows = 0 OR peak_prob < 0.5 THEN 'LOW'
            WHEN CAST(fault_windows AS DOUBLE) / GREATEST(total_windows, 1) >= 0.10 OR peak_prob >= 0.8 THEN 'HIGH'
            ELSE 'MEDIUM' END"""


@register("risk_level", with_views(["scores"], f"""
SELECT series_id, model_id, {_RISK_SQL} AS risk FROM summary""", extra=[_SUMMARY_CTE]))
def q_risk_level(spark, sf_dir):
    from ..operators import report
    s = _summary(spark, sf_dir)
    return s.select("series_id", "model_id",
                    report.risk_level(F.col("fault_windows"), F.col("total_windows"), F.col("peak_prob")).alias("risk"))


@register("executive_summary", with_views(["scores"], f"""
SELECT series_id, model_id, verdict, risk,
       CASE WHEN risk = 'LOW' AND fault_windows = 0 THEN 'No action required' WHEN risk = 'LOW' THEN 'Low concern'
            WHEN risk = 'MEDIUM' THEN 'Inspection recommended' ELSE 'Inspect immediately' END AS action,
       rows_analysed, 0.5::DOUBLE AS threshold, total_windows, fault_windows, peak_prob, peak_idx
FROM (SELECT s.*, {_RISK_SQL} AS risk,
             CASE WHEN fault_windows = 0 THEN 'Pump operating normally'
                  ELSE CAST(fault_windows AS VARCHAR) || ' anomaly window(s) detected' END AS verdict,
             l.n AS rows_analysed
      FROM summary s JOIN (SELECT series_id, CAST(COUNT(*) AS BIGINT) AS n FROM readings GROUP BY series_id) l
        ON l.series_id = s.series_id) x""", extra=[_SUMMARY_CTE]))
def q_executive_summary(spark, sf_dir):
    from ..operators import report
    r = fx.readings(spark, sf_dir)
    summ = runs.score_summary(fx.scores(spark, sf_dir, fx.windows(spark, sf_dir, r)))
    return report.executive_summary(summ, r)


_COMPARE_CTE = ("cmp", f"""
  SELECT sr.series_id, g.model_id, g.name, g.family, g.model_id = 'm1' AS selected,
         s.total_windows IS NULL AS unavailable, s.fault_windows AS flags, s.peak_prob,
         ROUND(m.f1, 6) AS f1_here, g.test_f1
  FROM (SELECT DISTINCT series_id FROM readings) sr CROSS JOIN registry g
  LEFT JOIN summary s ON s.series_id = sr.series_id AND s.model_id = g.model_id
  LEFT JOIN (SELECT series_id, model_id,
                    {div0("2 * COUNT(*) FILTER (WHERE y = 1 AND p >= 0.5)",
                          "2 * COUNT(*) FILTER (WHERE y = 1 AND p >= 0.5) + COUNT(*) FILTER (WHERE y <> 1 AND p >= 0.5) + COUNT(*) FILTER (WHERE y = 1 AND p < 0.5)")} AS f1
             FROM scores GROUP BY series_id, model_id) m ON m.series_id = sr.series_id AND m.model_id = g.model_id""")


def _compare(spark, sf_dir):
    from ..operators import metrics, report
    r = fx.readings(spark, sf_dir)
    s = fx.scores(spark, sf_dir, fx.windows(spark, sf_dir, r))
    keys = ["series_id", "model_id"]
    m = metrics.prf(s, keys)
    c = report.model_compare(runs.score_summary(s), m, fx.registry(spark),
                             r.select("series_id").distinct(), "m1")
    return c.withColumn("f1_here", _r6(F.col("f1_here")))


@register("model_compare", with_views(["scores", "registry"], """
SELECT series_id, model_id, name, family, selected, unavailable, flags, peak_prob, f1_here, test_f1 FROM cmp""",
    extra=[_SUMMARY_CTE, _COMPARE_CTE]))
def q_model_compare(spark, sf_dir):
    return _compare(spark, sf_dir)


@register("agreement", with_views(["scores", "registry"], """
SELECT series_id, CAST(COUNT(*) AS BIGINT) AS n_available, CAST(COUNT(*) FILTER (WHERE flags > 0) AS BIGINT) AS n_flagging,
       COALESCE(STRING_AGG(name, ', ' ORDER BY model_id) FILTER (WHERE flags = 0), '') AS silent_models,
       CASE WHEN COUNT(*) FILTER (WHERE flags > 0) = 0 THEN 'none'
            WHEN COUNT(*) FILTER (WHERE flags > 0) = COUNT(*) THEN 'all' ELSE 'partial' END AS agreement
FROM cmp WHERE NOT unavailable GROUP BY series_id""", extra=[_SUMMARY_CTE, _COMPARE_CTE]))
def q_agreement(spark, sf_dir):
    from ..operators import report
    return report.agreement(_compare(spark, sf_dir))


@register("prob_series", with_views(["scores"], """
SELECT s.series_id, s.model_id, CAST(s.idx AS BIGINT) AS idx, s.p, 0.5::DOUBLE AS threshold, s.p >= 0.5 AS flagged,
       CAST(m.start_idx AS BIGINT) AS run_start_idx
FROM scores s LEFT JOIN members m ON m.series_id = s.series_id AND m.model_id = s.model_id AND m.idx = s.idx""",
    extra=[_MEMBERS_CTE]))
def q_prob_series(spark, sf_dir):
    from ..operators import report
    p = report.prob_series(fx.scores(spark, sf_dir))
    return p.withColumn("idx", F.col("idx").cast("bigint"))


# ------------------------------------------------------------------ audit --

AUDIT_SENSORS = fx.CHANNELS


def _same_sql(cols: list[str]) -> str:
    return " AND ".join(["sa.o IS NOT NULL", "sb.o IS NOT NULL"] + [f"sa.{c} IS NOT DISTINCT FROM sb.{c}" for c in cols])


_AUDIT_COLS = [*AUDIT_SENSORS, "anomaly", "changepoint"]


@register("audit_file_info", with_views(["file_rows"], """
SELECT file_k, MIN(ts) AS start_ts, MAX(ts) AS end_ts, CAST(COUNT(*) AS BIGINT) AS rows,
       CAST(COUNT(*) FILTER (WHERE anomaly = 1) AS BIGINT) AS anomaly_count
FROM file_rows GROUP BY file_k"""))
def q_audit_file_info(spark, sf_dir):
    from ..operators import audit
    return audit.file_info(fx.file_rows(spark, sf_dir))


@register("overlap_pairs", with_views(["file_rows"], """
SELECT a.file_k AS file_a, b.file_k AS file_b
FROM info a JOIN info b ON a.file_k < b.file_k AND NOT (a.end_ts < b.start_ts OR b.end_ts < a.start_ts)""",
    extra=[("info", "SELECT file_k, MIN(ts) AS start_ts, MAX(ts) AS end_ts FROM file_rows GROUP BY file_k")]))
def q_overlap_pairs(spark, sf_dir):
    from ..operators import audit
    return audit.overlap_pairs(audit.file_info(fx.file_rows(spark, sf_dir)))


_COMMON_CTE = ("common", """
  SELECT a.file_k AS file_a, b.file_k AS file_b, a.ts
  FROM (SELECT DISTINCT file_k, ts FROM file_rows) a
  JOIN (SELECT DISTINCT file_k, ts FROM file_rows) b ON a.ts = b.ts AND a.file_k < b.file_k""")


@register("ts_intersect", with_views(["file_rows"], "SELECT file_a, file_b, ts FROM common",
                                     extra=[_COMMON_CTE]))
def q_ts_intersect(spark, sf_dir):
    from ..operators import audit
    return audit.common_timestamps(fx.file_rows(spark, sf_dir))


@register("overlap_counts", with_views(["file_rows"], """
SELECT file_a, file_b, overlap_count, CAST(r AS BIGINT) AS k, ts AS sample_time
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY file_a, file_b ORDER BY ts) AS r,
             CAST(COUNT(*) OVER (PARTITION BY file_a, file_b) AS BIGINT) AS overlap_count FROM common) c
WHERE r <= 5""", extra=[_COMMON_CTE]))
def q_overlap_counts(spark, sf_dir):
    from ..operators import audit
    return audit.overlap_counts(audit.common_timestamps(fx.file_rows(spark, sf_dir)))


_VERDICT_CTES = [_COMMON_CTE, ("occ", f"""
  SELECT *, ROW_NUMBER() OVER (PARTITION BY file_k, ts ORDER BY {", ".join(_AUDIT_COLS)}) AS o FROM file_rows"""),
    *[(f"s{x}", f"""SELECT c.file_a, c.file_b, c.ts, r.o, {", ".join(f"r.{c}" for c in _AUDIT_COLS)}
              FROM common c JOIN occ r ON r.file_k = c.file_{x} AND r.ts = c.ts""") for x in "ab"],
    ("verdicts", f"""
  SELECT file_a, file_b, sensor_equal, label_equal, changepoint_equal, full_equal,
         CASE WHEN sensor_equal AND NOT label_equal THEN 'label_conflict' WHEN full_equal THEN 'full_duplicate'
              WHEN sensor_equal AND label_equal THEN 'slicing_overlap' ELSE 'differ' END AS verdict
  FROM (SELECT COALESCE(sa.file_a, sb.file_a) AS file_a, COALESCE(sa.file_b, sb.file_b) AS file_b,
               BOOL_AND({_same_sql(AUDIT_SENSORS)}) AS sensor_equal,
               BOOL_AND({_same_sql(["anomaly"])}) AS label_equal,
               BOOL_AND({_same_sql(["changepoint"])}) AS changepoint_equal,
               BOOL_AND({_same_sql(_AUDIT_COLS)}) AS full_equal
        FROM sa FULL OUTER JOIN sb ON sa.file_a = sb.file_a AND sa.file_b = sb.file_b AND sa.ts = sb.ts AND sa.o = sb.o
        GROUP BY 1, 2) x""")]


def _verdicts(spark, sf_dir):
    from ..operators import audit
    rows = fx.file_rows(spark, sf_dir)
    return audit.overlap_verdict(rows, audit.common_timestamps(rows), AUDIT_SENSORS)


@register("overlap_verdict", with_views(["file_rows"], """
SELECT file_a, file_b, sensor_equal, label_equal, changepoint_equal, full_equal, verdict FROM verdicts""",
    extra=_VERDICT_CTES))
def q_overlap_verdict(spark, sf_dir):
    return _verdicts(spark, sf_dir)


@register("audit_summary", with_views(["file_rows"], """
SELECT overlap_cases, full_duplicates, label_conflicts, consistent_slicing,
       CASE WHEN overlap_cases = 0 THEN 'independent' WHEN label_conflicts > 0 THEN 'label_conflicts' ELSE 'clean' END AS conclusion
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS overlap_cases,
             CAST(COUNT(*) FILTER (WHERE full_equal) AS BIGINT) AS full_duplicates,
             CAST(COUNT(*) FILTER (WHERE sensor_equal AND NOT label_equal) AS BIGINT) AS label_conflicts,
             CAST(COUNT(*) FILTER (WHERE sensor_equal AND label_equal AND NOT full_equal) AS BIGINT) AS consistent_slicing
      FROM verdicts) s""", extra=_VERDICT_CTES))
def q_audit_summary(spark, sf_dir):
    from ..operators import audit
    return audit.audit_summary(_verdicts(spark, sf_dir))


# ------------------------------------------------------ profile, validation --

@register("split_assign", with_views(["readings"], """
SELECT r.series_id, p.split, CAST(COUNT(*) AS BIGINT) AS rows
FROM readings r JOIN (SELECT DISTINCT series_id, split FROM readings) p ON p.series_id = r.series_id
GROUP BY r.series_id, p.split"""))
def q_split_assign(spark, sf_dir):
    """The split plan (one row per file) joined to the readings."""
    from ..operators import profile
    r = fx.readings(spark, sf_dir)
    plan = r.select("series_id", "split").distinct()
    assigned, _missing = profile.assign_split(r.drop("split"), plan, ["series_id"])
    return assigned.groupBy("series_id", "split").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


@register("split_summary", with_views(["windows"], """
SELECT CASE g WHEN 0 THEN 'file' WHEN 1 THEN 'split' ELSE 'total' END AS level, split, series_id,
       samples, positives, samples - positives AS negatives,
       ROUND(CAST(positives AS DOUBLE) / samples, 6) AS positive_ratio,
       ROUND(CAST(samples AS DOUBLE) / SUM(samples) OVER (PARTITION BY g), 6) AS share
FROM (SELECT split, series_id, CAST(COUNT(*) AS BIGINT) AS samples,
             CAST(COUNT(*) FILTER (WHERE y = 1) AS BIGINT) AS positives, GROUPING(split, series_id) AS g
      FROM windows GROUP BY ROLLUP (split, series_id)) r"""))
def q_split_summary(spark, sf_dir):
    from ..operators import profile
    s = profile.split_summary(fx.windows(spark, sf_dir))
    return s.withColumn("positive_ratio", _r6(F.col("positive_ratio"))).withColumn("share", _r6(F.col("share")))


@register("file_summary", with_views(["readings"], """
SELECT series_id, CAST(COUNT(*) AS BIGINT) AS rows,
       CAST(COUNT(*) FILTER (WHERE anomaly = 1) AS BIGINT) AS anomaly_count,
       CAST(COUNT(*) FILTER (WHERE anomaly = 0) AS BIGINT) AS normal_count,
       ROUND(CAST(COUNT(*) FILTER (WHERE anomaly = 1) AS DOUBLE) / COUNT(*), 6) AS anomaly_ratio
FROM readings GROUP BY series_id"""))
def q_file_summary(spark, sf_dir):
    from ..operators import profile
    s = profile.file_summary(fx.readings(spark, sf_dir))
    return s.withColumn("anomaly_ratio", _r6(F.col("anomaly_ratio")))


@register("label_distribution", with_views(["readings"], """
SELECT CAST(anomaly AS BIGINT) AS label, CAST(COUNT(*) AS BIGINT) AS rows,
       ROUND(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 6) AS share
FROM readings GROUP BY anomaly"""))
def q_label_distribution(spark, sf_dir):
    from ..operators import profile
    d = profile.label_distribution(fx.readings(spark, sf_dir))
    return d.select(F.col("label").cast("bigint").alias("label"), "rows", _r6(F.col("share")).alias("share"))


_MISSING_COLS = ["series_id", "ts", *CH, "anomaly"]


@register("missing_counts", with_views(["readings"], "\nUNION ALL ".join(
    f"""SELECT CAST({k} AS BIGINT) AS col_pos, '{c}' AS col_name,
       CAST(COUNT(*) FILTER (WHERE {c} IS NULL{" OR series_id % 2 = 1" if c in ("ch8", "anomaly") else ""}) AS BIGINT) AS missing
FROM readings""" for k, c in enumerate(_MISSING_COLS))))
def q_missing_counts(spark, sf_dir):
    """A4 over files of two layouts: odd series lack ``ch8`` and the label."""
    from ..operators import profile
    r = fx.readings(spark, sf_dir).select(*_MISSING_COLS)
    full = r.where(F.col("series_id") % 2 == 0)
    partial = r.where(F.col("series_id") % 2 == 1).drop("ch8", "anomaly")
    m = profile.missing_counts([full, partial])
    return m.select(F.col("col_pos").cast("bigint").alias("col_pos"), "col_name", "missing")


def _blank_sql(c: str) -> str:
    from ..config import NA_TOKENS
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return (f"({c} IS NULL OR TRIM({c}) IN ({toks}) "
            f"OR COALESCE(isnan(TRY_CAST(TRIM({c}) AS DOUBLE)), FALSE))")


@register("time_column_hints", with_views(["upload_headers"], """
SELECT file, 'datetime' AS missing_column,
       arg_min(col_name, col_pos) FILTER (WHERE LOWER(col_name) IN ('timestamp', 'time', 'date', 'datetime')) AS suggestion
FROM upload_headers GROUP BY file HAVING NOT BOOL_OR(col_name = 'datetime')"""))
def q_time_column_hints(spark, sf_dir):
    from ..operators import validate
    return validate.time_column_hints(fx.upload_headers(spark, sf_dir), "datetime")


@register("rename_hints", with_views(["upload_headers"], f"""
SELECT m.file, CAST(m.ch_pos AS BIGINT) AS ch_pos, m.wanted AS missing_column, arg_max(h.col_name, h.col_pos) AS suggestion
FROM (SELECT f.file, w.ch_pos, w.wanted
      FROM (SELECT DISTINCT file FROM upload_headers) f
      CROSS JOIN (SELECT * FROM (VALUES {", ".join(f"({k}, '{c}')" for k, c in enumerate(CH))}) v(ch_pos, wanted)) w
      WHERE NOT EXISTS (SELECT 1 FROM upload_headers h WHERE h.file = f.file AND h.col_name = w.wanted)) m
LEFT JOIN upload_headers h ON h.file = m.file
     AND LOWER(REGEXP_REPLACE(TRIM(h.col_name), '[_ ]', '', 'g')) = LOWER(REGEXP_REPLACE(TRIM(m.wanted), '[_ ]', '', 'g'))
GROUP BY m.file, m.ch_pos, m.wanted"""))
def q_rename_hints(spark, sf_dir):
    from ..operators import validate
    return validate.rename_hints(fx.upload_headers(spark, sf_dir), CH)


@register("nonnumeric_cells", with_views(["uploads"], f"""
SELECT file, CAST(ch_pos AS BIGINT) AS ch_pos, channel, first_value, first_row, n_bad, rk <= 3 AS is_example FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY file ORDER BY ch_pos) AS rk FROM (
    SELECT file, ch_pos, channel, arg_min(cell, row) AS first_value, MIN(row) AS first_row,
           CAST(COUNT(*) AS BIGINT) AS n_bad
    FROM ({_unpivot_cols_sql("uploads", "file, row", CH, "cell")}) u
    WHERE NOT {_blank_sql("cell")} AND TRY_CAST(TRIM(cell) AS DOUBLE) IS NULL
    GROUP BY file, ch_pos, channel) a) b"""))
def q_nonnumeric_cells(spark, sf_dir):
    from ..operators import validate
    n = validate.nonnumeric_cells(fx.uploads(spark, sf_dir), CH)
    return n.select("file", F.col("ch_pos").cast("bigint").alias("ch_pos"), "channel", "first_value",
                    "first_row", "n_bad", "is_example")


@register("null_counts", with_views(["uploads"], "\nUNION ALL ".join(
    f"""SELECT file, CAST({k} AS BIGINT) AS ch_pos, '{c}' AS channel,
       CAST(COUNT(*) FILTER (WHERE {_blank_sql(c)}) AS BIGINT) AS n_blank FROM uploads GROUP BY file"""
    for k, c in enumerate(CH))))
def q_null_counts(spark, sf_dir):
    from ..operators import validate
    b = validate.blank_counts(fx.uploads(spark, sf_dir), CH)
    return b.select("file", F.col("ch_pos").cast("bigint").alias("ch_pos"), "channel", "n_blank")


_FACTS_SQL = f"""
  SELECT u.file, u.rows, h.columns, h.has_label, u.start_ts, u.end_ts, u.bad_timestamps, u.rows < 30 AS too_short
  FROM (SELECT file, CAST(COUNT(*) AS BIGINT) AS rows,
               CAST(COUNT(*) FILTER (WHERE TRY_CAST(TRIM(ts_text) AS TIMESTAMP) IS NULL AND NOT {_blank_sql("ts_text")}) AS BIGINT) AS bad_timestamps,
               MIN(TRY_CAST(TRIM(ts_text) AS TIMESTAMP)) AS start_ts, MAX(TRY_CAST(TRIM(ts_text) AS TIMESTAMP)) AS end_ts
        FROM uploads GROUP BY file) u
  LEFT JOIN (SELECT file, CAST(COUNT(*) AS BIGINT) AS columns, BOOL_OR(col_name = 'anomaly') AS has_label
             FROM upload_headers GROUP BY file) h ON h.file = u.file"""


def _facts(spark, sf_dir):
    from ..operators import validate
    r = fx.readings(spark, sf_dir)
    return validate.file_facts(fx.uploads(spark, sf_dir, r), "ts_text", fx.upload_headers(spark, sf_dir, r))


@register("file_facts", with_views(["uploads", "upload_headers"], "SELECT * FROM facts",
                                   extra=[("facts", _FACTS_SQL)]))
def q_file_facts(spark, sf_dir):
    return _facts(spark, sf_dir).select(
        "file", "rows", "columns", "has_label",
        F.col("start_ts").cast("timestamp_ntz").alias("start_ts"),
        F.col("end_ts").cast("timestamp_ntz").alias("end_ts"), "bad_timestamps", "too_short")


@register("too_short", with_views(["uploads", "upload_headers"], "SELECT file, rows, too_short FROM facts",
                                  extra=[("facts", _FACTS_SQL)]))
def q_too_short(spark, sf_dir):
    return _facts(spark, sf_dir).select("file", "rows", "too_short")


_PROFILE_SQL = """
  SELECT file, CAST(COUNT(*) AS BIGINT) AS n_intervals, MEDIAN(dt) AS median_interval,
         COALESCE(STDDEV_SAMP(dt), 0.0) AS std_interval,
         CAST(COUNT(*) FILTER (WHERE dt > 2.0) AS BIGINT) AS gaps,
         CAST(COUNT(*) FILTER (WHERE dt <= 0) AS BIGINT) AS duplicates
  FROM (SELECT series_id AS file,
               (epoch_us(ts) - LAG(epoch_us(ts)) OVER (PARTITION BY series_id ORDER BY ts, event_id)) / 1e6 AS dt
        FROM readings) d
  WHERE dt IS NOT NULL GROUP BY file"""


def _profile(spark, sf_dir):
    from ..operators import validate
    r = fx.readings(spark, sf_dir)
    return validate.sampling_profile(r.withColumnRenamed("series_id", "file"), "ts", "file", "event_id")


@register("sampling_profile", with_views(["readings"], """
SELECT file, n_intervals, median_interval, ROUND(std_interval, 6) AS std_interval,
       gaps, duplicates FROM prof""", extra=[("prof", _PROFILE_SQL)]))
def q_sampling_profile(spark, sf_dir):
    p = _profile(spark, sf_dir)
    return p.withColumn("std_interval", _r6(F.col("std_interval")))


@register("sampling_warnings", with_views(["readings", "uploads", "upload_headers"], """
SELECT p.file, w.warning, ROUND(CASE WHEN median_interval > 0 THEN 1 / median_interval END, 6) AS rate_hz,
       median_interval, ROUND(std_interval, 6) AS std_interval, gaps, duplicates
FROM prof p LEFT JOIN facts f ON f.file = p.file
JOIN (SELECT 'sampling_rate' AS warning UNION ALL SELECT 'uneven_intervals' UNION ALL SELECT 'gaps'
      UNION ALL SELECT 'duplicate_timestamps' UNION ALL SELECT 'no_label') w
  ON (w.warning = 'sampling_rate' AND ABS(median_interval - 1.0) > 0.3)
  OR (w.warning = 'uneven_intervals' AND std_interval > 0.5 AND median_interval > 0)
  OR (w.warning = 'gaps' AND gaps > 0) OR (w.warning = 'duplicate_timestamps' AND duplicates > 0)
  OR (w.warning = 'no_label' AND NOT COALESCE(f.has_label, FALSE))""",
    extra=[("prof", _PROFILE_SQL), ("facts", _FACTS_SQL)]))
def q_sampling_warnings(spark, sf_dir):
    from ..operators import validate
    w = validate.sampling_warnings(_profile(spark, sf_dir), _facts(spark, sf_dir))
    return w.select("file", "warning", _r6(F.col("rate_hz")).alias("rate_hz"),
                    "median_interval", _r6(F.col("std_interval")).alias("std_interval"), "gaps", "duplicates")


@register("unknown_models", with_views(["model_requests", "registry"], """
SELECT q.series_id, q.model_id FROM model_requests q WHERE q.model_id NOT IN (SELECT model_id FROM registry)"""))
def q_unknown_models(spark, sf_dir):
    from ..operators import validate
    return validate.unknown_models(fx.model_requests(spark, sf_dir), fx.registry(spark))


# ------------------------------------------------- live path (batch twins) --

def _qevents_ctes() -> list[tuple[str, str]]:
    return [
        ("longv", _unpivot_cols_sql("readings", "series_id, i", CH)),
        ("frz", """
  SELECT series_id, i, channel, flag, COALESCE(LAG(flag) OVER (PARTITION BY series_id, channel ORDER BY i), FALSE) AS prev
  FROM (SELECT series_id, i, channel,
               COUNT(value) OVER w >= 30 AND MIN(value) OVER w = MAX(value) OVER w AS flag
        FROM longv WHERE value IS NOT NULL
        WINDOW w AS (PARTITION BY series_id, channel ORDER BY i ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) f"""),
        ("rng", """
  SELECT series_id, i, channel, flag, COALESCE(LAG(flag) OVER (PARTITION BY series_id, channel ORDER BY i), FALSE) AS prev
  FROM (SELECT l.series_id, l.i, l.channel,
               COALESCE(l.value IS NOT NULL AND (l.value < c.lo OR l.value > c.hi), FALSE) AS flag
        FROM longv l JOIN channel_ranges c ON c.channel = l.channel) f"""),
        ("unv", """
  SELECT series_id, i, flag, COALESCE(LAG(flag) OVER (PARTITION BY series_id ORDER BY i), FALSE) AS prev
  FROM (SELECT series_id, i,
               COUNT(dt) OVER w >= 20 AND STDDEV_POP(dt) OVER w > 0.5 AS flag
        FROM (SELECT series_id, i, arrival_s - LAG(arrival_s) OVER (PARTITION BY series_id ORDER BY i) AS dt
              FROM readings) d
        WHERE dt > 0
        WINDOW w AS (PARTITION BY series_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) f"""),
        ("qev", """
  SELECT series_id, i, CASE WHEN flag THEN 'FROZEN_SENSOR' ELSE 'FROZEN_CLEARED' END AS code, channel,
         CASE WHEN flag THEN 'warning' ELSE 'info' END AS severity FROM frz WHERE flag <> prev
  UNION ALL
  SELECT series_id, i, CASE WHEN flag THEN 'OUT_OF_RANGE' ELSE 'OUT_OF_RANGE_CLEARED' END, channel,
         CASE WHEN flag THEN 'warning' ELSE 'info' END FROM rng WHERE flag <> prev
  UNION ALL
  SELECT series_id, i, CASE WHEN flag THEN 'UNEVEN_SAMPLING' ELSE 'EVEN_SAMPLING_RESTORED' END, NULL,
         CASE WHEN flag THEN 'warning' ELSE 'info' END FROM unv WHERE flag <> prev"""),
        ("openw", """
  SELECT series_id, warning, channel, i AS since_i FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id, warning, COALESCE(channel, '') ORDER BY i DESC) AS rk
    FROM (SELECT *, CASE code WHEN 'FROZEN_CLEARED' THEN 'FROZEN_SENSOR' WHEN 'OUT_OF_RANGE_CLEARED' THEN 'OUT_OF_RANGE'
                              WHEN 'EVEN_SAMPLING_RESTORED' THEN 'UNEVEN_SAMPLING' ELSE code END AS warning FROM qev) e) x
  WHERE rk = 1 AND code = warning"""),
    ]


def _quality(spark, sf_dir):
    from ..operators import quality
    r = fx.readings(spark, sf_dir)
    return r, quality.quality_events(r, fx.channel_ranges(spark), CH)


@register("frozen_sensor", with_views(["readings", "channel_ranges"], """
SELECT series_id, i, channel, CASE WHEN flag THEN 'FROZEN_SENSOR' ELSE 'FROZEN_CLEARED' END AS code
FROM frz WHERE flag <> prev""", extra=_qevents_ctes()))
def q_frozen_sensor(spark, sf_dir):
    from ..operators import quality
    e = quality.frozen_events(fx.readings(spark, sf_dir), CH)
    return e.select("series_id", "i", "channel", "code")


@register("out_of_range", with_views(["readings", "channel_ranges"], """
SELECT series_id, i, channel, CASE WHEN flag THEN 'OUT_OF_RANGE' ELSE 'OUT_OF_RANGE_CLEARED' END AS code
FROM rng WHERE flag <> prev""", extra=_qevents_ctes()))
def q_out_of_range(spark, sf_dir):
    from ..operators import quality
    e = quality.range_events(fx.readings(spark, sf_dir), fx.channel_ranges(spark), CH)
    return e.select("series_id", "i", "channel", "code")


@register("uneven_cadence", with_views(["readings", "channel_ranges"], """
SELECT series_id, i, CASE WHEN flag THEN 'UNEVEN_SAMPLING' ELSE 'EVEN_SAMPLING_RESTORED' END AS code
FROM unv WHERE flag <> prev""", extra=_qevents_ctes()))
def q_uneven_cadence(spark, sf_dir):
    from ..operators import quality
    e = quality.cadence_events(fx.readings(spark, sf_dir))
    return e.select("series_id", "i", "code")


@register("quality_events", with_views(["readings", "channel_ranges"], """
SELECT series_id, i, code, channel, severity FROM qev""", extra=_qevents_ctes()))
def q_quality_events(spark, sf_dir):
    return _quality(spark, sf_dir)[1]


@register("open_warnings", with_views(["readings", "channel_ranges"], """
SELECT series_id, warning, channel, since_i FROM openw""", extra=_qevents_ctes()))
def q_open_warnings(spark, sf_dir):
    from ..operators import quality
    return quality.open_warnings(_quality(spark, sf_dir)[1])


@register("stale_gaps", with_views(["readings"], """
SELECT series_id, i, ROUND(gap_s, 6) AS gap_s FROM (
  SELECT series_id, i, LEAD(epoch_us(ts) / 1e6) OVER (PARTITION BY series_id ORDER BY i) - epoch_us(ts) / 1e6 AS gap_s
  FROM readings WHERE i >= 19) g
WHERE gap_s > 5"""))
def q_stale_gaps(spark, sf_dir):
    """X9 over the recorded stream: a tick (from the 20th sample on) followed
    by more than 5 s without a tick, by the readings' own clock."""
    from ..operators import quality
    r = fx.readings(spark, sf_dir).where(F.col("i") >= 19)
    g = quality.stale_gaps(r, F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6))
    return g.withColumn("gap_s", _r6(F.col("gap_s")))


_CFG_CTES = [("cfg0", """
  SELECT at_s, LEAD(at_s) OVER (ORDER BY at_s) AS next_s,
         COALESCE(LAST_VALUE(model_id IGNORE NULLS) OVER (ORDER BY at_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'm1') AS model_id,
         COALESCE(LAST_VALUE(threshold IGNORE NULLS) OVER (ORDER BY at_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.5) AS threshold
  FROM live_config"""),
    ("cfg", """
  SELECT at_s, next_s, model_id, threshold,
         CAST(SUM(ch) OVER (ORDER BY at_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS segment
  FROM (SELECT *, CASE WHEN model_id <> COALESCE(LAG(model_id) OVER (ORDER BY at_s), 'm1') THEN 1 ELSE 0 END AS ch FROM cfg0) c"""),
    ("cfg_at", """
  SELECT r.series_id, r.i, r.arrival_s, COALESCE(c.model_id, 'm1') AS model_id, COALESCE(c.threshold, 0.5) AS threshold,
         COALESCE(c.segment, 0) AS segment
  FROM readings r LEFT JOIN cfg c ON r.arrival_s >= c.at_s AND (c.next_s IS NULL OR r.arrival_s < c.next_s)""")]


@register("asof_config", with_views(["readings", "live_config"], """
SELECT series_id, i, arrival_s, model_id, threshold, segment FROM cfg_at""", extra=_CFG_CTES))
def q_asof_config(spark, sf_dir):
    from ..operators import live
    r = fx.readings(spark, sf_dir)
    res = live.resolve_config(fx.live_config(spark), "m1")
    a = live.config_as_of(r, res)
    return a.select("series_id", "i", "arrival_s",
                    F.coalesce("model_id", F.lit("m1")).alias("model_id"),
                    F.coalesce("threshold", F.lit(0.5)).alias("threshold"),
                    F.coalesce("segment", F.lit(0).cast("bigint")).alias("segment"))


def _states_sql(src: str, keys: list[str], order: str) -> list[tuple[str, str]]:
    """The recursive fold over ``src`` (columns keys, order, p) as CTEs; the
    result CTE ``st`` has keys, order, st (0..3) and state."""
    k = ", ".join(keys)
    on = " AND ".join(f"b.{c} = r.{c}" for c in keys)
    return [("b", f"""
  SELECT {k}, {order}, p, MIN(p) OVER w AS mn, MAX(p) OVER w AS mx, COUNT(*) OVER w AS c,
         CASE WHEN p >= 0.8 THEN 3 WHEN p >= 0.5 THEN 2 WHEN p >= 0.3 THEN 1 ELSE 0 END AS bd
  FROM {src} WINDOW w AS (PARTITION BY {k} ORDER BY {order} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
        ("r", f"""
  SELECT {k}, {order}, CASE WHEN bd = 3 THEN 3 WHEN bd >= 1 THEN 1 ELSE 0 END AS st FROM b WHERE {order} = 0
  UNION ALL
  SELECT {", ".join("b." + c for c in keys)}, b.{order},
         CASE WHEN b.bd = 3 THEN 3
              WHEN b.bd > r.st THEN CASE WHEN r.st = 0 THEN 1 WHEN r.st = 1 AND b.c = 3 AND b.mn >= 0.5 THEN 2 ELSE r.st END
              WHEN b.bd < r.st THEN CASE WHEN b.c = 3 AND b.mx < CASE r.st WHEN 3 THEN 0.8 WHEN 2 THEN 0.5 ELSE 0.3 END THEN r.st - 1 ELSE r.st END
              ELSE r.st END
  FROM r JOIN b ON {on} AND b.{order} = r.{order} + 1"""),
        ("st", f"""
  SELECT {k}, {order}, st,
         CASE st WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'WATCH' WHEN 2 THEN 'WARNING' ELSE 'ALERT' END AS state FROM r""")]


_LIVE_CTES = _CFG_CTES + [
    ("lt0", """
  SELECT a.series_id, a.i, a.model_id, a.threshold, a.segment,
         ROUND(1 / (1 + EXP(-(m.slope * (w.cents / CAST(2000 AS DOUBLE) - 50) + m.bias))), 6) AS p
  FROM cfg_at a
  JOIN (SELECT series_id, i, COUNT(*) OVER x AS cnt,
               CAST(SUM(CAST(ROUND(ch1 * 100) AS BIGINT)) OVER x AS BIGINT) AS cents
        FROM readings WINDOW x AS (PARTITION BY series_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) w
    ON w.series_id = a.series_id AND w.i = a.i AND w.cnt = 20
  JOIN (SELECT 'm1' AS model_id, CAST(0.06 AS DOUBLE) AS slope, CAST(0 AS DOUBLE) AS bias
        UNION ALL SELECT 'm2', CAST(0.12 AS DOUBLE), CAST(0 AS DOUBLE)
        UNION ALL SELECT 'm3', CAST(0.03 AS DOUBLE), CAST(-1.5 AS DOUBLE)) m ON m.model_id = a.model_id"""),
    ("lt", """
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY i) AS BIGINT) AS tick,
         CAST(ROW_NUMBER() OVER (PARTITION BY series_id, segment ORDER BY i) - 1 AS BIGINT) AS k
  FROM lt0""")] + _states_sql("lt", ["series_id", "segment"], "k")

_LIVE_SQL = """
SELECT lt.series_id, lt.tick, lt.i, lt.segment, lt.model_id, lt.p, st.state AS status, lt.threshold,
       lt.p >= lt.threshold AS in_anomaly_window
FROM lt JOIN st ON st.series_id = lt.series_id AND st.segment = lt.segment AND st.k = lt.k"""


def _live_ticks(spark, sf_dir, r=None):
    from ..operators import live
    r = fx.readings(spark, sf_dir) if r is None else r
    frame = windows.series_frame(-19, 0)
    r = r.withColumn("cents", F.sum(F.round(F.col("ch1") * 100).cast("bigint")).over(frame).cast("bigint"))
    models = spark.createDataFrame(fx.FIXTURE_MODELS, "model_id string, slope double, bias double")

    def score(df):
        j = df.join(F.broadcast(models), "model_id")
        return j.withColumn("p", fx.fixture_prob(F.col("cents"), F.col("slope"), F.col("bias")))
    res = live.resolve_config(fx.live_config(spark), "m1")
    return live.live_ticks(r, CH, res, score)


@register("live_ticks", with_views(["readings", "live_config"], _LIVE_SQL, extra=_LIVE_CTES, recursive=True))
def q_live_ticks(spark, sf_dir):
    t = _live_ticks(spark, sf_dir)
    return t.select("series_id", "tick", "i", "segment", "model_id", "p", "status", "threshold",
                    "in_anomaly_window")


@register("live_status", with_views(["readings", "live_config", "channel_ranges"], """
SELECT b.series_id, b.buffered, COALESCE(t.ticks_emitted, 0) AS ticks_emitted,
       COALESCE(t.status, 'NORMAL') AS current_status, t.model_id, t.threshold,
       COALESCE(q.keys, '') AS active_quality_issues
FROM (SELECT series_id, CAST(LEAST(COUNT(*), 600) AS BIGINT) AS buffered FROM readings GROUP BY series_id) b
LEFT JOIN (SELECT series_id, CAST(COUNT(*) AS BIGINT) AS ticks_emitted,
                  arg_max(status, i) AS status, arg_max(model_id, i) AS model_id, arg_max(threshold, i) AS threshold
           FROM lticks GROUP BY series_id) t ON t.series_id = b.series_id
LEFT JOIN (SELECT series_id, STRING_AGG(key, ',' ORDER BY key) AS keys FROM (
             SELECT series_id, CASE warning WHEN 'FROZEN_SENSOR' THEN 'frozen' WHEN 'OUT_OF_RANGE' THEN 'range' ELSE 'uneven' END
                    || ':' || COALESCE(channel, 'ingest') AS key FROM openw) k GROUP BY series_id) q ON q.series_id = b.series_id""",
    extra=_LIVE_CTES + [("lticks", _LIVE_SQL)] + _qevents_ctes(), recursive=True))
def q_live_status(spark, sf_dir):
    from ..operators import live, quality
    r, ev = _quality(spark, sf_dir)
    return live.live_status(r, _live_ticks(spark, sf_dir, r), quality.open_warnings(ev))


@register("history_tail", with_views(["readings"], """
SELECT series_id, i, ts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY i DESC) AS rk FROM readings) x
WHERE rk <= 600"""))
def q_history_tail(spark, sf_dir):
    return windows.history_tail(fx.readings(spark, sf_dir)).select("series_id", "i", "ts")


# --------------------------------------------------- augmentation, k-NN --

_FX_GAINS = {"ch1": 2.0, "ch2": 2.0, "ch3": 0.8, "ch4": 0.4}


def _fx_uniform(series, i, ch_pos):
    """A modular draw both engines compute identically (the oracle's twin)."""
    return F.pmod(series * 7919 + i * 104729 + ch_pos * 15485863, F.lit(1000)).cast("double") / 1000.0


def _burst_sql() -> str:
    outs = []
    for k, c in enumerate(CH):
        x = f"r.{c} * (1.0 + (CAST((r.series_id * 7919 + r.i * 104729 + {k} * 15485863) % 1000 AS DOUBLE) / 1000.0 * 2 - 1) * 0.015)"
        if c in _FX_GAINS:
            x = f"{x} * (1.0 + {_FX_GAINS[c]} * COALESCE(e.envelope, 0.0))"
        if c == "ch5":
            x = f"{x} + 4.0 * COALESCE(e.envelope, 0.0)"
        outs.append(f"ROUND({x}, 9) AS {c}")
    return f"""
SELECT r.series_id, r.i, {", ".join(outs)}, ROUND(COALESCE(e.envelope, 0.0), 9) AS envelope
FROM readings r LEFT JOIN (
  SELECT b.series_id, p.i,
         SIN(LEAST(GREATEST(CAST(p.i - b.start_i AS DOUBLE) / GREATEST(b.dur, 1), 0.0), 1.0) * PI()) * b.intensity AS envelope
  FROM bursts b, LATERAL (SELECT UNNEST(RANGE(b.start_i, b.start_i + b.dur)) AS i) p) e
  ON e.series_id = r.series_id AND e.i = r.i"""


@register("inject_bursts", with_views(["readings", "bursts"], _burst_sql()))
def q_inject_bursts(spark, sf_dir):
    from ..operators import augment
    r = fx.readings(spark, sf_dir)
    out = augment.inject_bursts(r.select("series_id", "i", *CH), fx.bursts(spark, sf_dir, r), CH,
                                gains=_FX_GAINS, add_channel="ch5", uniform=_fx_uniform)
    # 9 decimals: the jittered values have at most 7 exact decimals, so no
    # rounding tie can occur there
    return out.select("series_id", "i", *[F.round(c, 9).alias(c) for c in CH],
                      F.round("envelope", 9).alias("envelope"))


@register("cyclic_shift", with_views(["readings"], """
SELECT series_id, CAST(((i - (series_id * 7) % n) % n + n) % n AS BIGINT) AS i, i AS source_i FROM readings"""))
def q_cyclic_shift(spark, sf_dir):
    from ..operators import augment
    r = fx.readings(spark, sf_dir)
    s = augment.cyclic_shift(r, (F.col("series_id") * 7) % F.col("n"))
    return s.select("series_id", F.col("i").cast("bigint").alias("i"), "source_i")


@register("knn_score", with_views([], """
SELECT vec_id, CAST(COUNT(*) FILTER (WHERE t_y = 1) AS BIGINT) AS n_pos,
       COUNT(*) FILTER (WHERE t_y = 1) / 5.0 AS p
FROM (SELECT q.vec_id, t.t_y,
             ROW_NUMBER() OVER (PARTITION BY q.vec_id ORDER BY
               list_reduce(list_transform(range(1, 65), lambda j: (q.embedding[j]::DOUBLE - t.t_x[j]::DOUBLE)
                                                      * (q.embedding[j]::DOUBLE - t.t_x[j]::DOUBLE)), lambda a, b: a + b),
               t.t_id) AS r
      FROM (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 4 = 0) q,
           (SELECT vec_id AS t_id, embedding AS t_x, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS t_y
            FROM embeddings WHERE vec_id % 4 <> 0) t) d
WHERE r <= 5 GROUP BY vec_id"""))
def q_knn_score(spark, sf_dir):
    """M9 on the embeddings table: every fourth vector is a query, the rest
    is the training set; positive class = label >= 5; k = 5."""
    from ..operators import knn
    e = fx.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), knn.as_double_array(F.col("embedding")).alias("x"),
        F.when(F.col("label") >= 5, 1).otherwise(0).alias("y"))
    train = e.where(F.col("id") % 4 != 0)
    queries = e.where(F.col("id") % 4 == 0)
    s = knn.knn_scores(train, queries, dim=64, bucket_rows=64)
    return s.select(F.col("id").alias("vec_id"), "n_pos", "p")


# ---------------------------------------------------------- file sources --

def _staged_csv(spark, sf_dir) -> str:
    """The fixture readings written as CSV files, one per series, under the
    session's checkpoint folder: even series with ``;``, odd with ``,``, in
    three folders, with a note in every row that needs quotes. Written once per scale; later calls reuse the
    files."""
    import hashlib

    from ..session import scratch_path
    from ..sources import files
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    root = scratch_path(spark, f"staged_csv/{tag}")
    if not files.path_exists(spark, f"{root}/_DONE"):
        r = fx.readings(spark, sf_dir).withColumn("datetime", F.col("ts")) \
              .withColumn("anomaly", F.col("anomaly").cast("double"))
        folder = F.concat(F.lit("valve"), (F.col("series_id") % 3).cast("string"))
        r = r.withColumn("note", F.concat(F.lit('say "on; off",\n'), F.col("i").cast("string")))
        cols = ["datetime", *CH[:4], "note", *CH[4:], "anomaly"]
        # both halves read the readings; they are computed once
        r.select("series_id", "i", *cols).write.mode("overwrite").parquet(f"{root}_rows")
        r = spark.read.parquet(f"{root}_rows")
        files.write_readings_csv(r.where(F.col("series_id") % 2 == 0), root, cols, ";", folder=folder)
        files.write_readings_csv(r.where(F.col("series_id") % 2 == 1), root, cols, ",", folder=folder)
        spark.createDataFrame([(1,)], "done int").coalesce(1).write.mode("overwrite").parquet(f"{root}/_DONE")
    return root


@register("csv_readings", with_views(["readings"], f"""
SELECT series_id, 'valve' || CAST(series_id % 3 AS VARCHAR) AS folder,
       CASE WHEN series_id % 2 = 0 THEN ';' ELSE ',' END AS sep,
       ts AS datetime, {", ".join(CH)}, CAST(anomaly AS DOUBLE) AS anomaly,
       'say "on; off",' || chr(10) || CAST(i AS VARCHAR) AS note
FROM readings"""))
def q_csv_readings(spark, sf_dir):
    """Scan the staged CSV tree once; every record by its own file's separator and header, notes with
    quoted separators, quotes and line breaks."""
    from ..sources import files
    root = _staged_csv(spark, sf_dir)
    schema = files.readings_schema(CH, extra=()).add("note", "string")
    df = files.read_readings(spark, root, schema)
    return df.select(F.regexp_extract("path", r"series_id=(\d+)", 1).cast("bigint").alias("series_id"),
                     F.regexp_extract("path", r"_folder=([^/]+)", 1).alias("folder"), "sep",
                     "datetime", *CH, "anomaly", "note")


@register("upload_gate")
def q_upload_gate(spark, sf_dir):
    """V11 over the staged CSV tree (rows-only check: part-file counts depend
    on the writer's partitioning)."""
    from ..sources import files
    return files.upload_gate(spark, _staged_csv(spark, sf_dir))


# ------------------------------------------------- trained models (rows-only) --

TRAINED_MODELS = ["lr", "rf", "et", "gb", "xgb", "svm", "mlp"]


def _trained_scores(model_id):
    def q(spark, sf_dir):
        """Fit on the training windows, score the test windows (M4-M8, M10,
        M11, M13). Rows-only check: no SQL twin for training."""
        from ..operators import models
        r = fx.readings(spark, sf_dir).where(F.col("split") != "val")  # neither fitted nor scored
        frame = models.written(models.model_frame(r, CH, inputs=[models.input_of(model_id)]))
        model = models.fit(frame, model_id)
        return models.score(model, frame.where(F.col("split") == "test"), model_id) \
                     .select("series_id", F.col("idx").cast("bigint").alias("idx"), "y", "model_id", "p")
    q.__name__ = f"q_model_{model_id}"
    return q


for _m in TRAINED_MODELS:
    register(f"model_{_m}")(_trained_scores(_m))


# All windows as one list of position-scaled values each.
_SCALED_LISTS = ("lists", f"""
  SELECT w.series_id, w.idx, w.split, w.y, w.series_id || ':' || w.idx AS id,
         FLATTEN(LIST([{", ".join(f"(r.{c} - p.mu_{c}) / p.sd_{c}" for c in CH)}] ORDER BY p.t)) AS x
  FROM windows w
  JOIN readings r ON r.series_id = w.series_id AND r.i BETWEEN w.idx AND w.i
  JOIN slot_scaler p ON p.t = r.i - w.idx
  GROUP BY ALL""")


@register("model_knn", with_views(["windows"], """
SELECT series_id, CAST(idx AS BIGINT) AS idx, CAST(y AS INTEGER) AS y, 'knn' AS model_id, COUNT(*) FILTER (WHERE t_y = 1) / 5.0 AS p
FROM (SELECT q.series_id, q.idx, q.y, t.y AS t_y,
             ROW_NUMBER() OVER (PARTITION BY q.id ORDER BY LIST_DISTANCE(q.x, t.x), t.id) AS r
      FROM lists q, lists t WHERE q.split = 'test' AND t.split = 'train') d
WHERE r <= 5 GROUP BY series_id, idx, y""", extra=[_TRAIN_SLOTS, _SCALER_TF, _SLOT_SCALER, _SCALED_LISTS]))
def q_model_knn(spark, sf_dir):
    """M9 as the reference uses it: k = 5 on the position-scaled windows,
    training split as neighbours, test split scored."""
    from ..operators import knn, models, scaling
    r = fx.readings(spark, sf_dir)
    tf = scaling.fit_position_scaler(r.where(F.col("split") == "train"), CH)
    w = windows.sliding_windows(windows.horizon_label(r, chunk_rows=SERIES_CHUNK_ROWS), CH,
                                chunk_rows=SERIES_CHUNK_ROWS)
    w = w.where(F.col("split") != "val").select("series_id", "split", "idx", "y",
                                                windows.flatten_window("win", CH).alias("features"))
    frame = models.written(scaling.apply_position_scaler(w, tf).select(
        "series_id", "split", "idx", F.concat_ws(":", "series_id", "idx").alias("id"),
        F.col("features_scaled").alias("x"), F.col("y").cast("int").alias("y")))
    test = frame.where(F.col("split") == "test")
    s = knn.knn_scores(frame.where(F.col("split") == "train"), test, dim=N_FEATURES)
    return s.join(test.select("id", "series_id", "idx", "y"), "id").select(
        "series_id", F.col("idx").cast("bigint").alias("idx"), "y", F.lit("knn").alias("model_id"), "p")


@register("external_scores", with_views(["windows"], """
SELECT w.series_id, CAST(w.idx AS BIGINT) AS idx, CAST(w.y AS INTEGER) AS y, 'mean_gap' AS model_id,
       ROUND(1 / (1 + EXP(-(AVG(r.ch8 - r.ch1) - 100) / 20)), 6) AS p
FROM windows w JOIN readings r ON r.series_id = w.series_id AND r.i BETWEEN w.idx AND w.i
GROUP BY w.series_id, w.idx, w.y"""))
def q_external_scores(spark, sf_dir):
    """M13 with a scorer of the user's own: margins from the (20, 8) windows, loaded once in each worker."""
    from ..operators import models

    def load():
        def margins(x):
            return (x[:, :, 7] - x[:, :, 0]).mean(axis=1) / 20 - 5
        return margins
    r = windows.horizon_label(fx.readings(spark, sf_dir), chunk_rows=SERIES_CHUNK_ROWS)
    w = windows.sliding_windows(r, CH, chunk_rows=SERIES_CHUNK_ROWS)
    w = w.select("series_id", "idx", "y", windows.flatten_window("win", CH).alias("f"))
    s = models.external_score(w, "mean_gap", load, "f", (WINDOW, len(CH)), logits=True)
    return s.select("series_id", F.col("idx").cast("bigint").alias("idx"), F.col("y").cast("int").alias("y"),
                    "model_id", _r6(F.col("p")).alias("p"))


@register("stored_scalers", with_views(["windows"], """
SELECT pos, t, channel, ROUND(mean, 6) AS mean, ROUND(scale, 6) AS scale FROM scaler_tf""",
                                       extra=[_TRAIN_SLOTS, _SCALER_TF]))
def q_stored_scalers(spark, sf_dir):
    """The position scaler fitted, stored as a new version and loaded again by that version."""
    from ..operators import scaling
    from ..operators.store import Store
    from ..session import scratch_path
    store = Store(spark, scratch_path(spark, "model_store"))
    version = store.save_table("scaler_tf", scaling.fit_position_scaler(_train(spark, sf_dir), CH))
    s = store.load_table("scaler_tf", version)
    return s.select("pos", "t", "channel", _r6(F.col("mean")).alias("mean"), _r6(F.col("scale")).alias("scale"))


@register("upload_report", with_views(["uploads", "upload_headers"], f"""
SELECT f.file,
       CASE WHEN v1.file IS NOT NULL THEN 'missing_time_column'
            WHEN v2.file IS NOT NULL THEN 'missing_sensor_columns'
            WHEN v3.file IS NOT NULL THEN 'non_numeric_values'
            WHEN v4.file IS NOT NULL THEN 'blank_values'
            WHEN fa.bad_timestamps > 0 THEN 'unparseable_timestamps'
            WHEN fa.too_short THEN 'too_few_rows' END AS first_error,
       v1.file IS NULL AND v2.file IS NULL AND v3.file IS NULL AND v4.file IS NULL
         AND NOT COALESCE(fa.bad_timestamps > 0, FALSE) AND NOT COALESCE(fa.too_short, FALSE) AS accepted
FROM (SELECT DISTINCT file FROM upload_headers) f
LEFT JOIN (SELECT file FROM upload_headers GROUP BY file HAVING NOT BOOL_OR(col_name = 'datetime')) v1 ON v1.file = f.file
LEFT JOIN (SELECT DISTINCT f2.file FROM (SELECT DISTINCT file FROM upload_headers) f2
           CROSS JOIN (SELECT * FROM (VALUES {", ".join(f"('{c}')" for c in CH)}) v(wanted)) w
           WHERE NOT EXISTS (SELECT 1 FROM upload_headers h WHERE h.file = f2.file AND h.col_name = w.wanted)) v2
  ON v2.file = f.file
LEFT JOIN (SELECT DISTINCT file FROM ({_unpivot_cols_sql("uploads", "file, row", CH, "cell")}) u
           WHERE NOT {_blank_sql("cell")} AND TRY_CAST(TRIM(cell) AS DOUBLE) IS NULL) v3 ON v3.file = f.file
LEFT JOIN (SELECT DISTINCT file FROM ({_unpivot_cols_sql("uploads", "file, row", CH, "cell")}) u
           WHERE {_blank_sql("cell")}) v4 ON v4.file = f.file
LEFT JOIN facts fa ON fa.file = f.file""", extra=[("facts", _FACTS_SQL)]))
def q_upload_report(spark, sf_dir):
    """validate_schema over all uploads: the first failing check per file."""
    from ..operators import validate
    r = fx.readings(spark, sf_dir)
    return validate.upload_report(fx.upload_headers(spark, sf_dir, r), fx.uploads(spark, sf_dir, r), CH,
                                  "datetime", "ts_text")


@register("sample_series", with_views(["readings"], """
SELECT series_id, i, ts, ch1 AS value, anomaly = 1 AS is_anomaly FROM readings"""))
def q_sample_series(spark, sf_dir):
    from ..operators import report
    return report.sample_series(fx.readings(spark, sf_dir), CH[0])


@register("provenance", with_views(["readings", "registry"], """
SELECT r.series_id, CAST(COUNT(*) AS BIGINT) AS rows_ingested, MIN(r.ts) AS start_ts, MAX(r.ts) AS end_ts,
       BOOL_OR(r.anomaly IS NOT NULL) AS has_label, g.model_id, g.family, 0.5::DOUBLE AS threshold,
       20 AS window_size, 10 AS horizon
FROM readings r CROSS JOIN (SELECT model_id, family FROM registry WHERE model_id = 'm1') g
GROUP BY r.series_id, g.model_id, g.family"""))
def q_provenance(spark, sf_dir):
    from ..operators import report
    return report.provenance(fx.readings(spark, sf_dir), fx.registry(spark), "m1", 0.5)


# Queries without a SQL twin (the checker compares row counts only): model
# training, and the upload gate whose part-file count depends on the writer.
ROWS_ONLY = {"upload_gate", *[f"model_{m}" for m in TRAINED_MODELS]}
