"""Distributed model training and scoring (M3-M8, M10-M15) on Spark ML.

Each model sees the input its family was trained on (M3): linear, kernel and
instance models the position-scaled flat window (160 values), tree models
the raw flat window, the sequence model the channel-scaled window plus its
window statistics. Scalers are fitted on the training split only and are
never refitted on new data.

Estimator settings follow the reference configurations; where Spark ML has
no identical algorithm the nearest one is used and said so:

* lr   LogisticRegression, 1000 iterations, L2 with ``regParam = 1/n`` (C = 1)
* rf   forest (``trees``), 100 trees, sqrt features, depth capped at 30 (as Spark's was)
* et   forest without bootstrap, 200 trees (no random thresholds)
* gb   boosted trees (``trees``), 200 rounds, depth 3, rate 0.1
* xgb  boosted trees, 300 rounds, depth 6, rate 0.1, row and column sampling 0.8
* svm  RBF support vectors: the kernel with the data's own gamma (1 / (values per window * their variance)) mapped
       to landmark features (Nystroem: kernel values to ``LANDMARKS`` training windows, whitened), then LinearSVC with
       C = 1; with all training windows as landmarks the inner products equal the kernel. The score is the sigmoid of
       the margin, as for a model without probabilities
* mlp  MultilayerPerceptron on [scaled window || statistics] (re-aimed deep model)
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session
from ..config import HORIZON, SERIES_CHUNK_ROWS, WINDOW
from ..session import ensure_checkpoint_dir
from . import features, scaling, trees, windows

# FIXED VALUES: model families and their inputs.
RAW_MODELS = ["rf", "et", "gb", "xgb"]
SCALED_MODELS = ["lr", "svm", "knn"]
SEQUENCE_MODELS = ["mlp"]
#: Feature columns of a model frame and the arrays that they are made from.
FEATURES = {"features_raw": "f", "features_tf": "f_tf", "features_seq": "f_seq"}
INPUTS = tuple(FEATURES)
#: Training windows that carry the kernel model; bounds its map to LANDMARKS x (values + LANDMARKS) doubles.
LANDMARKS = 512
LANDMARK_DRAWS = 8


def model_frame(readings: DataFrame, channels: Sequence[str], window: int = WINDOW,
                horizon: int = HORIZON, label: str = "anomaly", chunk_rows: int = SERIES_CHUNK_ROWS,
                inputs: Sequence[str] = INPUTS) -> DataFrame:
    """Windows with label ``y`` and the feature columns named by ``inputs``:
    ``features_raw`` (flat), ``features_tf`` (position-scaled flat) and
    ``features_seq`` (channel-scaled flat || statistics of the scaled window).

    Without the sequence input the windows are slices of sorted chunks.
    With it the raw and channel-scaled windows and the statistics are window
    aggregates over one spec of halo chunks, so the readings are shuffled once
    and no task holds a long series.
    """
    channels = list(channels)
    train = readings.where(F.col("split") == "train")
    tf = scaling.fit_position_scaler(train, channels, window, horizon)
    lab = windows.horizon_label(readings, horizon, label, chunk_rows=chunk_rows)
    keys = ["series_id", "split", "i", "idx", F.col("y").cast("double").alias("label")]
    if "features_seq" not in inputs:
        row = F.array(*[F.col(c) for c in channels])
        st = windows.sliced_windows(lab.select("series_id", "split", "i", "n", "y", *channels), {"win": row},
                                    window, horizon, chunk_rows=chunk_rows).withColumn("f", F.flatten("win"))
        if "features_tf" in inputs:
            st = scaling.apply_position_scaler(st, tf, "f", "f_tf")
        return st.select(*keys, *[array_to_vector(FEATURES[c]).alias(c) for c in inputs])
    fs = scaling.fit_channel_scaler(train, channels, window, horizon)
    lab = lab.select("*", *[F.col(c).alias(f"raw_{c}") for c in channels])
    scaled = scaling.apply_channel_scaler(lab, fs, channels)
    scaled = windows.chunk_with_halo(scaled, window - 1, 0, chunk_rows)
    frame = windows.series_frame(-(window - 1), 0, ["series_id", "_chunk"])
    scaled = (scaled.withColumn("win_raw", F.collect_list(F.array(*[F.col(f"raw_{c}") for c in channels]))
                                .over(frame))
                    .withColumn("win_sc", F.collect_list(F.array(*channels)).over(frame)))
    st = features.stat_features(scaled, channels, window, horizon)
    st = st.select("series_id", "split", "i", "idx", "y", F.flatten("win_raw").alias("f"),
                   F.concat(F.flatten("win_sc"), features.stats_vector(channels)).alias("f_seq"))
    st = scaling.apply_position_scaler(st, tf, "f", "f_tf")
    return st.select(*keys, *[array_to_vector(FEATURES[c]).alias(c) for c in inputs])


def input_of(model_id: str) -> str:
    """M3: the feature column of ``model_frame`` that a model sees."""
    return "features_seq" if model_id in SEQUENCE_MODELS else "features_tf" if model_id in SCALED_MODELS else "features_raw"


def written(frame: DataFrame) -> DataFrame:
    """The frame written once, as a table in the shared folder: counts, fits and scores read it, each the columns
    that it needs, instead of its lineage."""
    return session.written(frame, "frame")


@dataclass(frozen=True)
class KernelMap:
    """Landmark features of an RBF kernel exp(-gamma ||x-y||^2): z(x) = k(x, landmarks) @ whiten."""

    landmarks: np.ndarray
    whiten: np.ndarray
    gamma: float

    def features(self, x: Column) -> Column:
        marks, whiten, gamma = self.landmarks, self.whiten, self.gamma

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def project(x: pd.Series) -> pd.Series:
            out = []
            for lo in range(0, len(x), 256):
                m = np.stack(x.iloc[lo:lo + 256].to_numpy())
                out += list(_rbf(m, marks, gamma) @ whiten)
            return pd.Series(out, dtype="object")
        return project(x)

    def to_rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(k, m.tolist(), w.tolist(), self.gamma) for k, (m, w) in enumerate(zip(self.landmarks, self.whiten))],
            "pos long, landmark array<double>, whiten array<double>, gamma double")

    @classmethod
    def from_rows(cls, rows: DataFrame) -> KernelMap:
        got = rows.orderBy("pos").collect()
        return cls(np.array([r.landmark for r in got]), np.array([r.whiten for r in got]), got[0].gamma)


def _rbf(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    d2 = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        d2 += diff * diff
    return np.exp(-gamma * d2)


def kernel_map(train: DataFrame, features: str = "features_tf", landmarks: int = LANDMARKS) -> KernelMap:
    """Fits the map: gamma from the variance of all training values, landmarks drawn by hash from the distinct
    training vectors (all of them, where there are no more than ``landmarks``)."""
    x = train.select(vector_to_array(features).alias("x"))
    v = x.select(F.size("x").alias("n"), F.aggregate("x", F.lit(0.0), lambda s, e: s + e).alias("s"),
                 F.aggregate("x", F.lit(0.0), lambda s, e: s + e * e).alias("q"))
    n, values, s, q = v.agg(F.count(F.lit(1)), F.sum("n"), F.sum("s"), F.sum("q")).first()
    var = q / values - (s / values) ** 2
    gamma = 1.0 / (values / n * var) if var > 0 else 1.0
    h = F.xxhash64("x")
    every = max(1, n // (LANDMARK_DRAWS * landmarks))
    drawn = (x.select(h.alias("h"), "x").where(F.pmod("h", F.lit(every)) == 0)
              .groupBy("h").agg(F.first("x").alias("x")).orderBy("h").limit(landmarks).collect()) or x.limit(1).collect()
    marks = np.array([r.x for r in drawn])
    value, vector = np.linalg.eigh(_rbf(marks, marks, gamma))
    keep = value > 1e-10 * value[-1]
    # in line order, as a stored map is read again: products round by the layout
    return KernelMap(marks, np.ascontiguousarray(vector[:, keep] / np.sqrt(value[keep])), gamma)


@dataclass(frozen=True)
class FittedModel:
    """A fitted model with all that scoring needs: tree models have ``trees``, all others a ``pipeline``."""

    model_id: str
    pipeline: PipelineModel | None = None
    kernel: KernelMap | None = None
    trees: trees.TreeModel | None = None


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def estimator(model_id: str, n_train: int, n_features: int):
    """The Spark ML estimator of a model id (features/label column names set)."""
    if model_id == "lr":
        return LogisticRegression(featuresCol="features_tf", maxIter=1000, regParam=1.0 / max(n_train, 1),
                                  elasticNetParam=0.0, standardization=False)
    if model_id == "svm":
        return LinearSVC(featuresCol="features_kernel", maxIter=200, regParam=1.0 / max(n_train, 1),
                         standardization=False)
    if model_id == "mlp":
        return MultilayerPerceptronClassifier(featuresCol="features_seq", layers=[n_features, 64, 32, 2],
                                              maxIter=200, seed=1)
    raise ValueError(f"unknown model id {model_id}")


def fit_trees(train: DataFrame, model_id: str, n_train: int, n_features: int) -> trees.TreeModel:
    """The tree model of a model id, fitted on binned values."""
    size = ("features_raw", n_train, n_features)
    if model_id == "rf":
        return trees.fit_forest(train, *size, trees=100, bootstrap=True, max_depth=30)
    if model_id == "et":
        return trees.fit_forest(train, *size, trees=200, bootstrap=False, max_depth=30)
    if model_id == "gb":
        return trees.fit_boosted(train, *size, rounds=200, depth=3, rate=0.1)
    return trees.fit_boosted(train, *size, rounds=300, depth=6, rate=0.1, rows_share=0.8, share=0.8)


def _prepare(frame: DataFrame, kernel: KernelMap | None) -> DataFrame:
    if kernel is None:
        return frame
    return frame.withColumn("features_kernel", array_to_vector(kernel.features(vector_to_array("features_tf"))))


def fit(frame: DataFrame, model_id: str) -> FittedModel:
    """Fit one model on the training split. Rows are counted once to size
    the regularisation; the feature width comes from the schema of one row.
    Several jobs read ``frame``: hand in a ``written`` one."""
    ensure_checkpoint_dir(frame.sparkSession)  # the tree models write their binned rows and trees
    train = frame.where(F.col("split") == "train")
    n = train.count()
    n_features = len(train.select(vector_to_array(input_of(model_id)).alias("a")).first().a)
    if model_id in RAW_MODELS:
        return FittedModel(model_id, trees=fit_trees(train, model_id, n, n_features))
    kernel = kernel_map(train) if model_id == "svm" else None
    pipeline = Pipeline(stages=[estimator(model_id, n, n_features)]).fit(_prepare(train, kernel))
    return FittedModel(model_id, pipeline, kernel)


def score(model: FittedModel, frame: DataFrame, model_id: str) -> DataFrame:
    """Probability of class 1 per window (sigmoid of the margin for the
    margin-only SVM)."""
    if model.trees is not None:
        out = trees.score(model.trees, frame.select("series_id", "split", "idx", "label", input_of(model_id)),
                          input_of(model_id))
        return out.select("series_id", "split", "idx", F.col("label").cast("int").alias("y"),
                          F.lit(model_id).alias("model_id"), "p")
    out = model.pipeline.transform(_prepare(frame, model.kernel))
    if model_id == "svm":
        p = 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))
    else:
        p = vector_to_array("probability")[1]
    return out.select("series_id", "split", "idx", F.col("label").cast("int").alias("y"),
                      F.lit(model_id).alias("model_id"), p.alias("p"))


def external_score(frame: DataFrame, model_id: str, load: Callable[[], Callable[[np.ndarray], np.ndarray]],
                   features: str, shape: Sequence[int], logits: bool = False, batch_rows: int = 1024) -> DataFrame:
    """M13 for a model of the user's own: ``load`` runs once in each Python worker and returns a function from a
    batch of inputs (rows, *shape) to one number a row, a probability or, with ``logits``, a margin. ``features`` is
    a vector or array column of prod(shape) values; all other columns stay, ``model_id`` and ``p`` are added."""
    x = F.col(features)
    if not isinstance(frame.schema[features].dataType, T.ArrayType):
        x = vector_to_array(x)
    predict = predict_batch_udf(load, return_type=T.DoubleType(), batch_size=batch_rows,
                                input_tensor_shapes=[list(shape)])
    rows = frame.where(F.size(x) == math.prod(shape))
    raw = predict(x)
    p = 1 / (1 + F.exp(-raw)) if logits else raw
    return rows.withColumns({"model_id": F.lit(model_id), "p": p})


def fallback_model(requested: str, available: Sequence[str], fallback: str) -> str:
    """The live model, or the fallback when its artifact is missing."""
    return requested if requested in set(available) else fallback


def compare(frame: DataFrame, fitted: dict, registry: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Score every available model on the same prepared windows (the
    frame is reused, not rebuilt) and summarise per model; a registry model
    without a fitted artifact comes back ``unavailable`` instead of failing."""
    parts = [score(m, frame, mid) for mid, m in fitted.items()]
    scores = parts[0]
    for p in parts[1:]:
        scores = scores.unionByName(p)
    summ = scores.groupBy("model_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("total_windows"),
        F.count_if(F.col("p") >= threshold).cast("bigint").alias("fault_windows"),
        F.max("p").alias("peak_prob"))
    return (F.broadcast(registry).join(summ, "model_id", "left")
             .withColumn("unavailable", F.col("total_windows").isNull()))


def sweep(frame: DataFrame, configs: DataFrame, grid: DataFrame, metric: str = "weighted_f1",
          max_iter: int = 200) -> DataFrame:
    """M12 + T5 inputs: for each configuration row (``config_no``, ``name``,
    ``d_model``, ``ff``), fit the sequence model with hidden layers
    (d_model, ff) on the training split, choose the threshold on validation
    (first strict maximum of ``metric`` over ``grid``, ``p > t``) and score
    test at that threshold. Returns one results row per configuration; pick
    winners with ``metrics.select_best`` (by ``val_score`` or, as the
    reference also records, ``test_score``). Heads and dropout have no
    counterpart in the perceptron and are carried as labels only.

    The configuration table is a small parameter table (54 rows), iterated
    on the driver; every fit and every evaluation is a distributed job.
    """
    from . import metrics
    train = frame.where(F.col("split") == "train")
    n_features = len(train.select(vector_to_array("features_seq").alias("a")).first().a)
    results = []
    for cfg in configs.collect():
        est = MultilayerPerceptronClassifier(featuresCol="features_seq",
                                             layers=[n_features, int(cfg.d_model), int(cfg.ff), 2],
                                             maxIter=max_iter, seed=1)
        model = FittedModel("mlp", Pipeline(stages=[est]).fit(train))
        sc = score(model, frame.where(F.col("split").isin("val", "test")), "mlp")
        val = metrics.threshold_search(sc.where(F.col("split") == "val"), ["model_id"], grid)
        best = metrics.best_threshold(val, ["model_id"], metric)
        t = best.first()
        test = metrics.class_report(sc.where(F.col("split") == "test"), ["model_id"], t.best_t, strict=True)
        test_score = test.where(F.col("label") == "weighted avg").first().f1
        results.append((int(cfg.config_no), cfg.name, float(t.best_t), float(t.best_score), float(test_score)))
    spark = frame.sparkSession
    return spark.createDataFrame(results, "config_no long, name string, best_t double, val_score double, "
                                          "test_score double")
