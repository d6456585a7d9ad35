"""Toxicity: a classifier chain of linear models.

The categories are predicted one after another. Each is a logistic regression over hashed words, weighted by their
rarity among the fitted rows, and the probabilities of the categories before it, with an absolute penalty that leaves
few words a weight. What a later model is trained on are out-of-fold probabilities: each
labelled row's comes from models that have not seen its fold, as at prediction time no model has seen the row. The
models that predict are fitted on all folds.

The models are fitted on at most ``SAMPLE_ROWS`` labelled rows, those with the least hash of their id, in one task that
goes on until the conditions of the optimum hold; prediction runs over all documents on Spark's own machine learning
functions.

Edge cases: null and empty texts have no words and get the models' intercepts; unlabelled rows and null labels
are left out of the fit; several labels of one id count as the highest, and of several texts of one id
the one with the least hash is fitted; a category with one class, or none, among the fitted rows gets that share as its
probability; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, IDFModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import safe_names, stored

#: The labelled categories in the order of the chain; the last is the verdict.
CATEGORIES = ("quality", "toxic")
#: At most so many labelled rows are fitted.
SAMPLE_ROWS = 16384
FOLDS = 3
FEATURES = 1 << 16
#: Hashed words in fewer fitted rows have no weight.
LEAST_ROWS = 4
WORD_GAP = r"[^\p{L}\p{N}]+"
THRESHOLD = 0.2
#: Weight of the absolute penalty, and how far a gradient may be from the optimum's, as a share of it.
PENALTY = 1e-3
GAP = 0.01
#: A fit that needs more steps over one set of words fails.
MOST_STEPS = 50_000
#: At least so many columns are taken in at a time.
LEAST_TAKEN = 200


def word_vectors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the presence of hashed words as a sparse vector."""
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD_GAP), "")
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="words__", outputCol=out).transform(
        df.withColumn("words__", words)).drop("words__")


@dataclass
class Chain:
    """Word weights and one model per category, in the order of the chain."""

    weights: IDFModel | None
    categories: Sequence[str]
    models: Sequence[Linear]


class Entries:
    """The entries of a sparse matrix with a row per fitted row and a column per word or earlier probability."""

    def __init__(self, at, col, val, shape: tuple[int, int]):
        self.at, self.col, self.val, (self.rows, self.columns) = at, col, val, shape

    def times(self, w):
        return np.bincount(self.at, self.val * w[self.col], self.rows)

    def back(self, r):
        return np.bincount(self.col, self.val * r[self.at], self.columns)

    def some_rows(self, mask) -> Entries:
        place, keep = np.cumsum(mask) - 1, mask[self.at]
        return Entries(place[self.at[keep]], self.col[keep], self.val[keep], (int(mask.sum()), self.columns))

    def some_columns(self, names) -> Entries:
        place = np.full(self.columns, -1)
        place[names] = np.arange(len(names))
        keep = place[self.col] >= 0
        return Entries(self.at[keep], place[self.col[keep]], self.val[keep], (self.rows, len(names)))

    def scaled(self, s) -> Entries:
        return Entries(self.at, self.col, self.val * s[self.col], (self.rows, self.columns))

    def with_column(self, values) -> Entries:
        return Entries(np.concatenate([self.at, np.arange(self.rows)]),
                       np.concatenate([self.col, np.full(self.rows, self.columns)]),
                       np.concatenate([self.val, values]), (self.rows, self.columns + 1))


def chances(z):
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def descend(x: Entries, y, w, b: float):
    """Accelerated proximal steps over few columns, brought to one size, until the gradients are within the gap or
    ``MOST_STEPS`` are done: a fit that is slow to converge gives the weights it has reached."""
    size = np.sqrt(np.maximum(np.bincount(x.col, x.val * x.val, x.columns) / x.rows, 1e-12))
    unit, cut = x.scaled(1.0 / size), PENALTY / size
    # the greatest curvature by power steps, with the intercept as one more column
    v, v0, steep = np.ones(x.columns), 1.0, 1.0
    for _ in range(30):
        z = (unit.times(v) + v0) / x.rows
        v, v0 = unit.back(z), z.sum()
        steep = float(np.sqrt(v @ v + v0 * v0))
        v, v0 = v / steep, v0 / steep
    step = 1.0 / (0.25 * 1.2 * steep)
    u, u_at, b_at, t = w * size, w * size, b, 1.0
    for i in range(MOST_STEPS):
        r = (chances(unit.times(u_at) + b_at) - y) / x.rows
        g, g0 = unit.back(r), r.sum()
        if i % 10 == 0 and max(abs(g0), np.max(np.where(u_at != 0, np.abs(g + cut * np.sign(u_at)), np.abs(g) - cut)
                                               * size, initial=0.0)) <= GAP * PENALTY / 2:
            return u_at / size, b_at
        moved = u_at - step * g
        new, new_b = np.sign(moved) * np.maximum(np.abs(moved) - step * cut, 0.0), b_at - step * g0
        if (u_at - new) @ (new - u) + (b_at - new_b) * (new_b - b) > 0:
            t = 1.0
        then = 0.5 * (1.0 + np.sqrt(1.0 + 4.0 * t * t))
        ahead = (t - 1.0) / then
        u_at, b_at = new + ahead * (new - u), new_b + ahead * (new_b - b)
        u, b, t = new, new_b, then
    return u / size, b  # not within the gap: the weights that the steps have reached


def least_loss(x: Entries, y):
    """(weights, intercept) of the least mean log loss plus the penalty.

    Few columns have a weight. Those that have one are fitted together with the columns whose gradient passes the
    penalty most, until no column without a weight has such a gradient.
    """
    share = y.mean()
    w, b = np.zeros(x.columns), float(np.log(share / (1.0 - share)))
    while True:
        slope = np.abs(x.back((chances(x.times(w) + b) - y) / x.rows))
        held = np.flatnonzero(w)
        over = np.flatnonzero((w == 0) & (slope > PENALTY * (1.0 + GAP)))
        if not len(over):
            return w, b
        over = over[np.argsort(-slope[over], kind="stable")[:max(LEAST_TAKEN, len(held))]]
        names = np.sort(np.concatenate([held, over]))
        w[names], b = descend(x.some_columns(names), y, w[names], b)


def fit_all(x: Entries, ys: Sequence, fold) -> list[tuple]:
    """(share, intercept, columns, weights) of every category, the later ones over out-of-fold probabilities too."""
    def one(x, y):
        share = float(y.mean()) if len(y) else 0.0
        return (share, *least_loss(x, y)) if 0.0 < share < 1.0 else (share, None, None)

    out = []
    for i, y in enumerate(ys):
        share, w, b = one(x, y)
        names = np.flatnonzero(w) if w is not None else np.zeros(0, int)
        out.append((share, b, names.tolist(), w[names].tolist() if w is not None else []))
        if i + 1 < len(ys):
            p = np.zeros(len(y))
            for f in range(FOLDS):
                part, w, b = one(x.some_rows(fold != f), y[fold != f])
                p[fold == f] = part if w is None else chances(x.some_rows(fold == f).times(w) + b)
            x = x.with_column(p)
    return out


def _fit(categories: Sequence[str]):
    def run(batches):
        at, col, val, n, ys, fold = [], [], [], 0, [[] for _ in categories], []
        for batch in batches:
            words = batch.column("x")
            cols, vals = words.field("indices"), words.field("values")
            row = np.repeat(np.arange(n, n + batch.num_rows), cols.value_lengths().to_numpy(zero_copy_only=False))
            v = vals.flatten().to_numpy()
            at.append(row[v != 0]), col.append(cols.flatten().to_numpy()[v != 0]), val.append(v[v != 0])
            fold.append(batch.column("fold").to_numpy(zero_copy_only=False))
            for y, c in zip(ys, categories):
                y.append(batch.column(c).to_numpy(zero_copy_only=False))
            n += batch.num_rows
        if n:
            x = Entries(*map(np.concatenate, (at, col, val)), (n, FEATURES))
            made = fit_all(x, [np.concatenate(y) for y in ys], np.concatenate(fold))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(([*range(len(made))], *zip(*made)), (
                    pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.float64())))],
                names=["i", "share", "b", "names", "w"])

    return run


class Linear:
    """One category's model over the word vector ``x`` and the earlier probabilities."""

    def __init__(self, share: float, intercept: float | None, names: Sequence[int], weights: Sequence[float],
                 earlier: Sequence[str]):
        self.earlier, self.share, self.model = list(earlier), share, None
        if intercept is not None:
            # the constructor takes a vector and a double, and has no form in Python
            made = JavaWrapper._new_java_obj("org.apache.spark.ml.classification.LogisticRegressionModel", "linear",
                                             Vectors.sparse(FEATURES + len(earlier), names, weights), float(intercept))
            self.model = (LogisticRegressionModel(made).setFeaturesCol("all__").setRawPredictionCol("raw__")
                          .setProbabilityCol("p__").setPredictionCol("y__"))

    def _assembled(self, rows: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=["x", *self.earlier], outputCol="all__").transform(rows)

    def predict(self, rows: DataFrame, out: str) -> DataFrame:
        """Add the probability of the category."""
        if self.model is None:
            return rows.withColumn(out, F.lit(float(self.share)))
        done = self.model.transform(self._assembled(rows))
        return done.withColumn(out, vector_to_array("p__")[1]).drop("all__", "raw__", "p__", "y__")


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, categories: Sequence[str],
                    rows: int) -> DataFrame:
    """(words, fold, categories) of at most ``rows`` labelled ids."""
    usable = (labels.select(F.col(id_col).alias("id__"), *(F.col(c).cast("double").alias(c) for c in categories))
              .dropna().groupBy("id__").agg(*(F.max(c).alias(c) for c in categories))
              .orderBy(F.xxhash64("id__"), "id__").limit(rows))
    texts = docs.select(F.col(id_col).alias("id__"), F.col(text_col).alias("t__"))
    # bounded: at most ``rows`` ids and their labels
    # one text per id, so that the rows are bounded too
    one = (texts.join(F.broadcast(usable.select("id__")), "id__").groupBy("id__")
           .agg(F.min_by("t__", F.xxhash64("t__")).alias("t__")))
    picked = one.join(F.broadcast(usable), "id__").withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "id__"), F.lit(FOLDS)))
    return stored(word_vectors(picked, "t__", "words").select("words", "fold", *categories), "labelled")


def fit_chain(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              categories: Sequence[str] = CATEGORIES, sample_rows: int = SAMPLE_ROWS) -> Chain:
    """The fitted chain."""
    sample = labelled_sample(docs, labels, id_col, text_col, categories, sample_rows)
    weights = None if sample.isEmpty() else IDF(inputCol="words", outputCol="x", minDocFreq=LEAST_ROWS).fit(sample)
    if weights is None:
        return Chain(None, tuple(categories), [Linear(0.0, None, (), (), ()) for _ in categories])
    # one partition: the sample is bounded
    fits = (weights.transform(sample).select("x", "fold", *categories).coalesce(1)
            .mapInArrow(_fit(tuple(categories)), "i int, share double, b double, names array<int>, w array<double>")
            .collect())
    models = [Linear(r.share, r.b, r.names, r.w, [f"p_{c}" for c in categories[:r.i]]) for r in sorted(fits)]
    return Chain(weights, tuple(categories), models)


def predict_chain(docs: DataFrame, chain: Chain, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
                  threshold: float = THRESHOLD) -> DataFrame:
    """``keep``, p_<category> of every category, and the last category as a verdict."""
    plain, names = safe_names(docs)
    rows = word_vectors(plain, names[text_col], "words")
    if chain.weights:
        rows = chain.weights.transform(rows)
    for category, model in zip(chain.categories, chain.models):
        rows = model.predict(rows, f"p_{category}")
    verdict = chain.categories[-1]
    return rows.select(*(F.col(names[c]).alias(c) for c in keep), *(f"p_{c}" for c in chain.categories),
                       (F.col(f"p_{verdict}") >= threshold).alias(verdict))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return predict_chain(docs, fit_chain(docs, labels))
