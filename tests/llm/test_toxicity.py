"""The chain: held-out accuracy, out-of-fold training, odd inputs."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from early_warning.llm import toxicity as tx


def corpus(spark, n=700):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(n):
        low, bad = rng.random() < .4, rng.random() < .3
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 120))]
        words += ["junk"] * low + rng.sample(["vile", "Foul", "rotten"], 2) * bad
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(not low), int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus(spark)
    return docs, labels, tx.fit_chain(docs, labels.where("doc_id % 3 != 0"))


def test_held_out_accuracy(fitted):
    docs, labels, chain = fitted
    done = tx.predict_chain(docs, chain).withColumnRenamed("toxic", "said").join(labels.where("doc_id % 3 = 0"), "doc_id")
    right = done.agg(F.avg((F.col("said") == (F.col("toxic") == 1)).cast("double")).alias("t"),
                     F.avg(((F.col("p_quality") > .5) == (F.col("quality") == 1)).cast("double")).alias("q")).first()
    assert right.t > 0.95 and right.q > 0.9


def test_later_models_see_earlier_probabilities(fitted):
    chain = fitted[2]
    assert [m.earlier for m in chain.models] == [[], ["p_quality"]]
    assert chain.models[1].model.numFeatures == tx.FEATURES + 1


def test_edges(fitted, edges, wide, nothing):
    chain = fitted[2]
    done = tx.predict_chain(edges, chain)
    assert done.count() == edges.count() and done.where("p_toxic is null or p_toxic < 0 or p_toxic > 1").count() == 0
    assert done.columns == ["doc_id", "p_quality", "p_toxic", "toxic"]
    assert sorted(done.collect(), key=repr) == sorted(tx.predict_chain(wide, chain).collect(), key=repr)
    assert tx.predict_chain(nothing, chain).count() == 0


def test_one_class_and_no_labels(spark):
    docs, labels = corpus(spark, 30)
    flat = tx.toxicity(docs, labels.withColumn("toxic", F.lit(0)).withColumn("quality", F.lit(1)))
    assert {(r.p_quality, r.p_toxic, r.toxic) for r in flat.collect()} == {(1.0, 0.0, False)}
    none = tx.toxicity(docs, labels.withColumn("toxic", F.lit(None).cast("int")))
    assert {(r.p_toxic, r.toxic) for r in none.collect()} == {(0.0, False)}


def test_sample_is_bounded_and_labels_are_merged(spark):
    docs, labels = corpus(spark, 60)
    both = labels.unionAll(labels.where("doc_id < 9").withColumn("toxic", F.lit(1)))
    sample = tx.labelled_sample(docs, both, "doc_id", "text", tx.CATEGORIES, 40)
    assert sample.count() == 40
    assert tx.labelled_sample(docs, both, "doc_id", "text", tx.CATEGORIES, 400).count() == 60


def test_fit_ends_at_the_optimum(spark, fitted):
    docs, labels, chain = fitted
    sample = tx.labelled_sample(docs, labels.where("doc_id % 3 != 0"), "doc_id", "text", tx.CATEGORIES, tx.SAMPLE_ROWS)
    rows = chain.models[0].predict(chain.weights.transform(sample), "p").select("x", "quality", "p").collect()
    w, slope, off = chain.models[0].model.coefficients.toArray(), np.zeros(tx.FEATURES), 0.0
    for r in rows:
        slope[r.x.indices] += r.x.values * (r.p - r.quality) / len(rows)
        off += (r.p - r.quality) / len(rows)
    gap = np.where(w != 0, np.abs(slope + tx.PENALTY * np.sign(w)), np.maximum(np.abs(slope) - tx.PENALTY, 0))
    assert abs(off) < 2e-5 and gap.max() < 2e-5 and (w != 0).sum() > 0


def test_sample_has_one_row_per_id(spark):
    docs, labels = corpus(spark, 60)
    hot = docs.where("doc_id = 3").crossJoin(spark.range(500).select("id")).select(
        "doc_id", F.when(F.col("id") % 2 == 0, F.col("text")).otherwise(F.concat("text", F.lit(" w"), "id")).alias("text"))
    null = spark.createDataFrame([(4, None)], docs.schema)
    sample = tx.labelled_sample(docs.unionAll(hot).unionAll(null), labels, "doc_id", "text", tx.CATEGORIES, 400)
    assert sample.count() == 60
    one = tx.labelled_sample(docs, labels, "doc_id", "text", tx.CATEGORIES, 400)
    assert sorted(map(str, one.collect())) == sorted(map(str, tx.labelled_sample(
        docs.unionAll(docs), labels, "doc_id", "text", tx.CATEGORIES, 400).collect()))
