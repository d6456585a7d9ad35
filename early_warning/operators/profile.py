"""Dataset profile: split plan, split and file summaries, label distribution,
missing values (S4, A1-A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def assign_split(readings: DataFrame, plan: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Attach the split of each file from the plan (broadcast: one row per
    planned file), and list planned files that have no readings (an error in
    the reference)."""
    keys = list(keys)
    assigned = readings.join(F.broadcast(plan), keys)
    missing = plan.join(readings.select(*keys).distinct(), keys, "left_anti")
    return assigned, missing


def split_summary(windows: DataFrame, file: str = "series_id", label: str = "y") -> DataFrame:
    """A1: samples, positives, negatives, positive ratio and share of all
    samples, per (split, file), per split and in total, from one ROLLUP."""
    r = windows.rollup("split", file).agg(
        F.count(F.lit(1)).cast("bigint").alias("samples"),
        F.count_if(F.col(label) == 1).cast("bigint").alias("positives"),
        F.grouping_id().alias("_g"))
    total = Window.partitionBy("_g")
    return r.select(
        F.when(F.col("_g") == 0, "file").when(F.col("_g") == 1, "split").otherwise("total").alias("level"),
        "split", file, "samples", "positives",
        (F.col("samples") - F.col("positives")).alias("negatives"),
        (F.col("positives") / F.col("samples")).alias("positive_ratio"),
        (F.col("samples") / F.sum("samples").over(total)).alias("share"))


def file_summary(readings: DataFrame, file: str = "series_id", label: str = "anomaly") -> DataFrame:
    """A2: rows, anomaly rows, normal rows and anomaly ratio per file."""
    return readings.groupBy(file).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_if(F.col(label) == 1).cast("bigint").alias("anomaly_count"),
        F.count_if(F.col(label) == 0).cast("bigint").alias("normal_count"),
    ).withColumn("anomaly_ratio", F.col("anomaly_count") / F.col("rows"))


def label_distribution(readings: DataFrame, label: str = "anomaly") -> DataFrame:
    """A3: rows per label value and their share of all rows."""
    c = readings.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
    return c.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))


def missing_counts(frames: Sequence[DataFrame]) -> DataFrame:
    """A4: missing cells per column over the concatenation of files whose
    columns differ; a column a file lacks counts as missing for its rows."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    cols = u.columns
    wide = u.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("col_pos"), F.lit(c).alias("col_name"), F.col(c).alias("missing"))
        for k, c in enumerate(cols)])).alias("m")).select("m.*")
