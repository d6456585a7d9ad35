"""Overlap audit between files.

Instead of comparing every pair of files on the driver, the audit is a few
joins: per-file facts (one aggregate), candidate pairs from shared time
buckets (an equi-join, then the exact range test), common timestamps from an
equi-join on the timestamp itself, and row alignment as a full outer join on
(pair, timestamp, occurrence). A pair of files is reported once (``a < b``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EXCLUDED_COLUMNS

FILE = "file_k"
SAMPLE_TIMES = 5


def file_info(rows: DataFrame, file: str = FILE, label: str = "anomaly") -> DataFrame:
    """A5: time range, row count and anomaly count per file."""
    return rows.groupBy(file).agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"),
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_if(F.col(label) == 1).cast("bigint").alias("anomaly_count"))


def overlap_pairs(info: DataFrame, file: str = FILE, bucket_seconds: int = 86400) -> DataFrame:
    """Unordered file pairs whose [start, end] ranges intersect.

    Each file is expanded to the time buckets its range touches; pairs meet on
    a shared bucket (equi-join), then the exact test runs on the candidates.
    """
    b = F.floor(F.unix_seconds(F.col("start_ts").cast("timestamp")) / bucket_seconds)
    e = F.floor(F.unix_seconds(F.col("end_ts").cast("timestamp")) / bucket_seconds)
    ex = info.select(file, "start_ts", "end_ts", F.explode(F.sequence(b, e)).alias("bucket"))
    a = ex.select(*[F.col(c).alias(f"{c}_a") for c in (file, "start_ts", "end_ts")], "bucket")
    o = ex.select(*[F.col(c).alias(f"{c}_b") for c in (file, "start_ts", "end_ts")], "bucket")
    j = a.join(o, "bucket").where(
        (F.col(f"{file}_a") < F.col(f"{file}_b"))
        & ~((F.col("end_ts_a") < F.col("start_ts_b")) | (F.col("end_ts_b") < F.col("start_ts_a"))))
    return j.select(F.col(f"{file}_a").alias("file_a"), F.col(f"{file}_b").alias("file_b")).distinct()


def common_timestamps(rows: DataFrame, file: str = FILE) -> DataFrame:
    """(file_a, file_b, ts) for every timestamp both files hold.

    Timestamps are distinct per file first (sets), then self-joined on ts.
    Pairs whose time ranges are disjoint share no timestamp, so the range test
    is implied.
    """
    d = rows.select(file, "ts").distinct()
    a = d.select(F.col(file).alias("file_a"), "ts")
    b = d.select(F.col(file).alias("file_b"), "ts")
    return a.join(b, "ts").where(F.col("file_a") < F.col("file_b")).select("file_a", "file_b", "ts")


def overlap_counts(common: DataFrame, k: int = SAMPLE_TIMES) -> DataFrame:
    """J2 + T4: number of common timestamps per pair, and the first ``k`` of
    them, one row (``k`` = 1, 2, ...) per sample time."""
    w = Window.partitionBy("file_a", "file_b").orderBy("ts")
    first = (common.withColumn("k", F.row_number().over(w).cast("bigint")).where(F.col("k") <= k)
                   .withColumnRenamed("ts", "sample_time"))
    n = common.groupBy("file_a", "file_b").agg(F.count(F.lit(1)).cast("bigint").alias("overlap_count"))
    return n.join(first, ["file_a", "file_b"])


def overlap_verdict(rows: DataFrame, common: DataFrame, sensors: Sequence[str],
                    file: str = FILE, label: str = "anomaly",
                    changepoint: str = "changepoint") -> DataFrame:
    """Restrict both files of a pair to their common timestamps
    (semi-join), align rows by (timestamp, occurrence) and compare with
    null-safe equality. A row without a partner makes every comparison false.
    A label that one of the files does not have at all (all NULL) is not
    compared: it counts as equal.
    """
    cols = [*sensors, label, changepoint]
    # Rows repeating a timestamp inside one file are paired in value order,
    # which is deterministic under recomputation.
    occ = Window.partitionBy(file, "ts").orderBy(*cols)
    r = rows.withColumn("_occ", F.row_number().over(occ))
    side_a = common.join(r.withColumnRenamed(file, "file_a"), ["file_a", "ts"], "inner") \
                   .select("file_a", "file_b", "ts", "_occ", *[F.col(c).alias(f"a_{c}") for c in cols])
    side_b = common.join(r.withColumnRenamed(file, "file_b"), ["file_b", "ts"], "inner") \
                   .select("file_a", "file_b", "ts", "_occ", *[F.col(c).alias(f"b_{c}") for c in cols],
                           F.lit(True).alias("_in_b"))
    side_a = side_a.withColumn("_in_a", F.lit(True))
    j = side_a.join(side_b, ["file_a", "file_b", "ts", "_occ"], "full_outer")
    both = F.coalesce(F.col("_in_a"), F.lit(False)) & F.coalesce(F.col("_in_b"), F.lit(False))

    def same(cs):
        cond = both
        for c in cs:
            cond = cond & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
        return cond
    agg = j.groupBy("file_a", "file_b").agg(
        F.bool_and(same(sensors)).alias("sensor_equal"),
        F.bool_and(same([label])).alias("_label"),
        F.bool_and(same([changepoint])).alias("_change"))
    has = rows.groupBy(file).agg(F.bool_or(F.col(label).isNotNull()).alias("_l"),
                                 F.bool_or(F.col(changepoint).isNotNull()).alias("_c"))
    for side in ("a", "b"):
        agg = agg.join(has.select(F.col(file).alias(f"file_{side}"), F.col("_l").alias(f"_l{side}"),
                                  F.col("_c").alias(f"_c{side}")), f"file_{side}")
    agg = agg.select("file_a", "file_b", "sensor_equal",
                     (F.col("_label") | ~F.col("_la") | ~F.col("_lb")).alias("label_equal"),
                     (F.col("_change") | ~F.col("_ca") | ~F.col("_cb")).alias("changepoint_equal")) \
             .withColumn("full_equal", F.col("sensor_equal") & F.col("label_equal") & F.col("changepoint_equal"))
    return agg.withColumn("verdict", verdict(F.col("sensor_equal"), F.col("label_equal"),
                                             F.col("full_equal")))


def verdict(sensor_equal, label_equal, full_equal):
    """The first matching conclusion, in this order."""
    return (F.when(sensor_equal & ~label_equal, "label_conflict")
             .when(full_equal, "full_duplicate")
             .when(sensor_equal & label_equal, "slicing_overlap")
             .otherwise("differ"))


def audit_summary(verdicts: DataFrame) -> DataFrame:
    """Totals and the overall conclusion (keyed on label conflicts only)."""
    s = verdicts.agg(
        F.count(F.lit(1)).cast("bigint").alias("overlap_cases"),
        F.count_if("full_equal").cast("bigint").alias("full_duplicates"),
        F.count_if(F.col("sensor_equal") & ~F.col("label_equal")).cast("bigint").alias("label_conflicts"),
        F.count_if(F.col("sensor_equal") & F.col("label_equal") & ~F.col("full_equal"))
        .cast("bigint").alias("consistent_slicing"))
    return s.withColumn("conclusion", F.when(F.col("overlap_cases") == 0, "independent")
                        .when(F.col("label_conflicts") > 0, "label_conflicts")
                        .otherwise("clean"))


def sensor_columns(columns: Sequence[str]) -> list[str]:
    """Every column but the time, label and changepoint columns."""
    return [c for c in columns if c not in EXCLUDED_COLUMNS and c != "ts" and c != FILE]
