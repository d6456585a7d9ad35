"""Upload validation (V1-V10, V14), one pass per check over all files.

Uploads arrive as text: every cell is a string until validated, because a
failed cast must become a finding, not a failed query (ANSI mode). Checks run
for all files at once, keyed by ``file``; the first failing check of a file
is ``coalesce`` of the checks in their fixed order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (GAP_SECONDS, HORIZON, INTERVAL_STD_WARN, MEDIAN_INTERVAL_TOLERANCE, NA_TOKENS,
                      TIME_NAME_HINTS, WINDOW)

# FIXED VALUE: so many offending channels of a file are quoted as examples; all are reported.
EXAMPLE_CHANNELS = 3


def normalise_name(c: Column) -> Column:
    """F8: lower case, without underscores and spaces."""
    return F.lower(F.regexp_replace(F.trim(c), "[_ ]", ""))


def time_column_hints(headers: DataFrame, time_column: str, file: str = "file") -> DataFrame:
    """V1: files without the time column, with a rename suggestion when a
    column is called timestamp/time/date/datetime (any case): the first such
    column in file order."""
    has = headers.groupBy(file).agg(F.bool_or(F.col("col_name") == time_column).alias("has_time"))
    hint = (headers.where(F.lower("col_name").isin(TIME_NAME_HINTS))
                   .groupBy(file).agg(F.min_by("col_name", "col_pos").alias("suggestion")))
    return (has.where(~F.col("has_time")).join(hint, file, "left")
               .select(file, F.lit(time_column).alias("missing_column"), "suggestion"))


def rename_hints(headers: DataFrame, wanted: Sequence[str], file: str = "file") -> DataFrame:
    """V2: wanted channels a file lacks, each with the file's column whose
    normalised name equals the wanted one (if any; the last in file order)."""
    spark = headers.sparkSession
    want = spark.createDataFrame([(k, c) for k, c in enumerate(wanted)], "ch_pos int, wanted string")
    files = headers.select(file).distinct()
    need = files.crossJoin(F.broadcast(want))
    missing = need.join(headers.select(file, F.col("col_name").alias("wanted")), [file, "wanted"], "left_anti")
    cand = headers.select(file, "col_pos", F.col("col_name").alias("suggestion"),
                          normalise_name(F.col("col_name")).alias("_norm"))
    j = missing.withColumn("_norm", normalise_name(F.col("wanted"))).join(cand, [file, "_norm"], "left")
    return (j.groupBy(file, "ch_pos", "wanted").agg(F.max_by("suggestion", "col_pos").alias("suggestion"))
             .select(file, F.col("ch_pos").cast("bigint").alias("ch_pos"),
                     F.col("wanted").alias("missing_column"), "suggestion"))


def _long_cells(raw: DataFrame, channels: Sequence[str], file: str, order: str) -> DataFrame:
    cells = F.explode(F.array(*[
        F.struct(F.lit(k).alias("ch_pos"), F.lit(c).alias("channel"), F.col(c).alias("cell"))
        for k, c in enumerate(channels)]))
    return raw.select(file, order, cells.alias("x")).select(file, order, "x.*")


def is_blank(cell: Column) -> Column:
    """A cell read as missing: NULL, or one of the missing-value tokens
    (after trimming), or a number that is NaN."""
    v = F.trim(cell)
    return cell.isNull() | v.isin(NA_TOKENS) | F.isnan(v.try_cast("double"))


def is_non_numeric(cell: Column) -> Column:
    return ~is_blank(cell) & F.trim(cell).try_cast("double").isNull()


def nonnumeric_cells(raw: DataFrame, channels: Sequence[str], file: str = "file",
                     order: str = "row") -> DataFrame:
    """V3: per file, every channel holding a non-numeric cell, with the first
    offending value; ``is_example`` marks the first three in channel order."""
    long = _long_cells(raw, channels, file, order).where(is_non_numeric(F.col("cell")))
    per = long.groupBy(file, "ch_pos", "channel").agg(
        F.min_by("cell", F.col(order)).alias("first_value"),
        F.min(order).alias("first_row"),
        F.count(F.lit(1)).cast("bigint").alias("n_bad"))
    rk = F.row_number().over(Window.partitionBy(file).orderBy("ch_pos"))
    return per.withColumn("is_example", rk <= EXAMPLE_CHANNELS)


def blank_counts(raw: DataFrame, channels: Sequence[str], file: str = "file") -> DataFrame:
    """V4: blank cells per file and channel (any blank rejects the file)."""
    wide = raw.groupBy(file).agg(*[F.count_if(is_blank(F.col(c))).cast("bigint").alias(c)
                                   for c in channels])
    return wide.select(file, F.explode(F.array(*[
        F.struct(F.lit(k).alias("ch_pos"), F.lit(c).alias("channel"), F.col(c).alias("n_blank"))
        for k, c in enumerate(channels)])).alias("x")).select(file, "x.*")


def parse_time(cell: Column) -> Column:
    """text to a zone-free timestamp; unparseable text (or epoch
    numbers) -> NULL. Independent of the session time zone."""
    return F.trim(cell).try_cast("timestamp_ntz")


def header_facts(headers: DataFrame, label: str = "anomaly", file: str = "file") -> DataFrame:
    """Column count and label presence of each file's header."""
    return headers.groupBy(file).agg(F.count(F.lit(1)).cast("bigint").alias("columns"),
                                     F.bool_or(F.col("col_name") == label).alias("has_label"))


def file_facts(raw: DataFrame, time_text: str, headers: DataFrame, file: str = "file",
               window: int = WINDOW, horizon: int = HORIZON) -> DataFrame:
    """V5-V7: rows, columns, label presence, time range, unparseable
    timestamps (an empty cell is a missing time, not an unparseable one), and whether the file is too short for one window."""
    t = parse_time(F.col(time_text))
    f = raw.groupBy(file).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_if(t.isNull() & ~is_blank(F.col(time_text))).cast("bigint").alias("bad_timestamps"),
        F.min(t).alias("start_ts"), F.max(t).alias("end_ts"))
    f = f.join(header_facts(headers, file=file), file, "left")
    return f.select(file, "rows", "columns", "has_label", "start_ts", "end_ts", "bad_timestamps",
                    (F.col("rows") < window + horizon).alias("too_short"))


def sampling_profile(df: DataFrame, ts: str = "ts", file: str = "file", order: str = "row") -> DataFrame:
    """V8: on the time-sorted series: median and sample std of the intervals
    (seconds), gaps above 2 s, and non-positive intervals (duplicates)."""
    w = Window.partitionBy(file).orderBy(ts, order)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    d = df.select(file, ((us - F.lag(us).over(w)) / F.lit(1e6)).alias("dt")).where(F.col("dt").isNotNull())
    return d.groupBy(file).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_intervals"),
        F.median("dt").alias("median_interval"),
        F.coalesce(F.stddev_samp("dt"), F.lit(0.0)).alias("std_interval"),
        F.count_if(F.col("dt") > GAP_SECONDS).cast("bigint").alias("gaps"),
        F.count_if(F.col("dt") <= 0).cast("bigint").alias("duplicates"))


def sampling_warnings(profile: DataFrame, facts: DataFrame | None = None, file: str = "file") -> DataFrame:
    """One row per warning code (with its numbers)."""
    m, s = F.col("median_interval"), F.col("std_interval")
    p = profile if facts is None else profile.join(facts.select(file, "has_label"), file, "left")
    codes = [
        F.when(F.abs(m - 1.0) > MEDIAN_INTERVAL_TOLERANCE, F.lit("sampling_rate")),
        F.when((s > INTERVAL_STD_WARN) & (m > 0), F.lit("uneven_intervals")),
        F.when(F.col("gaps") > 0, F.lit("gaps")),
        F.when(F.col("duplicates") > 0, F.lit("duplicate_timestamps")),
    ]
    if facts is not None:
        codes.append(F.when(~F.coalesce(F.col("has_label"), F.lit(False)), F.lit("no_label")))
    arr = F.filter(F.array(*codes), lambda x: x.isNotNull())
    return p.select(file, F.explode(arr).alias("warning"),
                    F.when(m > 0, 1 / m).alias("rate_hz"), "median_interval", "std_interval",
                    "gaps", "duplicates")


def unknown_models(requests: DataFrame, registry: DataFrame, key: str = "model_id") -> DataFrame:
    """Requested model ids absent from the registry (broadcast)."""
    return requests.join(F.broadcast(registry.select(key)), key, "left_anti")


def threshold_in_range(t: Column, live: bool = False) -> Column:
    """[0, 1] for batch requests, (0, 1) for the live configuration."""
    return ((t > 0) & (t < 1)) if live else ((t >= 0) & (t <= 1))


# FIXED VALUES: validation failure codes, in the order they are checked.
CHECK_ORDER = ["missing_time_column", "missing_sensor_columns", "non_numeric_values",
               "blank_values", "unparseable_timestamps", "too_few_rows"]


def upload_report(headers: DataFrame, raw: DataFrame, channels: Sequence[str], time_column: str,
                  time_text: str, file: str = "file", order: str = "row") -> DataFrame:
    """validate_schema for every file at once: the first failing check in
    the fixed order (V1 time column, V2 sensor columns, V3 non-numeric cells,
    V4 blanks, V5 timestamps, V6 length), or NULL when the file is accepted.
    Each check is one aggregate keyed by file; the verdict is a coalesce."""
    files = headers.select(file).distinct()
    v1 = time_column_hints(headers, time_column, file).select(file, F.lit(True).alias("v1"))
    v2 = rename_hints(headers, channels, file).select(file).distinct().withColumn("v2", F.lit(True))
    v3 = nonnumeric_cells(raw, channels, file, order).select(file).distinct().withColumn("v3", F.lit(True))
    v4 = (blank_counts(raw, channels, file).where(F.col("n_blank") > 0).select(file).distinct()
          .withColumn("v4", F.lit(True)))
    facts = file_facts(raw, time_text, headers, file).select(
        file, (F.col("bad_timestamps") > 0).alias("v5"), F.col("too_short").alias("v6"))
    j = files
    for v in (v1, v2, v3, v4, facts):
        j = j.join(v, file, "left")
    first = F.coalesce(*[F.when(F.coalesce(F.col(f"v{k + 1}"), F.lit(False)), F.lit(code))
                         for k, code in enumerate(CHECK_ORDER)])
    return j.select(file, first.alias("first_error"), first.isNull().alias("accepted"))
