"""Validation and audit rules on small uploads."""

import pytest
from pyspark.sql import functions as F

from early_warning.operators import audit, live, validate


def headers(spark, names):
    return spark.createDataFrame([(1, k, n) for k, n in enumerate(names)], "file long, col_pos long, col_name string")


def test_time_hint_is_the_first_in_file_order(spark):
    assert validate.time_column_hints(headers(spark, ["time", "Date", "ch1"]), "datetime").first().suggestion == "time"


def test_rename_hint_is_the_last_in_file_order(spark):
    got = validate.rename_hints(headers(spark, ["datetime", "CH_1", "Ch1"]), ["ch1"]).first()
    assert (got.missing_column, got.suggestion) == ("ch1", "Ch1")


def test_every_non_numeric_channel_is_reported(spark):
    names = [f"ch{k}" for k in range(1, 6)]
    raw = spark.createDataFrame([(1, 0, *["x"] * 5)], ["file", "row", *names])
    got = validate.nonnumeric_cells(raw, names).orderBy("ch_pos").collect()
    assert [r.channel for r in got] == names
    assert [r.is_example for r in got] == [True, True, True, False, False]


def test_an_empty_time_cell_is_not_unparseable(spark):
    raw = spark.createDataFrame([(1, 0, ""), (1, 1, None), (1, 2, "2024-01-01 00:00:00"), (1, 3, "noon")],
                                "file long, row long, t string")
    assert validate.file_facts(raw, "t", headers(spark, ["t"])).first().bad_timestamps == 1


@pytest.mark.parametrize("labels,verdict", [((0, 0), "full_duplicate"), ((0, 1), "label_conflict"),
                                            ((0, None), "full_duplicate")])
def test_a_file_without_labels_is_not_in_conflict(spark, labels, verdict):
    rows = [(f, f"2024-01-01 00:00:0{k}", float(k), labels[f], 0) for f in (0, 1) for k in range(3)]
    df = spark.createDataFrame(rows, "file_k long, t string, ch1 double, anomaly int, changepoint int") \
              .select("*", F.col("t").cast("timestamp").alias("ts")).drop("t")
    got = audit.overlap_verdict(df, audit.common_timestamps(df), ["ch1"]).first()
    assert got.verdict == verdict


def test_config_as_of_has_one_plan(spark):
    config = spark.createDataFrame([(10.0, "m1", None), (4000.0, "m2", 0.7), (9000.0, "m1", None)],
                                   "at_s double, model_id string, threshold double")
    samples = spark.createDataFrame([(1, k, t) for k, t in enumerate([5.0, 10.0, 3999.0, 4000.0, 9500.0])],
                                    "series_id long, i long, arrival_s double")
    got = live.config_as_of(samples, live.resolve_config(config, "m1")).orderBy("i").collect()
    assert [(r.model_id, r.segment) for r in got] == [(None, None), ("m1", 0), ("m1", 0), ("m2", 1), ("m1", 2)]
