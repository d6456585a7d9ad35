"""Work that grows with the rows: windows as slices, one input a model, k-NN by runs of cells, files by many tasks."""

import os
import re
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from early_warning.operators import knn, models, windows
from early_warning.sources import files


def _readings(spark, n=600, series=3):
    df = spark.range(series * n).select((F.col("id") % series).alias("series_id"), F.floor(F.col("id") / series).alias("i"))
    return df.withColumns({"n": F.lit(n).cast("bigint"), "split": F.when(F.col("series_id") == 0, "test").otherwise("train"),
                           "anomaly": (F.col("i") % 37 == 0).cast("int"), "a": F.sin(F.col("i") + F.col("series_id")),
                           "b": F.when(F.col("i") % 11 != 0, F.col("i").cast("double"))})


def test_windows_are_slices_over_chunk_borders(spark):
    r = _readings(spark)
    w = windows.sliding_windows(r, ["a", "b"])
    got = {(x.series_id, x.idx): x.win for x in w.collect()}
    rows = {(x.series_id, x.i): (x.i, x.a, x.b) for x in r.collect()}
    assert len(got) == 3 * (600 - 29)
    assert all([tuple(c) for c in win] == [rows[s, k] for k in range(at, at + 20)] for (s, at), win in got.items())
    assert " Window [" not in w._jdf.queryExecution().executedPlan().toString()


def test_frame_holds_the_input_of_its_model_and_is_read_from_its_table(spark):
    r = _readings(spark, 80).fillna(0.0, ["b"])
    all_of = models.model_frame(r, ["a", "b"])
    for m in ("rf", "lr", "mlp"):
        own = models.input_of(m)
        frame = models.written(models.model_frame(r, ["a", "b"], inputs=[own]))
        assert [c for c in frame.columns if c.startswith("features")] == [own]
        assert frame.inputFiles()
        key = lambda x: (x.series_id, x.idx)
        for x, y in zip(sorted(frame.collect(), key=key), sorted(all_of.collect(), key=key), strict=True):
            assert (key(x), x.label) == (key(y), y.label) and np.allclose(x[own].toArray(), y[own].toArray(), equal_nan=True)


def test_a_query_moves_once_a_run_of_cells():
    cells = knn.Cells(np.zeros((6, 1)), np.array([5, 5, 30, 0, 2, 3]), np.zeros(6), np.zeros(6))
    runs = knn._runs_of_cells(cells, 10)
    assert runs.tolist() == [0, 0, 1, 2, 2, 2]
    q = pd.DataFrame({"q_id": [7, 8], "q_x": [[0.0], [1.0]], "rad": [1.0, 1.0], "met": [1, 1],
                      "cells": [[0, 1, 2, 5], []], "dists": [[.1, .2, .3, .4], []]})
    (out,) = knn._by_run(runs)([q])
    assert out["q_id"].tolist() == [7, 7, 7] and out["grp"].tolist() == [0, 1, 2]
    assert [x.tolist() for x in out["cells"]] == [[0, 1], [2], [5]]


def test_files_are_made_by_all_tasks_and_listed_by_the_read(spark):
    root = tempfile.mkdtemp(prefix="ew-grow-")
    r = _readings(spark, 5, 40)
    files.write_readings_csv(r, f"{root}/in", ["a", "b"], ";")
    found = files.scan_tree(spark, f"{root}/in").collect()
    assert len(found) == 40 and len({re.search(r"part-(\d+)", x.file)[1] for x in found}) > 1
    for name, text in (("a b%2.csv", "x;y\n"), ("none é.csv", ""), ("_hidden.csv", "x")):
        with open(f"{root}/in/_folder=data/{name}", "w") as f:
            f.write(text)
    gate = {os.path.basename(x.path): x.rejected for x in files.upload_gate(spark, f"{root}/in").collect()}
    assert len(gate) <= 42 and gate["a b%2.csv"] is None and gate["none é.csv"] == "empty" and "_hidden.csv" not in gate
