"""The stateful stream equals its batch twin."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from early_warning import fixtures as fx
from early_warning.operators import quality
from early_warning.plans.queries import _live_ticks
from early_warning.streaming import jobs
from early_warning.streaming.processor import fixture_scorer, resolve_changes


def _stage(spark, sf_dir, path, chunks):
    r = fx.readings(spark, sf_dir)
    rows = r.select("series_id", F.col("i").alias("seq"), F.col("ts").cast("timestamp").alias("ts"),
                    "arrival_s", *fx.CHANNELS, (F.col("i") / (100 // chunks + 1)).cast("int").alias("part"))
    for k in range(chunks + 2):
        rows.where(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(path)
    return r


def _say(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def _changes(spark):
    return [r.asDict() for r in fx.live_config(spark).collect()]


def _monitor(spark, samples, config, r, **more):
    models = {m: (s, b) for m, s, b in fx.FIXTURE_MODELS}
    ranges = {row.channel: (row.lo, row.hi) for row in fx.channel_ranges(spark).collect()}
    return jobs.live_monitor(samples, config, fx.CHANNELS, fixture_scorer(models), ranges, series=r.select("series_id"), **more)


def _finish(spark, frames, base):
    q, base = jobs.start_live_monitor(spark, frames, out_dir=base)
    assert q.awaitTermination(300), "stream did not finish"
    return base


def _check_ticks(spark, base, sf_dir, r):
    ticks = spark.read.parquet(f"{base}/ticks")
    twin = _live_ticks(spark, sf_dir, r).select("series_id", "i", "tick", F.col("p").alias("p_b"),
                                                F.col("status").alias("status_b"),
                                                F.col("in_anomaly_window").alias("flag_b"),
                                                F.col("model_id").alias("model_b"))
    j = twin.join(ticks.withColumnRenamed("seq", "i").drop("tick"), ["series_id", "i"], "full_outer")
    assert j.where(F.col("p").isNull() | F.col("p_b").isNull()).count() == 0
    assert j.where(F.abs(F.col("p") - F.col("p_b")) > 1e-6).count() == 0
    assert j.where((F.col("status") != F.col("status_b")) | (F.col("model_id") != F.col("model_b"))
                   | (F.col("in_anomaly_window") != F.col("flag_b"))).count() == 0
    assert ticks.count() == twin.count() > 0
    # the tick carries its newest sample: time and all channels
    own = r.select("series_id", F.col("i").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), *fx.CHANNELS)
    assert ticks.select(*own.columns).exceptAll(own).count() == 0
    return ticks


def test_stream_equals_batch_twin(spark, sf_dir):
    d = tempfile.mkdtemp(prefix="ew-stream-")
    r = _stage(spark, sf_dir, f"{d}/in", chunks=3)
    _say(f"{d}/config", "all", _changes(spark))
    stream = jobs.read_sample_files(spark, f"{d}/in", fx.CHANNELS, max_files_per_trigger=1)
    base = _finish(spark, _monitor(spark, stream, jobs.read_config_json(spark, f"{d}/config"), r), f"{d}/out")
    _check_ticks(spark, base, sf_dir, r)

    qs = spark.read.parquet(f"{base}/quality").select("series_id", F.col("seq").alias("i"), "code", "channel", "message")
    qb = quality.quality_events(r, fx.channel_ranges(spark), fx.CHANNELS).select("series_id", "i", "code", "channel")
    key = ["series_id", "i", "code", F.coalesce("channel", F.lit(""))]
    assert qs.select(*key).exceptAll(qb.select(*key)).count() == 0
    assert qb.select(*key).exceptAll(qs.select(*key)).count() == 0
    assert qb.count() > 0 and qs.where("message is null").count() == 0


def test_changes_while_the_stream_runs_from_json(spark, sf_dir):
    """Samples as JSON lines; each change is made known only when the samples before it have been handled."""
    d = tempfile.mkdtemp(prefix="ew-stream-")
    r = fx.readings(spark, sf_dir).where("series_id < 6").persist()
    cuts = [c["at_s"] for c in _changes(spark)]
    rows = [x.asDict() for x in r.select("series_id", "i", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), "arrival_s",
                                         *fx.CHANNELS).orderBy("series_id", "i").collect()]
    line = lambda x: {"series_id": x["series_id"], "seq": x["i"], "arrival_s": x["arrival_s"], "timestamp": x["at"],
                      "sensors": {c: x[c] for c in fx.CHANNELS if x[c] is not None} | {"extra": 1.0}}
    for k, change in enumerate(_changes(spark)):
        _say(f"{d}/config", f"c{k}", [change])
        lo, hi = cuts[k] if k else float("-inf"), cuts[k + 1] if k + 1 < len(cuts) else float("inf")
        _say(f"{d}/in", f"s{k}", [line(x) for x in rows if lo <= x["arrival_s"] < hi])
        frames = _monitor(spark, jobs.read_sample_json(spark, f"{d}/in", fx.CHANNELS), jobs.read_config_json(spark, f"{d}/config"), r)
        base = _finish(spark, frames, f"{d}/out")
    ticks = _check_ticks(spark, base, sf_dir, r)
    assert ticks.select("model_id").distinct().count() == 2
    told = spark.read.parquet(f"{base}/config")
    assert told.count() == len(cuts) * r.select("series_id").distinct().count()
    r.unpersist()


def test_fallback_model(spark, sf_dir):
    d = tempfile.mkdtemp(prefix="ew-stream-")
    r = _stage(spark, sf_dir, f"{d}/in", chunks=1)
    _say(f"{d}/config", "all", _changes(spark))
    stream = jobs.read_sample_files(spark, f"{d}/in", fx.CHANNELS)
    frames = _monitor(spark, stream, jobs.read_config_json(spark, f"{d}/config"), r, available={"m1"}, fallback="m1")
    ticks = spark.read.parquet(f"{_finish(spark, frames, f'{d}/out')}/ticks")
    assert [x.model_id for x in ticks.select("model_id").distinct().collect()] == ["m1"]


def test_late_and_folded_changes():
    base = (float("-inf"), "m1", .5, 0)
    assert resolve_changes(base, [(1.0, "m2", None), (2.0, None, .7), (3.0, "m1", None), (4.0, "m1", None)]) == [
        base, (1.0, "m2", .5, 1), (2.0, "m2", .7, 1), (3.0, "m1", .7, 2), (4.0, "m1", .7, 2)]
