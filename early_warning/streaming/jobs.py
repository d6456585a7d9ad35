"""Structured Streaming jobs for the live monitor.

    samples (parquet files or JSON lines)  \\
                                            union -> groupBy(series_id).transformWithStateInPandas(LiveMonitor)
    configuration changes (JSON lines)     /           -> foreachBatch: ticks, quality frames and changes to own tables

Changes of the configuration are rows of the keyed stream, so they take effect while the query runs. The state store
and the checkpoint live under the session's ``spark.checkpoint.dir`` (shared storage on a cluster), so a lost executor
or a restarted query resumes from the last committed micro-batch.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ALERT_THRESHOLD, WINDOW
from ..session import scratch_path
from .processor import LiveMonitor, Scorer, input_schema, output_schema


def sample_schema(channels: Sequence[str]) -> T.StructType:
    return T.StructType([
        T.StructField("series_id", T.LongType()), T.StructField("seq", T.LongType()),
        T.StructField("ts", T.TimestampType()), T.StructField("arrival_s", T.DoubleType()),
        *[T.StructField(c, T.DoubleType()) for c in channels]])


LIVE_JSON_SCHEMA = "timestamp string, sensors map<string, double>"


def decode_samples(raw: DataFrame, channels: Sequence[str], value: str = "value") -> DataFrame:
    """``{"timestamp": ..., "sensors": {...}}`` text -> one column per
    channel (absent keys -> NULL; extra keys ignored)."""
    j = raw.withColumn("_j", F.from_json(F.col(value), LIVE_JSON_SCHEMA))
    return j.select(*[c for c in raw.columns if c != value],
                    F.col("_j.timestamp").alias("timestamp_text"),
                    F.try_to_timestamp(F.col("_j.timestamp")).alias("ts"),
                    *[F.element_at(F.col("_j.sensors"), F.lit(c)).alias(c) for c in channels])


def read_sample_files(spark: SparkSession, path: str, channels: Sequence[str],
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of sample files (parquet) in arrival order."""
    r = spark.readStream.schema(sample_schema(channels))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


JSON_LINE_SCHEMA = "series_id long, seq long, arrival_s double, " + LIVE_JSON_SCHEMA
CONFIG_SCHEMA = "series_id long, at_s double, model_id string, threshold double"


def read_sample_json(spark: SparkSession, path: str, channels: Sequence[str],
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of JSON lines, ``{"series_id", "seq", "arrival_s", "timestamp", "sensors": {channel: value}}``.

    A channel that is not named is null, one that is not known is left out; lines that are no JSON have no series and go.
    """
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    line = r.text(path).select(F.from_json("value", JSON_LINE_SCHEMA).alias("j"))
    return line.where(F.col("j.series_id").isNotNull()).select(
        "j.series_id", "j.seq", F.try_to_timestamp(F.col("j.timestamp")).alias("ts"), "j.arrival_s",
        *(F.try_element_at("j.sensors", F.lit(c)).alias(c) for c in channels))


def read_config_json(spark: SparkSession, path: str) -> DataFrame:
    """A stream of changes, ``{"at_s", "model_id", "threshold", "series_id"}``; null leaves as is, or means all series."""
    line = spark.readStream.text(path).select(F.from_json("value", CONFIG_SCHEMA).alias("j")).select("j.*")
    return line.where(F.col("at_s").isNotNull() & (F.col("threshold").isNull() | F.col("threshold").between(1e-300, 1 - 1e-16)))


def live_monitor(samples: DataFrame, config: DataFrame | None, channels: Sequence[str], scorer: Scorer,
                 ranges: Mapping[str, tuple[float, float]], series: DataFrame | None = None, window: int = WINDOW,
                 default_model: str = "m1", default_threshold: float = ALERT_THRESHOLD, stale_ms: int | None = None,
                 lateness_s: float = 3600.0, available: Collection[str] | None = None, fallback: str | None = None) -> DataFrame:
    """The keyed stateful monitor. Output rows are ticks, quality frames and applied changes (``kind``).

    ``config`` is a stream of changes; those without a series go to every one of ``series`` (a table of series_id).
    ``stale_ms`` arms the processing-time timer of X9 (a STALE_DATA frame after that long without samples); timers keep
    the engine running batches without data, so leave it unset for ``availableNow`` runs.
    """
    names = [f.split()[0] for f in input_schema(channels).split(", ")]
    rows = samples.withColumn("kind", F.lit("sample")).withColumn("model_id", F.lit(None).cast("string")).withColumn(
        "threshold", F.lit(None).cast("double")).select(*names)
    if config is not None:
        told = config.where(F.col("series_id").isNotNull())
        if series is not None:
            # A change meets every series by meaning; changes are operator actions.
            told = told.unionByName(config.where(F.col("series_id").isNull()).drop("series_id").crossJoin(
                series.select("series_id").distinct()))
        none = {"seq": "long", "ts": "timestamp"} | {c: "double" for c in channels}
        told = told.withColumn("kind", F.lit("config")).withColumnRenamed("at_s", "arrival_s").select(
            "*", *(F.lit(None).cast(kind).alias(c) for c, kind in none.items()))
        rows = rows.unionByName(told.select(*names))
    return rows.groupBy("series_id").transformWithStateInPandas(
        statefulProcessor=LiveMonitor(channels, scorer, ranges, window, default_model, default_threshold, stale_ms,
                                      lateness_s, available, fallback),
        outputStructType=output_schema(channels), outputMode="Append", timeMode="ProcessingTime" if stale_ms else "None")


def start_live_monitor(spark: SparkSession, frames: DataFrame, out_dir: str | None = None,
                       name: str = "live", trigger_available_now: bool = True):
    """Write ticks, quality frames and changes to parquet tables from one
    ``foreachBatch`` (idempotent per batch id via overwrite of a batch folder)."""
    base = out_dir or scratch_path(spark, f"streams/{name}")

    def sink(df: DataFrame, batch_id: int) -> None:
        df.persist()
        df.where(F.col("kind") == "tick").drop("kind", "code", "channel", "severity", "message") \
          .write.mode("overwrite").parquet(f"{base}/ticks/batch={batch_id}")
        df.where(F.col("kind") == "quality").select("series_id", "seq", "ts", "code", "channel", "severity", "message") \
          .write.mode("overwrite").parquet(f"{base}/quality/batch={batch_id}")
        df.where(F.col("kind") == "config").select("series_id", "model_id", "threshold") \
          .write.mode("overwrite").parquet(f"{base}/config/batch={batch_id}")
        df.unpersist()

    w = frames.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/_checkpoint")
    w = w.trigger(availableNow=True) if trigger_available_now else w.trigger(processingTime="1 second")
    return w.start(), base
