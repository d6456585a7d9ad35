"""Driver tables -> the shapes the operators work on.

The synthetic ``events`` table stands in for sensor files: one user is one
series, and the event fields are spread over eight channels. Every view here
is derived by Spark from the given parquet tables, so its work grows with them.
The DuckDB side of the same views lives in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import HORIZON, INDEX_BUCKET, SERIES_CHUNK_ROWS, WINDOW
from .operators.windows import chunk_with_halo, series_index

CHANNELS = [f"ch{k}" for k in range(1, 9)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    e = ev.select(
        F.col("user_id").alias("series_id"),
        "event_id", "ts", "value",
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("k"),
        F.when((F.col("event_type") == "error") & (F.col("value") > 60), 1)
        .otherwise(0).alias("anomaly"),
    )
    return series_index(e, "series_id", ["ts", "event_id"], bucket=F.date_trunc(INDEX_BUCKET, "ts"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight-channel readings: ch4 frozen at 7 for i in 20..54, ch7 constant."""
    b = base(spark, sf_dir)
    i = F.col("i")
    return b.select(
        "series_id", "event_id", "ts", "i", "n", "anomaly",
        F.col("value").alias("ch1"),
        F.col("k").alias("ch2"),
        (F.col("value") - F.col("k")).alias("ch3"),
        F.when(i.between(20, 54), F.lit(7.0))
        .otherwise(F.minute("ts").cast("double")).alias("ch4"),
        F.hour("ts").cast("double").alias("ch5"),
        (F.col("event_id") % 97).cast("double").alias("ch6"),
        F.col("series_id").cast("double").alias("ch7"),
        (F.col("value") + 2 * F.col("k")).alias("ch8"),
        (i.cast("double")
         + F.when((i >= 40) & (i % 5 == 0), F.lit(3.0)).otherwise(F.lit(0.0))
         ).alias("arrival_s"),
        F.when(F.col("series_id") % 5 == 3, "val")
        .when(F.col("series_id") % 5 == 4, "test")
        .otherwise("train").alias("split"),
    )


def _series_frame(lo: int, hi: int):
    return Window.partitionBy("series_id", "_chunk").orderBy("i").rowsBetween(lo, hi)


def windows(spark: SparkSession, sf_dir: str, r: DataFrame | None = None,
            keep: list[str] | None = None) -> DataFrame:
    """One row per labelled window, with an integer window sum of ch1 cents.
    ``keep`` carries columns of the window's last reading along."""
    r = readings(spark, sf_dir) if r is None else r
    keep = list(keep or [])
    r = chunk_with_halo(r, WINDOW - 1, HORIZON, SERIES_CHUNK_ROWS)
    w = r.select("_home",
        "series_id", "split", "i", "n", *keep,
        F.coalesce(F.max("anomaly").over(_series_frame(1, 10)), F.lit(0)).alias("y"),
        F.sum(F.round(F.col("ch1") * 100).cast("bigint"))
        .over(_series_frame(-19, 0)).cast("bigint").alias("cents"),
    )
    return (w.where(F.col("_home") & (F.col("i") >= 19) & (F.col("i") < F.col("n") - 10))
            .select("series_id", "split", "i", (F.col("i") - 19).alias("idx"), "y", "cents", *keep))


# Deterministic stand-ins for trained models: (model_id, slope, bias).
FIXTURE_MODELS = [("m1", 0.06, 0.0), ("m2", 0.12, 0.0), ("m3", 0.03, -1.5)]


def fixture_prob(cents: Column, slope: Column, bias: Column) -> Column:
    return F.round(1 / (1 + F.exp(-(slope * (cents / F.lit(2000.0) - 50) + bias))), 6)


def scores(spark: SparkSession, sf_dir: str, w: DataFrame | None = None) -> DataFrame:
    """Scores of the three fixture models on every window.

    The model table has three rows, so it is broadcast; the windows are not
    shuffled.
    """
    w = windows(spark, sf_dir) if w is None else w
    models = spark.createDataFrame(FIXTURE_MODELS, "model_id string, slope double, bias double")
    extra = [c for c in w.columns if c not in ("series_id", "split", "i", "idx", "y", "cents")]
    return (w.crossJoin(F.broadcast(models))
            .select("series_id", "split", "i", "idx", "y", "model_id",
                    fixture_prob(F.col("cents"), F.col("slope"), F.col("bias")).alias("p"), *extra))


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping 'files' of 400 events, each holding a copy of the first 100
    events of the next file, the copies cycling through the four verdicts; in
    copies that differ, one of the eight channels does, in turn."""
    r = readings(spark, sf_dir)
    fk = F.floor(F.col("event_id") / 400).cast("bigint")
    own = r.select(fk.alias("file_k"), "ts", *CHANNELS, "anomaly", F.lit(0).alias("changepoint"))
    copy = (r.where((F.col("event_id") >= 400) & (F.col("event_id") % 400 < 100))
            .select((fk - 1).alias("file_k"), "ts",
                    *[F.when((fk % 4 == 2) & (F.floor(fk / 4) % 8 == k), F.col(c) + 1).otherwise(F.col(c)).alias(c)
                      for k, c in enumerate(CHANNELS)],
                    F.when(fk % 4 == 1, 1 - F.col("anomaly"))
                    .when(fk % 4 == 2, 1 - F.col("anomaly"))
                    .otherwise(F.col("anomaly")).alias("anomaly"),
                    F.when(fk % 4 == 3, 1).otherwise(0).alias("changepoint")))
    return own.unionByName(copy)


def registry(spark: SparkSession) -> DataFrame:
    """Fixture registry; ``m4`` has no scores (the unavailable case)."""
    return spark.createDataFrame(
        [("m1", "Model one", "Linear", 0.91, True),
         ("m2", "Model two", "Tree", 0.85, False),
         ("m3", "Model three", "Kernel", 0.53, True),
         ("m4", "Model four", "Deep", None, False)],
        "model_id string, name string, family string, test_f1 double, requires_scaling boolean")


def bursts(spark: SparkSession, sf_dir: str, r: DataFrame | None = None) -> DataFrame:
    r = readings(spark, sf_dir) if r is None else r
    return (r.select("series_id").distinct()
            .select("series_id", F.lit(10).alias("start_i"),
                    (15 + F.col("series_id") % 26).alias("dur"),
                    ((7 + F.col("series_id") % 8).cast("double") / 10).alias("intensity")))


def channel_ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("ch1", 0.0, 200.0), ("ch2", 1.0, 98.0), ("ch3", -90.0, 300.0), ("ch8", 0.0, 400.0)],
        "channel string, lo double, hi double")


def live_config(spark: SparkSession) -> DataFrame:
    """Runtime configuration changes; NULL means 'leave as is'."""
    return spark.createDataFrame(
        [(0.0, "m1", 0.5), (30.0, "m2", None), (45.0, None, 0.6)],
        "at_s double, model_id string, threshold double")


# Upload fixtures: the readings as text files, with a deterministic rule that
# damages cells so every validation check has findings on every scale.
DAMAGE = [  # (channel, modulus, remainder, text)
    ("ch1", 419, 23, "x1"),
    ("ch2", 401, 17, "abc"),
    ("ch3", 211, 7, "--"),
    ("ch5", 223, 11, "N/A"),
    ("ch6", 227, 13, ""),
    ("ch8", 409, 19, "#"),
]
BAD_TIME = (251, 5, "not a time")


def uploads(spark: SparkSession, sf_dir: str, r: DataFrame | None = None) -> DataFrame:
    """One text 'file' per series: ``file``, ``row`` (order in the file),
    ``ts_text``, ``ch1..ch8`` and ``anomaly`` as strings."""
    r = readings(spark, sf_dir) if r is None else r
    e = F.col("event_id")
    cols = []
    for c in CHANNELS:
        cell = F.col(c).cast("string")
        for ch, mod, rem, text in DAMAGE:
            if ch == c:
                cell = F.when(e % mod == rem, F.lit(text)).otherwise(cell)
        cols.append(cell.alias(c))
    mod, rem, text = BAD_TIME
    ts_text = F.when(e % mod == rem, F.lit(text)).otherwise(F.col("ts").cast("string"))
    return r.select(F.col("series_id").alias("file"), e.alias("row"), ts_text.alias("ts_text"),
                    *cols, F.col("anomaly").cast("string").alias("anomaly"))


HEADER_RENAMES = {1: ("ch2", "CH_2"), 2: ("ch3", "Ch 3"), 3: ("ch5", "channel5"),
                  4: ("datetime", "Timestamp")}


def upload_headers(spark: SparkSession, sf_dir: str, r: DataFrame | None = None) -> DataFrame:
    """(file, col_pos, col_name): each file's header; by ``series_id % 6`` one
    column is renamed (1-4) or the label column is absent (5)."""
    r = readings(spark, sf_dir) if r is None else r
    names = ["datetime", *CHANNELS, "anomaly"]
    files = r.select(F.col("series_id").alias("file")).distinct()
    h = files.select("file", F.posexplode(F.array(*[F.lit(n) for n in names])).alias("col_pos", "col_name"))
    kind = F.col("file") % 6
    col = F.col("col_name")
    for k, (old, new) in HEADER_RENAMES.items():
        col = F.when((kind == k) & (F.col("col_name") == old), F.lit(new)).otherwise(col)
    h = h.withColumn("col_name", col)
    return h.where(~((kind == 5) & (F.col("col_name") == "anomaly"))) \
            .withColumn("col_pos", F.col("col_pos").cast("bigint"))


def model_requests(spark: SparkSession, sf_dir: str, r: DataFrame | None = None) -> DataFrame:
    """One model request per series: ``m`` + series_id % 6 (m0 and m5 are unknown)."""
    r = readings(spark, sf_dir) if r is None else r
    return (r.select("series_id").distinct()
             .select("series_id", F.concat(F.lit("m"), (F.col("series_id") % 6).cast("string")).alias("model_id")))
