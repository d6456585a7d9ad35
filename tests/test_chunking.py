"""Hot-series handling gives the same rows as the one-partition-per-series plan."""

from pyspark.sql import functions as F

from early_warning import fixtures as fx
from early_warning.operators import features, windows


def _same(a, b, cols):
    a, b = a.select(*cols), b.select(*cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bucketed_index_equals_row_number(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select(F.col("user_id").alias("series_id"), "event_id", "ts")
    plain = windows.series_index(ev, "series_id", ["ts", "event_id"])
    bucketed = windows.series_index(ev, "series_id", ["ts", "event_id"], bucket=F.date_trunc("hour", "ts"))
    _same(plain, bucketed, ["series_id", "event_id", "i", "n"])


def test_halo_chunks_equal_series_partitions(spark, sf_dir):
    r = fx.readings(spark, sf_dir)
    for chunk in (19, 33):
        a = windows.horizon_label(r)
        b = windows.horizon_label(r, chunk_rows=chunk)
        _same(a, b, ["series_id", "i", "y"])
        a = windows.sliding_windows(r, fx.CHANNELS)
        b = windows.sliding_windows(r, fx.CHANNELS, chunk_rows=chunk)
        _same(a.select("series_id", "idx", F.to_json("win").alias("w")),
              b.select("series_id", "idx", F.to_json("win").alias("w")), ["series_id", "idx", "w"])
    cols = ["series_id", "idx", *features.stat_columns(fx.CHANNELS)]
    a = features.stat_features(r, fx.CHANNELS)
    b = features.stat_features(r, fx.CHANNELS, chunk_rows=21)
    _same(a.select(*[F.round(c, 9).alias(c) if c not in ("series_id", "idx") else c for c in cols]),
          b.select(*[F.round(c, 9).alias(c) if c not in ("series_id", "idx") else c for c in cols]), cols)
