"""Shared pieces of the text operators: table access, row scans in Arrow batches, written tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: Rows handed to Python at a time inside an Arrow batch; bounds what one step holds as Python objects.
STEP_ROWS = 128

_PLAIN = {
    "long": (T.LongType(), pa.int64()), "int": (T.IntegerType(), pa.int32()), "double": (T.DoubleType(), pa.float64()),
    "string": (T.StringType(), pa.string()), "boolean": (T.BooleanType(), pa.bool_()),
}
_KINDS = _PLAIN | {f"array<{k}>": (T.ArrayType(t), pa.list_(a)) for k, (t, a) in _PLAIN.items()}

#: Byte table that lower-cases A-Z and turns every ASCII character but digits and letters into a space.
#: UTF-8 bytes from 0x80 up stay, so splitting at spaces gives the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
_ALNUM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of digits, letters and non-ASCII characters; none for a null text."""
    return text.translate(_ALNUM).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting to remove the shuffle files of a query when it ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _clean_shuffles(spark: SparkSession):
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if before is None else spark.conf.set(CLEAN_SHUFFLES, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder under the session's shared checkpoint folder and read back.

    Cuts the lineage: what follows survives lost executors without recomputing what came before. The shuffle files
    of the write go with its end, so that the steps of an operator do not add up on disk.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with _clean_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def safe_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows under names c0, c1, ... that no operator's own column can clash with."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def where_last(df: DataFrame, condition: Column) -> DataFrame:
    """Filter by computed columns without computing them twice.

    A plain filter is pushed below the projections it reads from, and their expressions are put into it inside out; the
    row number, which the optimizer holds for not deterministic, keeps the filter above them.
    """
    return (df.withColumn("row__", F.monotonically_increasing_id())
            .where(condition & (F.col("row__") >= 0)).drop("row__"))


def sorted_list(column: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(column)), ",")


def each(row: Callable) -> Callable:
    """A function of one row as one of a list of rows."""
    return lambda rows: [row(*r) for r in rows]


def scan_texts(df: DataFrame, keep: Sequence[str], inputs: Sequence[str],
               make: Callable[[], Callable], out: Sequence[tuple[str, str]],
               binary: bool = True) -> DataFrame:
    """Python over Arrow batches: ``keep`` columns pass through, ``make()`` builds the function for the rest.

    ``make`` runs once per task; its function gets a list of rows, tuples of the values of ``inputs`` (strings as
    UTF-8 bytes if ``binary``), and returns for each a value per column of ``out`` (name, Spark type).
    """
    schema = df.select(*keep).schema
    for name, kind in out:
        schema = schema.add(name, _KINDS[kind][0])
    n_keep, kinds, names = len(keep), [_KINDS[k][1] for _, k in out], schema.names

    def run(batches):
        rows_of = make()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(at, STEP_ROWS)
                cols = part.columns
                values = [c.cast(pa.binary()) if binary and pa.types.is_string(c.type) else c for c in cols[n_keep:]]
                rows = rows_of(list(zip(*(c.to_pylist() for c in values))))
                made = [pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(cols[:n_keep] + made, names=names)

    picked = df.select(*keep, *(F.col(c).alias(f"in_{i}__") for i, c in enumerate(inputs)))
    return picked.mapInArrow(run, schema)
