"""The stages of the corpus pipeline, each a call of one operator whose decisions take effect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, encode, line_dedup, quality, simhash
from .common import safe_names, table, where_last
from .queries import PIECE_MODEL


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    plain, names = safe_names(docs)
    judged = quality.quality_rules(plain, names["text"], list(names.values()))
    return where_last(judged, F.col("kept")).select(*names.values()).toDF(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go, and with them the documents of which nothing is left; n_chars follows the text."""
    plain, names = safe_names(docs)
    done = line_dedup.dedup_lines(plain, names["doc_id"], names["text"], keep=list(names.values()))
    left = {c: F.col(n) for c, n in names.items()} | {"text": F.col("text")}
    if "n_chars" in names:
        left["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col(names["n_chars"])).cast(
            docs.schema["n_chars"].dataType)
    gone = (F.col("n_removed") > 0) & ~F.col("text").rlike(line_dedup.WORD)
    return where_last(done, ~gone).select(*(left[c].alias(c) for c in docs.columns))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.first_of_groups(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold words of a benchmark window go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with digests of the ids and of the decoded text."""
    return encode.encode_texts(docs, PIECE_MODEL, columns=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))
