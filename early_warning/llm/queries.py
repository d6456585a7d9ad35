"""The registered queries of the text operators, one per operator, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, encode, html_text, jaccard, licenses, line_dedup, negatives, oracles, quality, sharding, simhash,
               spelling, token_count, toxicity)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@register("op1_license_scan")
def op1(spark, sf_dir):
    return licenses.license_digest(licenses.scan_licenses(table(spark, sf_dir, "documents")))


@register("op3_decontamination", oracles.DECONTAMINATION)
def op3(spark, sf_dir):
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.leak_digest(found)


@register("op4_sentencepiece")
def op4(spark, sf_dir):
    return encode.encode_texts(table(spark, sf_dir, "documents"), PIECE_MODEL,
                               columns=("n_tokens", "ids_sha256", "decoded_sha256"))


@register("op6_token_count")
def op6(spark, sf_dir):
    return token_count.count_tokens(table(spark, sf_dir, "documents"), PIECE_MODEL)


@register("op7_quality_rules", oracles.QUALITY)
def op7(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("broken_rules", ",").alias("broken_rules"))


@register("op5_line_dedup", oracles.LINE_DEDUP)
def op5(spark, sf_dir):
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@register("op8_simhash")
def op8(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op10_html_text")
def op10(spark, sf_dir):
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@register("op2_toxicity")
def op2(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op9_shards")
def op9(spark, sf_dir):
    return sharding.kd_shards(table(spark, sf_dir, "documents"))


@register("op11_jaccard_join")
def op11(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@register("op12_spelling_variants", oracles.SPELLING)
def op12(spark, sf_dir):
    return spelling.spelling_groups(spelling.word_counts(table(spark, sf_dir, "documents")))


@register("op13_hard_negatives", oracles.NEGATIVES)
def op13(spark, sf_dir):
    rows = negatives.integer_rows(table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))
    return negatives.mine_negatives(rows, F.col("id") % 50 == 0)
