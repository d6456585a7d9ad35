"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark decontamination, encoding.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; each result is written as Parquet and read again as
the next stage's documents. All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from early_warning.llm import stages
from early_warning.llm.common import stored, table

STAGES = [
    ("quality_rules", stages.quality_stage),
    ("line_dedup", stages.line_stage),
    ("simhash_near_dedup", stages.simhash_stage),
    ("decontamination", stages.decontamination_stage),
    ("sentencepiece", stages.encode_stage),
]

#: SQL can express neither XXH64 fingerprints nor the tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
