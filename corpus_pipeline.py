"""A corpus cleaned and packed in five stages, each an operator of ``curatrix.llm``.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of ``documents``. What the stages decide is defined in the
operators' docstrings; none but decontamination is expressible in SQL (learned weights, hashes
that SQL lacks, a tokenizer). Tests hold near-dedup, decontamination and packing against brute
force or SQL, and toxicity and line dedup against planted cases.

Every stage takes null ids, null, empty and very long texts, repeated rows, columns of any name
and empty tables: a null text stays null, a row that stays is not changed but for its dropped
lines, and repeated rows are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm.common import documents, materialize, table
from curatrix.llm.decontaminate import drop_contaminated
from curatrix.llm.lines import dedup_lines
from curatrix.llm.near_copies import keep_representatives
from curatrix.llm.packing import best_fit_packing
from curatrix.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon rejects go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines leave the texts; n_chars follows."""
    kept = dedup_lines(docs).drop("__lines")
    return kept.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast("long"))).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: SimHash fingerprints, found in BK-trees, then checked exactly."""
    return keep_representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces placed in sequences."""
    return best_fit_packing(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
