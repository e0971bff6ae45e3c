"""Candidate pools: eligibility, ranking, versions, attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_CASES = 3
# How critic verdicts rank.
CRITIC_RANK = {"verified": 3, "skipped": 2, "unverified": 1, "failed": 0}


def critic_rank(status: Column) -> Column:
    """Missing ranks as skipped, unknown text as unverified."""
    known = F.coalesce(status, F.lit("skipped"))
    out = F.lit(1)
    for name, rank in CRITIC_RANK.items():
        out = F.when(known == name, rank).otherwise(out)
    return out


def eligible(strict: bool = True, critic_blocks: bool = False) -> Column:
    """The hard gate over compile, contract, oracle_blocked, refval_status, critic_status."""
    status = F.coalesce("refval_status", F.lit("skip"))
    numeric = (status == "pass") if strict else (status != "fail")
    gate = (F.col("compile") == "pass") & (F.col("contract") != "fail") & ~F.col("oracle_blocked") & numeric
    return gate & (F.coalesce("critic_status", F.lit("")) != "failed") if critic_blocks else gate


def rank_columns() -> list[Column]:
    """The seven ranking keys, larger is better."""
    return [
        (F.coalesce("refval_status", F.lit("")) == "pass").cast("int").alias("k_pass"),
        (F.coalesce("cases_run", F.lit(0)) >= MIN_CASES).cast("int").alias("k_cases"),
        critic_rank(F.col("critic_status")).alias("k_critic"),
        (-F.col("repairs")).alias("k_repairs"),
        F.coalesce("speedup", F.lit(0.0)).alias("k_speedup"),
        F.coalesce("score", F.lit(0)).alias("k_score"),
        (-F.col("candidate")).alias("k_candidate"),
    ]


def best_per_job(pool: DataFrame, payload: list[str], tie: list[str], **gate) -> DataFrame:
    """The winner of each job: one aggregate of the largest rank, combined before the shuffle."""
    ranked = pool.where(eligible(**gate)).select("job", F.struct(*rank_columns(), *tie, *payload).alias("r"))
    return ranked.groupBy("job").agg(F.max("r").alias("r"), F.count("*").alias("n_eligible")).select("job", *[F.col(f"r.{c}").alias(c) for c in payload], "n_eligible")


def merge_versions(pool: DataFrame, order: list[str]) -> DataFrame:
    """Per (job, candidate): arrival order decides ties for the newer, and the version counts
    how often the best so far was reached or beaten."""
    w = Window.partitionBy("job", "candidate").orderBy(*order)
    keys = [c for c in rank_columns()]
    ranked = pool.select("*", F.struct(*keys).alias("rank"), F.row_number().over(w).alias("arrival"))
    running = ranked.withColumn("best", F.max("rank").over(w))
    accepted = running.where(F.col("rank") == F.col("best"))
    return accepted.groupBy("job", "candidate").agg(F.count("*").alias("version"), F.max("arrival").alias("kept_arrival"))
