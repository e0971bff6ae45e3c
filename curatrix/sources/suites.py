"""Suites of validation cases on disk: plans as lines of JSON, a folder a question, and a hash of each suite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.operators.cases import PLAN, suite_hashes


def plan_of(line: Column) -> Column:
    """The plan in a line of JSON; null for what is no object, and for lines that were cut off."""
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json(line)), F.lit("")).startswith("OBJECT")
    return F.when(whole, F.from_json(line, f"struct<ordinal:int,{PLAN}>"))


def read_plans(lines: DataFrame, line: str = "value") -> DataFrame:
    """The plans of lines, bad ones left out, other columns kept."""
    parsed = lines.withColumn("__plan", plan_of(F.col(line))).where(F.col("__plan").isNotNull())
    return parsed.select(*[c for c in lines.columns if c != line], "__plan.*")


def write_suite(plans: DataFrame, root: str) -> None:
    """Write the plans of some questions. All that a question's folder held goes, so that no case
    of an earlier suite stays; other questions' folders are left alone."""
    fields = [c for c in plans.columns if c != "question_id"]
    lines = plans.select("question_id", F.to_json(F.struct(*fields)).alias("value")).repartition("question_id").sortWithinPartitions("question_id", "value")
    for rows, name, form in ((lines, "cases", "text"), (suite_hashes(plans), "hashes", "parquet")):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("question_id").format(form).save(f"{root}/{name}")


def read_suite(spark: SparkSession, root: str) -> DataFrame:
    """(question_id, plan's fields) of every question under root."""
    return read_plans(spark.read.schema("value string, question_id long").text(f"{root}/cases"))


def stale_suites(plans: DataFrame, root: str) -> DataFrame:
    """(question_id) whose written suite is missing or means something else than these plans."""
    spark = plans.sparkSession
    written = spark.read.schema("n_cases long, suite_hash string, question_id long").parquet(f"{root}/hashes").select("question_id", F.col("suite_hash").alias("__written"))
    both = suite_hashes(plans).join(written, "question_id", "left")
    return both.where(~F.col("suite_hash").eqNullSafe(F.col("__written"))).select("question_id")
