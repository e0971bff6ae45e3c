"""Runs held against what was asked: calls by question, manifests that questions bring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def question_of(job_key: Column) -> Column:
    """The question of a job key ``q{id}:...``, null for other keys."""
    return F.try_to_number(F.nullif(F.regexp_extract(job_key, r"^q(\d{1,18}):", 1), F.lit("")), F.lit("9" * 18)).cast("long")


def call_coverage(questions: DataFrame, calls: DataFrame, required: list[str]) -> DataFrame:
    """(question_id) and (job_key, role, ok) -> (question_id, n_calls, n_ok, missing_roles): an equi-join on the key's
    question, over one row a question."""
    ok = F.coalesce("ok", F.lit(False))
    done = [F.coalesce(F.bool_or(ok & (F.col("role") == r)), F.lit(False)).alias(f"r{i}") for i, r in enumerate(required)]
    counts = calls.select(question_of(F.col("job_key")).alias("question_id"), "role", "ok").where("question_id is not null")
    counts = counts.groupBy("question_id").agg(F.count("*").alias("n_calls"), F.count_if(ok).alias("n_ok"), *done)
    missing = F.array_compact(F.array(*[F.when(~F.coalesce(f"r{i}", F.lit(False)), r) for i, r in enumerate(required)]))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return questions.select("question_id").join(counts, "question_id", "left").select("question_id", zero("n_calls"), zero("n_ok"), F.array_join(missing, ",").alias("missing_roles"))


def manifest_status(metadata: Column, dialect: Column, question_id: Column) -> Column:
    """Of a question's metadata (JSON): ``none`` without manifests, ``resolved`` for one that fits, else what is wrong
    with it. Whether its interface fits the source is not looked at."""
    row = F.try_parse_json(metadata)
    kind = lambda v: F.coalesce(F.schema_of_variant(v), F.lit(""))
    manifests = F.try_variant_get(row, "$.oracle_manifests", "variant")
    entries = F.from_json(F.get_json_object(metadata, "$.oracle_manifests"), "map<string,string>")
    raw = F.try_element_at(entries, dialect)
    field = lambda name: F.get_json_object(raw, f"$.{name}")
    other = ~field("question_id").eqNullSafe(question_id.cast("string")) | ~field("dialect").eqNullSafe(dialect)
    return (
        F.when(manifests.isNull(), "none")
        .when(~kind(manifests).startswith("OBJECT"), "not a map of dialects")
        .when(raw.isNull(), F.concat(F.lit("no entry for "), dialect))
        .when(~kind(F.try_parse_json(raw)).startswith("OBJECT"), "entry is no object")
        .when(other, "identifies another question or dialect")
        .when(F.trim(F.coalesce(field("reference_source"), F.lit(""))) == "", "no reference source")
        .otherwise("resolved")
    )
