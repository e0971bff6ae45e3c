"""Recorded completions: kept once by the identity of their request, found again, and the
nearest recorded requests named where one is missing.

A request is (role, candidate, repair, purpose, system, messages), messages an array of
(content, role). Its identity holds a hash of all that was sent, so equal requests meet by one
key. A miss is compared by what it was for: requests of one profile (role, candidate, repair,
purpose) are counted once, profiles that share a field meet through it, and no two requests
are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.sources.sinks import append_new, exists, one_writer

PROFILE = ("role", "candidate", "repair", "purpose")
NEAREST = 3


def request_hash(system: Column, messages: Column) -> Column:
    sent = F.transform(messages, lambda m: F.struct(m["content"].alias("content"), m["role"].alias("role")))
    return F.sha2(F.concat(F.coalesce(system, F.lit("")), F.to_json(sent)), 256)


def identified(requests: DataFrame) -> DataFrame:
    """requests with request_hash and key_hash; what a profile lacks takes its default."""
    defaults = {"role": F.lit("generator"), "candidate": F.lit(0), "repair": F.lit(0), "purpose": F.lit("")}
    rows = requests.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()}).withColumn("request_hash", request_hash(F.col("system"), F.col("messages")))
    identity = F.to_json(F.struct("candidate", "purpose", "repair", "request_hash", "role"))
    return rows.withColumn("key_hash", F.sha2(identity, 256))


class Conflict(ValueError):
    """A request is recorded with another response already."""


def record(completions: DataFrame, path: str) -> DataFrame:
    """Add requests with their ``text`` and ``reasoning`` to the table at path, once each; return
    the table. One that the table or the rows hold with another response is an error, and nothing
    is then written."""
    spark = completions.sparkSession
    answer = F.sha2(F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("reasoning", F.lit("")).alias("reasoning"))), 256)
    rows = identified(completions).select("key_hash", *PROFILE, "request_hash", "text", "reasoning", answer.alias("answer_hash"))
    with one_writer(spark, path):
        table = f"{path}/completions"
        known = rows if not exists(spark, table) else rows.unionByName(spark.read.schema(rows.schema).parquet(table))
        clashing = known.groupBy("key_hash").agg(F.min("answer_hash").alias("a"), F.max("answer_hash").alias("b")).where("a <> b")
        if (first := clashing.select(F.min("key_hash")).first()[0]) is not None:
            raise Conflict(f"conflicting response for key {first}")
        return append_new(rows, table, ["key_hash"])


def replayed(requests: DataFrame, recorded: DataFrame) -> DataFrame:
    """requests with ``recorded`` and the text and reasoning of those that are; others have a
    ``miss`` that names the nearest recorded profiles."""
    asked = identified(requests)
    answers = recorded.select("key_hash", "text", "reasoning", F.lit(True).alias("recorded"))
    found = asked.join(answers, "key_hash", "left").withColumn("recorded", F.coalesce("recorded", F.lit(False)))
    near = nearest_profiles(found.where("not recorded"), recorded)
    shown = near.groupBy(*PROFILE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "nearest"))), lambda x: x["nearest"]), "; ").alias("__near"))
    said = F.concat(F.lit("no recorded response for "), profile_text(F.struct(*PROFILE)), F.lit("; closest: "), F.coalesce("__near", F.lit("")))
    return found.join(shown, list(PROFILE), "left").withColumn("miss", F.when(~F.col("recorded"), said)).drop("__near")


def profile_text(profile: Column) -> Column:
    return F.concat_ws("/", profile["role"], profile["candidate"].cast("string"), profile["repair"].cast("string"), profile["purpose"])


def nearest_profiles(misses: DataFrame, recorded: DataFrame, n: int = NEAREST) -> DataFrame:
    """(profile, place, nearest, agreeing) of the profiles of misses: recorded profiles that share
    a field, by the fields that agree, then by how far candidate and repair are apart, then by name."""
    one, other = misses.select(*PROFILE).distinct().select(F.struct(*PROFILE).alias("p")), recorded.select(*PROFILE).distinct().select(F.struct(*PROFILE).alias("r"))
    fields = lambda rows, c: rows.select(c, F.explode(F.array(*[F.concat(F.lit(f"{f}="), F.col(c)[f].cast("string")) for f in PROFILE])).alias("field"))
    shared = fields(one, "p").join(fields(other, "r"), "field").groupBy("p", "r").agg(F.count("*").alias("agreeing"))
    apart = F.abs(F.col("p.candidate") - F.col("r.candidate")) + F.abs(F.col("p.repair") - F.col("r.repair"))
    place = F.row_number().over(Window.partitionBy("p").orderBy(F.col("agreeing").desc(), apart, profile_text(F.col("r"))))
    return shared.withColumn("place", place).where(F.col("place") <= n).select("p.*", "place", profile_text(F.col("r")).alias("nearest"), "agreeing")
