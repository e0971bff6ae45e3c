"""Queries over recorded completions: turns of conversations are requests, most of which are recorded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators.completions import identified, nearest_profiles, replayed
from curatrix.plans.base import Tables, query

_KEPT = "conv_id % 4 <> 0 AND NOT (role = 'critic' AND candidate = 1)"
REQUESTS_SQL = f"""q AS (SELECT conv_id, turn, text, ['generator', 'critic', 'judge'][conv_id % 3 + 1] AS role, CAST(turn % 3 AS INT) AS candidate, CAST(conv_id % 2 AS INT) AS repair, CASE WHEN turn % 2 = 0 THEN '' ELSE 'split' END AS purpose FROM conversations WHERE text IS NOT NULL),
h AS (SELECT *, sha256('Be exact.[{{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":"user"}}]') AS request_hash FROM q),
k AS (SELECT *, sha256('{{"candidate":' || candidate || ',"purpose":"' || purpose || '","repair":' || repair || ',"request_hash":"' || request_hash || '","role":"' || role || '"}}') AS key_hash FROM h),
r AS (SELECT key_hash, role, candidate, repair, purpose, min(text) AS text FROM k WHERE {_KEPT} GROUP BY ALL),
profiles AS (SELECT DISTINCT role, candidate, repair, purpose FROM r),
missed AS (SELECT DISTINCT role, candidate, repair, purpose FROM k WHERE key_hash NOT IN (SELECT key_hash FROM r)),
near AS (SELECT m.*, p.role || '/' || p.candidate || '/' || p.repair || '/' || p.purpose AS nearest, (m.role = p.role)::INT + (m.candidate = p.candidate)::INT + (m.repair = p.repair)::INT + (m.purpose = p.purpose)::INT AS agreeing,
  row_number() OVER (PARTITION BY m.role, m.candidate, m.repair, m.purpose ORDER BY agreeing DESC, abs(m.candidate - p.candidate) + abs(m.repair - p.repair), nearest) AS place FROM missed m, profiles p WHERE agreeing > 0)"""


def requests(t: Tables) -> DataFrame:
    role = F.element_at(F.array(*map(F.lit, ("generator", "critic", "judge"))), (F.col("conv_id") % 3 + 1).cast("int"))
    message = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    return t.conversations.where("text is not null").select(
        "conv_id", "turn", role.alias("role"), (F.col("turn") % 3).cast("int").alias("candidate"), (F.col("conv_id") % 2).cast("int").alias("repair"), F.when(F.col("turn") % 2 == 0, "").otherwise("split").alias("purpose"),
        F.lit("Be exact.").alias("system"), message.alias("messages"), F.col("text").alias("answer"),
    )


def recorded(t: Tables) -> DataFrame:
    """The recorded table: each request once, the answer its own text."""
    rows = identified(requests(t)).where(_KEPT)
    return rows.groupBy("key_hash", "role", "candidate", "repair", "purpose").agg(F.min("answer").alias("text")).withColumn("reasoning", F.lit(""))


@query(f"WITH {REQUESTS_SQL} SELECT conv_id, turn, k.key_hash, r.key_hash IS NOT NULL AS recorded, sha256(r.text) AS answer_sha, CASE WHEN r.key_hash IS NULL THEN 'no recorded response for ' || k.role || '/' || k.candidate || '/' || k.repair || '/' || k.purpose || '; closest: ' || coalesce(n.shown, '') END AS miss FROM k LEFT JOIN r USING (key_hash) LEFT JOIN (SELECT role, candidate, repair, purpose, string_agg(nearest, '; ' ORDER BY place) FILTER (place <= 3) AS shown FROM near GROUP BY ALL) n ON n.role = k.role AND n.candidate = k.candidate AND n.repair = k.repair AND n.purpose = k.purpose")
def completion_replay(t: Tables) -> DataFrame:
    """Each request with its recorded answer, or what is nearest to it."""
    out = replayed(requests(t), recorded(t))
    return out.select("conv_id", "turn", "key_hash", "recorded", F.sha2("text", 256).alias("answer_sha"), "miss")


@query(f"WITH {REQUESTS_SQL} SELECT role, candidate, repair, purpose, place, nearest, agreeing FROM near WHERE place <= 3")
def completion_neighbours(t: Tables) -> DataFrame:
    """The three nearest recorded profiles of each profile that misses."""
    hits = recorded(t)
    misses = identified(requests(t)).join(hits.select("key_hash"), "key_hash", "left_anti")
    return nearest_profiles(misses, hits)
