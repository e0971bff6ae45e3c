"""Queries over prompts: parts are packs of texts, orders are jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatrix.operators.prompts import repair_prompts, selected_prompts, temperature
from curatrix.plans.base import Tables, query


def pack(t: Tables) -> DataFrame:
    """A brand's texts, a third of them Chinese, by parts' numbers; the first brand has none in Chinese."""
    part = F.when(F.col("p_size") % 2 == 0, "system").otherwise("suffix")
    chinese = (F.col("p_partkey") % 3 == 0) & (F.col("p_brand") != "Brand#11")
    ordinal = F.row_number().over(Window.partitionBy("p_brand", F.col("p_size") % 2).orderBy("p_partkey"))
    return t.part.select(F.col("p_brand").alias("track"), part.alias("part"), ordinal.alias("ordinal"), F.concat("p_name", F.when(chinese, F.lit(" 中文")).otherwise("")).alias("text"))


@query("""WITH pack AS (SELECT p_brand AS track, CASE WHEN p_size % 2 = 0 THEN 'system' ELSE 'suffix' END AS part, row_number() OVER (PARTITION BY p_brand, p_size % 2 ORDER BY p_partkey) AS ordinal, p_partkey % 3 = 0 AND p_brand <> 'Brand#11' AS zh,
  p_name || CASE WHEN p_partkey % 3 = 0 AND p_brand <> 'Brand#11' THEN ' 中文' ELSE '' END AS text FROM part),
jobs AS (SELECT o_orderkey AS q, o_custkey % 4 + 1 AS c, 'Brand#' || (o_orderkey % 5 + 1) || (o_custkey % 5 + 1) AS track, o_orderkey % 2 = 0 AS zh FROM orders),
l AS (SELECT j.*, p.part, list(p.ordinal ORDER BY p.ordinal) AS whole, list(p.ordinal ORDER BY p.ordinal) FILTER (p.zh = j.zh) AS own FROM (SELECT DISTINCT track, zh FROM jobs) j JOIN pack p USING (track) GROUP BY ALL),
s AS (SELECT q, c, track, part, CASE WHEN len(own) > 0 THEN own ELSE whole END AS pool, CASE part WHEN 'system' THEN 3 ELSE 7 END AS salt FROM jobs JOIN l USING (track, zh))
SELECT q AS question_id, c AS candidate, s.part, p.ordinal, p.text, [0.2, 0.5, 0.8, 0.8][c]::DOUBLE AS temperature FROM s JOIN pack p ON p.track = s.track AND p.part = s.part AND p.ordinal = s.pool[(q * 31 + c * 17 + salt) % len(s.pool) + 1]""")
def prompt_selection(t: Tables) -> DataFrame:
    """The system and suffix text of every job, in the question's language where there is one."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    track = F.concat(F.lit("Brand#"), (key % 5 + 1).cast("string"), (customer % 5 + 1).cast("string"))
    question = F.concat("o_orderpriority", F.when(key % 2 == 0, F.lit(" 问题")).otherwise(""))
    jobs = t.orders.select(key.alias("question_id"), (customer % 4 + 1).alias("candidate"), track.alias("track"), question.alias("question"))
    return selected_prompts(jobs, pack(t), {"system": 3, "suffix": 7}).withColumn("temperature", temperature(F.col("candidate")))


HINTS = (("timeout", "Check that loops end."), ("nan_inf", "Look for a division by zero."), ("empty", " "))
LIMIT = 260


@query(f"""WITH x AS (SELECT p_partkey AS part, CASE WHEN p_partkey % 11 = 0 THEN '(empty problem)' ELSE trim(p_name) END AS question, CASE WHEN p_size % 5 = 0 THEN 'cuda' ELSE 'triton' END AS dialect, [' Timeout', 'nan_inf', 'empty', 'other'][p_partkey % 4 + 1] AS class,
  ['- hint: Check that loops end.' || chr(10), '- hint: Look for a division by zero.' || chr(10), '', ''][p_partkey % 4 + 1] AS hint, CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN chr(10) || '- repair_round: ' || (p_size % 4) || '/?' ELSE chr(10) || '- repair_round: ' || (p_size % 4) || '/3' END AS rounds,
  CASE WHEN p_partkey % 6 = 0 THEN chr(10) || chr(10) || '## Earlier attempts' || chr(10) || 'none held' ELSE '' END AS history, CASE WHEN p_partkey % 5 <> 0 THEN repeat('bad=' || p_partkey || ';', p_size) END AS evidence, p_type AS body FROM part),
y AS (SELECT *, '## Problem' || chr(10) || question || chr(10) || chr(10) || '## Contract' || chr(10) || '- dialect: ' || dialect || chr(10) || '- error_class: ' || class || CASE WHEN hint = '' THEN '' ELSE chr(10) || rtrim(hint, chr(10)) END || rounds || history AS head, chr(10) || chr(10) || body AS tail FROM x)
SELECT part, length(prompt) AS n_chars, sha256(prompt) AS prompt_sha FROM (SELECT part, head || CASE WHEN evidence IS NOT NULL AND {LIMIT} - 14 - length(head || tail) > 0 THEN chr(10) || chr(10) || '## Evidence' || chr(10) || left(evidence, {LIMIT} - 14 - length(head || tail)) ELSE '' END || tail AS prompt FROM y)""")
def repair_requests(t: Tables) -> DataFrame:
    """Repair prompts within 260 characters where the evidence can be cut to that."""
    key, size = F.col("p_partkey"), F.col("p_size")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))
    rows = t.part.select(
        key.alias("part"), F.when(key % 11 != 0, F.col("p_name")).alias("question"), F.when(size % 5 != 0, "triton").alias("dialect"), pick((" Timeout", "nan_inf", "empty", "other")).alias("error_class"),
        F.when(size % 3 != 0, size % 4).alias("repair_idx"), F.when(size % 3 == 2, 3).alias("max_repairs"), F.when(key % 6 == 0, " none held ").otherwise(" ").alias("history"),
        F.when(key % 5 != 0, F.repeat(F.concat(F.lit("bad="), key.cast("string"), F.lit(";")), size)).alias("evidence"), F.col("p_type").alias("body"),
    )
    hints = t.spark.createDataFrame(HINTS, "error_class string, hint string")
    return repair_prompts(rows, hints, LIMIT).select("part", F.length("prompt").cast("long").alias("n_chars"), F.sha2("prompt", 256).alias("prompt_sha"))
