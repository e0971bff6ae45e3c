"""Driver tables bound to the engine's canonical schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.plans.base import Tables


def pool(t: Tables) -> DataFrame:
    """Candidate pools from order lines: a job is an order, a candidate a line."""
    q = F.col("l_quantity").cast("int")
    return t.lineitem.select(
        F.col("l_orderkey").alias("job"),
        F.col("l_linenumber").alias("candidate"),
        "l_partkey",
        "l_suppkey",
        q.alias("q"),
        F.when(q % 10 == 0, "fail").otherwise("pass").alias("compile"),
        F.when(q % 17 == 0, "fail").otherwise("pass").alias("contract"),
        (q % 13 == 0).alias("oracle_blocked"),
        F.when(F.col("l_returnflag") == "R", "fail").otherwise("pass").alias("refval_status"),
        (q % 7).alias("cases_run"),
        F.when(F.col("l_linestatus") == "O", F.when(q % 3 == 0, "verified").when(q % 3 == 1, "unverified").otherwise("failed")).alias("critic_status"),
        (q % 4).alias("repairs"),
        F.col("l_extendedprice").alias("speedup"),
        F.round(F.col("l_discount") * 100).cast("int").alias("score"),
    )


POOL_SQL = """pool AS (
  SELECT l_orderkey AS job, l_linenumber AS candidate, l_partkey, l_suppkey, CAST(l_quantity AS INT) AS q,
    CASE WHEN CAST(l_quantity AS INT) % 10 = 0 THEN 'fail' ELSE 'pass' END AS compile,
    CASE WHEN CAST(l_quantity AS INT) % 17 = 0 THEN 'fail' ELSE 'pass' END AS contract,
    CAST(l_quantity AS INT) % 13 = 0 AS oracle_blocked,
    CASE WHEN l_returnflag = 'R' THEN 'fail' ELSE 'pass' END AS refval_status,
    CAST(l_quantity AS INT) % 7 AS cases_run,
    CASE WHEN l_linestatus = 'O' THEN CASE CAST(l_quantity AS INT) % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'unverified' ELSE 'failed' END END AS critic_status,
    CAST(l_quantity AS INT) % 4 AS repairs, l_extendedprice AS speedup, CAST(round(l_discount * 100) AS INT) AS score
  FROM lineitem),
ranked AS (
  SELECT *, CAST(refval_status = 'pass' AS INT) AS k_pass, CAST(cases_run >= 3 AS INT) AS k_cases,
    CASE coalesce(critic_status, 'skipped') WHEN 'verified' THEN 3 WHEN 'skipped' THEN 2 WHEN 'failed' THEN 0 ELSE 1 END AS k_critic,
    -repairs AS k_repairs, speedup AS k_speedup, score AS k_score, -candidate AS k_candidate,
    compile = 'pass' AND contract <> 'fail' AND NOT oracle_blocked AND refval_status = 'pass' AS ok
  FROM pool)"""


def questions(t: Tables) -> DataFrame:
    """Questions from documents: a lead sentence chosen by id before the whole text."""
    lead = F.element_at(F.array(*map(F.lit, LEADS)), (F.col("doc_id") % len(LEADS)).cast("int") + 1)
    return t.documents.select(F.col("doc_id").alias("question_id"), F.concat(lead, F.lit(" "), "text").alias("question"), "lang", "source")


LEADS = (
    "Implement a matmul of two matrices.",
    "Explain occupancy and latency hiding.",
    "Derive the roofline for a scan.",
    "Write your implementation of vector add in solution.cu",
    "What is the shared memory bank layout?",
    "Implement a softmax over rows.",
    "Explain how ptx becomes sass.",
    "Transpose a strided tensor.",
    "What is a tensor core?",
    "Sort and histogram the keys.",
    "Explain kernel launch and streams.",
    "Copy and scale the buffer.",
    "Describe the weather.",
)
QUESTIONS_SQL = "questions AS (SELECT doc_id AS question_id, [" + ", ".join(f"'{x}'" for x in LEADS) + f"][CAST(doc_id % {len(LEADS)} AS INT) + 1] || ' ' || text AS question, lang, source FROM documents)"


def trace(t: Tables) -> DataFrame:
    """Trace events from the event stream; arrival order is the event id."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    event = F.when(kind == "purchase", "job.end").when(kind == "signup", "job.start").when(kind == "click", "llm.call").when(kind == "view", "node.end").otherwise("node.start")
    names = lambda xs: F.element_at(F.array(*map(F.lit, xs)), k % len(xs) + 1)
    return t.events.select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("job"),
        event.alias("event"),
        k.alias("k"),
        (k % 3).alias("candidate"),
        F.col("value").alias("elapsed_s"),
        F.when(k % 4 == 0, "abandoned").otherwise("success").alias("status"),
        F.when(k % 3 == 0, "strict").otherwise("basic").alias("release_tier"),
        names(("generate", "judge", "critic", "refval_extract")).alias("role"),
        names(("openai", "other", "third")).alias("provider"),
        names(("compile", "refval", "judge")).alias("gate"),
        names(("ORACLE", "INFRA", "KERNEL", "TEACHER")).alias("owner"),
        F.when(k % 2 == 0, "repair").otherwise("generate").alias("node"),
        F.when(k % 5 != 0, F.col("value") / 100).alias("cost_usd"),
    )


TRACE_SQL = """trace AS (
  SELECT event_id AS seq, ts, user_id AS job, k, k % 3 AS candidate, value AS elapsed_s,
    CASE event_type WHEN 'purchase' THEN 'job.end' WHEN 'signup' THEN 'job.start' WHEN 'click' THEN 'llm.call' WHEN 'view' THEN 'node.end' ELSE 'node.start' END AS event,
    CASE WHEN k % 4 = 0 THEN 'abandoned' ELSE 'success' END AS status,
    CASE WHEN k % 3 = 0 THEN 'strict' ELSE 'basic' END AS release_tier,
    ['generate', 'judge', 'critic', 'refval_extract'][k % 4 + 1] AS role, ['openai', 'other', 'third'][k % 3 + 1] AS provider,
    ['compile', 'refval', 'judge'][k % 3 + 1] AS gate, ['ORACLE', 'INFRA', 'KERNEL', 'TEACHER'][k % 4 + 1] AS owner,
    CASE WHEN k % 2 = 0 THEN 'repair' ELSE 'generate' END AS node, CASE WHEN k % 5 <> 0 THEN value / 100 END AS cost_usd
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""


def runs(t: Tables) -> DataFrame:
    """The trace of eight runs. Odd ones commit their jobs; run 6 has no success; in runs 1 and 2
    every call is priced."""
    k = F.get_json_object("props", "$.k").cast("int")
    run, kind = (F.col("user_id") % 8).cast("int"), F.col("event_type")
    names = lambda xs: F.element_at(F.array(*map(F.lit, xs)), k % len(xs) + 1)
    event = (
        F.when(kind == "purchase", F.when((run % 2 == 1) & (k % 3 != 0), "job.commit").otherwise("job.end"))
        .when(kind == "signup", F.when(k % 2 == 0, "job.start").otherwise("store.write"))
        .when(kind == "click", "llm.call")
        .when(kind == "view", F.when(k % 5 == 0, "node.error").otherwise("node.end"))
        .otherwise("node.start")
    )
    return t.events.select(
        run.alias("run_id"), F.col("user_id").alias("job"), (k % 2).alias("candidate"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), event.alias("event"),
        F.when((run == 6) | (k % 4 == 0), "abandoned").when(k % 7 == 0, "failed").otherwise("success").alias("status"), names(("strict", "strict_perf", "basic", "basic", "basic")).alias("release_tier"),
        F.when(k % 11 != 0, k * 10).alias("input_tokens"), (k * 3).alias("output_tokens"), F.when(run.isin(1, 2) | (k % 5 != 0), F.col("value") / 100).alias("cost_usd"),
        F.when(k % 9 != 0, names(("generate", "judge", "critic", "refval_extract"))).alias("role"), F.when(k % 3 != 0, "repair").otherwise("generate").alias("node"),
        names(("compile", "refval", "judge")).alias("gate"), names(("ORACLE", "INFRA", "KERNEL", "TEACHER")).alias("owner"), F.when(k != 7, F.col("value")).alias("elapsed_s"),
        F.when(k % 8 == 0, "deadline").when(k % 12 == 0, "").when(k % 16 != 4, "budget").alias("abandon_reason"),
    )


RUNS_SQL = """runs AS (
  SELECT *, CASE event_type
      WHEN 'purchase' THEN CASE WHEN run_id % 2 = 1 AND k % 3 <> 0 THEN 'job.commit' ELSE 'job.end' END
      WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'job.start' ELSE 'store.write' END
      WHEN 'click' THEN 'llm.call' WHEN 'view' THEN CASE WHEN k % 5 = 0 THEN 'node.error' ELSE 'node.end' END ELSE 'node.start' END AS event,
    k % 2 AS candidate, event_id AS seq, user_id AS job,
    CASE WHEN run_id = 6 OR k % 4 = 0 THEN 'abandoned' WHEN k % 7 = 0 THEN 'failed' ELSE 'success' END AS status,
    ['strict', 'strict_perf', 'basic', 'basic', 'basic'][k % 5 + 1] AS release_tier,
    CASE WHEN k % 11 <> 0 THEN k * 10 END AS input_tokens, k * 3 AS output_tokens, CASE WHEN run_id IN (1, 2) OR k % 5 <> 0 THEN value / 100 END AS cost_usd,
    CASE WHEN k % 9 <> 0 THEN ['generate', 'judge', 'critic', 'refval_extract'][k % 4 + 1] END AS role, CASE WHEN k % 3 <> 0 THEN 'repair' ELSE 'generate' END AS node,
    ['compile', 'refval', 'judge'][k % 3 + 1] AS gate, ['ORACLE', 'INFRA', 'KERNEL', 'TEACHER'][k % 4 + 1] AS owner, CASE WHEN k <> 7 THEN value END AS elapsed_s,
    CASE WHEN k % 8 = 0 THEN 'deadline' WHEN k % 12 = 0 THEN '' WHEN k % 16 <> 4 THEN 'budget' END AS abandon_reason
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(user_id % 8 AS INT) AS run_id FROM events))"""


def chats(t: Tables) -> DataFrame:
    """Archive rows from conversations: messages in turn order."""
    m = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return t.conversations.groupBy("conv_id").agg(m.alias("messages"))


def tensors(t: Tables) -> DataFrame:
    """Recorded outputs: embeddings as expected values, a copy as got that is perturbed, or
    holds NaN or Inf at place 3, or is missing."""
    v = F.col("vec_id")
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    base = F.transform("embedding", lambda x: x.cast("double"))
    bump = F.when(v % 5 == 0, 0.01).when(v % 3 == 0, 0.0001).otherwise(0.0)
    expected = F.transform(base, lambda x, i: F.when((i == 3) & (v % 11 == 0), inf).when((i == 3) & (v % 17 == 0), nan).otherwise(x))
    got = F.transform(base, lambda x, i: F.when((i == 3) & (v % 22 == 0), -inf).when((i == 3) & (v % 11 < 2), inf).when((i == 3) & ((v % 17 == 0) | (v % 13 == 0)), nan).otherwise(x + F.when(i % 7 == 0, bump).otherwise(0.0)))
    return t.embeddings.select(v.alias("case_id"), F.col("label").alias("job"), (v % 2 == 0).alias("allows_nan"), expected.alias("expected"), F.when(v % 19 != 0, got).alias("got"))


TENSORS_SQL = """elements AS (
  SELECT vec_id AS case_id, label AS job, vec_id % 2 = 0 AS allows_nan, vec_id % 19 = 0 AS missing, i,
    CASE WHEN i = 3 AND vec_id % 11 = 0 THEN 'inf'::DOUBLE WHEN i = 3 AND vec_id % 17 = 0 THEN 'nan'::DOUBLE ELSE CAST(embedding[i + 1] AS DOUBLE) END AS expected,
    CASE WHEN i = 3 AND vec_id % 22 = 0 THEN '-inf'::DOUBLE WHEN i = 3 AND vec_id % 11 < 2 THEN 'inf'::DOUBLE
      WHEN i = 3 AND (vec_id % 17 = 0 OR vec_id % 13 = 0) THEN 'nan'::DOUBLE
      ELSE CAST(embedding[i + 1] AS DOUBLE) + CASE WHEN i % 7 = 0 THEN CASE WHEN vec_id % 5 = 0 THEN 0.01::DOUBLE WHEN vec_id % 3 = 0 THEN 0.0001::DOUBLE ELSE 0.0::DOUBLE END ELSE 0.0::DOUBLE END END AS got
  FROM embeddings, LATERAL (SELECT unnest(range(0, len(embedding))) AS i))"""
