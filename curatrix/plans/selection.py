"""Selection, gates and publication queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatrix.operators import selection as S
from curatrix.plans.adapters import POOL_SQL, pool
from curatrix.plans.base import Tables, query

TIE = ["l_partkey", "l_suppkey"]
ORDER = "k_pass DESC, k_cases DESC, k_critic DESC, k_repairs DESC, k_speedup DESC, k_score DESC, k_candidate DESC, l_partkey DESC, l_suppkey DESC"


@query(f"WITH {POOL_SQL} SELECT job, candidate, repairs, score, speedup, n_eligible FROM (SELECT *, row_number() OVER (PARTITION BY job ORDER BY {ORDER}) AS rn, count(*) OVER (PARTITION BY job) AS n_eligible FROM ranked WHERE ok) WHERE rn = 1")
def winner_per_job(t: Tables) -> DataFrame:
    return S.best_per_job(pool(t), ["candidate", "repairs", "score", "speedup"], TIE)


@query(f"WITH {POOL_SQL} SELECT k_pass, k_cases, k_critic, k_repairs, count(*) AS n, max(k_speedup) AS best_speedup FROM ranked GROUP BY ALL")
def rank_components(t: Tables) -> DataFrame:
    return pool(t).select(*S.rank_columns()).groupBy("k_pass", "k_cases", "k_critic", "k_repairs").agg(F.count("*").alias("n"), F.max("k_speedup").alias("best_speedup"))


@query(f"""WITH {POOL_SQL}, a AS (
  SELECT *, row_number() OVER (PARTITION BY job, candidate ORDER BY l_partkey, l_suppkey, speedup, score, q) AS arrival,
    row_number() OVER (PARTITION BY job, candidate ORDER BY k_pass, k_cases, k_critic, k_repairs, k_speedup, k_score) AS r FROM ranked),
d AS (SELECT *, dense_rank() OVER (PARTITION BY job, candidate ORDER BY k_pass, k_cases, k_critic, k_repairs, k_speedup, k_score) AS dr FROM a),
b AS (SELECT *, max(dr) OVER (PARTITION BY job, candidate ORDER BY arrival) AS best FROM d)
SELECT job, candidate, count(*) AS version, max(arrival) AS kept_arrival FROM b WHERE dr = best GROUP BY ALL""")
def version_merge(t: Tables) -> DataFrame:
    return S.merge_versions(pool(t), ["l_partkey", "l_suppkey", "speedup", "score", "q"])


@query(f"""WITH {POOL_SQL} SELECT refval_status, coalesce(critic_status, 'skipped') AS critic_status, compile, count(*) AS n, sum(CAST(ok AS INT)) AS n_eligible, round(avg(repairs), 6) AS mean_repairs FROM ranked GROUP BY ALL""")
def candidate_pool_summary(t: Tables) -> DataFrame:
    return pool(t).groupBy("refval_status", F.coalesce("critic_status", F.lit("skipped")).alias("critic_status"), "compile").agg(F.count("*").alias("n"), F.sum(S.eligible().cast("int")).alias("n_eligible"), F.round(F.avg("repairs"), 6).alias("mean_repairs"))


@query(f"""WITH {POOL_SQL} SELECT CASE WHEN critic_status = 'failed' THEN 'critic' WHEN refval_status <> 'pass' THEN 'status' WHEN cases_run < 3 THEN 'cases' WHEN score = 0 THEN 'manifest' WHEN critic_status IS NULL THEN 'no_critic' ELSE 'publish' END AS veto, count(*) AS n FROM pool GROUP BY ALL""")
def publish_veto(t: Tables) -> DataFrame:
    """Why the strict policy keeps a row from publication, in the order of its checks."""
    veto = F.when(F.col("critic_status") == "failed", "critic").when(F.col("refval_status") != "pass", "status").when(F.col("cases_run") < S.MIN_CASES, "cases").when(F.col("score") == 0, "manifest").when(F.col("critic_status").isNull(), "no_critic").otherwise("publish")
    return pool(t).groupBy(veto.alias("veto")).agg(F.count("*").alias("n"))


@query(f"""WITH {POOL_SQL} SELECT job, min(candidate) AS first_candidate, count(*) AS n_passing FROM ranked WHERE ok GROUP BY job""")
def first_passing_attempt(t: Tables) -> DataFrame:
    return pool(t).where(S.eligible()).groupBy("job").agg(F.min("candidate").alias("first_candidate"), F.count("*").alias("n_passing"))


@query(f"""WITH {POOL_SQL}, f AS (SELECT job, candidate, repairs, row_number() OVER (PARTITION BY job ORDER BY candidate, repairs, l_partkey, l_suppkey) AS rn, compile = 'pass' AND refval_status = 'pass' AS good FROM pool)
SELECT a.job, a.rn AS attempt, (SELECT count(*) FROM f b WHERE b.job = a.job AND b.rn < a.rn AND b.rn >= a.rn - 3 AND NOT b.good) AS n_earlier FROM f a WHERE a.good""")
def earlier_failures(t: Tables) -> DataFrame:
    """Failed attempts among the last three before each good one."""
    w = Window.partitionBy("job").orderBy("candidate", "repairs", "l_partkey", "l_suppkey")
    good = (F.col("compile") == "pass") & (F.col("refval_status") == "pass")
    rows = pool(t).select("job", F.row_number().over(w).alias("attempt"), good.alias("good"), F.count_if(~good).over(w.rowsBetween(-3, -1)).alias("n_earlier"))
    return rows.where("good").select("job", "attempt", "n_earlier")


@query(f"""WITH {POOL_SQL} SELECT CASE WHEN refval_status = 'pass' THEN '' WHEN q % 6 = 0 THEN 'ORACLE' WHEN q % 6 = 1 THEN 'INFRA' ELSE 'KERNEL' END AS owner,
  CASE WHEN refval_status = 'pass' THEN '' WHEN q % 6 = 0 THEN 'extract_failed' WHEN q % 6 = 1 THEN 'harness_build_error' WHEN q % 6 = 2 THEN 'crash' ELSE 'numeric_mismatch' END AS error_class, count(*) AS n FROM pool GROUP BY ALL""")
def refval_owner(t: Tables) -> DataFrame:
    from curatrix.operators.gates import refval_owner as owner

    q = F.col("q")
    rows = t.lineitem.select(F.col("l_quantity").cast("int").alias("q"), F.when(F.col("l_returnflag") == "R", "fail").otherwise("pass").alias("status"))
    reason = F.when(q % 6 == 0, "extract failed").when(q % 6 == 1, "harness.cu(3): error: bad\nharness.cu(9): error: worse").otherwise("solution.cu(1): error: x")
    error_class = F.when(q % 6 == 1, "signature_mismatch").when(q % 6 == 2, "crash").otherwise("")
    rows = rows.select("status", reason.alias("reason"), error_class.alias("error_class"))
    return rows.select(owner("status", "reason", "error_class", extract_failed="extract failed").alias("o")).groupBy(F.col("o.owner").alias("owner"), F.col("o.error_class").alias("error_class")).agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN ok THEN '' WHEN lower(msg) LIKE '%failed to launch nvcc%' OR lower(msg) LIKE '%filenotfounderror%' OR (out = '' AND (lower(msg) LIKE '%timeout%' OR lower(msg) LIKE '%timed out%')) THEN 'INFRA' ELSE 'KERNEL' END AS owner, count(*) AS n
FROM (SELECT event_type <> 'error' AND value < 80 AS ok, CASE WHEN value < 20 THEN 'Failed to launch nvcc' WHEN value < 40 THEN 'nvcc timed out' WHEN value < 60 THEN 'FileNotFoundError: nvcc' ELSE 'error: identifier undefined' END AS msg, CASE WHEN event_id % 2 = 0 THEN '' ELSE 'log' END AS out FROM events) GROUP BY ALL""")
def compile_owner(t: Tables) -> DataFrame:
    from curatrix.operators.gates import compile_owner as owner

    v = F.col("value")
    msg = F.when(v < 20, "Failed to launch nvcc").when(v < 40, "nvcc timed out").when(v < 60, "FileNotFoundError: nvcc").otherwise("error: identifier undefined")
    rows = t.events.select(((F.col("event_type") != "error") & (v < 80)).alias("ok"), msg.alias("error_text"), F.when(F.col("event_id") % 2 == 0, "").otherwise("log").alias("output"))
    return rows.groupBy(owner("ok", "error_text", "output").alias("owner")).agg(F.count("*").alias("n"))


@query(f"""WITH {POOL_SQL} SELECT CASE WHEN q % 11 = 0 THEN 'off' WHEN refval_status = 'fail' THEN 'forced' WHEN q % 5 = 0 THEN 'topology' WHEN score < 8 THEN 'score' ELSE 'skip' END AS decision, count(*) AS n FROM pool GROUP BY ALL""")
def critic_trigger(t: Tables) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    score = F.round(F.col("l_discount") * 100).cast("int")
    decision = F.when(q % 11 == 0, "off").when(F.col("l_returnflag") == "R", "forced").when(q % 5 == 0, "topology").when(score < 8, "score").otherwise("skip")
    return t.lineitem.groupBy(decision.alias("decision")).agg(F.count("*").alias("n"))


@query(f"""WITH {POOL_SQL}, k AS (SELECT job, candidate, md5(CAST(l_partkey AS VARCHAR) || ':' || CAST(candidate AS VARCHAR)) AS sample_key, speedup FROM ranked WHERE ok),
archive AS (SELECT DISTINCT sample_key FROM k WHERE job % 3 = 0)
SELECT sample_key, count(*) AS n, min(job) AS first_job FROM k WHERE job % 3 <> 0 AND sample_key NOT IN (SELECT sample_key FROM archive) GROUP BY ALL""")
def sample_dedupe(t: Tables) -> DataFrame:
    """Rows whose key the archive lacks, one per key."""
    keyed = pool(t).where(S.eligible()).select("job", F.md5(F.concat_ws(":", "l_partkey", "candidate").cast("binary")).alias("sample_key"))
    fresh = keyed.where("job % 3 <> 0").join(keyed.where("job % 3 = 0").select("sample_key"), "sample_key", "left_anti")
    return fresh.groupBy("sample_key").agg(F.count("*").alias("n"), F.min("job").alias("first_job"))


@query(f"""WITH {POOL_SQL} SELECT job, compile, refval_status, count(*) AS n_attempts FROM pool WHERE NOT (compile = 'pass' AND refval_status = 'pass') GROUP BY ALL""")
def abandoned_dedupe(t: Tables) -> DataFrame:
    failed = pool(t).where("not (compile = 'pass' and refval_status = 'pass')")
    return failed.groupBy("job", "compile", "refval_status").agg(F.count("*").alias("n_attempts"))


@query(f"""WITH {POOL_SQL} SELECT job, candidate, arg_max(speedup, (l_partkey, l_suppkey, speedup)) AS speedup, count(*) AS n_seen FROM pool GROUP BY ALL""")
def snapshot_upsert(t: Tables) -> DataFrame:
    """The last snapshot of each candidate by arrival keys."""
    last = F.max(F.struct("l_partkey", "l_suppkey", "speedup")).alias("r")
    return pool(t).groupBy("job", "candidate").agg(last, F.count("*").alias("n_seen")).select("job", "candidate", "r.speedup", "n_seen")
