"""Queries over the trace of several runs: all indicators, their changes, repairs from outside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators.report import compared, outside_repairs, trace_report
from curatrix.plans.adapters import RUNS_SQL, runs
from curatrix.plans.base import Tables, query


def _report_sql(by: str) -> str:
    """The same report, a group's values in one place; by: the grouping column, or nothing."""
    key, group, on = (f"{by}, ", f"GROUP BY {by}", f"USING ({by})") if by else ("", "", "ON TRUE")
    return f"""WITH {RUNS_SQL}, flagged AS (SELECT r.*, c.commits > 0 AS committed FROM runs r JOIN (SELECT {key}count(*) FILTER (event = 'job.commit') AS commits FROM runs {group}) c {on}),
x AS (SELECT *, event = CASE WHEN committed THEN 'job.commit' ELSE 'job.end' END AS is_job, coalesce(elapsed_s, 0) AS spent, event = 'llm.call' AS is_call, event IN ('job.start', 'job.end', 'job.commit') AS stamped,
  lag(event) OVER w AS pe, lag(gate) OVER w AS pg, lag(owner) OVER w AS po FROM flagged WINDOW w AS (PARTITION BY run_id, job, candidate, event LIKE 'node.%' ORDER BY seq)),
roles AS (SELECT {key}string_agg(role || '=' || n, ',' ORDER BY role) AS s FROM (SELECT {key}coalesce(role, 'null') AS role, count(*) AS n FROM x WHERE is_call GROUP BY ALL) {group}),
reasons AS (SELECT {key}string_agg(reason || '=' || n, ',' ORDER BY reason) AS s FROM (SELECT {key}coalesce(nullif(abandon_reason, ''), 'unknown') AS reason, count(*) AS n FROM x WHERE is_job AND status = 'abandoned' GROUP BY ALL) {group}),
s AS (SELECT {key}count(*) FILTER (is_job) AS jobs, bool_or(committed) AS committed, count(*) FILTER (event = 'job.end') AS computed_jobs, count(*) FILTER (is_job AND status = 'success') AS success,
  count(*) FILTER (is_job AND release_tier IN ('strict', 'strict_perf')) AS strict, count(*) FILTER (is_job AND status IN ('success', 'abandoned')) AS finished, count(*) FILTER (is_call) AS calls,
  count(*) FILTER (is_call AND role = 'refval_extract') AS extracts, coalesce(sum(input_tokens) FILTER (is_call), 0) AS rd, coalesce(sum(output_tokens) FILTER (is_call), 0) AS wr,
  count(cost_usd) FILTER (is_call) AS priced, sum(cost_usd) FILTER (is_call) AS cost,
  CASE WHEN count(*) FILTER (stamped) > 1 THEN (epoch_us(max(ts) FILTER (stamped)) - epoch_us(min(ts) FILTER (stamped))) / 3.6e9 ELSE 0 END AS hours,
  quantile_cont(spent, 0.5) FILTER (is_job) AS p50, quantile_cont(spent, 0.95) FILTER (is_job) AS p95, quantile_cont(spent * 1000, 0.99) FILTER (event = 'store.write') AS p99, avg(spent) FILTER (is_job) AS mean,
  count(*) FILTER (event = 'node.start' AND node = 'repair' AND pe = 'node.end' AND pg IN ('compile', 'refval') AND po IN ('ORACLE', 'INFRA')) AS repairs FROM x {group}),
report AS (SELECT {key}jobs, CASE WHEN committed THEN 'commit' ELSE 'legacy_compute' END AS outcome_source, computed_jobs, success, round(success / nullif(jobs, 0), 4) AS success_rate, round(strict / nullif(jobs, 0), 4) AS strict_yield,
  calls AS llm_calls, coalesce(roles.s, '') AS llm_calls_by_role, round(calls / nullif(success, 0), 3) AS llm_calls_per_success, round(rd / nullif(success, 0), 1) AS input_tokens_per_success, round(wr / nullif(success, 0), 1) AS output_tokens_per_success,
  CASE WHEN calls > 0 AND priced = calls THEN round(cost / nullif(success, 0), 4) END AS cost_per_success, repairs AS infra_triggered_repairs, round(extracts / nullif(jobs, 0), 3) AS refval_extract_calls_per_job,
  CASE WHEN hours > 0 THEN round(finished / hours, 2) END AS throughput_jobs_per_hour, p50 AS job_latency_p50, p95 AS job_latency_p95, p99 AS store_write_p99_ms,
  NULL::DOUBLE AS gpu_utilization, NULL::DOUBLE AS false_accept_taskspec, NULL::DOUBLE AS false_accept_legacy, NULL::DOUBLE AS mutation_score, NULL::DOUBLE AS cot_consistency_pass,
  coalesce(reasons.s, '') AS abandon_reasons, round(mean, 2) AS mean_job_latency FROM s LEFT JOIN roles {on} LEFT JOIN reasons {on})"""


def _flat(report: DataFrame) -> DataFrame:
    """Maps as text, by key."""
    text = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return report.withColumns({c: text(F.col(c)) for c in ("llm_calls_by_role", "abandon_reasons")})


@query(f"{_report_sql('')} SELECT * FROM report")
def trace_indicators(t: Tables) -> DataFrame:
    """All 25 indicators over all runs, of which some commit: the commits are the jobs."""
    return _flat(trace_report(runs(t)))


@query(f"{_report_sql('run_id')} SELECT * FROM report")
def run_indicators(t: Tables) -> DataFrame:
    """All 25 indicators of each run; runs without a commit count the ends of their jobs."""
    return _flat(trace_report(runs(t), ["run_id"]))


_LONG = [("jobs", 1), ("outcome_source", 0), ("computed_jobs", 1), ("success", 1), ("success_rate", 1), ("llm_calls", 1), ("cost_per_success", 1), ("infra_triggered_repairs", 1), ("job_latency_p95", 1), ("store_write_p99_ms", 1)]


@query(f"""{_report_sql('run_id')}, long AS ({" UNION ALL ".join(f"SELECT run_id, '{n}' AS metric, {f'CAST({n} AS DOUBLE)' if number else 'NULL::DOUBLE'} AS v FROM report" for n, number in _LONG)})
SELECT a.run_id, a.metric, a.v AS number, b.v AS before, CASE WHEN b.v <> 0 AND a.v IS NOT NULL THEN CASE WHEN round((a.v - b.v) / b.v * 100, 1) >= 0 THEN '+' ELSE '' END || printf('%.1f', round((a.v - b.v) / b.v * 100, 1)) || '%' ELSE '' END AS change
FROM long a LEFT JOIN long b ON b.run_id = a.run_id - 1 AND a.metric = b.metric""")
def run_changes(t: Tables) -> DataFrame:
    """Each run's indicators beside those of the run before it."""
    report = trace_report(runs(t), ["run_id"]).select("run_id", *[n for n, _ in _LONG])
    out = compared(report, report.withColumn("run_id", F.col("run_id") + 1), ["run_id"])
    number = lambda c: F.when(F.col("metric") != "outcome_source", F.col(c)).cast("double")
    return out.select("run_id", "metric", number("value").alias("number"), number("previous").alias("before"), "change")


@query(f"WITH {RUNS_SQL}, n AS (SELECT *, lag(event) OVER w AS pe, lag(gate) OVER w AS pg, lag(owner) OVER w AS po FROM runs WHERE event LIKE 'node.%' WINDOW w AS (PARTITION BY run_id, job, candidate ORDER BY seq)) SELECT run_id, job, candidate, seq FROM n WHERE event = 'node.start' AND node = 'repair' AND pe = 'node.end' AND pg IN ('compile', 'refval') AND po IN ('ORACLE', 'INFRA')")
def repairs_from_outside(t: Tables) -> DataFrame:
    """Repairs that an oracle's or the infrastructure's failure set off, each by its run, job and candidate."""
    return outside_repairs(runs(t)).select("run_id", "job", "candidate", "seq")
