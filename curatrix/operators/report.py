"""The indicators of a trace, by run or over all runs.

Events have run_id, job, candidate, seq (their order), ts, event, status, release_tier,
input_tokens, output_tokens, cost_usd, role, node, gate, owner, elapsed_s and abandon_reason.
Jobs are counted from their commits; a group that holds none is counted from the ends of jobs.
What lacks a denominator is null. Percentiles are exact and come from ranges of values, so
one run may hold any number of events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.operators.ordered import beside, percentiles

COMMIT, END, CALL, WRITE = "job.commit", "job.end", "llm.call", "store.write"
# What a repair must follow to count as caused from outside, and the strict tiers.
OUTSIDE_GATES, OUTSIDE_OWNERS, STRICT = ("compile", "refval"), ("ORACLE", "INFRA"), ("strict", "strict_perf")
#: Indicators that need what a trace doesn't hold.
UNMEASURED = ("gpu_utilization", "false_accept_taskspec", "false_accept_legacy", "mutation_score", "cot_consistency_pass")


def outside_repairs(events: DataFrame) -> DataFrame:
    """The starts of a repair straight after the end of a compile or validation node that failed
    from outside, within a run, job and candidate. Any other node event in between clears it."""
    order = Window.partitionBy("run_id", "job", "candidate").orderBy("seq")
    nodes = events.where(F.col("event").isin("node.start", "node.end", "node.error"))
    nodes = nodes.select("*", *[F.lag(c).over(order).alias(f"__{c}") for c in ("event", "gate", "owner")])
    caused = (F.col("__event") == "node.end") & F.col("__gate").isin(*OUTSIDE_GATES) & F.col("__owner").isin(*OUTSIDE_OWNERS)
    return nodes.where((F.col("event") == "node.start") & (F.col("node") == "repair") & caused).select(events.columns)


def _tally(rows: DataFrame, by: Sequence[str], key: Column, name: str) -> DataFrame:
    """A map of how often each key occurs in a group."""
    counted = rows.groupBy(*by, key.alias("__key")).agg(F.count("*").alias("__n"))
    return counted.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__key", "__n")))).alias(name))


def trace_report(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row a group (or one in all) with every indicator. A trace without events has no groups."""
    event, status = F.col("event"), F.col("status")
    call = event == CALL
    spent = F.coalesce("elapsed_s", F.lit(0.0))
    stamped = event.isin("job.start", END, COMMIT) & F.col("ts").isNotNull()
    micros = F.unix_micros(F.when(stamped, F.col("ts")))

    def of_jobs(kind: str) -> list[Column]:
        """Sums over the jobs as that kind of event tells them, in one struct."""
        job = event == kind
        return [F.struct(
            F.count_if(job).alias("jobs"), F.count_if(job & (status == "success")).alias("success"), F.count_if(job & F.col("release_tier").isin(*STRICT)).alias("strict"),
            F.count_if(job & status.isin("success", "abandoned")).alias("finished"), F.avg(F.when(job, spent)).alias("mean"),
        ).alias(kind.split(".")[1])]

    sums = events.groupBy(*by).agg(
        *of_jobs(COMMIT), *of_jobs(END), F.count_if(call).alias("calls"), F.count_if(call & (F.col("role") == "refval_extract")).alias("extracts"),
        F.coalesce(F.sum(F.when(call, F.col("input_tokens"))), F.lit(0)).alias("read"), F.coalesce(F.sum(F.when(call, F.col("output_tokens"))), F.lit(0)).alias("wrote"),
        F.count(F.when(call, F.col("cost_usd"))).alias("priced"), F.sum(F.when(call, F.col("cost_usd"))).alias("cost"),
        F.when(F.count_if(stamped) > 1, (F.max(micros) - F.min(micros)) / 3.6e9).otherwise(0.0).alias("hours"),
    )
    sums = sums.withColumn("j", F.when(F.col("commit.jobs") > 0, F.col("commit")).otherwise(F.col("end")))
    ended = events.where(event.isin(COMMIT, END)).select(*by, "event", "status", "abandon_reason", spent.alias("elapsed_s"))
    keys = [*by, "event"]
    waits = percentiles(ended, "elapsed_s", {"p50": 0.5, "p95": 0.95}, keys)
    reasons = _tally(ended.where("status = 'abandoned'"), keys, F.coalesce(F.nullif("abandon_reason", F.lit("")), F.lit("unknown")), "reasons")
    out = sums
    for kind in (COMMIT, END):
        for part, names in ((waits, ("p50", "p95")), (reasons, ("reasons",))):
            named = part.where(F.col("event") == kind).select(*by, *[F.col(n).alias(f"{n}_{kind.split('.')[1]}") for n in names])
            out = beside(out, named, by)
    writes = events.where(event == WRITE).select(*by, (spent * 1000).alias("millis"))
    out = beside(out, percentiles(writes, "millis", {"write_p99": 0.99}, by), by)
    out = beside(out, _tally(events.where(call), by, F.coalesce("role", F.lit("null")), "roles"), by)
    out = beside(out, outside_repairs(events).groupBy(*by).agg(F.count("*").alias("repairs")), by)
    committed = F.col("commit.jobs") > 0
    jobs, success = F.nullif(F.col("j.jobs"), F.lit(0)), F.nullif(F.col("j.success"), F.lit(0))
    picked = lambda name: F.when(committed, F.col(f"{name}_commit")).otherwise(F.col(f"{name}_end"))
    none = F.create_map().cast("map<string,bigint>")
    return out.select(
        *by, F.col("j.jobs").alias("jobs"), F.when(committed, "commit").otherwise("legacy_compute").alias("outcome_source"), F.col("end.jobs").alias("computed_jobs"), F.col("j.success").alias("success"),
        F.round(F.col("j.success") / jobs, 4).alias("success_rate"), F.round(F.col("j.strict") / jobs, 4).alias("strict_yield"),
        F.col("calls").alias("llm_calls"), F.coalesce("roles", none).alias("llm_calls_by_role"), F.round(F.col("calls") / success, 3).alias("llm_calls_per_success"),
        F.round(F.col("read") / success, 1).alias("input_tokens_per_success"), F.round(F.col("wrote") / success, 1).alias("output_tokens_per_success"),
        F.when((F.col("calls") > 0) & (F.col("priced") == F.col("calls")), F.round(F.col("cost") / success, 4)).alias("cost_per_success"),
        F.coalesce("repairs", F.lit(0)).alias("infra_triggered_repairs"), F.round(F.col("extracts") / jobs, 3).alias("refval_extract_calls_per_job"),
        F.when(F.col("hours") > 0, F.round(F.col("j.finished") / F.col("hours"), 2)).alias("throughput_jobs_per_hour"),
        picked("p50").alias("job_latency_p50"), picked("p95").alias("job_latency_p95"), F.col("write_p99").alias("store_write_p99_ms"),
        *[F.lit(None).cast("double").alias(n) for n in UNMEASURED],
        F.coalesce(picked("reasons"), none).alias("abandon_reasons"), F.round(F.col("j.mean"), 2).alias("mean_job_latency"),
    )


def plain_indicators(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The report's single numbers and names, one row each: (group, metric, value, number)."""
    kinds = {n: t for n, t in report.dtypes if n not in by and not t.startswith("map")}
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("string").alias("value"), (F.lit(None) if t == "string" else F.col(n)).cast("double").alias("number")) for n, t in kinds.items()])
    return report.select(*by, F.explode(rows).alias("m")).select(*by, "m.*")


def compared(report: DataFrame, previous: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each indicator beside that of an earlier report, with the change in percent to one place
    and with its sign; none where either is missing or the earlier one is zero."""
    now, before = plain_indicators(report, by), plain_indicators(previous, by).withColumnsRenamed({"value": "previous", "number": "__before"})
    both = beside(now, before, [*by, "metric"])
    change = F.round((F.col("number") - F.col("__before")) / F.nullif("__before", F.lit(0.0)) * 100, 1)
    signed = F.concat(F.when(change >= 0, "+").otherwise(""), F.format_string("%.1f", change), F.lit("%"))
    return both.select(*by, "metric", "value", "previous", F.when(change.isNotNull(), signed).otherwise("").alias("change"))
