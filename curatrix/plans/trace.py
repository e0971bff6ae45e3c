"""Trace analytics and run integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatrix.operators.ordered import percentiles, running
from curatrix.plans.adapters import TRACE_SQL, trace
from curatrix.plans.base import Tables, query

T = f"WITH {TRACE_SQL}"
#: Rows of order lines that a task shares out by id.
ROWS_A_TASK = 2_000_000


@query(f"""{T} SELECT count(*) FILTER (event = 'job.end') AS jobs, count(*) FILTER (event = 'job.end' AND status = 'success') AS success,
  round(count(*) FILTER (event = 'job.end' AND status = 'success') / count(*) FILTER (event = 'job.end'), 4) AS success_rate,
  round(count(*) FILTER (event = 'job.end' AND release_tier = 'strict') / count(*) FILTER (event = 'job.end'), 4) AS strict_yield,
  count(*) FILTER (event = 'llm.call') AS llm_calls, round(CAST(sum(k) FILTER (event = 'llm.call') AS DOUBLE) / count(*) FILTER (event = 'job.end' AND status = 'success'), 1) AS tokens_per_success,
  quantile_cont(CAST(elapsed_s AS DOUBLE), 0.5) FILTER (event = 'job.end') AS latency_p50, quantile_cont(CAST(elapsed_s AS DOUBLE), 0.95) FILTER (event = 'job.end') AS latency_p95,
  (epoch_us(max(ts) FILTER (event IN ('job.start', 'job.end'))) - epoch_us(min(ts) FILTER (event IN ('job.start', 'job.end')))) AS wall_us FROM trace""")
def trace_kpis(t: Tables) -> DataFrame:
    """Nine indicators in one pass, percentiles by ranges of values; job ends are the population.
    ``trace_indicators`` has all of them."""
    end, ok = F.col("event") == "job.end", (F.col("event") == "job.end") & (F.col("status") == "success")
    call, wall = F.col("event") == "llm.call", F.col("event").isin("job.start", "job.end")
    n, s = F.count_if(end), F.count_if(ok)
    micros = F.unix_micros(F.when(wall, F.col("ts")))
    waits = percentiles(trace(t).where(end), "elapsed_s", {"latency_p50": 0.5, "latency_p95": 0.95})
    sums = trace(t).agg(
        n.alias("jobs"), s.alias("success"), F.round(s / n, 4).alias("success_rate"), F.round(F.count_if(end & (F.col("release_tier") == "strict")) / n, 4).alias("strict_yield"),
        F.count_if(call).alias("llm_calls"), F.round(F.sum(F.when(call, F.col("k"))).cast("double") / s, 1).alias("tokens_per_success"), (F.max(micros) - F.min(micros)).alias("wall_us"),
    )
    return sums.join(F.broadcast(waits))  # one row beside one row


@query(f"{T} SELECT job, provider, CASE WHEN count(cost_usd) = count(*) AND count(*) FILTER (status = 'success') > 0 THEN round(sum(cost_usd) / count(*) FILTER (status = 'success') + 1e-9, 4) END AS cost_per_success, count(*) AS calls, count(cost_usd) AS priced FROM trace WHERE event = 'llm.call' GROUP BY job, provider")
def cost_per_success(t: Tables) -> DataFrame:
    """Of each job and provider; null unless every call is priced and one succeeds. Ties of the fifth digit go up."""
    ok = F.count_if(F.col("status") == "success")
    cost = F.when((F.count("cost_usd") == F.count("*")) & (ok > 0), F.round(F.sum("cost_usd") / ok + 1e-9, 4))
    return trace(t).where("event = 'llm.call'").groupBy("job", "provider").agg(cost.alias("cost_per_success"), F.count("*").alias("calls"), F.count("cost_usd").alias("priced"))


@query(f"{T} SELECT status, quantile_cont(CAST(elapsed_s AS DOUBLE), 0.5) AS p50, quantile_cont(CAST(elapsed_s AS DOUBLE), 0.95) AS p95, quantile_cont(CAST(elapsed_s AS DOUBLE), 0.99) AS p99 FROM trace WHERE event = 'job.end' GROUP BY status")
def latency_percentiles(t: Tables) -> DataFrame:
    return percentiles(trace(t).where("event = 'job.end'"), "elapsed_s", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, ["status"])


@query(f"{T}, o AS (SELECT role, elapsed_s, row_number() OVER (PARTITION BY role ORDER BY elapsed_s) AS rn, count(*) OVER (PARTITION BY role) AS n FROM trace WHERE event = 'llm.call') SELECT role, max(elapsed_s) FILTER (rn = ceil(n * 0.5)) AS p50, max(elapsed_s) FILTER (rn = ceil(n * 0.95)) AS p95 FROM o GROUP BY role")
def nearest_rank_percentiles(t: Tables) -> DataFrame:
    """Nearest rank: the least value with at least that share at or below it."""
    return percentiles(trace(t).where("event = 'llm.call'"), "elapsed_s", {"p50": 0.5, "p95": 0.95}, ["role"], nearest=True)


@query(f"{T}, n AS (SELECT *, lag(event) OVER w AS pe, lag(gate) OVER w AS pg, lag(owner) OVER w AS po FROM trace WHERE event IN ('node.start', 'node.end') WINDOW w AS (PARTITION BY job, candidate ORDER BY seq)) SELECT job, count(*) AS infra_repairs FROM n WHERE event = 'node.start' AND node = 'repair' AND pe = 'node.end' AND pg IN ('compile', 'refval') AND po IN ('ORACLE', 'INFRA') GROUP BY job")
def infra_repairs(t: Tables) -> DataFrame:
    w = Window.partitionBy("job", "candidate").orderBy("seq")
    nodes = trace(t).where(F.col("event").isin("node.start", "node.end")).select("*", *[F.lag(c).over(w).alias(f"p_{c}") for c in ("event", "gate", "owner")])
    hit = "event = 'node.start' and node = 'repair' and p_event = 'node.end' and p_gate in ('compile', 'refval') and p_owner in ('ORACLE', 'INFRA')"
    return nodes.where(hit).groupBy("job").agg(F.count("*").alias("infra_repairs"))


SPANS = f"{T}, spans AS (SELECT seq, job, role, candidate, epoch_us(ts) - CAST(round(elapsed_s * 1000000) AS BIGINT) AS s, epoch_us(ts) AS e FROM trace WHERE event = 'llm.call')"


def spans(t: Tables) -> DataFrame:
    end = F.unix_micros("ts")
    return trace(t).where("event = 'llm.call'").select("seq", "job", "role", "candidate", (end - F.round(F.col("elapsed_s") * 1000000).cast("long")).alias("s"), end.alias("e"))


@query(f"{SPANS}, edges AS (SELECT role, s AS moment, 1 AS d FROM spans UNION ALL SELECT role, e, -1 FROM spans) SELECT role, max(c) AS peak FROM (SELECT role, sum(d) OVER (PARTITION BY role ORDER BY moment, d ROWS UNBOUNDED PRECEDING) AS c FROM edges) GROUP BY role")
def peak_concurrency(t: Tables) -> DataFrame:
    """Closes precede opens at ties. Equal edges are summed before the sweep, whose running sum
    carries over ranges of time."""
    x = spans(t)
    edges = x.select("role", F.col("s").alias("at"), F.lit(1).alias("d")).unionByName(x.select("role", F.col("e").alias("at"), F.lit(-1).alias("d"))).groupBy("role", "at", "d").agg(F.sum("d").alias("n"))
    return running(edges, [F.col("at"), F.col("d")], {"c": F.col("n")}, ["role"]).groupBy("role").agg(F.max("c").alias("peak"))


@query(f"{SPANS}, long AS (SELECT job, candidate, e - (e - s) * 600 AS s, e FROM spans WHERE s < e) SELECT l.job, count(*) AS overlaps FROM long l JOIN long r ON l.job = r.job AND l.candidate < r.candidate AND l.s < r.e AND r.s < l.e GROUP BY l.job")
def candidate_overlap(t: Tables) -> DataFrame:
    """Overlapping calls of different candidates of a job, seconds taken as ten minutes. Of all
    pairs of a group, those are apart whose one ends before the other starts; a sweep counts
    these. Pairs of one candidate are then taken from those of the job."""
    x = spans(t).where("s < e").select("job", "candidate", (F.col("e") - (F.col("e") - F.col("s")) * 600).alias("s"), "e")
    edges = x.select("job", "candidate", F.explode(F.array(F.struct(F.col("e").alias("at"), F.lit(0).alias("start")), F.struct(F.col("s").alias("at"), F.lit(1).alias("start")))).alias("p")).select("job", "candidate", "p.*")

    def pairs(by: list[str]) -> DataFrame:
        summed = edges.groupBy(*by, "at", "start").agg(F.count("*").alias("n"))
        swept = running(summed, [F.col("at"), F.col("start")], {"ended": F.when(F.col("start") == 0, F.col("n")).otherwise(0)}, by)
        begun = F.when(F.col("start") == 1, F.col("n")).otherwise(0)
        return swept.groupBy(*by).agg(F.sum(begun).alias("n"), F.sum(begun * F.col("ended")).alias("apart")).select("job", (F.col("n") * (F.col("n") - 1) / 2 - F.col("apart")).cast("long").alias("pairs"))

    signed = pairs(["job"]).unionByName(pairs(["job", "candidate"]).select("job", (-F.col("pairs")).alias("pairs")))
    return signed.groupBy("job").agg(F.sum("pairs").alias("overlaps")).where("overlaps > 0")


@query(f"{T}, m AS (SELECT *, count(*) FILTER (event = 'job.start') OVER (PARTITION BY job ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run FROM trace) SELECT job, run, sum(k) FILTER (event = 'llm.call') AS tokens, count(*) FILTER (event = 'llm.call') AS calls FROM m WHERE run > 0 GROUP BY job, run")
def job_token_rollup(t: Tables) -> DataFrame:
    """Tokens since the latest start of the job."""
    w = Window.partitionBy("job").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    call = F.col("event") == "llm.call"
    runs = trace(t).withColumn("run", F.count_if(F.col("event") == "job.start").over(w)).where("run > 0")
    return runs.groupBy("job", "run").agg(F.sum(F.when(call, F.col("k").cast("long"))).alias("tokens"), F.count_if(call).alias("calls"))


@query(f"{T} SELECT node, gate, count(*) AS n, round(sum(elapsed_s), 4) AS elapsed_s FROM trace WHERE event = 'node.end' GROUP BY node, gate")
def node_elapsed(t: Tables) -> DataFrame:
    return trace(t).where("event = 'node.end'").groupBy("node", "gate").agg(F.count("*").alias("n"), F.round(F.sum("elapsed_s"), 4).alias("elapsed_s"))


@query(f"{T} SELECT job, role, count(*) AS calls, string_agg(DISTINCT provider, ',' ORDER BY provider) AS routes FROM trace WHERE event = 'llm.call' AND status = 'success' GROUP BY job, role")
def roles_and_routes(t: Tables) -> DataFrame:
    return trace(t).where("event = 'llm.call' and status = 'success'").groupBy("job", "role").agg(F.count("*").alias("calls"), F.array_join(F.array_sort(F.collect_set("provider")), ",").alias("routes"))


@query(f"{T}, p AS (SELECT seq, job, event, lead(event) OVER (PARTITION BY job, candidate ORDER BY seq) AS ne, lead(seq) OVER (PARTITION BY job, candidate ORDER BY seq) AS nseq FROM trace WHERE event LIKE 'node.%') SELECT job, seq AS start_seq, nseq AS end_seq FROM p WHERE event = 'node.start' AND ne = 'node.end'")
def span_pairs(t: Tables) -> DataFrame:
    w = Window.partitionBy("job", "candidate").orderBy("seq")
    nodes = trace(t).where(F.col("event").startswith("node.")).select("job", "seq", "event", F.lead("event").over(w).alias("next"), F.lead("seq").over(w).alias("end_seq"))
    return nodes.where("event = 'node.start' and next = 'node.end'").select("job", F.col("seq").alias("start_seq"), "end_seq")


@query(f"{T}, h AS (SELECT role, CAST(count(*) FILTER (seq % 2 = 0) AS DOUBLE) AS cur, CAST(count(*) FILTER (seq % 2 = 1) AS DOUBLE) AS prev FROM trace WHERE event = 'llm.call' GROUP BY role) SELECT role AS metric, cur, prev, round((cur - prev) / nullif(prev, 0) * 100, 2) AS delta_pct FROM h")
def kpi_delta(t: Tables) -> DataFrame:
    """Metrics of a run against the previous one."""
    calls = trace(t).where("event = 'llm.call'")
    side = lambda r, n: calls.where(F.col("seq") % 2 == r).groupBy(F.col("role").alias("metric")).agg(F.count("*").cast("double").alias(n))
    both = side(0, "cur").join(side(1, "prev"), "metric", "full")
    cur, prev = F.coalesce("cur", F.lit(0.0)), F.coalesce("prev", F.lit(0.0))
    return both.select("metric", cur.alias("cur"), prev.alias("prev"), F.round((cur - prev) / F.nullif(prev, F.lit(0.0)) * 100, 2).alias("delta_pct"))


@query("SELECT o_orderpriority AS artifact, count(*) AS n, count(*) - count(DISTINCT o_custkey) AS duplicates, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS extraneous FROM orders GROUP BY ALL")
def artifact_counts(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderpriority").alias("artifact")).agg(F.count("*").alias("n"), (F.count("*") - F.countDistinct("o_custkey")).alias("duplicates"), F.count_if(~F.col("o_orderstatus").isin("F", "O")).alias("extraneous"))


@query("""WITH e AS (SELECT c_custkey AS id FROM customer), p AS (SELECT o_custkey AS id, count(*) AS n FROM orders GROUP BY ALL), s AS (SELECT o_custkey AS id, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL)
SELECT CASE WHEN p.id IS NULL THEN 'missing' WHEN s.id IS NULL THEN 'no_sample' WHEN s.n > 1 THEN 'duplicate' ELSE 'ok' END AS state, count(*) AS n FROM e LEFT JOIN p ON e.id = p.id LEFT JOIN s ON e.id = s.id GROUP BY ALL""")
def run_reconciliation(t: Tables) -> DataFrame:
    """Expected ids against progress and samples, both summed in one pass over the orders."""
    seen = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("samples"))
    state = F.when(F.col("n").isNull(), "missing").when(F.col("samples") == 0, "no_sample").when(F.col("samples") > 1, "duplicate").otherwise("ok")
    return t.customer.select(F.col("c_custkey").alias("id")).join(seen, "id", "left").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


@query("WITH o AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F'), l AS (SELECT l_orderkey AS id FROM lineitem WHERE l_returnflag <> 'A') SELECT id, 'no_lines' AS kind FROM o WHERE id NOT IN (SELECT id FROM l) UNION ALL SELECT DISTINCT id, 'no_order' FROM l WHERE id NOT IN (SELECT id FROM o)")
def orphans(t: Tables) -> DataFrame:
    """Open orders without lines that stay, and such lines' orders that aren't open."""
    # Sorted ids compress so well that their bytes say little: rows decide how many tasks share them.
    n = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), -(-t.lineitem.count() // ROWS_A_TASK))
    o = t.orders.where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("id")).repartition(n, "id")
    l = t.lineitem.where("l_returnflag <> 'A'").select(F.col("l_orderkey").alias("id")).repartition(n, "id").distinct()
    return o.join(l, "id", "left_anti").withColumn("kind", F.lit("no_lines")).unionByName(l.join(o, "id", "left_anti").withColumn("kind", F.lit("no_order")))


@query(f"{T}, c AS (SELECT job, seq, row_number() OVER (PARTITION BY job ORDER BY seq) AS call_no FROM trace WHERE event = 'llm.call') SELECT job, count(*) AS calls, count(*) FILTER (call_no <= 5) AS within_budget FROM c GROUP BY job")
def call_budget(t: Tables) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("job").orderBy("seq"))
    return trace(t).where("event = 'llm.call'").select("job", n.alias("n")).groupBy("job").agg(F.count("*").alias("calls"), F.count_if(F.col("n") <= 5).alias("within_budget"))


@query(f"{T} SELECT job, max(elapsed_s) > 90 AS timed_out, count(*) FILTER (elapsed_s > 90) AS late FROM trace WHERE event IN ('job.end', 'node.end') GROUP BY job")
def deadline_timeouts(t: Tables) -> DataFrame:
    late = F.col("elapsed_s") > 90
    return trace(t).where(F.col("event").isin("job.end", "node.end")).groupBy("job").agg((F.max("elapsed_s") > 90).alias("timed_out"), F.count_if(late).alias("late"))
