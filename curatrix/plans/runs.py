"""Budgets of chats, calls by job key, program output, manifests of questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators.budget import fit_messages
from curatrix.operators.runs import call_coverage, manifest_status
from curatrix.plans.base import Tables, query
from curatrix.sources.lines import last_object


def _tok(x: str) -> str:
    other = rf"length(regexp_replace({x}, '[\x00-\x7F]', '', 'g'))"
    return f"((length({x}) - {other} + 3) // 4 + {other})"


MARK_SQL = "(chr(10) || '...[truncated]...' || chr(10))"
HEAD_SQL = "(CASE WHEN r >= 2 THEN least(r - 1, greatest(1, CAST(round_even(r * 0.3::DOUBLE, 0) AS BIGINT))) ELSE 0 END)"


@query(f"""WITH turns AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role <> 'system'),
costs AS (SELECT conv_id, i, n - 1 + n % 2 AS m, text, {_tok('text')} + 4 AS cost FROM turns WHERE i < n - 1 + n % 2),
tails AS (SELECT *, sum(cost) OVER (PARTITION BY conv_id ORDER BY i DESC) AS rest FROM costs),
system AS (SELECT conv_id, coalesce(max(text) FILTER (role = 'system'), '') AS system, 20 + 60 * (conv_id % 9) AS lim FROM conversations GROUP BY conv_id),
chosen AS (SELECT conv_id, any_value(system) AS system, any_value(lim) AS lim, any_value(m) AS m, max(text) FILTER (i = m - 1) AS latest, max(cost) FILTER (i = m - 1) AS c_latest, max(cost) FILTER (i = 0) AS c_first,
  coalesce(min(i) FILTER (i % 2 = 1 AND i <= m - 2 AND c_first_of + rest + {_tok('system')} + 4 <= lim), greatest(any_value(m) - 2, 1)) AS start
  FROM (SELECT *, max(cost) FILTER (i = 0) OVER (PARTITION BY conv_id) AS c_first_of FROM tails JOIN system USING (conv_id)) GROUP BY conv_id),
used AS (SELECT c.*, c_first + coalesce(t.rest, 0) AS used FROM chosen c LEFT JOIN tails t ON t.conv_id = c.conv_id AND t.i = c.start),
ends AS (SELECT conv_id, max(r) AS r FROM (SELECT *, unnest(range(0, length(system) + 1)) AS r FROM used) WHERE {_tok('right(system, r)')} <= greatest(0, lim - 4 - used) GROUP BY conv_id),
cut AS (SELECT u.*, CASE WHEN {_tok('system')} + 4 + used > lim THEN right(system, e.r) ELSE system END AS sys FROM used u JOIN ends e USING (conv_id)),
rooms AS (SELECT *, {_tok('sys')} + 4 + used > lim AS over_limit, greatest(0, lim - 4 - {_tok('sys')} - (used - c_latest) - 4) AS room FROM cut),
places AS (SELECT *, unnest(range(0, length(latest) + 1)) AS r FROM rooms WHERE over_limit),
best AS (SELECT conv_id, max(r) FILTER (r < length(latest) AND {_tok(f'(left(latest, {HEAD_SQL}) || {MARK_SQL} || right(latest, r - {HEAD_SQL}))')} <= room) AS mid, max(r) FILTER ({_tok('right(latest, r)')} <= room) AS tail FROM places GROUP BY conv_id)
SELECT conv_id, CASE WHEN m = 1 THEN 1 ELSE 1 + m - start END AS n_kept, sha256(sys) AS system_sha, sha256(CASE WHEN NOT over_limit THEN latest WHEN room < 5 THEN right(latest, tail) WHEN tail = length(latest) THEN latest ELSE (SELECT left(latest, {HEAD_SQL}) || {MARK_SQL} || right(latest, r - {HEAD_SQL}) FROM (SELECT mid AS r)) END) AS latest_sha
FROM rooms LEFT JOIN best USING (conv_id)""")
def fit_budget(t: Tables) -> DataFrame:
    """Chats (turns in order, roles by place) fitted to budgets from 20 to 500 tokens."""
    turn = F.struct("turn", F.col("text").alias("content"))
    chats = t.conversations.groupBy(F.col("conv_id").alias("id")).agg(F.coalesce(F.max(F.when(F.col("role") == "system", F.col("text"))), F.lit("")).alias("system"), F.array_sort(F.collect_list(F.when(F.col("role") != "system", turn))).alias("turns"))
    odd = F.slice("turns", F.lit(1), F.size("turns") - 1 + F.size("turns") % 2)
    messages = F.transform(odd, lambda x, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), x.content.alias("content")))
    fitted = fit_messages(chats.where(F.size("turns") > 0).select("id", "system", messages.alias("messages"), (20 + 60 * (F.col("id") % 9)).alias("max_tokens")))
    return fitted.select(F.col("id").alias("conv_id"), F.size("messages").cast("long").alias("n_kept"), F.sha2("system", 256).alias("system_sha"), F.sha2(F.element_at("messages", -1)["content"], 256).alias("latest_sha"))


@query("""WITH calls AS (SELECT 'q' || o_custkey || ':' || o_orderpriority AS job_key, ['generator', 'refval_extract', 'critic'][o_orderkey % 3 + 1] AS role, o_orderstatus <> 'P' AS ok FROM orders)
SELECT c_custkey AS question_id, count(job_key) AS n_calls, count(*) FILTER (ok) AS n_ok,
  concat_ws(',', CASE WHEN count(*) FILTER (ok AND role = 'generator') = 0 THEN 'generator' END, CASE WHEN count(*) FILTER (ok AND role = 'refval_extract') = 0 THEN 'refval_extract' END) AS missing_roles
FROM customer LEFT JOIN calls ON starts_with(job_key, 'q' || c_custkey || ':') GROUP BY c_custkey""")
def question_calls(t: Tables) -> DataFrame:
    role = F.element_at(F.array(*map(F.lit, ("generator", "refval_extract", "critic"))), (F.col("o_orderkey") % 3).cast("int") + 1)
    calls = t.orders.select(F.concat(F.lit("q"), "o_custkey", F.lit(":"), "o_orderpriority").alias("job_key"), role.alias("role"), (F.col("o_orderstatus") != "P").alias("ok"))
    return call_coverage(t.customer.select(F.col("c_custkey").alias("question_id")), calls, ["generator", "refval_extract"])


@query("""WITH e AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'debug' || chr(10) || props WHEN 1 THEN props || chr(10) || '{broken}' WHEN 2 THEN 'got ' || props || ' at end' WHEN 3 THEN '{"k": -1}' || chr(10) || props || chr(10) || 'bye' ELSE 'no object' END AS output FROM events)
SELECT event_id, CAST(json_extract_string(coalesce(list_filter(string_split(output, chr(10)), lambda x: starts_with(x, '{') AND json_valid(x))[-1], nullif(regexp_extract(output, '(?s)\\{.*\\}'), '')), '$.k') AS INT) AS k FROM e""")
def harness_output(t: Tables) -> DataFrame:
    """The last object that a program printed: on a line of its own, else between the outermost braces."""
    kind, props, end = F.col("event_id") % 5, F.col("props"), F.lit("\n")
    output = F.when(kind == 0, F.concat(F.lit("debug\n"), props)).when(kind == 1, F.concat(props, F.lit("\n{broken}"))).when(kind == 2, F.concat(F.lit("got "), props, F.lit(" at end"))).when(kind == 3, F.concat(F.lit('{"k": -1}\n'), props, end, F.lit("bye"))).otherwise("no object")
    return t.events.select("event_id", F.try_variant_get(last_object(output), "$.k", "int").alias("k"))


@query("""SELECT p_partkey AS question_id, CASE p_size % 7 WHEN 0 THEN 'none' WHEN 1 THEN 'not a map of dialects' WHEN 2 THEN 'no entry for triton' WHEN 3 THEN 'entry is no object'
  WHEN 4 THEN CASE WHEN p_partkey = p_size THEN 'resolved' ELSE 'identifies another question or dialect' END WHEN 5 THEN 'no reference source' ELSE 'resolved' END AS status FROM part""")
def question_manifests(t: Tables) -> DataFrame:
    """Metadata that names no manifest, a wrong one, or one that fits."""
    size, key = F.col("p_size") % 7, F.col("p_partkey").cast("string")
    entry = lambda i, source: F.concat(F.lit('{"oracle_manifests": {"triton": {"question_id": '), i, F.lit(f', "dialect": "triton", "reference_source": "{source}"}}}}}}'))
    fixed = ('{"a": 1}', '{"oracle_manifests": [1]}', '{"oracle_manifests": {"cuda": {}}}', '{"oracle_manifests": {"triton": 5}}')
    metadata = F.when(size == 4, entry(F.col("p_size").cast("string"), "def f")).when(size == 5, entry(key, " ")).when(size == 6, entry(key, "def f"))
    for i, text in enumerate(fixed):
        metadata = F.when(size == i, text).otherwise(metadata)
    return t.part.select(F.col("p_partkey").alias("question_id"), manifest_status(metadata, F.lit("triton"), F.col("p_partkey")).alias("status"))
