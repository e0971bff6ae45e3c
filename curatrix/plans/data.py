"""Dataset quality, exports and numeric comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.plans.adapters import chats
from curatrix.plans.base import Tables, query

PAIRS_SQL = """pairs AS (SELECT conv_id, arg_max(text, turn) FILTER (role = 'user') AS u, arg_max(text, turn) FILTER (role = 'assistant') AS a, arg_min(text, turn) FILTER (role = 'system' AND trim(text) <> '') AS s FROM conversations GROUP BY conv_id)"""


def pairs(t: Tables) -> DataFrame:
    """The last user and assistant texts and the first system text of each archive row."""
    c, turn = F.col("text"), F.col("turn")
    of = lambda role: F.col("role") == role
    return t.conversations.groupBy("conv_id").agg(F.max_by(F.when(of("user"), c), F.when(of("user"), turn)).alias("u"), F.max_by(F.when(of("assistant"), c), F.when(of("assistant"), turn)).alias("a"), F.min_by(F.when(of("system") & (F.trim("text") != ""), c), F.when(of("system") & (F.trim("text") != ""), turn)).alias("s"))


USABLE = "u is not null and a is not null and trim(u) <> '' and trim(a) <> ''"


@query(f"WITH {PAIRS_SQL} SELECT conv_id, u AS user_text, a AS assistant_text FROM pairs WHERE {USABLE}")
def sft_pairs(t: Tables) -> DataFrame:
    return pairs(t).where(USABLE).select("conv_id", F.col("u").alias("user_text"), F.col("a").alias("assistant_text"))


@query(f"WITH {PAIRS_SQL} SELECT conv_id, CASE WHEN s IS NULL THEN 2 ELSE 3 END AS n_messages, coalesce('system:' || s || chr(10), '') || 'user:' || u || chr(10) || 'assistant:' || a AS flat FROM pairs WHERE {USABLE}")
def export_messages(t: Tables) -> DataFrame:
    m = F.filter(F.array(F.when(F.col("s").isNotNull(), F.struct(F.lit("system").alias("role"), F.col("s").alias("content"))), F.struct(F.lit("user").alias("role"), F.col("u").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("a").alias("content"))), lambda x: x.isNotNull())
    return pairs(t).where(USABLE).select("conv_id", F.size(m).alias("n_messages"), F.array_join(F.transform(m, lambda x: F.concat_ws(":", x.role, x.content)), "\n").alias("flat"))


@query(f"WITH {PAIRS_SQL} SELECT conv_id, coalesce(s || chr(10) || chr(10), '') || u AS input, a AS output FROM pairs WHERE {USABLE}")
def export_input_output(t: Tables) -> DataFrame:
    return pairs(t).where(USABLE).select("conv_id", F.concat(F.coalesce(F.concat("s", F.lit("\n\n")), F.lit("")), "u").alias("input"), F.col("a").alias("output"))


@query(f"WITH {PAIRS_SQL} SELECT count(*) AS n_rows, count(*) FILTER ({USABLE}) AS exported, count(s) AS with_system FROM pairs")
def export_counts(t: Tables) -> DataFrame:
    return pairs(t).agg(F.count("*").alias("n_rows"), F.count_if(F.expr(USABLE)).alias("exported"), F.count("s").alias("with_system"))


@query("SELECT p_type AS task, p_brand AS dialect, count(*) FILTER (p_size % 2 = 0) AS good, count(*) FILTER (p_size % 2 = 1 AND p_size % 3 <> 0) AS mutants_caught, count(*) FILTER (p_size % 2 = 1) AS mutants FROM part GROUP BY ALL")
def mutation_summary(t: Tables) -> DataFrame:
    even, third = F.col("p_size") % 2 == 0, F.col("p_size") % 3 == 0
    return t.part.groupBy(F.col("p_type").alias("task"), F.col("p_brand").alias("dialect")).agg(F.count_if(even).alias("good"), F.count_if(~even & ~third).alias("mutants_caught"), F.count_if(~even).alias("mutants"))


@query("SELECT page_id, sha256(regexp_replace(regexp_replace(html, '(?i)(authorization: *bearer +)[A-Za-z0-9._-]+', '\\1[REDACTED]', 'g'), 'href=\"[^\"]*\"', 'href=\"[REDACTED]\"', 'g')) AS redacted_sha FROM pages")
def redact_text(t: Tables) -> DataFrame:
    """Authorisation headers and link targets replaced."""
    out = F.regexp_replace(F.regexp_replace("html", r"(?i)(authorization: *bearer +)[A-Za-z0-9._-]+", "$1[REDACTED]"), 'href="[^"]*"', 'href="[REDACTED]"')
    return t.pages.select("page_id", F.sha2(out, 256).alias("redacted_sha"))


@query("WITH l AS (SELECT page_id, unnest(string_split(html, chr(10))) AS line, unnest(range(0, len(string_split(html, chr(10))))) AS i FROM pages) SELECT page_id, count(*) AS n_lines, count(DISTINCT trim(line)) AS n_distinct, max(length(line)) AS longest FROM l GROUP BY page_id")
def log_summary(t: Tables) -> DataFrame:
    """Distinct diagnostics of each log."""
    lines = t.pages.select("page_id", F.explode(F.split("html", "\n")).alias("line"))
    return lines.groupBy("page_id").agg(F.count("*").alias("n_lines"), F.countDistinct(F.trim("line")).alias("n_distinct"), F.max(F.length("line")).cast("long").alias("longest"))


@query("SELECT doc_id, coalesce(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, 'error', 'i'))[1], list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')[1], '')[1:200] AS line FROM documents")
def first_error_line(t: Tables) -> DataFrame:
    lines = F.split("text", "\n")
    first = F.coalesce(F.try_element_at(F.filter(lines, lambda x: x.rlike("(?i)error")), F.lit(1)), F.try_element_at(F.filter(lines, lambda x: F.trim(x) != ""), F.lit(1)), F.lit(""))
    return t.documents.select("doc_id", F.substring(first, 1, 200).alias("line"))


@query("SELECT source, string_agg(lang, ',' ORDER BY first) AS langs FROM (SELECT source, lang, min(doc_id) AS first FROM documents GROUP BY ALL) GROUP BY source")
def ordered_distinct(t: Tables) -> DataFrame:
    """Distinct values in the order of their first occurrence."""
    first = t.documents.groupBy("source", "lang").agg(F.min("doc_id").alias("first"))
    return first.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "lang"))), lambda x: x.lang), ",").alias("langs"))


@query("SELECT c_custkey AS request, sha256(c_name || '|' || c_mktsegment) AS key_hash, c_mktsegment IN (SELECT c_mktsegment FROM customer WHERE c_custkey % 50 = 0 AND c_nationkey < 5) AS recorded FROM customer")
def completion_lookup(t: Tables) -> DataFrame:
    """Requests that the recorded index holds."""
    index = t.customer.where("c_custkey % 50 = 0 and c_nationkey < 5").select("c_mktsegment").distinct().withColumn("hit", F.lit(True))
    return t.customer.join(index, "c_mktsegment", "left").select(F.col("c_custkey").alias("request"), F.sha2(F.concat_ws("|", "c_name", "c_mktsegment"), 256).alias("key_hash"), F.coalesce("hit", F.lit(False)).alias("recorded"))


@query("SELECT n_name, count(o_orderkey) AS jobs, count(DISTINCT c_custkey) AS questions, round(sum(o_totalprice), 2) AS total FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_name")
def calls_by_question(t: Tables) -> DataFrame:
    rows = t.nation.join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.groupBy("n_name").agg(F.count("o_orderkey").alias("jobs"), F.countDistinct("c_custkey").alias("questions"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""WITH l AS (SELECT event_type, CASE event_id % 8 WHEN 0 THEN props[:-2] WHEN 1 THEN '[' || props || ']' WHEN 2 THEN '{"j": 1}' ELSE props END AS line FROM events)
SELECT event_type AS source, count(*) AS n, count(*) FILTER (kind IS DISTINCT FROM 'OBJECT') AS corrupt, count(*) FILTER (kind = 'OBJECT' AND NOT contains(line, '"k"')) AS without_k FROM (SELECT *, CASE WHEN json_valid(line) THEN json_type(line) END AS kind FROM l) GROUP BY ALL""")
def corrupt_lines(t: Tables) -> DataFrame:
    """Lines that are no object, and objects without their key; lines are torn, put in a list, or lack the key."""
    form = F.col("event_id") % 8
    line = F.when(form == 0, F.expr("substring(props, 1, length(props) - 1)")).when(form == 1, F.concat(F.lit("["), "props", F.lit("]"))).when(form == 2, '{"j": 1}').otherwise(F.col("props"))
    kind = F.try_variant_get(F.try_parse_json(line), "$", "string")
    whole = F.coalesce(F.startswith(kind, F.lit("{")), F.lit(False))
    lines = t.events.select("event_type", whole.alias("whole"), F.get_json_object(line, "$.k").alias("k"))
    return lines.groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("n"), F.count_if(~F.col("whole")).alias("corrupt"), F.count_if(F.col("whole") & F.col("k").isNull()).alias("without_k"))


@query("WITH c AS (SELECT conv_id, list(role ORDER BY turn) AS roles FROM conversations GROUP BY conv_id) SELECT conv_id, len(roles) AS n_messages, roles[1] AS first_role, roles[-1] AS last_role FROM c")
def archive_shape(t: Tables) -> DataFrame:
    m = F.col("messages")
    return chats(t).select("conv_id", F.size(m).cast("long").alias("n_messages"), m[0]["role"].alias("first_role"), F.element_at(m, -1)["role"].alias("last_role"))
