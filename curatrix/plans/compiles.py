"""Queries over compiler logs: a part's log has a line for each of its order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators.logs import diagnostics, log_lines, log_summaries
from curatrix.plans.base import Tables, query
from curatrix.sources.suites import read_plans

LIMIT = 700
#: Lines by form, with S for the supplier's number, N for the line's; (text, class, key) where the class is e, w or nothing.
FORMS = (
    ("k.cu(N): error: identifier \"vS\" is undefined", "e", "error|identifier \"vs\" is undefined"),
    ("  k.cu(N): warning #177-D: variable \"wS\"   was never used", "w", "warning|variable \"ws\" was never used"),
    ("host.cpp:N:7: error: Expected ; before xS", "e", "error|expected ; before xs"),
    ("      ^~~~", "", ""),
    ("fatal error: too many errors", "e", "fatal error|too many errors"),
    ("k.cu(N): error: no instance of f<thing<SSSS>, a_long_list_of_arguments> fits", "e", "error|no instance of f<>, a_long_list_of_arguments> fits"),
    ("note: candidate N", "", ""),
    ("Remark: The warnings can be suppressed with \"-diag\"", "", ""),
    ("nvlink: fatal error: lost S", "e", "fatal error|lost s"),
)


def logs(t: Tables) -> DataFrame:
    """(log, text); every seventh part's log is a trace without a diagnostic."""
    form = F.element_at(F.array(*[F.lit(f[0]) for f in FORMS]), ((F.col("l_orderkey") + F.col("l_linenumber")) % len(FORMS) + 1).cast("int"))
    line = F.when(F.col("l_partkey") % 7 == 0, F.lit("at frame N of module S, called there")).otherwise(form)
    supplier = (F.col("l_suppkey") % 11).cast("string")
    line = F.regexp_replace(F.regexp_replace(line, F.lit("S"), supplier), F.lit("N"), F.col("l_linenumber").cast("string"))
    ordered = F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_suppkey", line.alias("line"))))
    return t.lineitem.groupBy(F.col("l_partkey").alias("log")).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))


def _by_form(at: int, default: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{f[at]}'" for i, f in enumerate(FORMS))
    return f"CASE form {cases} ELSE '{default}' END"


_LINES = f"""raw AS (SELECT l_partkey AS log, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) - 1 AS pos, CASE WHEN l_partkey % 7 = 0 THEN -1 ELSE (l_orderkey + l_linenumber) % {len(FORMS)} END AS form, l_suppkey % 11 AS s, l_linenumber AS n FROM lineitem),
t AS (SELECT log, pos, replace(replace({_by_form(0, "at frame N of module S, called there")}, 'S', CAST(s AS VARCHAR)), 'N', CAST(n AS VARCHAR)) AS line, {_by_form(1, "")} AS class,
  CASE form WHEN 0 THEN 'error|identifier "v' || s || '" is undefined' WHEN 1 THEN 'warning|variable "w' || s || '" was never used' WHEN 2 THEN 'error|expected ; before x' || s WHEN 4 THEN 'fatal error|too many errors'
    WHEN 5 THEN 'error|no instance of f<thing<' || s || s || s || s || '>, a_long_list_of_arguments> fits' WHEN 8 THEN 'fatal error|lost ' || s ELSE '' END AS key FROM raw)"""


@query(f"WITH {_LINES} SELECT log, key, count(*) AS n, min(pos) AS first_at, arg_min(trim(line), pos) AS shown FROM t WHERE class <> '' GROUP BY ALL")
def compile_diagnostics(t: Tables) -> DataFrame:
    """The different diagnostics of each log: how often, where first, and as shown there."""
    return diagnostics(log_lines(logs(t))).groupBy("log", "key").agg(F.count("*").alias("n"), F.min("at").cast("long").alias("first_at"), F.min_by("shown", "at").alias("shown"))


@query(f"""WITH {_LINES}, txt AS (SELECT log, trim(string_agg(line, chr(10) ORDER BY pos), ' ' || chr(10)) AS text FROM t GROUP BY log),
d AS (SELECT log, class, key, count(*) AS n, min(pos) AS pos, arg_min(trim(line), pos) AS line FROM t WHERE class <> '' GROUP BY ALL),
s AS (SELECT x.log, length(text) AS n_chars, text, coalesce(sum(n) FILTER (class = 'e'), 0) AS errors, count(*) FILTER (class = 'e') AS unique_errors, coalesce(sum(n) FILTER (class = 'w'), 0) AS warnings, count(*) FILTER (class = 'w') AS unique_warnings FROM txt x LEFT JOIN d USING (log) GROUP BY ALL),
h AS (SELECT *, errors || ' errors (' || unique_errors || ' unique), ' || warnings || ' warnings (' || unique_warnings || ' unique); log truncated from ' || n_chars || ' chars' AS header FROM s),
a AS (SELECT log, coalesce(chr(10) || chr(10) || 'errors:' || chr(10) || string_agg(line, chr(10) ORDER BY pos) FILTER (class = 'e'), '') || coalesce(chr(10) || chr(10) || 'warnings:' || chr(10) || string_agg(line, chr(10) ORDER BY pos) FILTER (class = 'w'), '') AS body FROM d GROUP BY log),
r AS (SELECT d.*, header, sum(length(line) + 1) OVER (PARTITION BY log, class ORDER BY pos) AS upto FROM d JOIN h USING (log)),
e AS (SELECT h.log, length(h.header) + 9 + coalesce(max(upto), 0) AS used, string_agg(line, chr(10) ORDER BY pos) AS shown FROM h LEFT JOIN r ON r.log = h.log AND class = 'e' AND length(h.header) + 9 + upto <= {LIMIT} GROUP BY h.log, h.header),
w AS (SELECT e.log, string_agg(line, chr(10) ORDER BY pos) AS shown FROM e JOIN r ON r.log = e.log AND class = 'w' AND e.used + 11 + upto <= {LIMIT} GROUP BY e.log)
SELECT h.log, n_chars, errors, unique_errors, warnings, unique_warnings, CASE WHEN n_chars <= {LIMIT} THEN text WHEN errors + warnings = 0 THEN '...[truncated ' || (n_chars - {LIMIT - 40}) || ' chars]...' || chr(10) || text[-{LIMIT - 40}:]
  WHEN length(header || body) <= {LIMIT} THEN header || body
  ELSE left(rtrim(header || chr(10) || chr(10) || 'errors:' || coalesce(chr(10) || e.shown, '') || CASE WHEN e.used < {LIMIT - 20} AND unique_warnings > 0 THEN chr(10) || chr(10) || 'warnings:' || coalesce(chr(10) || w.shown, '') ELSE '' END, ' ' || chr(10)), {LIMIT}) END AS summary
FROM h LEFT JOIN a USING (log) LEFT JOIN e USING (log) LEFT JOIN w USING (log)""")
def compile_summaries(t: Tables) -> DataFrame:
    """Each log within 700 characters, with the counts of its diagnostics."""
    return log_summaries(log_lines(logs(t)), LIMIT)


@query("""WITH l AS (SELECT p_partkey, p_size, CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '{"name": "cut' WHEN 2 THEN '[' || p_size || ']' ELSE '' END AS bad, p_brand FROM part)
SELECT p_brand AS suite, count(*) AS n_lines, count(*) FILTER (bad = '') AS n_plans, sum(p_size * 3) FILTER (bad = '') AS elements, count(*) FILTER (bad = '' AND p_size % 2 = 0) AS large FROM l GROUP BY p_brand""")
def plan_lines(t: Tables) -> DataFrame:
    """Plans read from lines of JSON, of which some are cut off, no object or missing."""
    size, form = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    plan = F.concat(F.lit('{"name": "n'), size, F.lit('", "kind": "non_tile", "shapes": {"x": ['), size, F.lit(', 3]}, "seed": '), F.col("p_partkey").cast("string"), F.lit(', "large": '), (F.col("p_size") % 2 == 0).cast("string"), F.lit(', "other": []}'))
    line = F.when(form == 1, '{"name": "cut').when(form == 2, F.concat(F.lit("["), size, F.lit("]"))).when(form > 2, plan)
    lines = t.part.select(F.col("p_brand").alias("suite"), line.alias("value"))
    plans = read_plans(lines).groupBy("suite").agg(F.count("*").alias("n_plans"), F.sum(F.aggregate(F.col("shapes")["x"], F.lit(1), lambda a, d: a * d)).alias("elements"), F.count_if("large").alias("large"))
    return lines.groupBy("suite").agg(F.count("*").alias("n_lines")).join(plans, "suite", "left")
