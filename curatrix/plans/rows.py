"""Rows of the archive and of reports: labels, snapshots, evidence, acceptance and logs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions.names import track
from curatrix.functions.text import operation_family
from curatrix.operators import rules as R
from curatrix.plans.adapters import TRACE_SQL, trace
from curatrix.plans.base import Tables, query
from curatrix.plans.data import PAIRS_SQL, USABLE, pairs
from curatrix.plans.numeric import PLACED_SQL, _verdicts
from curatrix.plans.rules import by_hand

KERNEL = "__global__ void k() {}"


@by_hand(
    ("plain", "reasoned"),
    [
        ((f"<think>why</think>\n```cuda\n{KERNEL}\n```", "", "", "kernel"), (KERNEL + "\n", f"<think>\nwhy\n</think>\n{KERNEL}\n")), ((f"```cpp\n{KERNEL}\n```\nand\n```text\nx\n```", "", "archived", "kernel"), (KERNEL + "\n", f"<think>\narchived\n</think>\n{KERNEL}\n")),
        (("```text\na\n```\n```python\nb\n```", "", "", "kernel"), ("b\n", "b\n")), (("```cpp\na\n```\n```python\nb\n```", "", "", "kernel"), ("a\n", "a\n")), (("", KERNEL, "", "kernel"), (KERNEL + "\n", KERNEL + "\n")),
        (("<think>t</think> An answer. ", "", "", "knowledge"), ("An answer.\n", "<think>\nt\n</think>\nAn answer.\n")), ((None, None, None, None), ("", "")), (("int x;", "", " ", "kernel"), ("int x;\n", "int x;\n")),
    ],
)
def export_label(assistant, code, archived, task):
    """Training labels of an archive row, without and with reasoning."""
    return [R.export_label(assistant, code, archived, task, wrap) for wrap in (False, True)]


PROMPTS = {("kernel", False): "kernel en", ("kernel", True): "kernel zh", ("knowledge", False): "knowledge en", ("knowledge", True): "knowledge zh"}


@by_hand(
    ("system",),
    [
        (("none", "kernel", "add", "g"), (None,)), (("generation", "kernel", "add", "g"), ("g",)), (("fixed", "kernel", "add", "g"), ("kernel en",)), (("fixed", "kernel", "实现", "g"), ("kernel zh",)),
        (("fixed", "knowledge", "为什么", "g"), ("knowledge zh",)), (("fixed", "knowledge", None, "g"), ("knowledge en",)), (("generation", "knowledge", "x", None), ("",)),
    ],
)
def training_system(mode, kind, question, generated):
    return [R.training_system(mode, kind, question, generated, PROMPTS)]


@by_hand(
    ("refval", "cases_run", "critic", "contract"),
    [
        ((True, "pass", "", 5, None, True, None, "pass", "independent"), ("pass", 5, "skipped", "pass")), ((False, "pass", "", 5, "verified", False, True, "pass", "self"), ("skip", 0, "verified", "skip")),
        ((True, None, "fail", 2, None, False, True, "fail", None), ("fail", 2, "verified", "fail")), ((True, None, None, 0, None, False, False, None, None), ("skip", 0, "failed", "skip")), ((True, "", "", 1, None, None, None, "other", "independent"), ("skip", 1, "skipped", "skip")),
    ],
)
def snapshot_defaults(*inputs):
    """A candidate's snapshot with what it lacks filled in."""
    return R.snapshot(*inputs)


@by_hand(
    ("system_text", "user_text", "assistant_text"),
    [
        (('{"messages":[{"role":"user","content":"u"},{"role":"user","content":"v"},{"role":"assistant","content":"a"}],"system":"s"}',), ("s", "u", "a")), (('{"metadata":{"system":"m"},"user_prompt":"p","output":"o"}',), ("m", "p", "o")),
        (('{"question":"q","user_prompt":"p","code":"c","output":"o"}',), ("", "q", "c")), (('{"messages":[{"role":"user","content":null}],"question":"q"}',), ("", "", "")), (("no json",), ("", "", "")), ((None,), ("", "", "")),
    ],
)
def audit_message(row):
    return [R.archive_message(row, role) for role in ("system", "user", "assistant")]


@by_hand(
    ("chosen", "origin"),
    [
        (("i", "c", True, "s", "r", "h"), ("i", "injected")), ((None, "c", True, "s", "r", "h"), ("c", "cache")), ((None, "c", False, "s", "r", "h"), ("s", "prefetched")), ((None, None, None, None, "r", "h"), ("r", "retried")),
        ((None, "c", False, None, None, "h"), ("h", "heuristic")), ((None, None, None, None, None, None), (None, "none")),
    ],
)
def manifest_precedence(injected, cached, cached_fits, prefetched, retried, heuristic):
    """The first manifest there is; a cached one only if it fits the interface still."""
    ladder = {"injected": injected, "cache": F.when(cached_fits, cached), "prefetched": prefetched, "retried": retried, "heuristic": heuristic}
    origin = F.coalesce(*[F.when(c.isNotNull(), name) for name, c in ladder.items()], F.lit("none"))
    return [F.coalesce(*ladder.values()), origin]


@by_hand(
    ("family", "dtype", "layout"),
    [
        (('{"task_spec":{"dtype":"f16","operation_family":"own"},"dtype":"f64"}', "a matmul"), ("own", "f16", "contiguous")), (('{"dtype":"f64","layout":"strided"}', "implement a matmul"), ("gemm", "f64", "strided")),
        (('{"task_spec":{"dtype":""},"dtype":"","operation_family":"raw"}', "add"), ("raw", "f32", "contiguous")), (('{"operation_family":"raw"}', None), ("raw", "f32", "contiguous")),
    ],
)
def task_contract(metadata, question):
    """What the input says of a task, by precedence; a family that it lacks is read off the question."""
    at = lambda key: [F.nullif(F.get_json_object(metadata, path), F.lit("")) for path in (f"$.task_spec.{key}", f"$.{key}")]
    return [F.coalesce(*at("operation_family"), operation_family(R.text(question))), F.coalesce(*at("dtype"), F.lit("f32")), F.coalesce(*at("layout"), F.lit("contiguous"))]


@by_hand(
    ("short", "long"),
    [((0.5,), ("0.5", "0.5")), ((0.0,), ("0", "0")), ((123456.0,), ("1.235e+05", "123456")), ((0.00012345678,), ("0.0001235", "0.000123457")), ((1e-7,), ("1e-07", "1e-07")), ((100.0,), ("100", "100")), ((9999.96,), ("1e+04", "9999.96"))],
)
def evidence_numbers(x):
    """Errors as reports print them, with four and with six digits."""
    return [R.general(x, 4), R.general(x, 6)]


@query(
    f"""{PLACED_SQL} SELECT case_id, '  [' || CASE WHEN error = '' THEN 'PASS' ELSE 'FAIL' END || '] ' || case_id || ' n=' || n_compared || ' mismatch=' || n_mismatch || ' max_abs=' || printf('%.4g', round(max_abs, 6)) AS line FROM verdicts"""
)
def case_log_lines(t: Tables) -> DataFrame:
    """The log line of each case."""
    flag = F.when(F.col("v.status") == "pass", "PASS").otherwise("FAIL")
    parts = [F.lit("  ["), flag, F.lit("] "), F.col("case_id").cast("string"), F.lit(" n="), F.col("v.n_compared").cast("string"), F.lit(" mismatch="), F.col("v.n_mismatch").cast("string"), F.lit(" max_abs="), R.general(F.round("v.max_abs", 6), 4)]
    return _verdicts(t, "elementwise").select("case_id", F.concat(*parts).alias("line"))


@query(
    f"""{PLACED_SQL}, k AS (SELECT *, CASE WHEN error LIKE 'NaN%' OR error LIKE 'Inf%' THEN 'nan_inf' ELSE 'numeric_mismatch' END AS kind FROM verdicts),
o AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY case_id) AS rn FROM k WHERE error <> '')
SELECT job, count(*) AS cases_run, min(case_id) FILTER (error <> '') AS failed_case, coalesce(arg_min(kind, case_id) FILTER (error <> ''), '') AS error_class,
  (SELECT string_agg(case_id || ' ' || kind || ' mismatch=' || n_mismatch || '/' || n_compared, ';' ORDER BY case_id) FROM o WHERE o.job = k.job AND rn <= 3) AS evidence FROM k GROUP BY job"""
)
def refval_report(t: Tables) -> DataFrame:
    """A job's report with its first three failing cases as evidence. The rank is limited
    before the shuffle, so no task gathers a job's cases."""
    bad = F.col("v.status") == "fail"
    kind = F.when(F.col("v.error").rlike("^(NaN|Inf)"), "nan_inf").otherwise("numeric_mismatch")
    rows = _verdicts(t, "elementwise").select("job", "case_id", bad.alias("bad"), kind.alias("kind"), F.format_string("%d %s mismatch=%d/%d", "case_id", kind, "v.n_mismatch", "v.n_compared").alias("line"))
    first = rows.where("bad").withColumn("rank", F.row_number().over(Window.partitionBy("job").orderBy("case_id"))).where("rank <= 3")
    evidence = first.groupBy("job").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("case_id", "line"))), lambda x: x["line"]), ";").alias("evidence"))
    totals = rows.groupBy("job").agg(F.count("*").alias("cases_run"), F.min(F.when(F.col("bad"), F.struct("case_id", "kind"))).alias("f"))
    both = totals.alias("t").join(evidence.alias("e"), F.expr("t.job <=> e.job"), "left")
    return both.select("t.job", "cases_run", F.col("f.case_id").alias("failed_case"), F.coalesce("f.kind", F.lit("")).alias("error_class"), "evidence")


REQUIRED = ("critic", "generate", "refval_extract")


@query(f"WITH {TRACE_SQL}, r AS (SELECT job, count(*) AS calls, list(DISTINCT role) FILTER (status = 'success') AS seen, bool_and(status = 'success') AS strict FROM trace WHERE event = 'llm.call' GROUP BY job) SELECT job, calls, strict, array_to_string(list_filter({list(REQUIRED)}, lambda x: NOT coalesce(list_contains(seen, x), false)), ',') AS missing FROM r")
def run_failures(t: Tables) -> DataFrame:
    """Required roles that a job's good calls lack, and whether all of its calls were good."""
    good = F.col("status") == "success"
    rows = trace(t).where("event = 'llm.call'").groupBy("job").agg(F.count("*").alias("calls"), F.every(good).alias("strict"), F.collect_set(F.when(good, F.col("role"))).alias("seen"))
    return rows.select("job", "calls", "strict", F.array_join(F.array_except(F.array(*map(F.lit, REQUIRED)), "seen"), ",").alias("missing"))


@query("WITH e AS (SELECT c_custkey AS id, true AS expected FROM customer WHERE c_acctbal > 0), s AS (SELECT o_custkey AS id, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS done FROM orders GROUP BY ALL) SELECT coalesce(e.id, s.id) AS id, concat_ws(',', CASE WHEN expected IS NULL THEN 'extra' END, CASE WHEN expected AND coalesce(n, 0) <> 1 THEN 'samples=' || coalesce(n, 0) END, CASE WHEN expected AND coalesce(done, 0) <> 1 THEN 'progress_success=' || coalesce(done, 0) END) AS issues FROM e FULL JOIN s ON e.id = s.id")
def acceptance_issues(t: Tables) -> DataFrame:
    """Expected questions against samples and progress, with what is wrong with each."""
    expected = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.lit(True).alias("expected"))
    found = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    n, done, wanted = F.coalesce("n", F.lit(0)), F.coalesce("done", F.lit(0)), F.col("expected").isNotNull()
    issues = R.reasons((~wanted, "extra"), (wanted & (n != 1), F.concat(F.lit("samples="), n.cast("string"))), (wanted & (done != 1), F.concat(F.lit("progress_success="), done.cast("string"))))
    return expected.join(found, "id", "full").select("id", F.array_join(issues, ",").alias("issues"))


@query("WITH k AS (SELECT p_partkey, sha256(concat_ws('|', p_brand, p_size)) AS key, p_retailprice FROM part), c AS (SELECT key, min(p_partkey) AS manifest FROM k WHERE p_retailprice > 980 GROUP BY key) SELECT p_partkey AS request, k.key AS key, manifest, manifest IS NOT NULL AS hit FROM k LEFT JOIN c USING (key)")
def cache_lookup(t: Tables) -> DataFrame:
    """Requests joined with a cache by the digest of what describes them."""
    keyed = t.part.select("p_partkey", "p_retailprice", F.sha2(F.concat_ws("|", "p_brand", F.col("p_size").cast("string")), 256).alias("key"))
    cache = keyed.where("p_retailprice > 980").groupBy("key").agg(F.min("p_partkey").alias("manifest"))
    return keyed.join(cache, "key", "left").select(F.col("p_partkey").alias("request"), "key", "manifest", F.col("manifest").isNotNull().alias("hit"))


@query(f"""WITH {TRACE_SQL}, l AS (SELECT *, date_part('hour', ts) * 3600 + date_part('minute', ts) * 60 + floor(date_part('second', ts)) AS clock FROM trace),
j AS (SELECT job, arg_min(clock, seq) FILTER (event = 'llm.call') AS s, arg_max(clock, seq) FILTER (event = 'job.end') AS e, coalesce(string_agg(CASE WHEN k % 2 = 0 THEN 'pass' ELSE 'fail' END, ',' ORDER BY seq) FILTER (event = 'node.end'), '') AS compiles FROM l GROUP BY job)
SELECT job, CAST((e - s + 86400) % 86400 AS BIGINT) AS elapsed, compiles FROM j""")
def console_log_metrics(t: Tables) -> DataFrame:
    """A log's lines read back: clock times modulo a day, and compile results in order."""
    k, event = F.col("k"), F.col("event")
    said = F.when(event == "llm.call", "calling model").when(event == "job.end", "saved SFT sample").when(event == "node.end", F.when(k % 2 == 0, "compile PASS").otherwise("compile FAIL")).otherwise("idle")
    lines = trace(t).select("seq", F.format_string("%s [Q%d] %s", F.date_format("ts", "HH:mm:ss"), F.col("job"), said).alias("line"))
    part = lambda i: F.regexp_extract("line", r"^(\d{2}):(\d{2}):(\d{2})", i).cast("long")
    read = lines.select("seq", "line", F.regexp_extract("line", r"\[Q(\d+)\]", 1).cast("long").alias("job"), (part(1) * 3600 + part(2) * 60 + part(3)).alias("clock"), F.nullif(F.lower(F.regexp_extract("line", r"compile (PASS|FAIL)\b", 1)), F.lit("")).alias("result"))
    start, end = F.col("line").contains("calling model"), F.col("line").rlike("saved SFT sample|abandoned")
    agg = read.groupBy("job").agg(
        F.min_by(F.when(start, F.col("clock")), F.when(start, F.col("seq"))).alias("s"), F.max_by(F.when(end, F.col("clock")), F.when(end, F.col("seq"))).alias("e"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("result").isNotNull(), F.struct("seq", "result")))), lambda x: x["result"]), ",").alias("compiles"),
    )
    return agg.select("job", F.pmod(F.col("e") - F.col("s"), F.lit(86400)).alias("elapsed"), "compiles")


@query(f"""WITH {PAIRS_SQL} SELECT conv_id AS id, CASE WHEN trim(coalesce(s, '')) = '' THEN 2 ELSE 3 END AS n_messages, sha256('{{"code": ' || CAST(to_json(a) AS VARCHAR) || ', "dialect": "cuda", "id": ' || conv_id || ', "question": ' || CAST(to_json(u) AS VARCHAR) || '}}') AS sample_key, sha256(a) AS code_sha256 FROM pairs WHERE {USABLE}""")
def kernel_row(t: Tables) -> DataFrame:
    """An archive row put together, with its key over the sorted fields."""
    quoted = lambda c: F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)")
    key = F.concat(F.lit('{"code": '), quoted("a"), F.lit(', "dialect": "cuda", "id": '), F.col("conv_id").cast("string"), F.lit(', "question": '), quoted("u"), F.lit("}"))
    return pairs(t).where(USABLE).select(F.col("conv_id").alias("id"), F.when(F.trim(F.coalesce("s", F.lit(""))) == "", 2).otherwise(3).alias("n_messages"), F.sha2(key, 256).alias("sample_key"), F.sha2("a", 256).alias("code_sha256"))


COMPLETE = {
    "dataset_version": "v", "sample_key": "k", "question_hash": "h", "track": "t", "dialect": "d", "language": "l", "system_mode": "s", "user_mode": "u", "release_tier": "r", "source_line": 1, "candidate": 1, "repairs": 0,
    "generation": {"system": "s", "user": "u", "prompt_variant": {}}, "cot": {"source": "raw", "policy": "p", "chars": 3}, "provenance": {"model": "m", "provider": "p", "prompt_packs": {}, "run_id": "r", "created_at": "c"},
    "selected_code_sha256": "x", "refval": {}, "critic": {"status": "verified"}, "judge": {}, "candidate_pool": {"count": 1, "selected_candidate": 1, "eligible_count": 1, "reports": []},
}


@by_hand(
    ("missing", "n_kernel"),
    [
        ((json.dumps(COMPLETE),), ("", 0)), ((json.dumps(COMPLETE | {"source_line": True, "track": None}),), ("track,source_line", 0)), ((json.dumps(COMPLETE | {"cot": {"source": 1, "policy": "p", "chars": 3.5}, "critic": {}}),), ("cot.source,cot.chars", 1)),
        (("no json",), (",".join(R.REQUIRED), len(R.REQUIRED_KERNEL))), ((None,), (",".join(R.REQUIRED), len(R.REQUIRED_KERNEL))), ((json.dumps(COMPLETE | {"candidate_pool": {"count": 1, "reports": {}}}),), ("", 3)),
    ],
)
def required_fields(metadata):
    """Metadata fields that a row lacks, and how many more a kernel's row lacks."""
    return [F.array_join(R.missing_fields(metadata, R.REQUIRED), ","), F.size(R.missing_fields(metadata, R.REQUIRED_KERNEL))]


@by_hand(
    ("synthesize", "source", "error"),
    [
        (("raw", "synthetic", "e", 0, True, True), (True, "raw", "e")), (("", "empty", "", 0, False, True), (False, "empty", "raw reasoning unstructured")), ((" Synthetic ", "", "e", 1, True, True), (True, "empty", "e; raw reasoning inconsistent")),
        (("off", "synthetic", None, 2, False, False), (False, "empty", "raw reasoning inconsistent")), ((None, None, None, 0, False, False), (False, "raw", "")),
    ],
)
def reasoning_fallback(mode, on_empty, error, issues, structured, needed):
    """Whether a reasoning may be made up, and what the teacher's own is good for."""
    out = R.raw_outcome(error, issues, structured, needed)
    return [R.may_synthesize(mode, on_empty), out["source"], out["error"]]


@by_hand(
    ("states",),
    [
        (("kernel", "compile,cot"), ("not_requested,pending,not_requested,not_requested,not_requested,pending",)), (("knowledge", "generate,compile"), ("pending,not_applicable,not_requested,not_requested,not_requested,not_requested",)),
        (("kernel", ""), ("not_requested,not_requested,not_requested,not_requested,not_requested,not_requested",)),
    ],
)
def component_matrix(kind, requested):
    """The first state of every component of a run."""
    return [F.array_join(R.component_status(kind, F.split(requested, ",")), ",")]


@query(f"""WITH {PAIRS_SQL} SELECT conv_id AS id, 'knowledge:' || ['general', 'memory', 'isa'][conv_id % 3 + 1] AS track, sha256(a) AS answer_sha256, sha256('{{"code": ' || CAST(to_json(a) AS VARCHAR) || ', "dialect": "knowledge:' || ['general', 'memory', 'isa'][conv_id % 3 + 1] || '", "id": ' || conv_id || ', "question": ' || CAST(to_json(u) AS VARCHAR) || '}}') AS sample_key FROM pairs WHERE {USABLE}""")
def knowledge_row(t: Tables) -> DataFrame:
    """An answer's archive row, with the digest that its review is bound to."""
    quoted = lambda c: F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)")
    name = track(F.element_at(F.array(F.lit("general"), F.lit(" Memory"), F.lit("knowledge:isa")), (F.col("conv_id") % 3 + 1).cast("int")))
    key = F.concat(F.lit('{"code": '), quoted("a"), F.lit(', "dialect": "'), name, F.lit('", "id": '), F.col("conv_id").cast("string"), F.lit(', "question": '), quoted("u"), F.lit("}"))
    return pairs(t).where(USABLE).select(F.col("conv_id").alias("id"), name.alias("track"), F.sha2("a", 256).alias("answer_sha256"), F.sha2(key, 256).alias("sample_key"))


@query("SELECT o_orderpriority AS dialect, o_orderstatus AS status, count(*) AS n, count(l.k) AS sampled, sum(l.n) AS candidates FROM orders LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY ALL) l ON k = o_orderkey GROUP BY ALL")
def phase_summary(t: Tables) -> DataFrame:
    """Progress rows of a phase by dialect and status, with the samples behind them."""
    pools = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("k"))
    return t.orders.join(pools, "o_orderkey", "left").groupBy(F.col("o_orderpriority").alias("dialect"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"), F.count("k").alias("sampled"), F.sum("k").alias("candidates"))
