"""Rules over errors, answers, interfaces and rows.

The driver tables hold no compiler logs or critic replies, so each part number picks one of a
few recorded inputs; the oracle holds the outputs worked out by hand. Rules on counts and
states bind their inputs to order lines, with the rule in SQL as oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions import reasoning
from curatrix.operators import rules as R
from curatrix.operators.judges import cuda_score
from curatrix.operators.ordered import beside, percentiles
from curatrix.plans.adapters import POOL_SQL, pool
from curatrix.plans.base import Tables, query


def _sql(v) -> str:
    if v is None:
        return "NULL"
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)


def by_hand(outputs: tuple[str, ...], rows: list[tuple[tuple, tuple]], kind: str = "string"):
    """Register f(inputs) -> columns, over parts that pick the rows (inputs, outputs) in turn."""
    n = len(rows)
    picked = ", ".join(f"[{', '.join(_sql(out[i]) for _, out in rows)}][CAST(p_partkey % {n} AS INT) + 1] AS {name}" for i, name in enumerate(outputs))

    def wrap(f: Callable[..., list[Column]]):
        def run(t: Tables) -> DataFrame:
            at = (F.col("p_partkey") % n + 1).cast("int")
            width = len(rows[0][0])
            given = t.part.select("p_partkey", *[F.element_at(F.array(*[F.lit(r[0][i]) for r in rows]), at).alias(f"i{i}") for i in range(width)])
            results = f(*[F.col(f"i{i}") for i in range(width)])
            return given.select(F.col("p_partkey").alias("part"), *[c.alias(name) for c, name in zip(results, outputs, strict=True)])

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        return query(f"SELECT p_partkey AS part, {picked} FROM part")(run)

    return wrap


@by_hand(
    ("error_class",),
    [
        (("no CUDA source extracted", "cuda", ""), ("empty_source",)), (("boom", "triton", "__global__ void k()"), ("dialect_violation",)), (("boom", "triton", "# __global__\nx = 1"), ("other",)),
        (("boom", "cutlass", "using A = cute::SM90;"), ("dialect_violation",)), (("boom", "cutlass", "// no SM90 here"), ("other",)), (("a.cu: fatal error: x.h", "cuda", ""), ("missing_header",)),
        (("NameError: x", "triton", ""), ("undeclared",)), (("error: expected ';'", "cuda", ""), ("syntax",)), (("cute::Layout failed", "cuda", ""), ("template",)),
        (("cute::Layout failed", "tilelang", ""), ("other",)), (("timed out at import", "tilelang", ""), ("import_time",)), (("Lowering failed", "triton", ""), ("jit_compile",)), ((None, None, None), ("other",)),
        (("boom", "tilelang", "__global__ tilelang"), ("other",)), (("boom", "tilelang", "__global__"), ("dialect_violation",)),
    ],
)
def compile_error_class(error, dialect, code):
    """Class of a compiler's error; marks in comments don't count."""
    return [R.compile_error_class(error, dialect, code)]


@by_hand(
    ("repair_class", "report_class"),
    [
        (("illegal access", ""), ("crash", "numeric_mismatch")), (("x", "Crash "), ("crash", "Crash ")), (("x", "own"), ("numeric_mismatch", "own")), (("Timed out: reference", ""), ("timeout", "timeout")),
        (("reference has nan", ""), ("reference_error", "reference_error")), (("no matching overload", ""), ("numeric_mismatch", "signature_mismatch")), (("inf in row", ""), ("nan_inf", "numeric_mismatch")),
        (("CUDA error 700", None), ("crash", "crash")), (("undeclared x", ""), ("signature_mismatch", "signature_mismatch")), ((None, None), ("numeric_mismatch", "numeric_mismatch")),
    ],
)
def refval_error_class(error, given):
    """Class of a numeric failure, for the repair prompt and for the report."""
    return [R.refval_error_class(error, given), R.refval_error_class(error, given, report=True)]


@by_hand(
    ("retry", "category", "budget"),
    [
        ((429, "slow", 4000), (True, "agent_error", None)), ((401, "unavailable 401", 4000), (False, "authentication", None)), ((402, "can only afford 900", 4000), (False, "agent_error", 899)),
        ((402, "can only afford 200", 4000), (False, "agent_error", None)), ((402, "pay", 4000), (False, "agent_error", 2000)), ((402, "pay", 100000), (False, "agent_error", 32768)),
        ((402, "pay", 400), (False, "agent_error", None)), ((None, "Connection reset", 10), (True, "agent_error", None)), ((400, "deadline passed", 10), (False, "timeout", None)),
        ((400, "Rate limit", 10), (True, "rate_limit", None)), ((400, "payment_required: credits", 1001), (False, "agent_error", 500)), ((400, "bad JSON", 10), (False, "parse_failure", None)), ((503, "overloaded", 9), (True, "provider_overload", None)),
    ],
)
def retryable_errors(status, error, current):
    """Whether a failed call is tried again, its category, and a smaller token budget."""
    return [R.retryable(status, error), R.live_error_category(error), R.affordable_tokens(status, error, current)]


LONG = "A plain line of an answer that is long enough. " * 10
@by_hand(
    ("reasons",),
    [
        (("short", "general", ""), ("short,unstructured",)), ((LONG, "general", ""), ("unstructured",)), (("# Head\n" + LONG + "end.", "general", ""), ("",)), (("# Head\n" + LONG + "end.", "formula", ""), ("no_equation",)),
        (("# Head\n$a = b$ " + LONG + "end.", "formula", "derive it"), ("no_steps",)), (("1. a\n2. b\n3. c\n" + LONG + "end.", "general", "Why does it"), ("",)), (("# Head\n" + LONG + "and so on ...", "general", ""), ("truncated",)),
        (("# Head\n" + LONG + "\n```c\nx", "general", ""), ("open_fence",)), (("# Head\n" + LONG + "$$ a.", "general", ""), ("open_equation",)), (("# Head\n```c\n" + LONG + "\n```\nend.", "general", ""), ("fence_ratio",)),
        (("# Head\n```c\n" + LONG + "\n```\nend.", "worked_example", ""), ("",)), (("# Head\n" + LONG + "The warp size is 64 lanes.", "general", ""), ("warp_size_32",)), ((None, None, "prove"), ("short",)),
    ],
)
def answer_hard_gate(answer, topic, question):
    """Why an answer must not be saved yet."""
    return [F.array_join(R.answer_gate(answer, topic, question, reasoning.fact_violations(R.text(answer))), ",")]


@by_hand(
    ("status",),
    [
        (('{"pass": true}',), ("verified",)), (('{"pass": true, "must_fix": ["x"]}',), ("failed",)), (('{"pass": false}',), ("failed",)), (("not json",), ("unverified",)), (('{"score": 3}',), ("unverified",)),
        (('said:\n```json\n{"pass": true, "must_fix": []}\n```',), ("verified",)), (('{"must_fix": [" "], "pass": true}',), ("verified",)), ((None,), ("unverified",)),
    ],
)
def critic_verdict(reply):
    """What a critic's reply decides."""
    return [R.critic_status(reply)]


@by_hand(
    ("dialects", "flags", "rdc", "has_main"),
    [
        (("__global__ void k() { cufftExecC2C(p); }", "try -rdc=true"), ("cuda,cutlass", "-lcufft", True, False)), (("import triton\n@triton.jit", ""), ("triton", "", False, False)), (("@tilelang.jit T.Kernel", "x"), ("tilelang", "", False, False)),
        (("cute::Layout a; int main() { curand_init (s); cublasCreate(&h); }", "Dynamic Parallelism"), ("cutlass", "-lcurand,-lcublas", True, True)), ((None, None), ("", "", False, False)),
    ],
)
def source_hints(source, log):
    """Dialects that a source looks like, what it links with, and what its log asks for."""
    return [F.array_join(R.looks_like(source), ","), F.array_join(R.link_flags(source), ","), R.any_of(F.lower(R.text(log)), R.RDC_HINTS), R.text(source).rlike(r"\bint\s+main\s*\(")]


@by_hand(
    ("kernel", "version"),
    [(("kernel", "cuda", "cuda", "set-2"), (True, 2)), (("knowledge", None, None, "set-12"), (False, 12)), ((None, "prose", "cuda", "set-"), (False, 0)), ((None, None, "knowledge:ptx", None), (False, 0)), ((None, None, None, "x set-3"), (True, 0))],
)
def row_kind_version(task, language, track, version):
    """Whether a row is a kernel's, and the version of its set."""
    return [R.is_kernel(task, language, track), R.dataset_version(version, "set")]


PARAM = "struct<name:string,kind:string,dtype:string,rank:int,shape_from:array<string>>"


@by_hand(
    ("issues",),
    [
        (("k", '[{"name":"a","kind":"input","shape_from":["n"]},{"name":"o","kind":"output"},{"name":"n","kind":"size"}]', "void"), ("",)), (("1k", "[]", "void"), ("entry,no parameters,no output",)),
        (("k", '[{"name":"a","kind":"input","shape_from":["m"]},{"name":"a","kind":"inout"}]', ""), ("duplicate names,a from m",)), (("k", '[{"name":"h","kind":"input","dtype":"cufft_handle"}]', "cufft_handle"), ("h must be scalar,handle returned,no plan input",)),
        (("k", '[{"name":"h","kind":"scalar","dtype":"cufft_handle"},{"name":"x","kind":"inout","dtype":"c64","rank":2}]', None), ("",)), (("k", '[{"name":"x","kind":"input"}]', "float"), ("",)),
    ],
)
def abi_issues(entry, params, returns):
    """What is wrong with a kernel's interface."""
    return [F.array_join(R.abi_issues(entry, F.from_json(params, f"array<{PARAM}>"), returns), ",")]


BITS = ", ".join(f"(p_partkey // {1 << i}) % 2 = 1 AS b{i}" for i in range(6))
SYNCS = ("", "__syncthreads();", "__syncthreads();" * 4)
BLOCKS = ("dim3 block(48);", "BLOCK_SIZE = 2048;", "dim3 block(128);", "")


@query(
    f"""WITH b AS (SELECT p_partkey, {BITS}, [0, 1, 4][CAST(p_size % 3 AS INT) + 1] AS syncs, p_size % 4 < 2 AS odd, p_size % 5 = 0 AS passed FROM part)
SELECT p_partkey AS part, least(10, greatest(1, 10 - CASE WHEN b1 AND NOT b2 AND NOT b5 THEN 2 ELSE 0 END - CASE WHEN b1 AND NOT b3 THEN 2 ELSE 0 END - CASE WHEN syncs = 4 AND NOT b4 THEN 1 ELSE 0 END - CASE WHEN b1 AND b5 THEN 1 ELSE 0 END
 - CASE WHEN odd THEN 1 ELSE 0 END - CASE WHEN NOT b1 THEN 2 ELSE 0 END - CASE WHEN NOT b0 THEN 1 ELSE 0 END - CASE WHEN b4 AND syncs = 0 THEN 1 ELSE 0 END) + CASE WHEN passed THEN 1 ELSE 0 END) AS score FROM b"""
)
def static_judge(t: Tables) -> DataFrame:
    """The static score of a source put together from the pieces that the part's bits name."""
    pieces = ("#include <cuda_runtime.h>\n", "__global__ void k(float* a)\n", "const auto p = threadIdx.x;\n", "if (p < n) a[p] = 1;\n", "__shared__ float s[32];\n", "a[threadIdx.y] = 2;\n")
    bit = lambda i: F.floor(F.col("p_partkey") / (1 << i)) % 2 == 1
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("p_size") % len(values) + 1).cast("int"))
    code = F.concat(*[F.when(bit(i), p).otherwise("") for i, p in enumerate(pieces)], pick(SYNCS), F.lit("\n"), pick(BLOCKS))
    return t.part.select(F.col("p_partkey").alias("part"), cuda_score(code, F.col("p_size") % 5 == 0).alias("score"))


@query(
    f"""WITH {POOL_SQL}, s AS (SELECT *, ['KERNEL', 'INFRA', 'ORACLE', NULL][q % 4 + 1] AS owner FROM pool)
SELECT job, candidate, CASE WHEN compile = 'pass' THEN 'validate' WHEN coalesce(owner, '') = 'INFRA' THEN 'retry_oracle' WHEN repairs < 2 THEN 'repair' ELSE 'collect_candidate' END AS compiled,
 CASE WHEN oracle_blocked THEN 'collect_candidate' WHEN owner IN ('ORACLE', 'INFRA') THEN 'retry_oracle' WHEN refval_status = 'pass' OR owner IS NULL THEN 'judge' WHEN repairs < 2 THEN 'repair' ELSE 'collect_candidate' END AS validated,
 CASE WHEN critic_status = 'failed' AND score > 5 AND repairs < 2 THEN 'bank_pre_repair' ELSE 'collect_candidate' END AS criticised,
 CASE WHEN contract = 'pass' THEN 'judge' WHEN repairs < 2 THEN 'repair' WHEN candidate < 3 THEN 'next_candidate' ELSE 'save_abandoned' END AS gated,
 CASE WHEN q % 5 = 0 THEN 'save_abandoned' WHEN score >= 5 THEN CASE WHEN q % 2 = 0 THEN 'cot' ELSE 'save_abandoned' END WHEN repairs < 2 THEN 'repair' WHEN candidate < 3 THEN 'next_candidate' ELSE 'save_abandoned' END AS judged,
 CASE WHEN q % 5 = 0 THEN 'knowledge_judge_unavailable' WHEN score >= 5 AND q % 2 = 1 THEN 'knowledge_judge_unverified' ELSE 'knowledge_quality' END AS reason FROM s"""
)
def route_next_stage(t: Tables) -> DataFrame:
    """Where a candidate goes after each gate, kernels and answers alike."""
    owner = F.element_at(F.array(F.lit("KERNEL"), F.lit("INFRA"), F.lit("ORACLE"), F.lit(None)), F.col("q") % 4 + 1)
    repairs, cap, most, candidate = F.col("repairs"), F.lit(2), F.lit(3), F.col("candidate")
    away, passed, accepted = F.col("q") % 5 == 0, F.col("score") >= 5, F.col("q") % 2 == 0
    fix = F.when(F.col("score") > 5, F.array(F.lit("bounds"))).otherwise(F.array(F.lit(" ")))
    return pool(t).select(
        "job", "candidate", R.after_compile(F.col("compile") == "pass", owner, repairs, cap).alias("compiled"),
        R.after_validate(F.col("oracle_blocked"), F.col("refval_status") == "pass", F.lit(True), owner, repairs, cap).alias("validated"), R.after_critic(F.col("critic_status"), fix, repairs, cap).alias("criticised"),
        R.after_answer_gate(F.col("contract") == "pass", repairs, cap, candidate, most).alias("gated"), R.after_judge(away, passed, accepted, repairs, cap, candidate, most).alias("judged"), R.abandon_reason(away, passed, accepted).alias("reason"),
    )


STATUS = "['pass', 'fail', 'skip', 'reference_error']"


@query(f"SELECT l_orderkey AS job, l_linenumber AS candidate, CASE WHEN s = 'fail' THEN e <> 'reference_error' OR strict WHEN s IN ('skip', 'reference_error') THEN strict ELSE false END AS blocked FROM (SELECT *, {STATUS}[CAST(l_partkey % 4 AS INT) + 1] AS s, CASE WHEN l_suppkey % 2 = 0 THEN 'reference_error' ELSE 'crash' END AS e, l_linestatus = 'O' AS strict FROM lineitem)")
def save_block(t: Tables) -> DataFrame:
    """Whether a numeric report keeps a candidate from being saved."""
    status = F.element_at(F.array(*map(F.lit, ("pass", "fail", "skip", "reference_error"))), (F.col("l_partkey") % 4 + 1).cast("int"))
    error = F.when(F.col("l_suppkey") % 2 == 0, "reference_error").otherwise("crash")
    return t.lineitem.select(F.col("l_orderkey").alias("job"), F.col("l_linenumber").alias("candidate"), R.blocks_save(status, error, F.col("l_linestatus") == "O").alias("blocked"))


@query(f"WITH s AS (SELECT l_returnflag, coalesce({STATUS}[CAST(l_partkey % 8 AS INT) + 1], 'pass') AS s, l_suppkey % 9 = 0 AND l_returnflag = 'R' AS sig FROM lineitem) SELECT l_returnflag AS run, count(*) AS n, count(*) FILTER (s = 'pass') AS n_pass, count(*) FILTER (s = 'fail') AS n_fail, count(*) FILTER (s = 'skip') AS n_skip, count(*) FILTER (s = 'reference_error') AS n_reference, count(*) FILTER (sig) AS n_signature, (count(*) FILTER (s = 'reference_error') + count(*) FILTER (sig)) / count(*) > 0.2 AS alarm FROM s GROUP BY ALL")
def refval_offline_summary(t: Tables) -> DataFrame:
    """Counts of an offline validation, and the alarm over a fifth of faulty references."""
    status = F.coalesce(F.try_element_at(F.array(*map(F.lit, ("pass", "fail", "skip", "reference_error"))), (F.col("l_partkey") % 8 + 1).cast("int")), F.lit("pass"))
    n = lambda s: F.count_if(F.col("s") == s)
    rows = t.lineitem.select(F.col("l_returnflag").alias("run"), status.alias("s"), ((F.col("l_suppkey") % 9 == 0) & (F.col("l_returnflag") == "R")).alias("sig"))
    faulty = n("reference_error") + F.count_if("sig")
    return rows.groupBy("run").agg(F.count("*").alias("n"), n("pass").alias("n_pass"), n("fail").alias("n_fail"), n("skip").alias("n_skip"), n("reference_error").alias("n_reference"), F.count_if("sig").alias("n_signature"), (faulty / F.count("*") > 0.2).alias("alarm"))


SEED = "sha256(p_partkey || '|case|' || lower(trim(p_brand)) || '|')"


@query(f"SELECT p_partkey AS question, CAST(('0x' || {SEED}[7:8] || {SEED}[5:6] || {SEED}[3:4] || {SEED}[1:2]) AS BIGINT) & 2147483647 AS seed FROM part")
def case_seed(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("question"), R.case_seed(F.col("p_partkey"), F.col("p_brand")).alias("seed"))


POLICY = "['synthetic', 'drop_cot', 'first_turn']"


@query(f"""WITH {POOL_SQL}, s AS (SELECT *, {POLICY}[CAST(l_partkey % 3 AS INT) + 1] AS policy FROM pool)
SELECT job, candidate, CASE WHEN repairs = 0 OR policy = 'first_turn' THEN 'r' || q ELSE '' END AS text, CASE WHEN repairs = 0 OR policy = 'first_turn' THEN 'field' ELSE 'none' END AS source, CASE WHEN repairs = 0 OR policy = 'first_turn' THEN 'polish' WHEN policy = 'drop_cot' THEN 'drop' ELSE 'synthetic' END AS mode FROM s""")
def reasoning_policy(t: Tables) -> DataFrame:
    policy = F.element_at(F.array(*map(F.lit, ("synthetic", "drop_cot", "first_turn"))), (F.col("l_partkey") % 3 + 1).cast("int"))
    return pool(t).select("job", "candidate", R.reasoning_choice(F.col("repairs"), policy, F.concat(F.lit("r"), F.col("q").cast("string")), F.lit("field")).alias("x")).select("job", "candidate", "x.*")


@query(f"""WITH {POOL_SQL} SELECT job, candidate, CASE WHEN critic_status = 'unverified' THEN 'critic_unverified' WHEN critic_status = 'failed' THEN 'critic_rejected' WHEN refval_status = 'fail' THEN 'refval_fail' WHEN oracle_blocked THEN CASE WHEN q % 2 = 0 THEN 'timeout' ELSE 'abandoned' END WHEN q % 2 = 0 THEN 'timeout' END AS kind FROM pool""")
def failure_record(t: Tables) -> DataFrame:
    """What a row's failure is called, by precedence; null without one."""
    status, category = F.when(F.col("oracle_blocked"), "abandoned").otherwise("success"), F.when(F.col("q") % 2 == 0, "timeout").otherwise("")
    return pool(t).select("job", "candidate", R.failure_kind(F.col("critic_status"), F.col("refval_status"), status, category).alias("kind"))


@query("SELECT l_orderkey AS job, l_returnflag AS case_name, min(l_linenumber) AS kept, count(*) AS copies FROM lineitem GROUP BY ALL")
def case_dedupe(t: Tables) -> DataFrame:
    """The first case of each name in a job."""
    return t.lineitem.groupBy(F.col("l_orderkey").alias("job"), F.col("l_returnflag").alias("case_name")).agg(F.min("l_linenumber").alias("kept"), F.count("*").alias("copies"))


@query("WITH o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY l_linenumber DESC, l_extendedprice DESC, l_returnflag DESC) AS rn FROM lineitem) SELECT l_orderkey AS question, l_linestatus AS dialect, l_linenumber AS attempt, l_extendedprice AS source, l_returnflag <> 'R' AS success FROM o WHERE rn = 1")
def final_sources(t: Tables) -> DataFrame:
    """The last attempt of each question and dialect; ties go to the greater source."""
    last = F.max(F.struct("l_linenumber", "l_extendedprice", "l_returnflag")).alias("x")
    rows = t.lineitem.groupBy(F.col("l_orderkey").alias("question"), F.col("l_linestatus").alias("dialect")).agg(last)
    return rows.select("question", "dialect", F.col("x.l_linenumber").alias("attempt"), F.col("x.l_extendedprice").alias("source"), (F.col("x.l_returnflag") != "R").alias("success"))


@query(f"""WITH {POOL_SQL} SELECT job, count(*) AS candidates, count(*) FILTER (compile <> 'pass' OR contract = 'fail') AS failed, string_agg(candidate || ':' || CASE WHEN compile <> 'pass' THEN 'compile' ELSE 'contract' END, ',' ORDER BY candidate, CASE WHEN compile <> 'pass' THEN 'compile' ELSE 'contract' END) FILTER (compile <> 'pass' OR contract = 'fail') AS errors FROM pool GROUP BY job""")
def candidate_errors(t: Tables) -> DataFrame:
    """The errors of a job's candidates, in candidate order; a failing one stops no other."""
    bad = (F.col("compile") != "pass") | (F.col("contract") == "fail")
    at = F.struct("candidate", F.concat(F.col("candidate").cast("string"), F.lit(":"), F.when(F.col("compile") != "pass", "compile").otherwise("contract")).alias("e"))
    errors = F.transform(F.array_sort(F.collect_list(F.when(bad, at))), lambda x: x["e"])
    return pool(t).groupBy("job").agg(F.count("*").alias("candidates"), F.count_if(bad).alias("failed"), F.nullif(F.array_join(errors, ","), F.lit("")).alias("errors"))


@query("SELECT o_orderkey AS job, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def progress_missing(t: Tables) -> DataFrame:
    """Planned jobs without a progress row."""
    done = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.where("o_orderstatus <> 'P'").join(done, "o_orderkey", "left_anti").select(F.col("o_orderkey").alias("job"), F.col("o_orderstatus").alias("status"))


@query("SELECT lang AS track, count(*) AS n, round(quantile_cont(CAST(length(text) AS DOUBLE), 0.5), 2) AS p50, round(quantile_cont(CAST(length(text) AS DOUBLE), 0.95), 2) AS p95, count(DISTINCT text) AS texts FROM documents GROUP BY ALL")
def dataset_metrics(t: Tables) -> DataFrame:
    """Row counts, different texts and exact length quantiles of each track."""
    docs = t.documents.select(F.col("lang").alias("track"), "text", F.length("text").alias("size"))
    sizes = percentiles(docs, "size", {"p50": 0.5, "p95": 0.95}, ["track"]).select("track", F.round("p50", 2).alias("p50"), F.round("p95", 2).alias("p95"))
    return beside(docs.groupBy("track").agg(F.count("*").alias("n"), F.countDistinct(F.sha2("text", 256)).alias("texts")), sizes, ["track"])


SYSTEMS = ("You are a Repairer.", "Use nvcc -c only.", "Fix the previous one; do not explain.", "Be precise.", "")
FLAGS_SQL = f"""f AS (SELECT p_partkey, p_brand, p_partkey % 5 IN (0, 2) AS repair, p_partkey % 5 IN (1, 2) AS protocol, p_size % 3 = 0 AS leak, p_size % 4 = 0 AS pool, p_size % 7 <> 0 AND p_partkey % 3 <> 0 AS refval FROM part)"""


def _flagged(t: Tables) -> DataFrame:
    """Archive rows made of parts: the system text, the thought, the pool and the report."""
    system = F.lower(F.element_at(F.array(*map(F.lit, SYSTEMS)), (F.col("p_partkey") % 5 + 1).cast("int")))
    think = F.when(F.col("p_size") % 3 == 0, "fixing the previous attempt").otherwise("we tile the rows")
    selected, count = F.when(F.col("p_size") % 4 == 0, 4).otherwise(2), F.lit(3)
    knowledge, status = F.col("p_size") % 7 == 0, F.when(F.col("p_partkey") % 3 == 0, "pass").otherwise("skip")
    return t.part.select("p_partkey", "p_brand", R.reasons(
        (R.any_of(system, R.REPAIR_MARKS), "repair_system_leak"), (R.any_of(system, R.PROTOCOL_MARKS), "protocol_system_leak"), (F.size(reasoning.repair_leaks(think, F.lit(""))) > 0, "cot_repair_leak"),
        (~selected.between(1, count), "pool_mismatch_risk"), (~knowledge & (status != "pass"), "no_refval_evidence"),
    ).alias("flags"))


FLAG_NAMES = {"repair": "repair_system_leak", "protocol": "protocol_system_leak", "leak": "cot_repair_leak", "pool": "pool_mismatch_risk", "refval": "no_refval_evidence"}
FLAG_LIST = "list_filter([" + ", ".join(f"CASE WHEN {k} THEN '{v}' END" for k, v in FLAG_NAMES.items()) + "], lambda x: x IS NOT NULL)"


@query(f"WITH {FLAGS_SQL} SELECT p_partkey AS row, array_to_string({FLAG_LIST}, ',') AS flags, len({FLAG_LIST}) > 0 AS needs_regen FROM f")
def audit_flags(t: Tables) -> DataFrame:
    """Independent defect labels of each archive row."""
    return _flagged(t).select(F.col("p_partkey").alias("row"), F.array_join("flags", ",").alias("flags"), (F.size("flags") > 0).alias("needs_regen"))


@query(f"WITH {FLAGS_SQL}, x AS (SELECT unnest({FLAG_LIST}) AS flag FROM f) SELECT flag, count(*) AS n, round(count(*) / (SELECT count(*) FROM part), 4) AS ratio FROM x GROUP BY flag")
def audit_split_counts(t: Tables) -> DataFrame:
    """How many rows carry each flag, and their share of all rows."""
    total = _flagged(t).agg(F.count("*").alias("total"))
    counts = _flagged(t).select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(total)).select("flag", "n", F.round(F.col("n") / F.col("total"), 4).alias("ratio"))


@query("SELECT s_suppkey AS worker, d.dialect, CASE WHEN nvcc AND s_suppkey % 3 = 0 THEN 'nvcc is not installed' WHEN nvcc AND s_nationkey % 4 = 0 THEN 'no GPU' WHEN torch AND s_suppkey % 5 = 0 THEN 'torch is not installed' ELSE 'ok' END AS status FROM supplier, (VALUES ('cuda', true, false), ('cutlass', true, false), ('triton', false, true), ('tilelang', false, true)) AS d(dialect, nvcc, torch)")
def capability_join(t: Tables) -> DataFrame:
    """Which dialects each worker can run, or what it lacks. The four dialects are exploded, not joined."""
    needs = F.array(*[F.struct(F.lit(d).alias("dialect"), F.lit(n).alias("nvcc"), F.lit(not n).alias("torch")) for d, n in (("cuda", True), ("cutlass", True), ("triton", False), ("tilelang", False))])
    rows = t.supplier.select("s_suppkey", "s_nationkey", F.explode(needs).alias("d")).select("s_suppkey", "s_nationkey", "d.*")
    status = F.when(F.col("nvcc") & (F.col("s_suppkey") % 3 == 0), "nvcc is not installed").when(F.col("nvcc") & (F.col("s_nationkey") % 4 == 0), "no GPU").when(F.col("torch") & (F.col("s_suppkey") % 5 == 0), "torch is not installed").otherwise("ok")
    return rows.select(F.col("s_suppkey").alias("worker"), "dialect", status.alias("status"))


MATRIX = ("elementwise_add", "scale", "row_sum"), ("cuda", "cutlass", "triton", "tilelang")


@query(f"""WITH m AS (SELECT task, dialect, mutant, task || '/' || dialect || CASE WHEN mutant THEN '/mutant' ELSE '/good' END AS key FROM (SELECT unnest({list(MATRIX[0])}) AS task), (SELECT unnest({list(MATRIX[1])}) AS dialect), (SELECT unnest([false, true]) AS mutant)),
r AS (SELECT {list(MATRIX[0])}[p_size % 3 + 1] AS task, {list(MATRIX[1])}[p_partkey % 4 + 1] AS dialect, p_size % 4 > 1 AS mutant, p_retailprice > 910 AS ok FROM part WHERE NOT (p_size % 3 = 2 AND p_partkey % 4 = 3))
SELECT key, m.task, m.dialect, m.mutant, count(r.task) AS runs, count(*) FILTER (r.ok) AS passed, count(r.task) = 0 AS missing FROM m LEFT JOIN r USING (task, dialect, mutant) GROUP BY ALL""")
def canonical_matrix(t: Tables) -> DataFrame:
    """Every task, dialect and variant with the runs that parts stand for; a cell without a run is missing."""
    pick = lambda values, c, n: F.element_at(F.array(*map(F.lit, values)), (F.col(c) % n + 1).cast("int"))
    runs = t.part.where("not (p_size % 3 = 2 and p_partkey % 4 = 3)").select(pick(MATRIX[0], "p_size", 3).alias("task"), pick(MATRIX[1], "p_partkey", 4).alias("dialect"), (F.col("p_size") % 4 > 1).alias("mutant"), (F.col("p_retailprice") > 910).alias("ok"))
    counts = runs.groupBy("task", "dialect", "mutant").agg(F.count("*").alias("runs"), F.count_if("ok").alias("passed"))
    cells = t.spark.range(1).select(F.explode(F.array(*map(F.lit, MATRIX[0]))).alias("task"))
    cells = cells.withColumn("dialect", F.explode(F.array(*map(F.lit, MATRIX[1])))).withColumn("mutant", F.explode(F.array(F.lit(False), F.lit(True))))
    key = F.concat_ws("/", "task", "dialect", F.when(F.col("mutant"), "mutant").otherwise("good"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return cells.join(counts, ["task", "dialect", "mutant"], "left").select(key.alias("key"), "task", "dialect", "mutant", zero("runs"), zero("passed"), F.col("runs").isNull().alias("missing"))


@query("""WITH s AS (SELECT lang, source, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id) AS depth FROM documents) SELECT lang, source, count(*) AS available, count(*) FILTER (depth <= 5) AS chosen, min(doc_id) FILTER (depth <= 5) AS least FROM s GROUP BY ALL""")
def sample_stats(t: Tables) -> DataFrame:
    """Strata of a sample of five a stratum: what there was and what was chosen. The depth is a top-k by window, which Spark limits to five rows a task before the shuffle."""
    order = Window.partitionBy("lang", "source").orderBy(F.sha2(F.col("doc_id").cast("string"), 256), "doc_id")
    top = t.documents.select("lang", "source", "doc_id").withColumn("depth", F.row_number().over(order)).where("depth <= 5").groupBy("lang", "source").agg(F.count("*").alias("chosen"), F.min("doc_id").alias("least"))
    sizes = t.documents.groupBy("lang", "source").agg(F.count("*").alias("available"))
    both = F.expr("t.lang <=> s.lang and t.source <=> s.source")
    return sizes.alias("s").join(top.alias("t"), both).select("s.lang", "s.source", "available", "chosen", "least")
