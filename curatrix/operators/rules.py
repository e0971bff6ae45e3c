"""Rules over gates, errors, answers and archive rows, as column expressions.

Each takes columns and returns one; nulls in texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.functions.reasoning import SOURCE_MARKS

# Error patterns, in order of precedence.
MISSING_HEADER = r"(?i)no such file or directory|cannot find|file not found|fatal error:.*\.h|no module named"
UNDECLARED = r"(?i)was not declared|undeclared identifier|identifier .* is undefined|nameerror|not defined"
SYNTAX = r"(?i)expected |syntax error|invalid syntax|missing (?:semicolon|;)"
TEMPLATE = r"(?i)template|cute::|cutlass::|substitution failure|no matching function"
IMPORT_TIME = r"(?i)timed out|timeout|import[- ]time|at import"
JIT_COMPILE = r"(?i)lowering failed|no @triton\.jit kernel|no tilelang prim_func|prim_?func|jitkernel|unsupported tilelang|compilationerror|triton\.compiler"
C_COMMENT = r"//[^\n]*|(?s:/\*.*?\*/)"
PY_COMMENT_OR_STRING = r"(?s:\"\"\".*?\"\"\"|'''.*?''')|\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*'|#[^\n]*"
SM90_MARKS = ("SM90", "cute::SM90", "tma_load", "cp.async.bulk")
REFVAL_CLASSES = ("numeric_mismatch", "nan_inf", "crash", "timeout", "signature_mismatch", "reference_error")
RETRYABLE_STATUS = (408, 409, 425, 429, 500, 502, 503, 504, 529)
RETRY_HINTS = ("overloaded", "unavailable", "temporarily", "upstream", "rate limit", "timeout", "try again", "capacity", "incomplete chunked", "peer closed", "connection reset", "broken pipe")
LEAST_TOKENS, TOKENS_CAP = 256, 32768
TRITON_MARKS = ("@triton.jit", "triton.language", "tl.program_id")
TILELANG_MARKS = ("T.prim_func", "T.Kernel", "tilelang.language", "@tilelang.jit")
CUTLASS_MARKS = ("cute::", "cutlass::", "make_tensor", "make_layout")
RDC_HINTS = ("relocatable device code", "-rdc=true", "rdc=true", "dynamic parallelism", "cudalaunchdevice", "__global__ function from a __device__", "calling a __global__ function from device", "cannot call a __global__ function from device")
LIBRARIES = {"cufft": "-lcufft", "curand": "-lcurand", "cublas": "-lcublas"}
HEADING = r"(?md)^(#{1,4}\s+\S+|#{0,4}\s*(结论|推导|机制|适用边界|答案|Answer|Conclusion|Derivation|Caveats)\b)"
NUMBERED = r"(?md)^\s*(?:\d+[\.\)]\s+\S+|[-*]\s+\S+)"
EQUATION = r"(\$[^$]+\$)|(\\frac\b)|(\\mathrm\b)|(occupancy\s*=)|([A-Za-z\\][A-Za-z0-9_\\{}]*\s*=\s*[^\n]{1,80})|[≈≤≥]"
STEP = r"(?i)(因此|所以|故|假设|其中|step\s*\d|therefore|where\b|thus\b|hence\b|推导)"
DERIVATION_ASKED = r"(?i)推导|证明|逐步计算|计算过程|\bderive\b|\bderivation\b|\bprove\b|\bcalculate\b|\bstep[- ]by[- ]step\b|\bshow (?:your |the )?work\b|\bwhy does\b|为什么"
FENCED = r"(?s)```[^\n]*\n(.*?)```"
CODE_RATIO_MAX = 0.40
REPAIR_MARKS = ("repairer", "compile-fix", "rewriting a failed", "fix the previous")
PROTOCOL_MARKS = ("nvcc -c", "do not explain", "compile-only gate", "downstream checker")
BOUNDS = r"\b(if|while)\s*\([^)]{0,160}\b(idx|tid|gid|index|i|col|row|x|y|n|size|N)\b"
BLOCK_SIZE = r"\b(?:block(?:Dim|Size)|BLOCK(?:_SIZE|DIM)|THREADS(?:_PER_BLOCK)?)\s*=\s*(\d+)"
DIM3 = r"\bdim3\s+\w+\s*\(\s*(\d+)"


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def any_of(c: Column, marks) -> Column:
    out = F.lit(False)
    for mark in marks:
        out = out | c.contains(mark)
    return out


def reasons(*pairs: tuple[Column, str | Column]) -> Column:
    """The labels whose condition holds, in the given order."""
    return F.filter(F.array(*[F.when(c, F.lit(v) if isinstance(v, str) else v) for c, v in pairs]), lambda x: x.isNotNull())


def compile_error_class(error: Column, dialect: Column, code: Column) -> Column:
    e, d = text(error), F.lower(F.trim(F.coalesce(dialect, F.lit("cuda"))))
    python = d.isin("triton", "tilelang")
    source = F.when(python, F.regexp_replace(text(code), PY_COMMENT_OR_STRING, " ")).otherwise(F.regexp_replace(text(code), C_COMMENT, " "))
    low, kernel = F.lower(e), source.contains("__global__")
    leak = ((d == "triton") & kernel) | ((d == "tilelang") & kernel & ~F.lower(source).contains("tilelang")) | ((d == "cutlass") & any_of(source, SM90_MARKS))
    out = F.when(low.contains("no ") & low.contains("source extracted"), "empty_source").when(leak, "dialect_violation")
    out = out.when(e.rlike(MISSING_HEADER), "missing_header").when(e.rlike(UNDECLARED), "undeclared").when(e.rlike(SYNTAX), "syntax")
    out = out.when(d.isin("cuda", "cutlass") & e.rlike(TEMPLATE), "template")
    return out.when(python & e.rlike(IMPORT_TIME), "import_time").when(python & e.rlike(JIT_COMPILE), "jit_compile").otherwise("other")


def refval_error_class(error: Column, given: Column, report: bool = False) -> Column:
    """The class of a numeric failure; a report's own class counts as it stands."""
    e, preset = F.lower(text(error)), F.lower(F.trim(text(given)))
    own = text(given) if report else preset
    out = F.when((own != "") if report else preset.isin(*REFVAL_CLASSES), own)
    out = out.when(any_of(e, ("timeout", "timed out")), "timeout").when(e.contains("reference"), "reference_error")
    out = out.when(any_of(e, ("signature", "undeclared", "not declared", "no matching" if report else "no matching function")), "signature_mismatch")
    out = out.when(any_of(e, ("nan", "inf mismatch") if report else ("nan", "inf mismatch", "inf in")), "nan_inf")
    out = out.when(any_of(e, ("crash", "cuda error", "segfault", "aborted") if report else ("crash", "cuda error", "segfault", "aborted", "illegal")), "crash")
    return out.otherwise("numeric_mismatch")


def live_error_category(error: Column) -> Column:
    e = F.lower(text(error))
    ladder = (
        ("timeout", ("timeout", "timed out", "deadline")), ("authentication", ("401", "403", "unauthorized", "api key", "authentication")),
        ("rate_limit", ("429", "rate limit", "too many")), ("provider_overload", ("overload", "capacity", "temporarily unavailable")), ("parse_failure", ("parse", "json", "extract")),
    )
    out = F.lit("agent_error")
    for label, marks in reversed(ladder):
        out = F.when(any_of(e, marks), label).otherwise(out)
    return out


def retryable(status: Column, error: Column) -> Column:
    """By status first; a refused key is never retried, hints in the text decide the rest."""
    s = F.coalesce(status, F.lit(0))
    return ~s.isin(401, 403) & (s.isin(*RETRYABLE_STATUS) | any_of(F.lower(text(error)), RETRY_HINTS))


def affordable_tokens(status: Column, error: Column, current: Column) -> Column:
    """A smaller token budget after a billing error, or null."""
    e = F.lower(text(error))
    billing = (F.coalesce(status, F.lit(0)) == 402) | any_of(e, ("billing_error", "can only afford")) | (e.contains("payment_required") & e.contains("credits"))
    stated = F.nullif(F.regexp_extract(e, r"can only afford (\d+)", 1), F.lit("")).cast("int")
    half = F.least(F.floor(current / 2).cast("int"), F.lit(TOKENS_CAP))
    named = F.least(current - 1, stated - 1)
    return F.when(~billing, None).when(stated.isNotNull(), F.when(named >= LEAST_TOKENS, named)).otherwise(F.when((half >= LEAST_TOKENS) & (half < current), half))


def answer_gate(answer: Column, topic: Column, question: Column, facts: Column, least: int = 400) -> Column:
    """Why an answer must not be saved, in order; empty if it may."""
    a, name, some = text(answer), F.lower(F.trim(F.coalesce(topic, F.lit("general")))), F.trim(text(answer)) != ""
    fenced = F.aggregate(F.regexp_extract_all(a, F.lit(FENCED), F.lit(1)), F.lit(0), lambda n, x: n + F.length(x))
    n_numbered = F.regexp_count(a, F.lit(NUMBERED))
    structured = a.rlike(HEADING) | (n_numbered >= 2)
    derived = (F.regexp_count(a, F.lit(STEP)) >= 2) | (n_numbered >= 3)
    body = F.regexp_replace(a, r"\s+$", "")
    cut = body.rlike(r"(?i)(?:\.\.\.\s*\[truncated[^\]]*\]|\[truncated[^\]]*\]|\.\.\.|…)$") | body.rlike(r"(?:,|:|;|=|->|→)$")
    count = lambda mark: F.floor((F.length(body) - F.length(F.replace(body, F.lit(mark), F.lit("")))) / len(mark))
    gate = reasons(
        (F.length(F.regexp_replace(a, r"^\s+|\s+$", "")) < least, "short"), ((fenced / F.greatest(F.length(a), F.lit(1)) > CODE_RATIO_MAX) & (name != "worked_example"), "fence_ratio"),
        (some & ~structured, "unstructured"), ((name == "formula") & some & ~a.rlike(EQUATION), "no_equation"), (text(question).rlike(DERIVATION_ASKED) & some & ~derived, "no_steps"),
    )
    integrity = reasons((cut, "truncated"), (F.regexp_count(body, F.lit(r"(?md)^[ \t]*```")) % 2 == 1, "open_fence"), ((count("$$") % 2 == 1) | (count("\\[") != count("\\]")), "open_equation"))
    return F.concat(gate, facts, integrity)


def after_compile(ok: Column, owner: Column, repairs: Column, cap: Column) -> Column:
    return F.when(ok, "validate").when(F.coalesce(owner, F.lit("")) == "INFRA", "retry_oracle").when(repairs < cap, "repair").otherwise("collect_candidate")


def after_validate(blocked: Column, ok: Column, gated: Column, owner: Column, repairs: Column, cap: Column) -> Column:
    o = F.coalesce(owner, F.lit(""))
    return F.when(blocked, "collect_candidate").when(o.isin("ORACLE", "INFRA"), "retry_oracle").when(ok | (gated & owner.isNull()), "judge").when(repairs < cap, "repair").otherwise("collect_candidate")


def after_critic(status: Column, must_fix: Column, repairs: Column, cap: Column) -> Column:
    """Only a rejection with something to act on is repaired."""
    actionable = F.exists(F.coalesce(must_fix, F.array().cast("array<string>")), lambda x: F.trim(x) != "")
    return F.when((F.coalesce(status, F.lit("skipped")) == "failed") & actionable & (repairs < cap), "bank_pre_repair").otherwise("collect_candidate")


def after_answer_gate(ok: Column, repairs: Column, cap: Column, candidate: Column, most: Column) -> Column:
    return F.when(ok, "judge").when(repairs < cap, "repair").when(candidate < most, "next_candidate").otherwise("save_abandoned")


def after_judge(unavailable: Column, passed: Column, accepted: Column, repairs: Column, cap: Column, candidate: Column, most: Column) -> Column:
    return F.when(unavailable, "save_abandoned").when(passed, F.when(accepted, "cot").otherwise("save_abandoned")).when(repairs < cap, "repair").when(candidate < most, "next_candidate").otherwise("save_abandoned")


def abandon_reason(unavailable: Column, passed: Column, accepted: Column) -> Column:
    return F.when(unavailable, "knowledge_judge_unavailable").when(passed & ~accepted, "knowledge_judge_unverified").otherwise("knowledge_quality")


def blocks_save(status: Column, error_class: Column, strict: Column) -> Column:
    return F.when(status == "fail", (text(error_class) != "reference_error") | strict).otherwise(status.isin("skip", "reference_error") & strict)


def case_seed(question: Column, case: Column, salt: str = "") -> Column:
    """31 bits of the digest's first bytes, read little-endian; the same in every dialect."""
    h = F.sha2(F.concat_ws("|", question.cast("string"), F.lit("case"), F.lower(F.trim(case)), F.lit(salt)), 256)
    low = F.concat(*[F.substring(h, i, 2) for i in (7, 5, 3, 1)])
    return F.conv(low, 16, 10).cast("long").bitwiseAND(0x7FFFFFFF)


def reasoning_choice(repairs: Column, policy: Column, first: Column, source: Column) -> Column:
    """(text, source, mode): the first turn's reasoning unless repairs made it untrue."""
    kept = (F.coalesce(repairs, F.lit(0)) == 0) | (policy == "first_turn")
    return F.struct(
        F.when(kept, text(first)).otherwise("").alias("text"), F.when(kept, F.coalesce(source, F.lit("empty"))).otherwise("none").alias("source"),
        F.when(kept, "polish").when(policy == "drop_cot", "drop").otherwise("synthetic").alias("mode"),
    )


def critic_status(reply: Column) -> Column:
    """verified, failed or unverified; something to fix beats a pass."""
    body = F.coalesce(F.nullif(F.regexp_extract(text(reply), r"(?s)```(?:json)?[^\n]*\n(.*?)```", 1), F.lit("")), text(reply))
    v = F.from_json(body, "`pass` boolean, must_fix array<string>")
    decided = v["pass"].isNotNull() | v["must_fix"].isNotNull()
    fix = F.exists(F.coalesce(v["must_fix"], F.array().cast("array<string>")), lambda x: F.trim(x) != "")
    return F.when(~F.coalesce(decided, F.lit(False)), "unverified").when(fix | ~F.coalesce(v["pass"], F.lit(False)), "failed").otherwise("verified")


def failure_kind(critic: Column, refval: Column, status: Column, category: Column) -> Column:
    r = F.lower(text(refval))
    out = F.when(critic == "unverified", "critic_unverified").when(critic == "failed", "critic_rejected").when(r.isin("fail", "reference_error"), F.concat(F.lit("refval_"), r))
    given = F.nullif(category, F.lit(""))
    return out.when(status.isin("abandoned", "crashed", "incomplete") | given.isNotNull(), F.coalesce(given, status))


def dataset_version(version: Column, prefix: str) -> Column:
    """The number after the prefix, 0 for anything else."""
    return F.coalesce(F.nullif(F.regexp_extract(text(version), rf"^{prefix}-(\d+)$", 1), F.lit("")).cast("int"), F.lit(0))


def is_kernel(task: Column, language: Column, track: Column) -> Column:
    return (text(task) != "knowledge") & (text(language) != "prose") & ~text(track).startswith("knowledge:")


def looks_like(source: Column) -> Column:
    """Dialects whose marks a source shows."""
    cuda = any_of(F.lower(text(source)), [m.lower() for m in SOURCE_MARKS])
    return reasons((cuda, "cuda"), (any_of(text(source), TRITON_MARKS), "triton"), (any_of(text(source), TILELANG_MARKS), "tilelang"), (cuda | any_of(text(source), CUTLASS_MARKS), "cutlass"))


def link_flags(source: Column) -> Column:
    return reasons(*[(text(source).rlike(rf"\b{name}[A-Za-z0-9_]*\s*\("), flag) for name, flag in LIBRARIES.items()])


def abi_issues(entry: Column, params: Column, returns: Column) -> Column:
    """Self-check of an interface; params are (name, kind, dtype, rank, shape_from)."""
    none = F.array().cast("array<string>")
    names = F.transform(params, lambda p: p["name"])
    outputs = F.exists(params, lambda p: p["kind"].isin("output", "inout"))
    tensors = F.filter(params, lambda p: p["kind"].isin("input", "output", "inout"))
    unknown = F.flatten(F.transform(tensors, lambda p: F.transform(F.filter(F.coalesce(p["shape_from"], none), lambda d: ~F.array_contains(names, d)), lambda d: F.concat(p["name"], F.lit(" from "), d))))
    handles = F.transform(F.filter(params, lambda p: p["dtype"].isin("cublas_handle", "cufft_handle") & (p["kind"] != "scalar")), lambda p: F.concat(p["name"], F.lit(" must be scalar")))
    plan = F.exists(params, lambda p: p["dtype"] == "cufft_handle") & ~F.exists(params, lambda p: p["kind"].isin("input", "inout") & (p["dtype"] == "c64") & (p["rank"] == 2))
    return F.concat(
        reasons((~text(entry).rlike(r"^[A-Za-z_]\w*$"), "entry"), (F.size(params) == 0, "no parameters"), (F.size(F.array_distinct(names)) < F.size(names), "duplicate names")),
        unknown, handles, reasons((text(returns).isin("cublas_handle", "cufft_handle"), "handle returned"), (plan, "no plan input"), (~outputs & text(returns).isin("", "void"), "no output")),
    )


FENCE_LANGS = ("cuda", "cu", "cpp", "c++", "cc", "cxx", "c", "hpp")


def fenced_source(reply: Column) -> Column:
    """The source of a reply: its last fenced body that looks like device code, else the last
    in a listed language, else the last, else the whole; one line end follows."""
    whole = T.strip_thinking(text(reply))
    fence = r"(?s)```([^\n]*)\n(.*?)```"
    parts = F.arrays_zip(F.regexp_extract_all(whole, F.lit(fence), F.lit(1)).alias("lang"), F.regexp_extract_all(whole, F.lit(fence), F.lit(2)).alias("body"))
    parts = F.filter(parts, lambda p: F.trim(F.translate(p["body"], "\n\t\r", "   ")) != "")
    device = F.filter(parts, lambda p: any_of(F.lower(p["body"]), [m.lower() for m in SOURCE_MARKS]))
    listed = F.filter(parts, lambda p: F.lower(F.trim(p["lang"])).isin(*FENCE_LANGS))
    last = lambda a: F.try_element_at(a, F.lit(-1))["body"]
    body = F.coalesce(last(device), last(listed), last(parts), whole)
    body = F.regexp_replace(body, r"^\s*(?:cuda|cu|cpp|c\+\+|c)[ \t]*\n", "")
    return ended(body)


def ended(body: Column) -> Column:
    """Without white space around it, and with one line end unless it is blank."""
    bare = F.regexp_replace(text(body), r"^\s+|\s+$", "")
    return F.when(bare == "", "").otherwise(F.concat(bare, F.lit("\n")))


def export_label(assistant: Column, code: Column, archived: Column, task: Column, reasoning: bool) -> Column:
    """The training label; prose stays prose, kernels are cut to their source. With
    ``reasoning`` the tagged thought, or else the archived one, comes before it."""
    said = text(assistant)
    tagged = T.extract_thinking(said)
    thought = F.trim(F.when(F.trim(tagged) != "", tagged).otherwise(text(archived)))
    prose = ended(T.strip_thinking(said))
    given = F.when(said == "", text(code)).otherwise(said)
    source = fenced_source(given)
    body = F.when(text(task) == "knowledge", F.when(prose == "", ended(code)).otherwise(prose)).otherwise(F.when(source == "", ended(code)).otherwise(source))
    return F.when(thought != "", F.concat(F.lit("<think>\n"), thought, F.lit("\n</think>\n"), body)).otherwise(body) if reasoning else body


def training_system(mode: Column, kind: Column, question: Column, generated: Column, prompts: dict[tuple[str, bool], str]) -> Column:
    """The system text of a training row; ``prompts`` are by kind and whether it is Chinese."""
    chinese = text(question).rlike("[㐀-鿿]")
    fixed = lambda k: F.when(chinese, prompts[k, True]).otherwise(prompts[k, False])
    return F.when(mode == "none", None).when(mode == "generation", text(generated)).otherwise(F.when(kind == "knowledge", fixed("knowledge")).otherwise(fixed("kernel")))


def general(x: Column, digits: int) -> Column:
    """A number with that many significant digits, without trailing zeros."""
    full = F.format_string(f"%.{digits}g", x.cast("double"))
    short = F.regexp_replace(F.regexp_replace(full, r"(\.[0-9]*?)0+(?=e|$)", "$1"), r"\.(?=e|$)", "")
    return F.when(x == 0, "0").otherwise(short)


def snapshot(compiled: Column, refval: Column, recorded: Column, cases: Column, critic: Column, skipped: Column, passed: Column, contract: Column, tier: Column) -> list[Column]:
    """(refval, cases_run, critic, contract) of a candidate, with defaults; what did not
    compile was not run, and a contract counts only if checked independently."""
    ran = F.when(compiled, F.coalesce(F.nullif(refval, F.lit("")), F.nullif(recorded, F.lit("")), F.lit("skip"))).otherwise("skip")
    reviewed = F.coalesce(critic, F.when(F.coalesce(skipped, F.lit(True)), "skipped").when(F.coalesce(passed, F.lit(True)), "verified").otherwise("failed"))
    kept = F.when((contract == "pass") & (text(tier) == "independent"), "pass").when(contract == "fail", "fail").otherwise("skip")
    return [ran, F.when(compiled, cases).otherwise(0), reviewed, kept]


def archive_message(row: Column, role: str) -> Column:
    """The first message of a role in a row's JSON, a value that is no text as ''; without such a message, the older fields."""
    v = F.from_json(row, "messages array<struct<role:string,content:string>>")
    said = F.filter(F.coalesce(v["messages"], F.array().cast("array<struct<role:string,content:string>>")), lambda m: m["role"] == role)
    older = {"system": ("system", "metadata.system"), "user": ("question", "user_prompt"), "assistant": ("assistant", "code", "output")}[role]
    return F.when(F.size(said) > 0, text(F.try_element_at(said, F.lit(1))["content"])).otherwise(F.coalesce(*[F.get_json_object(row, f"$.{p}") for p in older], F.lit("")))


# Required fields of an archive row's metadata, and their types.
REQUIRED = {
    "dataset_version": "STRING", "sample_key": "STRING", "question_hash": "STRING", "track": "STRING", "dialect": "STRING", "language": "STRING", "system_mode": "STRING", "user_mode": "STRING", "release_tier": "STRING",
    "source_line": "BIGINT", "candidate": "BIGINT", "repairs": "BIGINT", "generation": "OBJECT", "generation.system": "STRING", "generation.user": "STRING", "generation.prompt_variant": "OBJECT",
    "cot": "OBJECT", "cot.source": "STRING", "cot.policy": "STRING", "cot.chars": "BIGINT", "provenance": "OBJECT", "provenance.model": "STRING", "provenance.provider": "STRING", "provenance.prompt_packs": "OBJECT", "provenance.run_id": "STRING", "provenance.created_at": "STRING",
}
REQUIRED_KERNEL = {
    "selected_code_sha256": "STRING", "refval": "OBJECT", "critic": "OBJECT", "critic.status": "STRING", "judge": "OBJECT",
    "candidate_pool": "OBJECT", "candidate_pool.count": "BIGINT", "candidate_pool.selected_candidate": "BIGINT", "candidate_pool.eligible_count": "BIGINT", "candidate_pool.reports": "ARRAY",
}


def missing_fields(metadata: Column, required: dict[str, str]) -> Column:
    """Paths that are absent or of another type; a boolean is no integer."""
    v = F.try_parse_json(metadata)
    kind = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(v, f"$.{path}", "variant")), F.lit("VOID"))
    return reasons(*[(~kind(path).startswith(name), path) for path, name in required.items()])


def may_synthesize(mode: Column, on_empty: Column) -> Column:
    m = F.lower(F.trim(F.when(text(mode) == "", "raw").otherwise(mode)))
    return (m == "synthetic") | ((m == "raw") & (text(on_empty) == "synthetic"))


def raw_outcome(error: Column, issues: Column, structured: Column, needed: Column) -> Column:
    """(source, error) when a teacher's own reasoning stands in for an edited one."""
    say = lambda why: F.regexp_replace(F.concat(text(error), F.lit(f"; {why}")), r"^[; ]+", "")
    return F.when(needed & ~structured, F.struct(F.lit("empty").alias("source"), say("raw reasoning unstructured").alias("error"))).when(issues > 0, F.struct(F.lit("empty").alias("source"), say("raw reasoning inconsistent").alias("error"))).otherwise(F.struct(F.lit("raw").alias("source"), text(error).alias("error")))


COMPONENTS = ("generate", "compile", "repair", "refval", "critic", "cot")


def component_status(kind: Column, requested: Column) -> Column:
    """The first state of each component of a run, in their order."""
    own = lambda name: F.lit(True) if name in ("generate", "critic", "cot") else kind == "kernel"
    return F.array(*[F.when(~F.array_contains(requested, name), "not_requested").when(own(name), "pending").otherwise("not_applicable") for name in COMPONENTS])
