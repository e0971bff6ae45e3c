"""Checks of archive rows: one state a rule and row, from the row's JSON text."""

from __future__ import annotations

import ast
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.functions import reasoning
from curatrix.operators.judge import WEIGHTS

RULES = tuple(f"H{i}" for i in range(1, 14))
# Marks of repair and protocol prompts, of lines of prose, and of C++ sources;
# the tiers that promise a numeric check.
REPAIR_MARKS = ("repairer", "compile-fix", "rewriting a failed", "fix the previous")
PROTOCOL_MARKS = ("nvcc -c", "do not explain", "compile-only gate", "downstream checker")
EXPLAINING = r"(?im)^[^\S\n]*(?:here (?:is|are)|this (?:code|kernel)|the (?:code|kernel)|explanation:|note:|以下是|代码如下|说明[:：]|上述代码)"
SOURCE_SIGNS = (";", "{", "#include", "__global__", "<<<")
STRICT_TIERS = ("strict", "strict_perf")
# The fields that rows of version 2 must have, by type.
TEXTS = ("dataset_version", "sample_key", "question_hash", "track", "dialect", "language", "system_mode", "user_mode", "release_tier", "generation.system", "generation.user", "cot.source", "cot.policy", "provenance.model", "provenance.provider", "provenance.run_id", "provenance.created_at")
NUMBERS = ("source_line", "candidate", "repairs", "cot.chars")
OBJECTS = ("generation", "generation.prompt_variant", "cot", "provenance", "provenance.prompt_packs")
KERNEL_FIELDS = {"text": ("selected_code_sha256", "critic.status"), "object": ("refval", "critic", "judge", "candidate_pool"), "int": ("candidate_pool.count", "candidate_pool.selected_candidate", "candidate_pool.eligible_count"), "list": ("candidate_pool.reports",)}
REVIEW_FLAGS = {"pass": True, "unavailable": False, "skipped_llm": False, "hard_gate_failed": False}


#: Types by the names used above; a truth value is no number.
TYPES = {"text": str, "int": int, "number": (int, float), "bool": bool, "object": dict, "list": list}
CHECKED = "well_formed boolean, checks array<struct<rule:string,state:string,message:string>>, track string, tier string, repaired boolean, cot_chars int"
_CHECKED = pa.struct([("well_formed", pa.bool_()), ("checks", pa.list_(pa.struct([(x, pa.string()) for x in ("rule", "state", "message")]))), ("track", pa.string()), ("tier", pa.string()), ("repaired", pa.bool_()), ("cot_chars", pa.int32())])
#: Rows that a task checks at once.
AT_ONCE = 256
_LEAKS = [re.compile(p, re.IGNORECASE) for p in reasoning.LEAKS]
_EXPLAINING = re.compile(EXPLAINING)
_TAG = re.compile(r"</?(?:think|thinking|reasoning)>", re.IGNORECASE)
_THOUGHT = re.compile(r"<(?:think|thinking|reasoning)>(.*?)</(?:think|thinking|reasoning)>", re.IGNORECASE | re.DOTALL)


def at(value: object, path: str) -> object:
    for key in path.split("."):
        value = value.get(key) if isinstance(value, dict) else None
    return value


def is_a(value: object, kind: str) -> bool:
    return isinstance(value, TYPES[kind]) and (kind == "bool" or not isinstance(value, bool))


def lacking(meta: dict, fields: dict[str, tuple[str, ...]]) -> list[str]:
    return [path for kind, paths in fields.items() for path in paths if not is_a(at(meta, path), kind)]


def assistant_source(content: str, language: str) -> tuple[str, str, str]:
    """(thought, source, problem): one thought at most, then one source, bare or in one fence."""
    rest, thought = content.strip(), ""
    if rest.startswith("<think>"):
        head, closed, tail = rest[len("<think>") :].partition("</think>")
        if not closed:
            return "", "", "malformed thought"
        thought, rest = head.strip(), tail.strip()
    if _TAG.search(rest):
        return thought, "", "thinking tag in source"
    if "```" in rest:
        first, _, body = rest.partition("\n")
        whole = first.startswith("```") and "`" not in first[3:] and body.endswith("```")
        rest = body[:-3].strip()
        if not whole or "```" in rest:
            return thought, "", "not exactly one fence"
    if not rest:
        return thought, "", "empty source"
    if _EXPLAINING.search(rest):
        return thought, "", "explanation outside source"
    problem = ""
    if language != "python":
        problem = "" if any(sign in rest for sign in SOURCE_SIGNS) else "no source"
    else:
        try:
            problem = "prose" if all(isinstance(n, ast.Expr) for n in ast.parse(rest).body) else ""
        except (SyntaxError, ValueError):
            problem = "does not parse"
    return (thought, "", problem) if problem else (thought, rest + "\n", "")


def contradictions(thought: str, code: str) -> list[str]:
    """Repair narration, and constants that the code gives other values."""
    out = [f"repair leak: {m[0]}" for m in (p.search(thought) for p in _LEAKS) if m]
    for name, value in re.findall(reasoning.CONSTANT, thought):
        actual = {int(x) for x in re.findall(rf"\b{re.escape(name)}\b\s*(?:=|\s)\s*(\d+)", code)}
        if actual and int(value) not in actual:
            out.append(f"constant mismatch: {name}={value}")
    return list(dict.fromkeys(out))


def missing_fields(meta: dict, kernel: bool, assistant: str) -> list[str]:
    """Fields of a row of version 2 that are missing or wrong."""
    out = lacking(meta, {"text": TEXTS, "int": NUMBERS, "object": OBJECTS})
    if is_a(at(meta, "cot"), "object") and "consistency_issues" in meta["cot"]:
        out += lacking(meta, {"list": ("cot.consistency_issues",)})
    if kernel:
        return out + lacking(meta, KERNEL_FIELDS)
    out += lacking(meta, {"text": ("topic",), "object": ("knowledge_judge",)})
    review = meta.get("knowledge_judge")
    if not isinstance(review, dict):
        return out
    body = _THOUGHT.sub("", assistant).strip()
    wrong = [k for k, v in REVIEW_FLAGS.items() if review.get(k) is not v]
    wrong += ["judge_error"] * (review.get("judge_error", "") != "") + ["must_fix"] * (review.get("must_fix") != [])
    wrong += ["topic"] * ("topic" in review and review["topic"] != meta.get("topic"))
    wrong += ["answer_sha256"] * (not body or review.get("answer_sha256") != hashlib.sha256(body.encode()).hexdigest())
    scores = review.get("dimensions")
    good = lambda x: is_a(x, "number") and 1 <= x <= 10
    wrong += [f"dimensions.{k}" for k in WEIGHTS if not good(scores.get(k))] if isinstance(scores, dict) else ["dimensions"]
    return out + [f"knowledge_judge.{k}" for k in wrong + ["overall"] * (not good(review.get("overall")))]


def _parsed(line: str | None) -> tuple[dict | None, str, str, str]:
    """(metadata, system, assistant, problem) of a row."""
    try:
        row = json.loads(line or "")
    except ValueError:
        return None, "", "", "invalid JSON"
    messages, meta = (row.get("messages"), row.get("metadata")) if isinstance(row, dict) else (None, None)
    said = [(m.get("role"), m.get("content")) for m in messages] if isinstance(messages, list) and all(isinstance(m, dict) for m in messages) else []
    roles = [r for r, _ in said]
    if roles[-2:] != ["user", "assistant"] or roles[:-2] not in ([], ["system"]) or not all(isinstance(c, str) for _, c in said) or not isinstance(meta, dict):
        return None, "", "", "expected metadata and messages"
    return meta, said[0][1] if len(said) == 3 else "", said[-1][1], ""


def row_checks(line: str | None, set_name: str = "set") -> dict:
    """CHECKED of one row."""
    meta, system, assistant, broken = _parsed(line)
    state = {rule: ("n/a", "") for rule in RULES}

    def put(rule: str, message: str) -> None:
        state[rule] = ("fail", message) if message else ("pass", "")

    put("H1", broken)
    out = {"well_formed": meta is not None, "track": "unknown", "tier": "unknown", "repaired": False, "cot_chars": 0}
    if meta is not None:
        word = lambda key: str(meta.get(key) or "")
        kernel = meta.get("task") != "knowledge" and meta.get("language") != "prose" and not word("track").startswith("knowledge:")
        version = int(m[1]) if (m := re.fullmatch(rf"{re.escape(set_name)}-(\d+)", word("dataset_version"))) else 0
        prompt = system.lower()
        put("H2", "repair system text" * any(m in prompt for m in REPAIR_MARKS))
        if meta.get("system_mode") == "fixed":
            put("H3", "protocol in fixed system" * any(m in prompt for m in PROTOCOL_MARKS))
        thought, code = "\n\n".join(x.strip() for x in _THOUGHT.findall(assistant) if x.strip()), ""
        if kernel:
            thought, code, problem = assistant_source(assistant, word("language"))
            put("H4", problem)
        if kernel and code:
            if version >= 2:
                put("H5", "sha256 differs" * (hashlib.sha256(code.encode()).hexdigest() != meta.get("selected_code_sha256")))
            if "consistency_issues" in (meta.get("cot") if isinstance(meta.get("cot"), dict) else {}):
                put("H7", "; ".join(contradictions(thought, code)) if thought else "")
        put("H6", "repair narrative" * any(p.search(thought) for p in _LEAKS))
        if kernel and meta.get("release_tier") in STRICT_TIERS:
            cases = at(meta, "refval.cases_run")
            good = at(meta, "refval.status") == "pass" and is_a(cases, "int") and cases >= 3 and bool(at(meta, "refval.manifest_hash"))
            put("H8", "" if good else "no passing check of 3 cases")
        if version >= 2:
            put("H13", ", ".join(missing_fields(meta, kernel, assistant)))
        repairs = meta.get("repairs")
        out |= {"track": word("track") or word("dialect") or "unknown", "tier": word("release_tier") or "unknown", "repaired": isinstance(repairs, int) and repairs > 0, "cot_chars": len(thought)}
    return out | {"checks": [{"rule": r, "state": s, "message": m} for r, (s, m) in state.items()]}


def checked_batches(batches: Iterator[pa.RecordBatch], set_name: str) -> Iterator[pa.RecordBatch]:
    """The rows, whose last column is the line, with CHECKED in place of it; a few rows at once,
    as a row's checks take many times its bytes."""
    for batch in batches:
        for low in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(low, AT_ONCE)
            checked = pa.array([row_checks(x, set_name) for x in part.column(part.num_columns - 1).to_pylist()], _CHECKED)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *checked.flatten()], names=[*part.schema.names[:-1], *(f.name for f in _CHECKED)])


def checked_rows(rows: DataFrame, value: str = "value", set_name: str = "set") -> DataFrame:
    """Rows of a set whose versions are named ``set_name-N``: rows with well_formed, checks
    (array of rule, state, message), and track, tier, repaired and cot_chars for metrics. Rows
    that aren't JSON, or have no well-formed messages, fail H1 and no other rule applies to
    them; H9 to H12 apply to none. Types as they were written and Python sources are beyond
    the built-in functions, hence Arrow batches."""

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.select("*", F.col(value).cast("string").alias("__line")).mapInArrow(lambda batches: checked_batches(batches, set_name), f"{kept}, {CHECKED}")


def rule_counts(checked: DataFrame) -> DataFrame:
    """passed, failed and not_applicable rows of each rule; a set without rows fails H1 once."""
    state = F.col("c.state")
    counted = checked.select(F.explode("checks").alias("c")).groupBy(F.col("c.rule").alias("rule")).agg(F.count_if(state == "pass").alias("passed"), F.count_if(state == "fail").alias("failed"), F.count_if(state == "n/a").alias("not_applicable"))
    rules = checked.sparkSession.createDataFrame([(r,) for r in RULES], "rule string")
    empty = (F.col("rule") == "H1") & F.col("passed").isNull()
    return rules.join(counted, "rule", "left").select("rule", F.coalesce("passed", F.lit(0)).alias("passed"), F.when(empty, 1).otherwise(F.coalesce("failed", F.lit(0))).alias("failed"), F.coalesce("not_applicable", F.lit(0)).alias("not_applicable"))
