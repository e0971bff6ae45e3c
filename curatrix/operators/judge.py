"""Replies of a judge and its rubric: parsing, scores and acceptance."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The rubric's axes with their weights, other names of an axis, and the topics
# that keep the derivation axis.
WEIGHTS = {"factual": 0.30, "completeness": 0.20, "derivation": 0.20, "terminology": 0.10, "structure": 0.10, "grounding": 0.10}
ALIASES = {
    "factual": ("factual", "factual_correctness", "facts", "accuracy"),
    "completeness": ("completeness", "coverage", "complete"),
    "derivation": ("derivation", "derivation_quality", "reasoning", "math"),
    "terminology": ("terminology", "terms", "vocab"),
    "structure": ("structure", "organization", "format"),
    "grounding": ("grounding", "assumptions", "caveats", "scope"),
}
DERIVED = ("formula",)
AXES = ", ".join(f"{k}: double" for k in WEIGHTS)
REPLY = f"struct<{AXES}, must_fix: array<string>, issues: array<string>, passed: boolean>"


def clamp(score: Column) -> Column:
    """A score between 1 and 10; nothing and NaN are 1."""
    number = F.coalesce(score.cast("double"), F.lit(1.0))
    return F.when(F.isnan(number), 1.0).otherwise(F.least(F.lit(10.0), F.greatest(F.lit(1.0), number)))


def overall(scores: dict[str, Column], topic: Column) -> Column:
    """The weighted mean, rounded to four places; off formula topics the derivation axis goes
    and the others share its weight."""
    kept = {k: w for k, w in WEIGHTS.items() if k != "derivation"}
    mean = lambda weights: sum(clamp(scores[k]) * F.lit(w / sum(weights.values())) for k, w in weights.items())
    formula = F.lower(F.trim(F.coalesce(topic, F.lit("")))).isin(*DERIVED)
    return F.round(F.when(formula, mean(WEIGHTS)).otherwise(mean(kept)), 4)


def capped(value: Column, scores: dict[str, Column]) -> Column:
    """No better than its two decisive axes."""
    return F.least(value, clamp(scores["factual"]), clamp(scores["completeness"]))


def accepts(value: Column, scores: dict[str, Column], must_fix: Column, least: float, least_factual: float) -> Column:
    """Nothing must be fixed, and the whole and the facts are good enough."""
    return (F.size(F.coalesce(must_fix, F.array().cast("array<string>"))) == 0) & (value >= least) & (clamp(scores["factual"]) >= least_factual)


def accepted_answer(flags: Column, answer: Column, digest: Column, value: Column, scores: dict[str, Column], must_fix: Column, gate: Column, least: float, least_factual: float) -> Column:
    """Whether a saved answer is the one that a live review accepted: flags (gate_ok,
    judge_pass, pass true; unavailable, skipped, hard_gate_failed false), its hash, a finite
    overall, the threshold, and a clean run of the gate (reasons in ``gate``)."""
    yes = [F.coalesce(flags[k], F.lit(False)) for k in ("gate_ok", "judge_pass", "pass")]
    no = [F.coalesce(~flags[k], F.lit(False)) for k in ("unavailable", "skipped", "hard_gate_failed")]
    ok = yes[0]
    for c in (*yes[1:], *no):
        ok = ok & c
    same = F.sha2(F.coalesce(answer, F.lit("")), 256) == digest
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.coalesce(ok & same & finite & must_fix.isNotNull() & accepts(value, scores, must_fix, least, least_factual) & (F.size(gate) == 0), F.lit(False))


_TAGGED = re.compile(r"<(?:think|thinking|reasoning)>(.*?)</(?:think|thinking|reasoning)>", re.DOTALL | re.IGNORECASE)
_FENCED = re.compile(r"```(?:json)?\s*(\{.*?\})\s*```", re.DOTALL | re.IGNORECASE)
_STRING_OR_BRACE = re.compile(r'"(?:[^"\\]|\\.)*"|[{}]', re.DOTALL)


def objects_in(text: str) -> list[str]:
    """Outermost brace-balanced pieces, the last one first; braces in strings don't count. An
    unclosed brace ends the search."""
    out, depth, start, at = [], 0, 0, 0
    while at < len(text):
        if not depth:
            at = text.find("{", at)
            if at < 0:
                break
        m = _STRING_OR_BRACE.search(text, at)
        if m is None:
            break
        at = m.end()
        if m[0] == "{":
            start = m.start() if not depth else start
            depth += 1
        elif m[0] == "}" and depth:
            depth -= 1
            if not depth:
                out.append(text[start:at])
    return out[::-1]


def loaded(text: str) -> dict | None:
    """The JSON object of a text, also with commas before a closing bracket."""
    for mended in (False, True):
        if mended:
            fewer = None
            while fewer != text:
                fewer, text = text, re.sub(r",\s*([}\]])", r"\1", text)
        try:
            value = json.loads(text)
        except ValueError:
            continue
        if isinstance(value, dict):
            return value
    return None


def pieces(reply: str) -> list[str]:
    """What of a reply may be its JSON, in order: what is visible, what is tagged as thought,
    the whole; of each the text, its fences and its balanced objects."""
    visible, tagged = _TAGGED.sub("", reply), "\n\n".join(x.strip() for x in _TAGGED.findall(reply) if x.strip())
    out: dict[str, None] = {}
    for part in (visible.strip(), tagged, reply.strip()):
        if part:
            out.update(dict.fromkeys([part, *(x.strip() for x in _FENCED.findall(part)), *objects_in(part)]))
    return list(out)


def parse_reply(reply: str | None) -> dict | None:
    """The first JSON object with scores (``dimensions``, or ``scores`` by another name)."""
    for piece in pieces(reply or ""):
        value = loaded(piece)
        if value is not None and isinstance(value.get("dimensions", value.get("scores")), dict):
            return value
    return None


def _score(value: object) -> float:
    try:
        number = float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return 1.0
    return number if number == number else 1.0


def reply_row(reply: str | None) -> dict | None:
    value = parse_reply(reply)
    if value is None:
        return None
    scores = {str(k).strip().lower(): v for k, v in value.get("dimensions", value.get("scores")).items()}
    texts = lambda key: [x.strip() for x in value.get(key) or [] if isinstance(x, str) and x.strip()] if isinstance(value.get(key), list) else []
    out: dict[str, object] = {k: min(10.0, max(1.0, _score(next((scores[a] for a in names if a in scores), 1)))) for k, names in ALIASES.items()}
    return out | {"must_fix": texts("must_fix"), "issues": texts("issues"), "passed": value.get("pass") if isinstance(value.get("pass"), bool) else None}


def parsed_reply(reply: Column) -> Column:
    """A judge's reply as scores, must_fix and issues; null where it holds no scores. Brace
    balance is beyond the built-in functions, hence Arrow batches."""

    @F.pandas_udf(REPLY)
    def parse(replies: pd.Series) -> pd.DataFrame:
        rows = [reply_row(r) or dict.fromkeys([*WEIGHTS, "must_fix", "issues", "passed"]) for r in replies]
        return pd.DataFrame(rows, columns=[*WEIGHTS, "must_fix", "issues", "passed"])

    out = parse(reply)
    return F.when(out["factual"].isNotNull(), out)
