"""PII: base patterns, and further spans by weak supervision.

Base spans (email, ip, card, phone) follow fixed patterns and checks. Candidates for more
spans are looser secret, number and address shapes. Regex, gazetteer and context labelers
vote on each candidate; expectation-maximisation over the counted vote patterns of the whole
corpus estimates every labeler's reliability, and its posteriors train the final span
classifier, a logistic curve on votes, shape and context, which accepts or rejects each
candidate. Votes, shape and context take few values, so the corpus is counted by them and
the classifier learns from the counts of all candidates. Base spans stay whatever it says.

Places are code points, ends exclusive. Defined results: null and empty texts have no
spans; repeated rows repeat their values and count as often; texts and spans of any length
are read whole; ties (accepted candidates that overlap) go to the one that starts first,
then to the longer; an empty table gives no rows; a candidate that overlaps a base span or
an earlier accepted one is left out; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import canonical, documents, materialize

KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("secret", "number", "address")

# Possessive forms of the contract's patterns; they match the same text without backtracking.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SECRET = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{16,}+")
_NUMBER = re.compile(r"(?<![0-9A-Za-z+.@-])\(?[0-9]{2,6}\)?(?:[ .-][0-9]{2,6}){1,5}(?![0-9A-Za-z@])")

# Words that announce personal data, and words that deny it.
ANNOUNCING = ("tel", "phone", "call", "fax", "mobile", "contact", "ssn", "card", "account", "iban", "key", "token", "secret", "password", "api", "auth", "credential", "bearer", "passport", "id", "address", "resident", "lives", "ship", "mail")
DENYING = ("version", "page", "isbn", "chapter", "figure", "table", "section", "year", "line", "build")
SECRET_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_", "pk_", "xox", "AIza", "glpat-", "eyJ")
# Words for ways, full and short, in the corpus's languages; and dialling prefixes.
WAYS = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Lane", "Ln", "Drive", "Dr", "Boulevard", "Blvd", "Court", "Ct", "Square", "Sq", "Terrace", "Highway", "Hwy", "Way", "Place", "Pl", "Rue", "Allee", "Calle", "Plaza", "Platz", "Weg")
FULL_WAYS = frozenset(w for w in WAYS if len(w) > 4)
AREA_CODES = frozenset(("201", "202", "212", "213", "305", "310", "312", "408", "415", "512", "555", "614", "617", "646", "650", "702", "718", "800", "888", "917"))
_ANNOUNCE = re.compile(r"(?<![a-z])(?:" + "|".join(ANNOUNCING) + r")s?(?![a-z])")
_DENY = re.compile(r"(?<![a-z])(?:" + "|".join(DENYING) + r")s?(?![a-z])")
_ADDRESS = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,5}[A-Za-z]?,?(?: [A-Z][A-Za-z'-]{1,30}){0,3} (?:" + "|".join(WAYS) + r")(?![A-Za-z])\.?")
_SHAPES = (("secret", _SECRET), ("number", _NUMBER), ("address", _ADDRESS))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    found = [(s, e, 0) for s, e in emails(text)]
    if any(c in text for c in "0123456789"):
        found += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if 14 <= m.end() - m.start() and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                found.append((m.start(), m.end(), 2))
        if "+" in text:
            found += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]


# Labelers: candidate text, kind, folded context before it -> 1 personal, 0 not, -1 no vote.
def _by_context(span: str, kind: str, before: str) -> int:
    return 1 if _ANNOUNCE.search(before) else 0 if _DENY.search(before) else -1


def _by_gazetteer(span: str, kind: str, before: str) -> int:
    if kind == "secret":
        return 1 if span.startswith(SECRET_STARTS) else -1
    if kind == "address":
        return 1 if span.rstrip(".").rsplit(" ", 1)[-1] in FULL_WAYS else -1
    return 1 if _digits(span)[:3] in AREA_CODES else -1


def _by_shape(span: str, kind: str, before: str) -> int:
    if kind == "secret":
        classes = sum(any(f(c) for c in span) for f in (str.islower, str.isupper, str.isdigit))
        return 1 if classes == 3 or len(span) >= 32 and classes == 2 else 0
    if kind == "address":
        return 1 if span.count(" ") >= 2 else 0
    return 1 if len(_digits(span)) in (7, 9, 10, 11) else 0


def _by_regex(span: str, kind: str, before: str) -> int:
    if kind == "secret":
        return 1 if re.fullmatch(r"[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[A-Z0-9]{20}|(?:[A-Za-z]{2,6}[_-])+[A-Za-z0-9]{16,}", span) else -1
    if kind == "address":
        return 1 if re.fullmatch(r"[1-9][0-9]{0,4}[A-Za-z]?,?(?: [A-Z][a-z'-]+){1,3} [A-Z][a-z]+\.?", span) else 0
    return 1 if re.fullmatch(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{3}[.-][0-9]{4}", span) else 0


def _by_spread(span: str, kind: str, before: str) -> int:
    most = max(span.count(c) for c in set(span)) / len(span)
    return 0 if most > 0.4 else -1


LABELERS = (_by_context, _by_gazetteer, _by_shape, _by_regex, _by_spread)


def traits(span: str, before: str) -> tuple[int, ...]:
    """Shape and context in few values: length, share of digits, cases, what stands before."""
    digits = len(_digits(span))
    cases = 2 * any(c.isupper() for c in span) + any(c.islower() for c in span)
    last = before.rstrip()[-1:]
    return (sum(len(span) >= n for n in (12, 24, 48)), sum(3 * digits >= n * len(span) for n in (1, 2, 3)), cases, 1 if last in (":", "=") and last else 2 if last in ('"', "'", "(", "<") and last else 0)


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str, tuple[int, ...], tuple[int, ...]]]:
    """(start, end, kind, votes, traits) of looser shapes that overlap no base span."""
    if not any(c in text for c in "0123456789"):
        return []
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, e, _ in base), max))
    out = []
    for kind, pattern in _SHAPES:
        for m in pattern.finditer(text):
            s, e = m.span()
            before_end = bisect.bisect_left(starts, e)
            if before_end and reach[before_end - 1] > s:
                continue
            before = text[max(0, s - 30) : s].lower()
            out.append((s, e, kind, tuple(f(m[0], kind, before) for f in LABELERS), traits(m[0], before)))
    return out


def reliabilities(patterns: np.ndarray, weights: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over counted vote patterns (rows of -1, 0, 1): the prior, P(vote | personal or not)
    as [labeler, class, vote], and each pattern's posterior."""
    post = np.clip(0.5 + 0.25 * ((patterns == 1).sum(1) - (patterns == 0).sum(1)), 0.05, 0.95)
    prior, table = 0.5, np.zeros((patterns.shape[1], 2, 3))
    for _ in range(rounds):
        side = np.stack([1 - post, post]) * weights
        prior = float((side[1].sum() + 1) / (weights.sum() + 2))
        for v in range(3):
            table[:, :, v] = np.stack([side @ (patterns[:, j] == v - 1) for j in range(patterns.shape[1])])
        table += np.array([[0.5, 1.0, 0.5], [0.5, 0.5, 1.0]])
        table /= table.sum(2, keepdims=True)
        log = np.stack([np.full(len(patterns), math.log(1 - prior)), np.full(len(patterns), math.log(prior))])
        for j in range(patterns.shape[1]):
            log += np.log(table[j][:, patterns[:, j] + 1])
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -40, 40)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return prior, table, post


def _design(votes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """An intercept, each vote for and against, and each value of each trait."""
    values = [shapes[:, [j]] == np.arange(1, 4) for j in range(shapes.shape[1])]
    return np.concatenate([np.ones((len(votes), 1)), votes == 1, votes == 0, *values], 1).astype(float)


def train_spans(counted: pd.DataFrame) -> dict[tuple, float]:
    """Counted (kind, votes, traits, n) -> the classifier's probability of each. There are at
    most 3 * 3^5 * 4^4 of them, so the classifier is stored as their table."""
    out: dict[tuple, float] = {}
    for kind, rows in counted.groupby("kind"):
        votes = np.array(rows["votes"].tolist(), int).reshape(len(rows), -1)
        shapes = np.array(rows["traits"].tolist(), int).reshape(len(rows), -1)
        weights = rows["n"].to_numpy(float)
        patterns, which = np.unique(votes, axis=0, return_inverse=True)
        _, _, post = reliabilities(patterns, np.bincount(which.ravel(), weights))
        post = post[which.ravel()]
        x = _design(votes, shapes)
        beta = np.zeros(x.shape[1])
        share = weights / weights.sum()
        for _ in range(60):  # Newton steps on soft labels, with a ridge of one ten-thousandth of the mass
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(beta)), x.T @ (share * (post - p)) - 1e-4 * beta)
            beta += np.clip(step, -2, 2)
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        out.update({(kind, tuple(v), tuple(t)): float(q) for v, t, q in zip(votes.tolist(), shapes.tolist(), p, strict=True)})
    return out


SPANS = "base array<struct<s:int,e:int,kind:string>>, more array<struct<s:int,e:int,kind:string,votes:array<int>,traits:array<int>>>"


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and voted candidates of every text."""

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.DataFrame:
        base = [base_spans(t) for t in texts]
        more = [candidates(t, b) for t, b in zip(texts, base, strict=True)]
        return pd.DataFrame({"base": [[{"s": s, "e": e, "kind": k} for s, e, k in b] for b in base], "more": [[{"s": s, "e": e, "kind": k, "votes": list(v), "traits": list(t)} for s, e, k, v, t in m] for m in more]}, columns=["base", "more"])

    return canonical(docs).select("doc_id", spans("text").alias("f")).select("doc_id", "f.base", "f.more")


def accepted(row, model: dict[tuple, float], threshold: float) -> list[dict]:
    """Of a text's candidates those that the classifier accepts, none overlapping."""
    kept, end = [], -1
    for c in sorted(row, key=lambda c: (c["s"], -c["e"])):
        if c["s"] >= end and model.get((c["kind"], tuple(int(v) for v in c["votes"]), tuple(int(v) for v in c["traits"])), 0.0) >= threshold:
            kept.append({"s": c["s"], "e": c["e"], "kind": c["kind"]})
            end = c["e"]
    return kept


def detect_pii(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, base and added spans as arrays of (s, e, kind)."""
    found = materialize(find_spans(docs), "pii-spans")
    counted = found.select(F.explode("more").alias("c")).groupBy("c.kind", "c.votes", "c.traits").agg(F.count("*").alias("n")).toPandas()
    share = docs.sparkSession.sparkContext.broadcast(train_spans(counted))

    @F.pandas_udf("array<struct<s:int,e:int,kind:string>>")
    def accept(batch: pd.Series) -> pd.Series:
        return pd.Series([accepted(row, share.value, threshold) for row in batch])

    return found.select("doc_id", "base", F.when(F.size("more") > 0, accept("more")).otherwise(F.array().cast("array<struct<s:int,e:int,kind:string>>")).alias("added"))


def _joined(spans):
    order = F.transform(spans, lambda x: F.struct(x.s.alias("s"), F.array_position(F.array(*map(F.lit, KINDS + MORE_KINDS)), x.kind).alias("k"), x.e.alias("e"), x.kind.alias("kind")))
    return F.array_join(F.transform(F.array_sort(order), lambda x: F.concat_ws(":", x.kind, x.s.cast("string"), x.e.cast("string"))), ",")


def op8_pii(spark, sf_dir: str) -> DataFrame:
    found = detect_pii(documents(spark, sf_dir))

    def count(side: str, kind: str):
        return F.size(F.filter(side, lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [*[count("base", k) for k in KINDS], *[count("added", k) for k in MORE_KINDS]]
    total = F.size("base") + F.size("added")
    return found.select("doc_id", *counts, total.cast("long").alias("n_spans"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", "added")).alias("spans"))
