"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps homoglyphs to Latin letters and digits or signs to the letters
they stand in for, one character for one, so places in the folded text are places in the
text. The lexicon holds word beginnings and whole words learned from labelled rows; the
weights of a text's matches, without those inside exception phrases, are normalised by its
length, and a logistic curve turns both sums into the score.

Defined results: null and empty texts score as texts without matches; repeated rows score
alike and are learned from once; texts of any length are scored whole; terms that tie are
both kept; an empty table gives no rows; with no usable labels every score is 2e-9 (the curve
at -20); a document with several labels counts as toxic if any says so; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import bisect
import functools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import canonical, documents, fold_column, materialize, table

#: Different labelled rows that are learned from, at most. All their terms and phrases count.
MAX_LABELLED = 12_000
THRESHOLD = 0.7

# Characters that look like, or stand in for, a Latin letter.
HOMOGLYPHS = {"а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l"}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}


@functools.cache
def _fold_table() -> dict[int, str]:
    wide = {chr(0xFF01 + i): chr(0x21 + i).lower() for i in range(94)}
    return {ord(k): v for k, v in (wide | HOMOGLYPHS | SUBSTITUTES).items()}


def fold(text: str) -> str:
    """Same length as the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return low.translate(_fold_table())


_EDGES = ".,;:!?*&%#$()[]{}\"'-_|+<>/\\~^`="


def _terms(text: str) -> set[str]:
    """Whole words ('=word') and word beginnings of a text, folded."""
    out = set()
    for raw in set(text.split()):
        word = fold(raw.strip(_EDGES))
        if len(word) >= 3:
            out.add("=" + word)
            out.update(word[:n] for n in range(4, min(len(word), 9)))
    return out


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    coefficients: tuple[float, float, float]


class Matcher:
    """The automaton over the lexicon and the exception phrases."""

    def __init__(self, lexicon, exceptions=()) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon:
            whole = term.startswith("=")
            key = term.removeprefix("=")
            old = self.automaton.get(key, ())
            self.automaton.add_word(key, (*old, ("=" if whole else "^", len(key), weight)))
        for phrase in exceptions:
            key = fold(phrase)
            self.automaton.add_word(key, (*self.automaton.get(key, ()), ("x", len(key), 0.0)))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight): the heaviest at each word, none inside an exception phrase."""
        if self.empty:
            return []
        best: dict[int, tuple[int, float]] = {}
        shielded: list[tuple[int, int]] = []
        for last, values in self.automaton.iter(fold(text)):
            for kind, n, weight in values:
                start, end = last + 1 - n, last + 1
                if start and _joins(text[start - 1]):
                    continue
                if kind != "^" and end < len(text) and unicodedata.category(text[end])[0] == "L":
                    continue
                if kind == "x":
                    shielded.append((start, end))
                elif weight > best.get(start, (0, -1.0))[1]:
                    best[start] = (end, weight)
        out, shields, at, reach = [], sorted(shielded), 0, 0
        for start, (end, weight) in sorted(best.items()):
            while at < len(shields) and shields[at][0] <= start:
                reach = max(reach, shields[at][1])
                at += 1
            if end > reach:
                out.append((start, end, weight))
        return out


def _joins(c: str) -> bool:
    return c.isalpha()


def _phrases(text: str, matches) -> list[str]:
    """The two folded words, whole, that each match begins, once each."""
    words = [m.span() for m in re.finditer(r"\S+", text)]
    starts, out = [a for a, _ in words], set()
    for start, _, _ in matches:
        k = bisect.bisect_right(starts, start) - 1
        second = text[slice(*words[k + 1])] if k + 1 < len(words) else ""
        out.add(fold(f"{text[start : words[k][1]]} {second}".rstrip()))
    return sorted(out)


def _features(matches, text: str) -> tuple[float, float]:
    total = sum(w for _, _, w in matches)
    return math.log1p(total), math.log1p(1000.0 * total / (50.0 + len(text) / 6.0))


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """text and the labels' other columns for at most ``most`` different rows of docs, taken in
    an order fixed by hashes of id and text. labels has one row an id."""
    rows = canonical(docs).withColumn("th", F.xxhash64("text"))
    keys = rows.select("doc_id", "th").join(labels, "doc_id").distinct().orderBy(F.xxhash64("doc_id", "th"), "doc_id", "th").limit(most)
    # ``most`` rows of a few numbers: small enough to broadcast. Repeated rows come once.
    return rows.join(F.broadcast(keys), ["doc_id", "th"]).dropDuplicates(["doc_id", "th"]).drop("doc_id", "th")


def train_toxicity(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = (), max_labelled: int = MAX_LABELLED) -> ToxicityModel:
    """Learn the lexicon, exception phrases and curve from at most ``max_labelled`` rows of
    the training fold, taken in an order fixed by a hash of the id."""
    spark = docs.sparkSession
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null").where(fold_column(F.col("doc_id"), 3) != 1)
    train = materialize(labelled_rows(docs, usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), max_labelled), "toxic-train")
    n_pos, n_neg = train.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).first()
    if not n_pos or not n_neg:
        return ToxicityModel((), exceptions, (-20.0, 0.0, 0.0))

    def counter(wanted=None):
        def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                seen: Counter = Counter()
                for text in frame["text"]:
                    seen.update(_terms(text) if wanted is None else _terms(text) & wanted.value)
                if seen:  # a frame without rows has no type of strings
                    yield pd.DataFrame({"term": list(seen), "n": list(seen.values())}, columns=["term", "n"])

        return count

    # Terms of toxic rows first; other rows are then counted for those terms alone.
    least = max(3, n_pos // 200)
    toxic = train.where("toxic > 0").mapInPandas(counter(), "term string, n long").groupBy("term").agg(F.sum("n").alias("pos")).where(F.col("pos") >= least)
    pos = {r["term"]: r["pos"] for r in toxic.collect()}  # terms of max_labelled rows
    wanted = spark.sparkContext.broadcast(frozenset(pos))
    clean = train.where("toxic <= 0").mapInPandas(counter(wanted), "term string, n long").groupBy("term").agg(F.sum("n").alias("neg"))
    neg = {r["term"]: r["neg"] for r in clean.collect()}
    ratios = {t: math.log((c + 0.5) / (n_pos + 1)) - math.log((neg.get(t, 0) + 0.5) / (n_neg + 1)) for t, c in pos.items()}
    rows = sorted(((t, r) for t, r in ratios.items() if r > 2.5), key=lambda x: (-x[1], -pos[x[0]], x[0]))
    # A longer beginning says nothing more than a shorter one that is as telling.
    kept: dict[str, float] = {}
    for term, ratio in sorted(rows, key=lambda r: (len(r[0].removeprefix("=")), r[0])):
        stem = term.removeprefix("=")
        if not any(kept.get(stem[:k], -9.0) >= ratio - 1.0 for k in range(4, len(stem) + 1)):
            kept[term] = ratio
    lexicon = tuple(sorted(kept.items()))
    share = spark.sparkContext.broadcast((lexicon, exceptions))

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(*share.value)
        for frame in frames:
            found = [matcher.matches(t) for t in frame["text"]]
            phrases = [_phrases(t, m) for t, m in zip(frame["text"], found, strict=True)]
            xs = [_features(m, t) for t, m in zip(frame["text"], found, strict=True)]
            yield pd.DataFrame({"a": [x[0] for x in xs], "b": [x[1] for x in xs], "toxic": frame["toxic"], "phrases": phrases})

    fitted = train.mapInPandas(apply, "a double, b double, toxic int, phrases array<string>").toPandas()  # max_labelled rows at most
    seen = {1: Counter(), 0: Counter()}
    for toxic, phrases in zip(fitted["toxic"], fitted["phrases"], strict=True):
        seen[int(toxic > 0)].update(phrases)
    learned = [p for p, c in sorted(seen[0].items()) if " " in p and c >= 3 and c > 4 * seen[1][p]]
    x = np.column_stack([np.ones(len(fitted)), fitted["a"], fitted["b"]])
    return ToxicityModel(lexicon, (*exceptions, *learned), tuple(_logistic(x, (fitted["toxic"] > 0).to_numpy(float))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta)), x.T @ (y - p) - ridge * beta)
        beta = beta + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def toxicity_score(model: ToxicityModel, spark):
    """A column function: text -> score."""
    share = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = share.value
        matcher = Matcher(m.lexicon, m.exceptions)
        for texts in batches:
            out = []
            for text in texts:
                a, b = _features(matcher.matches(text), text) if text else (0.0, 0.0)
                z = m.coefficients[0] + m.coefficients[1] * a + m.coefficients[2] * b
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pd.Series(out, dtype="float64")

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = (), threshold: float = THRESHOLD) -> DataFrame:
    model = train_toxicity(docs, labels, exceptions)
    score = toxicity_score(model, docs.sparkSession)
    scored = canonical(docs).select("doc_id", (fold_column(F.col("doc_id"), 3) == 1).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that aren't rejected, all columns kept."""
    score = toxicity_score(train_toxicity(docs, labels), docs.sparkSession)
    return docs.where(score(F.coalesce(F.col("text"), F.lit(""))) < threshold)
