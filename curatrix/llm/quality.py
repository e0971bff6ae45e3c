"""Quality classifier: positive-unlabelled learning.

A small network on text statistics minimises the non-negative unbiased risk (Kiryo et al.
2017) over trusted positives and unlabelled texts; its steps take bounded samples of both.
Feature means and scales and the class prior come from all texts of the training fold: for
a first scorer, the least ratio of unlabelled to positive mass above any threshold, with a
margin for its sampling error, bounds the share of positives; both masses are histograms
that Spark counts.

Defined results: null and empty texts have the feature vector of an empty text; repeated
rows score alike and are stepped on once; texts of any length are read whole; scores that
tie with the threshold are predicted 1; an empty table gives no rows; without trusted
positives every score is 0.5; a document with several labels is a positive only if all say
so; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import canonical, documents, fold_column, materialize, table

#: Bounds on the rows that steps are taken on: trusted positives and unlabelled texts.
MAX_POSITIVE, MAX_UNLABELLED = 8_000, 12_000
#: Cells of the score histograms.
CELLS = 4096
THRESHOLD = 0.5
N_FEATURES = 18
_SYMBOL_TAIL = re.compile(r"[^\w\s.,;:!?)\"'»]{2,}(?=\s|$)")


def features(text: str) -> np.ndarray:
    """Length-free statistics of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256)
    n = max(1, len(raw))
    words = raw.lower().split()
    w = max(1, len(words))
    lines = text.split("\n")
    filled = [x for x in lines if x.strip()]
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    letters = kinds[65:91].sum() + kinds[97:123].sum() + kinds[128:].sum()
    symbols = n - letters - kinds[48:58].sum() - kinds[9:14].sum() - kinds[32] - kinds[[33, 39, 44, 46, 58, 59, 63]].sum()
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    distinct = len(set(words))
    return np.array([
        math.log1p(len(words)), distinct / w, math.log(distinct + 1) / math.log(w + 2), repeats / w,
        lengths.mean() / 10, lengths.std() / 10, letters / n, symbols / n, kinds[48:58].sum() / n, kinds[65:91].sum() / n,
        math.log1p(kinds[124] + kinds[9]) / 5, math.log1p(len(_SYMBOL_TAIL.findall(text))) / 5, len(_SYMBOL_TAIL.findall(text)) / w,
        (kinds[46] + kinds[44] + kinds[33] + kinds[63]) / w, len(set(filled)) / max(1, len(filled)), math.log1p(w / max(1, len(filled))) / 5,
        kinds[128:].sum() / n, kinds[[35, 36, 37, 38, 42, 60, 61, 62, 64, 94, 95, 126]].sum() / w,
    ])


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2, -30, 30)))


def estimate_prior(pos: np.ndarray, unl: np.ndarray, delta: float = 0.1) -> float:
    """The share of positives among the unlabelled, from histograms of both sides' scores
    over the same cells, ascending."""
    n_pos, n_unl = pos.sum(), unl.sum()
    above_p, above_u = np.cumsum(pos[::-1])[::-1] / n_pos, np.cumsum(unl[::-1])[::-1] / n_unl
    slack = math.sqrt(math.log(4 / delta) / 2) * (1 / math.sqrt(n_pos) + 1 / math.sqrt(n_unl))
    held = above_p > 0
    above_p, above_u = above_p[held], above_u[held]
    best = np.argmin((above_u + slack) / above_p)
    return float(min(0.98, max(0.02, above_u[best] / above_p[best])))


def _descend(xp: np.ndarray, xu: np.ndarray, prior: float | None, hidden: int = 16, steps: int = 800, seed: int = 7) -> tuple:
    """Adam on the non-negative risk in random batches; prior=None: plain positive against unlabelled."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.3, (xp.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.3, hidden), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        ip, iu = rng.integers(0, len(xp), 1024), rng.integers(0, len(xu), 1024)
        x = np.concatenate([xp[ip], xu[iu]])
        h = np.tanh(x @ params[0] + params[1])
        p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30)))
        pp, pu = p[:1024], p[1024:]
        # The loss is sigmoid: l(z, +1) = 1 - p, l(z, -1) = p; its slope is p (1 - p).
        sp, su = pp * (1 - pp) / 1024, pu * (1 - pu) / 1024
        if prior is None:
            g = np.concatenate([-sp, su])
        elif pu.mean() - prior * pp.mean() >= 0:
            g = np.concatenate([-2 * prior * sp, su])
        else:  # the negative part went below 0: climb back
            g = np.concatenate([prior * sp, -su])
        dh = np.outer(g, params[2]) * (1 - h * h)
        grads = [x.T @ dh, dh.sum(0), h.T @ g, np.array([g.sum()])]
        for i, grad in enumerate(grads):
            grad = grad + 1e-5 * params[i]
            m[i] = 0.9 * m[i] + 0.1 * grad
            v[i] = 0.999 * v[i] + 0.001 * grad * grad
            params[i] = params[i] - 0.01 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return params[0], params[1], params[2], float(params[3][0])


def described(docs: DataFrame) -> DataFrame:
    """doc_id and the features x of every row, written once."""

    @F.pandas_udf("array<double>")
    def feature_column(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t).tolist())

    return materialize(canonical(docs).select("doc_id", feature_column("text").alias("x")), "quality-features")


def score_column(share):
    """x -> score by a broadcast model; 0.5 without one."""

    @F.pandas_udf("double")
    def score(xs: pd.Series) -> pd.Series:
        x = np.array(xs.tolist(), float).reshape(-1, N_FEATURES)
        return pd.Series(share.value.score(x) if share.value else np.full(len(x), 0.5), dtype="float64")

    return score


def _sample(rows: DataFrame, most: int, salt: int) -> np.ndarray:
    """Features of at most ``most`` different rows, in an order fixed by hashes of id and features."""
    order = F.xxhash64("doc_id", "x", F.lit(salt))
    got = rows.distinct().orderBy(order, "doc_id", "x").limit(most).select("x").toPandas()
    return np.array(got["x"].tolist(), float).reshape(-1, N_FEATURES)


def train_quality(rows: DataFrame, labels: DataFrame) -> QualityModel | None:
    """rows: ``described`` texts. Trusted positives: label 1 in the training fold. Unlabelled:
    all texts of that fold, whatever their labels."""
    spark = rows.sparkSession
    fold = rows.where(fold_column(F.col("doc_id"), 3) != 1)
    trusted = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality is not null").where(fold_column(F.col("doc_id"), 3) != 1)
    trusted = trusted.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    positive = materialize(fold.join(trusted, "doc_id", "left_semi"), "quality-positive")
    pos, unl = _sample(positive, MAX_POSITIVE, 0), _sample(fold, MAX_UNLABELLED, 1)
    if len(pos) < 2 or len(unl) < 2:
        return None
    cells = [F.col("x")[i] for i in range(N_FEATURES)]
    moments = fold.agg(*[F.avg(c) for c in cells], *[F.stddev_pop(c) for c in cells]).first()
    mean, scale = np.array(moments[:N_FEATURES]), np.array(moments[N_FEATURES:]) + 1e-6
    zp, zu = np.clip((pos - mean) / scale, -8, 8), np.clip((unl - mean) / scale, -8, 8)
    first = QualityModel(mean, scale, *_descend(zp, zu, None), prior=0.5)
    score = score_column(spark.sparkContext.broadcast(first))
    cell = F.least(F.floor(score("x") * CELLS), F.lit(CELLS - 1)).cast("int")
    masses = []
    for side in (positive, fold):
        mass = np.zeros(CELLS)
        for row in side.select(cell.alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).collect():  # CELLS rows at most
            mass[row["cell"]] = row["n"]
        masses.append(mass)
    prior = estimate_prior(*masses)
    return QualityModel(mean, scale, *_descend(zp, zu, prior), prior=prior)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    rows = described(docs)
    score = score_column(docs.sparkSession.sparkContext.broadcast(train_quality(rows, labels)))
    scored = rows.select("doc_id", (fold_column(F.col("doc_id"), 3) == 1).alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    return score_quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
