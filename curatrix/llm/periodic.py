"""Periodic runs of words: repeated k-grams mask the text, Main-Lorentz settles what is left.

A run is a stretch of words with smallest period q and at least ``max(min_length, exponent * q)``
words that no neighbouring word extends keeping period q. Words q apart agree over at least
``overlap(min_length, exponent)`` words, so each word of a run lies in a k-gram of that size
that the document holds twice. Words outside such k-grams can't join a run; they cut the text
into segments, and only segments as long as the shortest run are searched, by Main and
Lorentz's division: repetitions over the middle from longest common extensions, then both halves.
The mask compares hashes, and a collision only leaves more to search; runs compare words.

Each document is settled where it is read: nothing is shuffled, and a document's words are
the most that a task holds beside its batch.

Defined results: words are runs of anything but ASCII white space; null and empty texts have no
words, no runs and an empty collapsed text; runs of equal place keep their smallest period;
overlapping runs are all listed, by start, then period; a word goes if any run holds it after
that run's first period; texts of any length are read whole; repeated rows appear once each
with equal values; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import WORD_SPLIT, by_texts, canonical, documents

MIN_LENGTH, EXPONENT = 24, 3
#: Odd numbers that mix hashes.
_STEP, _DOC = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

Run = tuple[int, int, int]


def overlap(min_length: int, exponent: int) -> int:
    """The least number of words that agree with those one period on, over all periods."""
    return min(max(min_length - q, (exponent - 1) * q) for q in range(1, min_length + 1))


def _gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each stretch of k words, from stretches of powers of two."""
    out, done, part, width = None, 0, words, 1
    while done < k:
        if k & width:
            out = part if out is None else out[: len(words) - done - width + 1] * _power(width) + part[done:]
            done += width
        if done < k:
            part = part[:-width] * _power(width) + part[width:]
            width *= 2
    return out


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_STEP), n, 1 << 64))


def surviving(texts: list[list[bytes]], k: int, least: int) -> list[tuple[int, int, int]]:
    """(document, from, to): stretches of at least ``least`` words, each in a k-gram that the document holds twice."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    total = int(bounds[-1])
    if total < k:
        return []
    words = np.fromiter(map(hash, chain.from_iterable(texts)), np.int64, total).astype(np.uint64) * _STEP
    words ^= words >> np.uint64(29)
    doc = np.repeat(np.arange(len(texts)), sizes)
    at = np.flatnonzero(doc[: total - k + 1] == doc[k - 1 :])
    keys = _gram_hashes(words, k)[at] + doc[at].astype(np.uint64) * _DOC
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not twice.size:
        return []
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    starts = at[twice[place] == keys]
    covers = np.zeros(total + 1, np.int64)
    covers[starts] += 1
    covers[starts + k] -= 1
    held = np.concatenate([[False], np.cumsum(covers[:-1]) > 0, [False]])
    edges = set(np.flatnonzero(held[1:] != held[:-1]).tolist())
    cuts = sorted(edges | {b for b in bounds.tolist() if 0 < b < total and held[b] and held[b + 1]})
    return [(int(doc[a]), a - int(bounds[doc[a]]), b - int(bounds[doc[a]])) for a, b in pairwise(cuts) if held[a + 1] and b - a >= least]


def _prefixes(s: list[int]) -> list[int]:
    """For each place, how many symbols from there agree with the beginning."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        x = min(z[i - left], right - i) if i < right else 0
        while i + x < n and s[x] == s[i + x]:
            x += 1
        z[i] = x
        if i + x > right:
            left, right = i, i + x
    return z


def _over_middle(w: list[int], low: int, mid: int, high: int, min_length: int, exponent: int) -> Iterator[Run]:
    """(start, end, period) of long enough repetitions of w[low:high] that hold words on both
    sides of mid, or touch it; they end where the stretch does."""
    left, right = w[low:mid], w[mid:high]
    a, b = len(left), len(right)
    back, ahead = left[::-1], right[::-1]
    own_left, own_right = [*_prefixes(back), 0], [*_prefixes(right), 0]
    into_right, into_left = _prefixes([*right, -1, *left, *right]), _prefixes([*back, -1, *ahead, *back])
    for p in range(1, (high - low) // exponent + 1):
        least = max(min_length, exponent * p)
        if p <= a:  # a whole period before the middle
            before, after = own_left[p], into_right[b + 1 + a - p]
            if before + p + after >= least:
                yield mid - p - before, mid + after, p
        if p <= b:  # a whole period behind it
            before, after = into_left[a + 1 + b - p], own_right[p]
            if before + p + after >= least:
                yield mid - before, mid + p + after, p


def main_lorentz(w: list[int], min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[Run]:
    """(start, length, smallest period) of all runs of a sequence of numbers, none negative."""
    found: dict[tuple[int, int], int] = {}
    todo = [(0, len(w))]
    while todo:
        low, high = todo.pop()
        if high - low < max(2, min_length):
            continue
        mid = (low + high) // 2
        todo += [(low, mid), (mid, high)]
        for start, end, p in _over_middle(w, low, mid, high, min_length, exponent):
            whole = (start == 0 or w[start - 1] != w[start - 1 + p]) and (end == len(w) or w[end] != w[end - p])
            if whole and p < found.get((start, end), len(w) + 1):
                found[start, end] = p
    return sorted(((start, end - start, p) for (start, end), p in found.items()), key=lambda r: (r[0], r[2]))


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[list[Run]]:
    """The runs of each text, by start, then period."""
    out: list[list[Run]] = [[] for _ in texts]
    for doc, low, high in surviving(texts, overlap(min_length, exponent), min_length):
        numbers: dict[bytes, int] = {}
        stretch = [numbers.setdefault(x, len(numbers)) for x in texts[doc][low:high]]
        out[doc] += [(low + start, length, p) for start, length, p in main_lorentz(stretch, min_length, exponent)]
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run holds after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, p in runs:
        change[start + p] += 1
        change[start + length] -= 1
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0))


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period in words) and the collapsed text of each row."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in by_texts(batches):
            texts = [x.split() for x in batch.column("text").cast(pa.binary()).to_pylist()]
            runs = runs_of(texts, min_length, exponent)
            columns = [
                batch.column("doc_id"),
                pa.array(map(len, texts), pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs], pa.list_(run)),
                pa.array([collapsed(t, found) for t, found in zip(texts, runs, strict=True)], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return canonical(docs, id_col, text_col).mapInArrow(settle, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The text with the periodic tail that the query's contract lays into a tenth of the ids."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.floor((n - a) / (g % 8 + 3)) + 1
        at = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(at, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    words = F.filter(F.split(text, WORD_SPLIT), lambda w: w != "")
    tail = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]  # the words are bound once
    return F.when((h % 10 == 0) & text.isNotNull(), F.coalesce(tail, text)).otherwise(text)


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = periodic_runs(docs.select("doc_id", planted(F.col("doc_id").cast("long"), F.col("text")).alias("text")))
    ahead = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    # Runs come by start, then period, so the first of equals stays.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda kept, r: F.when(ahead(r, kept), r).otherwise(kept))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )
