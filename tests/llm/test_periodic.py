"""Periodic runs against a scan of every period, and the query's digests against its contract."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

DATA = "/root/testdata/sf0.001"


def scanned(words, min_length=24, exponent=3):
    """All runs, by looking at every period from every place."""
    found, n = {}, len(words)
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(min_length, exponent * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def made(rng):
    n, k = rng.randint(0, 150), rng.choice((1, 2, 3, 5, 30))
    words = [rng.randrange(k) for _ in range(n)]
    if n > 5 and rng.random() < 0.8:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 3))
        for i in range(a, min(n, a + rng.randint(p, 6 * p))):
            words[i] = words[a + (i - a) % p]
    return [str(x).encode() for x in words]


@pytest.mark.parametrize(("min_length", "exponent"), [(24, 3), (6, 3), (4, 2), (30, 5)])
def test_runs_equal_a_scan_of_every_period(min_length, exponent):
    from curatrix.llm.periodic import runs_of

    rng = random.Random(min_length)
    texts = [made(rng) for _ in range(400)]
    assert runs_of(texts, min_length, exponent) == [scanned(t, min_length, exponent) for t in texts]


def test_overlap_is_the_least_over_all_periods():
    from curatrix.llm.periodic import overlap

    assert (overlap(24, 3), overlap(1, 3), overlap(10, 2)) == (16, 2, 5)


def test_long_text_of_one_period():
    from curatrix.llm.periodic import runs_of

    words = [b"%d" % (i % 4999) for i in range(60_000)]
    assert runs_of([words[:7], words, words[:9]]) == [[], [(0, 60_000, 4999)], []]


def expected(doc_id, text):
    words = [] if text is None else re.findall(r"[^\x20\x09-\x0D]+", text)
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = scanned(words)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def digest(spark, tmp_path, rows, schema="doc_id long, text string, runs int, best string, start long"):
    from curatrix.llm.periodic import op12_periodic_runs

    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r[n] for n in names) for r in op12_periodic_runs(spark, str(tmp_path)).collect()), key=str)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.choice((0, 1, 3, 30, 120, 400)))) for _ in range(160)]
    texts += [None, "", " \t\n", "É É É É \x00 " * 30, "a b\n" * 40 + "c " * 50, "x" * 9000, "Ab ab " * 20]
    rows = [(i, t, 1, "b", 2) for i, t in enumerate(texts)] + [(3, texts[3], 1, "b", 2), (None, "a " * 30, None, None, None), (None, None, None, None, None)]
    assert digest(spark, tmp_path, rows) == sorted((expected(d, t) for d, t, *_ in rows), key=str)
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, *_ in rows) > 5


def test_query_on_an_empty_table(spark, tmp_path):
    assert digest(spark, tmp_path, []) == []


def test_query_equals_brute_force_on_the_table(spark):
    from curatrix.llm.periodic import op12_periodic_runs

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = op12_periodic_runs(spark, DATA).collect()
    some = [r for r in got if len(docs[r["doc_id"]] or "") < 3000]
    assert len(got) == len(docs) and len(some) > 50
    assert sorted(map(tuple, some)) == sorted(expected(r["doc_id"], docs[r["doc_id"]]) for r in some)
