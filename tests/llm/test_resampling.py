"""Importance resampling against a plain count over all features."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

DATA = "/root/testdata/sf0.001"


def features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in words + [" ".join(p) for p in zip(words, words[1:], strict=False)]]


def expected(docs, targets):
    """Rows of (doc_id, n_features, weight, score, rank)."""
    have = [(d, *features(t)) for d, t in docs]
    own, goal = Counter(b for *_, f in have for b in f), Counter(b for t in targets for b in features(t)[1])
    n_own, n_goal = own.total(), goal.total()
    gain = {b: math.floor(1000 * math.log((goal[b] + 1) * (n_own + 10_000) / ((own[b] + 1) * (n_goal + 10_000)))) for b in own}
    rows = []
    for d, words, f in have:
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        rows.append((d, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    places = {id(r): i + 1 for i, r in enumerate(order[: 25 * len(order) // 100])}
    return [(r[0], r[2], r[3], r[4], places.get(id(r))) for r in rows]


def made(n=400):
    rng = random.Random(8)
    words = [a + b for a in ("Ka", "lo", "mi", "é", "漢") for b in ("", "n", "r9", "-do", "\x00fe")]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice((0, 1, 5, 19, 20, 40, 300)))) for _ in range(n)]
    return texts + [None, "", "--", "x" * 200 + " y " + "z" * 70, f"{'a' * 64} {'b' * 65} {'c' * 64} {'d' * 63}", "the " * 20_000]


def test_features_of_a_batch_equal_those_of_each_text():
    from curatrix.llm.resampling import hashed_features

    texts = made()
    whole = pa.array(["other words", *texts, "more"])
    text, bucket, words = hashed_features(whole.slice(1, len(texts)))
    assert words.tolist() == [features(t)[0] for t in texts]
    assert Counter(zip(text.tolist(), bucket.tolist(), strict=True)) == Counter((i, b) for i, t in enumerate(texts) for b in features(t)[1])
    assert [len(x) for x in hashed_features(pa.array([], pa.string()))] == [0, 0, 0]
    assert hashed_features(pa.array([None, ""], pa.string()))[2].tolist() == [0, 0]


def drawn(spark, tmp_path, docs, targets):
    from curatrix.llm.resampling import op11_importance_resampling

    rows = [(d, t, 3, "b", 1.5) for d, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, weight int, block string, own double").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t, "r") for i, t in enumerate(targets)], "item_id long, text string, range string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = op11_importance_resampling(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return [tuple(r) for r in got.collect()]


@pytest.mark.parametrize("block_bytes", [4 << 20, 3000])
def test_query_equals_a_plain_count(spark, tmp_path, monkeypatch, block_bytes):
    from curatrix.llm import resampling

    monkeypatch.setattr(resampling, "BLOCKS_A_SALT", 2)
    monkeypatch.setattr(resampling, "BLOCK_BYTES", block_bytes)
    texts = made()
    docs = [(3 * i, t) for i, t in enumerate(texts)] + [(None, texts[7])]
    targets = [*texts[5:25], None, "Unseen words here"]
    got, want = drawn(spark, tmp_path, docs, targets), expected(docs, targets)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[4] is not None for r in got) > 20


def test_repeated_rows_are_rows_of_their_own(spark, tmp_path):
    docs = [(i // 3, f"{'word ' * 25}{i // 3}") for i in range(60)]
    got, want = drawn(spark, tmp_path, docs, ["word word"]), expected(docs, ["word word"])
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 60


def test_empty_tables(spark, tmp_path):
    assert drawn(spark, tmp_path / "a", [], ["a b"]) == []
    docs = [(i, "only own words " * 9) for i in range(8)]
    assert sorted(drawn(spark, tmp_path / "b", docs, []), key=str) == sorted(expected(docs, []), key=str)


def test_query_equals_a_plain_count_on_the_tables(spark):
    from curatrix.llm.resampling import op11_importance_resampling

    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    targets = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = [tuple(r) for r in op11_importance_resampling(spark, DATA).collect()]
    assert sorted(got, key=str) == sorted(expected(docs, targets), key=str)


def test_a_task_reads_few_postings_at_once(spark):
    """Rows of postings are wide: the reader holds a row group of them, which must not follow a task's input."""
    import glob

    import pyarrow.parquet as pq

    from curatrix.llm import common
    from curatrix.llm.resampling import importance_weights

    docs = spark.range(0, 2500, 1, 1).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 2000), i -> substring(hex(xxhash64(id, i)), 1, 4)), ' ') AS text")
    weights = importance_weights(docs, docs.select("text").limit(0))
    made = [p for p in common._WRITTEN if "/postings-" in p][-1]
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{made.removeprefix('file:')}/*.parquet")]
    groups = [m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)]
    assert weights.count() == 2500
    assert sum(groups) > 20 << 20
    assert max(groups) < 16 << 20
