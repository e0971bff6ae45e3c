"""The near-copy step finds its links in BK-trees of SimHash fingerprints, as brute force does."""

import numpy as np

from curatrix.llm import lines, near_copies
from curatrix.llm.simhash import BKForest


def planted(rng, count):
    """Fingerprints of two times 64 bits about a few centres."""
    centres = rng.integers(0, 1 << 63, (8, 2), np.uint64)
    flips = (rng.random((count, 2, 64)) < 0.13).astype(np.uint64) << np.arange(64, dtype=np.uint64)
    return centres[rng.integers(0, 8, count)] ^ flips.sum(-1, dtype=np.uint64)


def classes(label):
    return {frozenset(np.flatnonzero(label == k).tolist()) for k in np.unique(label)}


def test_tree_groups_are_those_of_brute_force():
    rng = np.random.default_rng(5)
    for count in (0, 1, 2, *rng.integers(3, 80, 60).tolist()):
        shard, n, fps = np.sort(rng.integers(0, 4, count)), rng.integers(1, 90, count), planted(rng, count)
        label = np.arange(count)
        for i in range(count):
            for j in range(i):
                alike = shard[i] == shard[j] and 4 * max(n[i], n[j]) <= 5 * min(n[i], n[j])
                if alike and label[i] != label[j] and (min(n[i], n[j]) <= near_copies.FEW or int(np.bitwise_count(fps[i] ^ fps[j]).sum()) <= near_copies.RADIUS):
                    label[label == max(label[i], label[j])] = min(label[i], label[j])
        assert classes(near_copies.tree_groups(shard, n, fps)) == classes(label)


def test_near_copies_ask_bk_trees(spark, monkeypatch):
    import pyarrow as pa

    asked, query = [], BKForest.query
    monkeypatch.setattr(BKForest, "query", lambda self, points, *rest: asked.append(len(points)) or query(self, points, *rest))
    fps = np.array([[5, 9], [7, 9], [~5, ~9]], np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 1, 1]), pa.array([10, 20, 30]), pa.array([50, 50, 50], pa.int32()), pa.array(fps[:, 0]), pa.array(fps[:, 1])], names=["place", "key", "n", "fp", "fp2"])
    (links,) = near_copies.meet(iter([batch]))
    assert links.to_pylist() == [{"a": 20, "b": 10}] and sum(asked) > 0


def test_near_copies_among_some_rows(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words[:59], "x"]), " ".join(words[::-1]), " ".join(words[:58]), None]
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    only = near_copies.materialize(spark.createDataFrame([(1,), (2,), (3,)], "row long"), "only")
    groups = {r["row"]: r["group"] for r in near_copies.near_copy_groups(rows, only).collect()}
    assert sorted(groups) == [1, 2, 3] and groups[1] == groups[3] != groups[2]


def test_line_dedup_writes_no_texts_of_documents(spark, monkeypatch):
    """Texts of the documents that hold candidate lines were shuffled and written once more."""
    written, materialize = [], lines.materialize
    monkeypatch.setattr(lines, "materialize", lambda df, name, *rest: written.append((name, df.columns)) or materialize(df, name, *rest))
    rows = [(i, f"a line that all of these documents hold again\nown {'abcdefgh'[i]} words here, {'abcdefgh'[i] * 3} only") for i in range(8)]
    out = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["__lines"]["n_dropped"] == 1 for r in out)
    assert written and not [name for name, columns in written if "text" in columns]
