"""Decontamination against its SQL: items of other sizes than the window, mixed alignments, repeats."""

import random

import duckdb
import pytest


def words(n, rng, of=4000):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def both(spark, tmp_path, texts, items):
    from curatrix.llm.decontaminate import ORACLE, op10_decontamination

    spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, k1 string, n int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i + 1, t, 9) for i, t in enumerate(items)], "item_id long, text string, fp int").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = ["doc_id", "contaminated", "n_items", "item_ids", "best_similarity"]
    rounded = lambda r: (*r[:4], round(r[4], 9))
    got = sorted(rounded(tuple(r[n] for n in names)) for r in op10_decontamination(spark, str(tmp_path)).collect())
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    want = sorted(map(rounded, c.execute(f"select {', '.join(names)} from ({ORACLE})").fetchall()))
    assert got == want
    return {r[0]: r[3] for r in got}


def test_windows_meet_items_of_their_own_size_alone(spark, tmp_path):
    rng = random.Random(1)
    one = words(45, rng)
    longer = [*one[:22], "inserted", *one[22:]]
    text = " ".join([*words(30, rng), *longer, *words(30, rng)])
    got = both(spark, tmp_path, [text, " ".join([*words(30, rng), *one, *words(30, rng)]), None, ""], [" ".join(one), " ".join(longer)])
    assert got == {0: "2", 1: "1", 2: "", 3: ""}


def test_a_size_that_another_item_gives_contaminates_nothing(spark, tmp_path):
    rng = random.Random(2)
    one = words(45, rng)
    held = [*one[:22], "inserted", *one[22:]]
    other = [*held[:5], *words(41, rng)]
    got = both(spark, tmp_path, [" ".join([*words(30, rng), *held, *words(30, rng)])], [" ".join(one), " ".join(other)])
    assert got == {0: ""}


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_edited_items_equal_the_sql(spark, tmp_path, seed):
    rng = random.Random(seed)
    items = [words(rng.choice((3, 5, 6, 20, 40, 41, 42)), rng, 60) for _ in range(25)]
    items += [[*x[:-1], "last"] for x in items[:8]] + [["a"] * 30, ["a", "b"] * 20, items[3]]
    texts = []
    for _ in range(90):
        x = list(rng.choice(items))
        for _ in range(rng.choice((0, 1, 1, 2, 3, 8))):
            at = rng.randrange(len(x) + 1)
            x[at : at + rng.choice((0, 1))] = words(rng.choice((0, 1)), rng, 60)
        texts.append(" ".join([*words(rng.choice((0, 3, 30)), rng, 60), *x, *words(rng.choice((0, 3, 30)), rng, 60)]))
    texts += [texts[0], "a " * 500, "a b " * 100, " ".join(words(9000, rng, 60) + items[0])]
    got = both(spark, tmp_path, texts, [" ".join(x) for x in items] + [None, ""])
    assert any(got.values()) and not all(got.values())


def test_pipeline_keeps_what_only_another_size_would_reject(spark):
    from curatrix.llm.decontaminate import drop_contaminated

    rng = random.Random(2)
    one = words(45, rng)
    held = [*one[:22], "inserted", *one[22:]]
    other = [*held[:5], *words(41, rng)]
    docs = spark.createDataFrame([(0, " ".join(held)), (1, " ".join(one))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(one)), (2, " ".join(other))], "item_id long, text string")
    assert [r["doc_id"] for r in drop_contaminated(docs, bench).collect()] == [0]
