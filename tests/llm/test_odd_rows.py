"""Rows that no corpus should have: nulls, blanks, repeats, megabytes, clashing columns, empty tables."""

import itertools
import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, place int, words string, group int"
LABELS = "doc_id long, quality int, toxic int"


def prose(n, rng):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    texts = [prose(rng.randint(3, 60), rng) + (" vile scum pond" if i % 4 == 0 else "") for i in range(120)]
    texts += [None, "", " \n\t", texts[3], texts[3], prose(200_000, rng)]
    out = [(i, t, "xx", "s", len(t or ""), "r", 1, "w", 2) for i, t in enumerate(texts)]
    return [*out, out[5], out[5], *[(None, t, None, None, None, None, None, None, None) for t in (texts[8], None, "", prose(40, rng))]]


@pytest.fixture(scope="module")
def tables(spark, rows, tmp_path_factory):
    labels = [(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(120)] + [(3, 0, None), (None, 1, 1), (7, None, None), (8, 1, 1)]
    bench = [(1, rows[11][1]), (2, None), (3, ""), (None, rows[13][1])]
    out = {}
    for name, docs in (("rows", rows), ("none", [])):
        folder = str(tmp_path_factory.mktemp(name))
        spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(labels if docs else [], LABELS).write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame(bench if docs else [], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        out[name] = folder
    return out


def test_the_pipeline_takes_odd_rows(spark, tables):
    import corpus_pipeline

    docs = spark.read.parquet(f"{tables['rows']}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, tables["rows"])
        assert kept.columns == docs.columns and kept.count() <= docs.count(), name
    packed = corpus_pipeline.run(spark, tables["rows"])
    assert packed.where("doc_id is null").count() > 0 and packed.where("doc_id = 125").count() > 100
    assert corpus_pipeline.run(spark, tables["none"]).count() == 0


def test_learned_scores_take_odd_rows(spark, tables, rows):
    from curatrix.llm.quality import op9_quality
    from curatrix.llm.toxicity import op7_toxicity

    for query in (op7_toxicity, op9_quality):
        got = query(spark, tables["rows"]).collect()
        assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
        by_id = {}
        for r in got:
            by_id.setdefault(r["doc_id"], set()).add((r["score"], r["predicted"], r["held_out"]))
        assert all(len(v) == 1 for d, v in by_id.items() if d is not None)  # repeated rows score alike
        assert by_id[120] == by_id[121] or {s for s, *_ in by_id[120]} == {s for s, *_ in by_id[121]}  # null as empty
        assert query(spark, tables["none"]).count() == 0


@pytest.mark.parametrize("max_tree", [6, 50])
def test_over_full_shards_lose_no_link(spark, max_tree):
    from curatrix.llm.components import components
    from curatrix.llm.simhash import near_links

    rng = random.Random(max_tree)
    base = [rng.getrandbits(64) for _ in range(4)]
    prints = {b ^ sum(1 << k for k in rng.sample(range(64), rng.choice((0, 1, 2, 3, 6)))) for b in base for _ in range(120)} | {rng.getrandbits(64) for _ in range(60)}
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    group = {p: p for p in signed}

    def top(p):
        while group[p] != p:
            p = group[p]
        return p

    for a, b in itertools.combinations(signed, 2):
        if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4:
            group[max(top(a), top(b))] = min(top(a), top(b))
    links = near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), 4, max_tree)
    found = {r["node"]: r["component"] for r in components(links).collect()}
    classes = {}
    for p in signed:
        classes.setdefault(found.get(p, p), set()).add(p)
    want = {}
    for p in signed:
        want.setdefault(top(p), set()).add(p)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values())) and len(want) < len(signed)
