"""Places, running sums and percentiles over ranges against plain loops."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from curatrix.operators.ordered import percentiles, ranked, running


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    return [(i, rng.choice(("a", "b", None)) if i % 3 else "hot", rng.choice((None, 1.5, 2.5, 7.0)) if i % 5 == 0 else rng.random()) for i in range(3000)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "i long, g string, x double").repartition(7)


def test_places(frame, rows):
    got = {r["i"]: r["rank"] for r in ranked(frame, [F.col("g").desc_nulls_last(), F.col("i").desc()]).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[0]), reverse=True)
    assert got == {r[0]: n + 1 for n, r in enumerate(order)}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_running_sums(frame, rows, by):
    got = {r["i"]: (r["n"], r["s"]) for r in running(frame, [F.col("i")], {"n": F.lit(1), "s": F.col("i") * 2}, by).collect()}
    seen, want = {}, {}
    for i, g, _ in rows:
        n, s = seen.get(g if by else 0, (0, 0))
        want[i] = seen[g if by else 0] = (n + 1, s + 2 * i)
    assert got == want


@pytest.mark.parametrize("nearest", [False, True])
def test_percentiles(frame, rows, nearest):
    shares = {"p0": 0.0, "p5": 0.05, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    groups = {}
    for _, g, x in rows:
        if x is not None:
            groups.setdefault(g, []).append(x)

    def at(values, q):
        values = sorted(values)
        if nearest:
            return next(v for i, v in enumerate(values) if (i + 1) >= q * len(values))
        place = q * (len(values) - 1)
        low = values[int(place)]
        return low + (values[min(int(place) + 1, len(values) - 1)] - low) * (place - int(place))

    got = {r["g"]: [r[n] for n in shares] for r in percentiles(frame, "x", shares, ["g"], nearest).collect()}
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        assert got[g] == pytest.approx([at(values, q) for q in shares.values()])
    if not nearest:
        whole = [x for v in groups.values() for x in v]
        assert percentiles(frame, "x", {"m": 0.5}).first()["m"] == pytest.approx(statistics.median(whole))


def test_nothing_to_order(frame):
    none = frame.where("false")
    assert ranked(none, [F.col("i")]).count() == 0 and running(none, [F.col("i")], {"n": F.lit(1)}, ["g"]).count() == 0
    assert percentiles(none, "x", {"m": 0.5}, ["g"]).count() == 0
    assert [r["m"] for r in percentiles(none, "x", {"m": 0.5}).collect()] == [None]
