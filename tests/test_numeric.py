"""Numeric comparison, cases, judges and row rules on fixed inputs."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.functions import reasoning
from curatrix.operators import cases as C
from curatrix.operators import dataset as D
from curatrix.operators import intake as I
from curatrix.operators import judge as J
from curatrix.operators import numeric as N

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize(
    "got, expected, nan, status, n_mismatch",
    [
        ([INF, 1.0], [INF, 1.0], False, "pass", 0),
        ([INF, 1.0], [-INF, 1.0], False, "fail", 1),
        ([INF, 1.0], [1.0, 1.0], False, "fail", 1),
        ([NAN, 1.0], [1.0, 1.0], False, "fail", 1),
        ([NAN, 1.0], [NAN, 1.0], True, "pass", 0),
        ([NAN, 1.0], [1.0, NAN], True, "fail", 2),
        ([1.00005], [1.0], False, "pass", 0),
        ([1.1, 2.0, 3.5], [1.0, 2.0, 3.0], False, "fail", 2),
        ([], [], False, "pass", 0),
        ([1.0], [1.0, 2.0], False, "fail", 0),
        (None, [1.0], False, "fail", 0),
    ],
)
def test_compared(spark, got, expected, nan, status, n_mismatch):
    rows = spark.createDataFrame([(got, expected)], "g array<double>, e array<double>")
    v = rows.select(N.compared(F.col("g"), F.col("e"), atol=F.lit(1e-4), rtol=F.lit(1e-3), allows_nan=F.lit(nan)).alias("v")).first()["v"]
    assert (v["status"], v["n_mismatch"]) == (status, n_mismatch)


def test_compared_integers_complex_shapes_and_order(spark):
    big = 1 << 60
    rows = spark.createDataFrame([([big, big + 1], [big, big], [3.0, 1.0], [1.0, 3.0], [2, 1], [1, 2])], "g array<long>, e array<long>, a array<double>, b array<double>, s array<int>, t array<int>")
    zero = {"atol": F.lit(0.0), "rtol": F.lit(0.0)}
    z = F.array(F.struct(F.lit(3.0).alias("re"), F.lit(4.0).alias("im")))
    off = F.array(F.struct(F.lit(3.0).alias("re"), F.lit(4.5).alias("im")))
    r = rows.select(
        N.compared(F.col("g"), F.col("e"), kind="int", **zero).alias("i"),
        N.compared(F.col("a"), F.col("b"), mode=F.lit("sorted"), **zero).alias("sorted"),
        N.compared(F.col("a"), F.col("b"), got_shape=F.col("s"), shape=F.col("t"), **zero).alias("shape"),
        N.compared(F.col("a"), F.col("b"), got_dtype=F.lit("f64"), dtype=F.lit("f32"), **zero).alias("dtype"),
        N.compared(off, z, kind="complex", atol=F.lit(0.0), rtol=F.lit(0.2)).alias("near"),
        N.compared(off, z, kind="complex", atol=F.lit(0.0), rtol=F.lit(0.01)).alias("far"),
    ).first()
    assert [r[k]["status"] for k in ("i", "sorted", "shape", "dtype", "near", "far")] == ["fail", "pass", "fail", "fail", "pass", "fail"]
    assert r["i"]["n_mismatch"] == 1 and r["shape"]["error"] == "shape mismatch got=2x1 expected=1x2" and r["far"]["max_abs"] == 0.5 and r["far"]["mismatches"][0]["index"] == 0


def test_half_value(spark):
    bits = np.arange(0, 65536, 97, dtype=np.uint16)
    rows = spark.createDataFrame([(int(b),) for b in bits], "b int").select("b", N.half_value(F.col("b")).alias("v")).collect()
    for r in rows:
        want = float(np.array([r["b"]], np.uint16).view(np.float16)[0])
        assert r["v"] == want or (np.isnan(r["v"]) and np.isnan(want))


def test_fill_is_the_generator_of_the_seed(spark):
    param = '{"name":"x","kind":"input","dtype":"f32","shape":[3]}', '{"name":"y","kind":"output","dtype":"f32","shape":[3]}'
    rows = spark.createDataFrame([(1, "odd_7", "non_tile", 5, False, False, False, {}, [json.loads(p) for p in param])], "question_id long, name string, kind string, seed long, generate_dup boolean, generate_denorm boolean, generate_nan boolean, alias map<string,string>, params array<struct<name:string,kind:string,dtype:string,shape:array<int>>>")
    out = {r["tensor"]: bytes(r["data"]) for r in C.filled(rows).collect()}
    rng = random.Random(5)
    assert out["x"] == np.asarray([rng.random() * 4.0 - 2.0 for _ in range(3)], "<f4").tobytes() and out["y"] == bytes(12)


@pytest.mark.parametrize(
    "reply, factual",
    [
        ('{"dimensions": {"factual": 7}}', 7.0),
        ('x {"scores": {"accuracy": 12,},} y', 10.0),
        ('```json\n{"dimensions": {"facts": "nan"}}\n```', 1.0),
        ('{"a": {"b": "}"}} {"dimensions": {"factual": 4}}', 4.0),
        ('<think>{"dimensions": {"factual": 3}}</think>', 3.0),
        ('{"verdict": 1}', None),
        ("{", None),
        (None, None),
    ],
)
def test_judge_reply(reply, factual):
    row = J.reply_row(reply)
    assert (row and row["factual"]) == factual


def test_row_checks():
    state = lambda row: {c["rule"]: c["state"] for c in D.row_checks(json.dumps(row))["checks"]}
    row = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "```cuda\nint x;\n```"}], "metadata": {"language": "cpp"}}
    assert state(row)["H4"] == "pass" and state(row)["H13"] == "n/a"
    row["messages"][1]["content"] = "```cuda\nint x;\n```\n```cuda\nint y;\n```"
    assert state(row)["H4"] == "fail"
    row["messages"][1]["content"] = 5
    assert state(row)["H1"] == "fail" and state(row)["H2"] == "n/a"
    assert D.row_checks("")["checks"][0]["state"] == "fail"


@pytest.mark.parametrize(
    "text, facts",
    [
        ("It is not warp size 64.", []),
        ("The warp size is 64.", ["warp_size_32"]),
        ("On AMD the warp size is 64.", []),
        ("a warp has 64 lanes", ["warp_size_32"]),
        ("warp size: 128 bytes", []),
        ("warp size is 32; not warp width 64", []),
        ("at most 2048 threads per block", ["threads_per_block_1024"]),
    ],
)
def test_facts(spark, text, facts):
    assert spark.createDataFrame([(text,)], "t string").select(reasoning.fact_violations(F.col("t"))).first()[0] == facts


def test_intake(spark):
    rows = [("Explain x", '{"task":"nonsense","kind":"Theory","topic":"PTX"}'), ("Implement a scan", "{}"), ("What is ptx", None)]
    got = spark.createDataFrame(rows, "q string, raw string").select(I.classified(F.col("q"), F.col("raw")).alias("c")).collect()
    assert [tuple(r["c"]) for r in got] == [("knowledge", "isa", "field"), ("kernel", "general", "heuristic"), ("knowledge", "isa", "heuristic")]
    table = spark.range(1, 101).withColumnRenamed("id", "question_id")
    done = spark.createDataFrame([(12,)], "question_id long")
    out = I.selected(table, "question_id", offset=10, ids={5, 11, 12, 13, 99}, done=done, limit=2)
    assert [r[0] for r in out.orderBy("question_id").collect()] == [11, 13] and I.parsed_ids("1, 2,") == {1, 2}
    placed = I.global_row_numbers(table, "question_id").collect()
    assert all(r["place"] == r["question_id"] - 1 for r in placed)


def test_decoded_bf16_is_of_its_type(spark):
    rows = spark.createDataFrame([([1.0], "f32", "bf16"), ([1.0], "f32", "f16"), ([1.0], "bf16", "bf16")], "x array<double>, got string, want string")
    verdict = N.compared(F.col("x"), F.col("x"), atol=F.lit(0.0), rtol=F.lit(0.0), got_dtype=F.col("got"), dtype=F.col("want"))
    assert [r.v.status for r in rows.select(verdict.alias("v")).collect()] == ["pass", "fail", "pass"]
