"""Suites of cases, written and read again."""

from pyspark.sql import functions as F

from curatrix.operators import cases as C
from curatrix.sources.suites import read_plans, read_suite, stale_suites, write_suite

NONE = {"alias_of": "", "layout": "contiguous"}
PARAMS = [{"name": "x", "kind": "input", "dtype": "f32", "rank": 1, "shape_from": ["n"], **NONE}, {"name": "y", "kind": "output", "dtype": "f32", "rank": 1, "shape_from": ["n"], **NONE}, {"name": "n", "kind": "size", "dtype": "i32", "rank": 0, "shape_from": [], **NONE}]


def plans(spark, *questions, nan=False):
    flags = {"dtype": "f32", "layout": "contiguous", "allows_nan": nan, "in_place": False, "supports_strided": True, "supports_broadcast": False, "supports_inplace": False}
    rows = spark.createDataFrame([(q, {**flags, "params": PARAMS}) for q in questions], f"question_id long, abi {C.ABI}")
    return C.case_plans(rows, "smoke").drop("n")


def test_written_suites_are_read_again(spark, tmp_path):
    root = str(tmp_path)
    write_suite(plans(spark, 1, 2), root)
    got = {(r.question_id, r.ordinal): (r.name, r.kind, r.shapes, r.seed) for r in read_suite(spark, root).collect()}
    assert got == {(r.question_id, r.ordinal): (r.name, r.kind, r.shapes, r.seed) for r in plans(spark, 1, 2).collect()} and len(got) >= 6
    assert stale_suites(plans(spark, 1, 2), root).count() == 0


def test_a_suite_is_replaced_and_others_stay(spark, tmp_path):
    root = str(tmp_path)
    write_suite(plans(spark, 1, 2), root)
    write_suite(plans(spark, 2).where("ordinal = 0"), root)
    assert {(r.question_id, r.n) for r in read_suite(spark, root).groupBy("question_id").agg(F.count("*").alias("n")).collect()} == {(1, plans(spark, 1).count()), (2, 1)}
    assert [r.question_id for r in stale_suites(plans(spark, 1, 2, 3), root).orderBy("question_id").collect()] == [2, 3]


def test_bad_lines_are_left_out(spark):
    lines = spark.createDataFrame([(1, '{"name": "a", "shapes": {"x": [3]}, "large": true}'), (2, '{"name": "b"'), (3, "[1]"), (4, ""), (5, None), (6, '{"name": "c", "seed": "odd"}')], "at long, value string")
    got = {r.at: r for r in read_plans(lines).collect()}
    assert set(got) == {1, 6} and got[1].shapes == {"x": [3]} and got[1].large and got[6].seed is None
