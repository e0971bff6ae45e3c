"""Queries at lengths and sizes that the smallest tables lack."""

from curatrix.plans.registry import queries


def test_a_draft_of_a_hundred_characters_is_within_the_budget(spark, tmp_path):
    """A text of 92 characters and its fence are 100, as the oracle has it."""
    rows = [(2, 0, "user", "a" * 92), (6, 0, "user", "a" * 93)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r.problems for r in queries()["draft_issues"](spark, str(tmp_path)).collect()}
    assert got == {2: "headings: 1, 2; code", 6: "headings: 1, 2; budget; code"}


def test_a_task_checks_few_rows_at_once():
    import pyarrow as pa

    from curatrix.operators.dataset import AT_ONCE, checked_batches

    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(["{}", None] * 500)], names=["id", "__line"])
    out = list(checked_batches(iter([batch]), "set"))
    assert max(b.num_rows for b in out) == AT_ONCE
    assert [i for b in out for i in b.column("id").to_pylist()] == list(range(1000))


def test_candidates_are_walked_in_batches(spark, capsys):
    """No data frame a candidate, and one whose attempts fill several batches is walked as a whole."""
    from curatrix.streaming.repair import Limits, repair_loop

    many = spark.range(25_000).selectExpr("1L AS job", "1 AS candidate", "24999 - id AS seq", "timestamp_millis(24999 - id) AS ts", "id = 0 AS ok", "true AS compiled", "'KERNEL' AS owner", "concat('v', id % 7) AS version")
    few = spark.range(30).selectExpr("id + 2 AS job", "2 AS candidate", "1L AS seq", "timestamp_millis(0) AS ts", "true AS ok", "true AS compiled", "'KERNEL' AS owner", "'v' AS version")
    found = repair_loop(many.unionByName(few), Limits(repairs=30_000))
    steps = [(r.seq, r.action, r.banked) for r in found.where("job = 1").orderBy("seq").collect()]
    assert [s for s, *_ in steps] == list(range(25_000))
    assert {a for _, a, _ in steps[:-1]} == {"repair"}
    assert steps[-1] == (24_999, "success", 7)
    assert found.where("job > 1 and action = 'success'").count() == 30
    found.explain()
    assert "FlatMapGroups" not in capsys.readouterr().out


def test_parts_are_dealt_over_all_cores(spark):
    from curatrix.plans.base import Tables

    assert Tables(spark, "/root/testdata/sf0.001").part.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_orphans_take_more_tasks_for_more_lines(spark, monkeypatch):
    from curatrix.plans import trace

    run = lambda: queries()["orphans"](spark, "/root/testdata/sf0.001")
    want = sorted(map(str, run().collect()))
    monkeypatch.setattr(trace, "ROWS_A_TASK", 100)
    assert run().rdd.getNumPartitions() > 50
    assert sorted(map(str, run().collect())) == want


def test_long_texts_lose_their_code_in_one_pass(spark):
    """4000 lines: work that goes through all lines again for each of them takes minutes."""
    import time

    from pyspark.sql import functions as F

    from curatrix.functions.reasoning import clean_reasoning

    prose = "\n".join(f"word {i} of prose" for i in range(4000))
    rows = spark.createDataFrame([(prose + "\n#include <a>\nx = 1;",)], "text string")
    begun = time.monotonic()
    assert rows.select(clean_reasoning(F.col("text"), 1 << 20)).first()[0] == prose
    assert time.monotonic() - begun < 20
