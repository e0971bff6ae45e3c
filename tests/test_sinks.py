"""Commits that are cut off after each step, and writers that meet."""

import os
import threading
import time

import pytest

from curatrix.sources import sinks

SCHEMA = "sample_key string, id long, dialect string, user string, assistant string, system string"
ROWS = [("k1", 1, None, "u", "a", "s"), ("k2", 2, "triton", "u", "b", None)]


def state(spark, root):
    """Keys of the archive and of progress, and both exports' answers."""
    return (
        sorted(r.sample_key for r in spark.read.parquet(f"{root}/archive").collect()),
        sorted(r.sample_key for r in spark.read.parquet(f"{root}/progress").collect()),
        sorted(r.output for r in spark.read.json(f"{root}/export/input_output").collect()),
        sorted(r.messages[-1].content for r in spark.read.json(f"{root}/export/messages").collect()),
    )


WHOLE = (["k1", "k2"], ["k1", "k2"], ["a", "b"], ["a", "b"])


@pytest.mark.parametrize("step", ["archive", "messages", "input_output", "rename", "progress"])
def test_a_rerun_repairs_what_a_crash_left_out(spark, tmp_path, monkeypatch, step):
    root, samples = str(tmp_path), spark.createDataFrame(ROWS, SCHEMA)
    append, replace = sinks.append_new, sinks.replaced

    def failing_append(rows, path, *rest, **named):
        out = append(rows, path, *rest, **named) if step == "archive" or not path.endswith(step) else None
        if path.endswith(step):
            raise RuntimeError("lost")
        return out

    def failing_replace(spark, path, write):
        if path.endswith(step):
            raise RuntimeError("lost")
        if step == "rename" and path.endswith("messages"):
            write(f"{path}.left-behind")
            raise RuntimeError("lost")
        replace(spark, path, write)

    monkeypatch.setattr(sinks, "append_new", failing_append)
    monkeypatch.setattr(sinks, "replaced", failing_replace)
    with pytest.raises(RuntimeError, match="lost"):
        sinks.commit_success(samples, root)
    assert not os.path.exists(f"{root}/.writer") and not os.path.exists(f"{root}/progress")
    monkeypatch.setattr(sinks, "append_new", append)
    monkeypatch.setattr(sinks, "replaced", replace)
    for _ in range(2):
        sinks.commit_success(samples, root)
    assert state(spark, root) == WHOLE


def test_two_writers_double_no_key(spark, tmp_path):
    root, faults = str(tmp_path), []

    def write(rows):
        try:
            sinks.commit_success(spark.createDataFrame(rows, SCHEMA), root)
        except Exception as fault:
            faults.append(fault)

    both = [threading.Thread(target=write, args=(rows,)) for rows in (ROWS, ROWS[::-1], ROWS[:1])]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert not faults and state(spark, root) == WHOLE


def test_locks_of_dead_writers_are_taken_over(spark, tmp_path):
    (tmp_path / ".writer").write_text("someone")
    with pytest.raises(sinks.Busy), sinks.one_writer(spark, str(tmp_path), wait=0.1, pause=0.05):
        pass
    old = time.time() - 7200
    os.utime(tmp_path / ".writer", (old, old))
    with sinks.one_writer(spark, str(tmp_path), wait=5, pause=0.05):
        assert (tmp_path / ".writer").read_text() != "someone"
    assert not (tmp_path / ".writer").exists()


def test_the_first_row_of_a_key_is_a_certain_one(spark, tmp_path):
    rows = [("k", i, None, f"u{i}", "a", None) for i in range(40)]
    for n, part in enumerate((rows, rows[::-1])):
        frame = spark.createDataFrame(part, SCHEMA).repartition(3 + n)
        assert sinks.append_new(frame, f"{tmp_path}/by{n}", ["sample_key"], ["id"]).first().id == 0
        sinks.append_new(frame, f"{tmp_path}/any{n}", ["sample_key"])
    assert spark.read.parquet(f"{tmp_path}/any0").first() == spark.read.parquet(f"{tmp_path}/any1").first()
    keyless = spark.createDataFrame([(None, 1, None, "u", "a", None)] * 2, SCHEMA)
    for _ in range(2):
        assert sinks.append_new(keyless, f"{tmp_path}/null", ["sample_key"]).count() == 1
