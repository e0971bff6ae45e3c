"""The repair loop as a table and as a stream: hand-worked steps, equal rows, restarts."""

import datetime as dt
import random

import pytest

from curatrix.streaming.repair import Limits, repair_loop, repair_stream

SCHEMA = "job long, candidate int, seq long, ts timestamp, ok boolean, compiled boolean, owner string, version string"
START = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
STORE = "spark.sql.streaming.stateStore.providerClass"


def attempt(seq, seconds, ok=False, owner="KERNEL", job=1, compiled=True, version=None):
    return (job, 0, seq, START + dt.timedelta(seconds=seconds), ok, compiled, owner, version or f"v{seq}")


def steps(rows):
    return sorted((r.job, r.candidate, r.at, r.seq or -1, r.action, r.repairs, r.retries, r.wait_s, r.banked) for r in rows)


def actions(spark, *attempts):
    got = repair_loop(spark.createDataFrame(attempts, SCHEMA)).collect()
    return [(r.action, r.repairs, r.retries, r.wait_s, r.banked) for r in sorted(got, key=lambda r: (r.at, r.seq or 10**9))]


def test_steps_of_one_candidate(spark):
    assert actions(spark, attempt(1, 0), attempt(2, 1, True), attempt(3, 2)) == [("repair", 1, 0, 0.0, 1), ("success", 1, 0, 0.0, 2)]
    assert actions(spark, *[attempt(i, i, compiled=False) for i in range(6)]) == [("repair", 1, 0, 0.0, 0), ("repair", 2, 0, 0.0, 0), ("repair", 3, 0, 0.0, 0), ("abandoned", 3, 0, 0.0, 0)]
    assert actions(spark, *[attempt(i, i, owner="INFRA", version="same") for i in range(4)]) == [("retry", 0, 1, 5.0, 1), ("retry", 0, 2, 20.0, 1), ("blocked", 0, 2, 0.0, 1)]


def test_retries_that_do_not_come(spark):
    assert actions(spark, attempt(1, 0, owner="ORACLE"), attempt(2, 700, True)) == [("retry", 0, 1, 5.0, 1), ("lost", 0, 1, 0.0, 1)]
    assert actions(spark, attempt(1, 0, owner="ORACLE"), attempt(2, 605, True)) == [("retry", 0, 1, 5.0, 1), ("success", 0, 1, 0.0, 2)]
    # Another job's attempts show that the time has come.
    assert actions(spark, attempt(1, 0, owner="ORACLE"), attempt(2, 5000, True, job=2)) == [("retry", 0, 1, 5.0, 1), ("lost", 0, 1, 0.0, 1), ("success", 0, 0, 0.0, 1)]
    assert repair_loop(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(STORE, before)


def test_a_restarted_stream_gives_the_rows_of_the_table(spark, rocks, tmp_path):
    rng = random.Random(4)
    rows = [(rng.randrange(12), 0, i, START + dt.timedelta(seconds=40 * i), rng.random() < 0.15, rng.random() < 0.5, rng.choice(("ORACLE", "INFRA", "KERNEL", None)), f"v{rng.randrange(4)}") for i in range(240)]
    limits = Limits(patience_s=300.0)
    source, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    for n in range(3):  # each part is another run of the query, from its checkpoint
        spark.createDataFrame(rows[80 * n : 80 * n + 80], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = repair_stream(spark.readStream.schema(SCHEMA).parquet(source), limits)
        stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    want = steps(repair_loop(spark.createDataFrame(rows, SCHEMA), limits).collect())
    assert steps(spark.read.parquet(sink).collect()) == want
    assert {r[4] for r in want} == {"repair", "retry", "success", "blocked", "abandoned", "lost"} or {"lost", "retry", "success"} <= {r[4] for r in want}
