"""Reasoning texts, sources, sinks and streams on small made cases."""

import struct

import pytest
from pyspark.sql import functions as F

from curatrix.functions import names, reasoning
from curatrix.sources import lines as L
from curatrix.sources import sinks
from curatrix.streaming import trace


def one(spark, make, *values):
    row = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, want",
    [
        (None, ""),
        ("", ""),
        ("Plan first.\n```cuda\nint x;\n```\nThen run.", "Plan first.\n\nThen run."),
        ("```text\njust words\n```", "just words"),
        ("Ends with a brace; in prose;\nnext line of prose", "Ends with a brace; in prose;\nnext line of prose"),
        ("int a = 1;\nint b = 2;\nwords", "words"),
        ("__global__ void k(float* x) {\n  x[0] = 1;\n}\nwords", "words"),
        ("open ```cuda\nint x", "open ```cuda\nint x"),
        ("- item one;\n- item two;", "- item one;\n- item two;"),
    ],
)
def test_strip_code(spark, text, want):
    assert one(spark, reasoning.strip_code, text) == want


@pytest.mark.parametrize("text, want", [("short", "short"), ("a" * 9 + "\nbbbb", "a" * 9), ("Aaaaaaaa. bbbb", "Aaaaaaaa."), ("a" * 20, "a" * 10), ("a.b\n" + "c" * 20, "a.b\ncccccc"), (None, None)])
def test_clip_at_boundary(spark, text, want):
    assert one(spark, lambda c: reasoning.clip_at_boundary(c, 10), text) == want


def test_clip_middle_keeps_head_and_tail(spark):
    got = one(spark, lambda c: reasoning.clip_middle(c, 60), "h" * 100 + "t" * 100)
    room = 60 - len(reasoning.MARKER)
    assert got == "h" * int(room * 0.3) + reasoning.MARKER + "t" * (room - int(room * 0.3))


def test_leaks_spare_what_the_question_says(spark):
    assert one(spark, reasoning.repair_leaks, "After the compile error I was fixing the code. 修复", "") == ["修复", "compile error", "fixing the code"]
    assert one(spark, reasoning.repair_leaks, "a compile error", "why this compiler error?") == []
    assert one(spark, reasoning.repair_leaks, None, None) == []


def test_consistency(spark):
    code = "constexpr int BLOCK_SIZE = 128; #define TILE_N 8"
    assert one(spark, reasoning.constant_mismatches, "BLOCK_SIZE = 64, TILE_N: 8, WARPS = 4", code) == ["BLOCK_SIZE=64"]
    assert one(spark, reasoning.constant_mismatches, None, None) == []
    assert one(spark, lambda a, b, c: reasoning.unknown_identifiers(a, b, c, ("dim3",)), "`dim3` `kern` `other` `asked`", "void kern()", "asked") == ["other"]


@pytest.mark.parametrize("text, want", [("warp size is 64", ["warp_size_32"]), ("warp size is 32, not 64", []), ("warp size is 128 bytes", []), ("AMD warp size is 64", []), ("a warp has 16 threads", ["warp_size_32"]), ("unlimited threads per block", ["threads_per_block_1024"]), (None, [])])
def test_facts(spark, text, want):
    assert one(spark, reasoning.fact_violations, text) == want


def test_tracks(spark):
    assert one(spark, names.track, " Memory ") == "knowledge:memory" and one(spark, names.track, None) == "knowledge:general"
    assert [one(spark, lambda c: names.topic(c, ("isa",)), x) for x in ("knowledge:api", "knowledge:", "ISA", "cuda")] == ["api", "general", "isa", "general"]


def lines(spark, *values):
    return spark.createDataFrame([("f", i + 1, v) for i, v in enumerate(values)], "file string, line long, value string")


def test_questions(spark):
    got = L.questions(lines(spark, '{"question": " a ", "x": 1}', "", "[1]", '{"question": " "}', '{"question": "b"}', "null")).orderBy("question_id").collect()
    assert [(r.question_id, r.question) for r in got] == [(1, "a"), (5, "b")]
    with pytest.raises(Exception, match="f:2: malformed JSON"):
        L.questions(lines(spark, '{"question": "a"}', "{torn")).select("question").collect()


def test_trace_progress_issues(spark):
    with pytest.raises(Exception, match="f:1: no event"):
        L.trace_events(lines(spark, '{"v": 1}')).collect()
    assert [r.event for r in L.trace_events(lines(spark, '{"event": "job.end"}', " ")).collect()] == ["job.end"]
    rows = ('{"id": 1, "status": "success"}', '{"id": 1, "dialect": " CUDA ", "status": "abandoned"}', '{"id": 2, "dialect": "triton", "status": "running"}', '{"id": 3, "sta')
    assert [tuple(r) for r in L.done_keys(lines(spark, *rows)).collect()] == [(1, "cuda")]
    assert [tuple(r) for r in L.line_issues(lines(spark, *rows, "")).collect()] == [("f", 4, 1)]


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"event": "x"}\n\n{"event": "y"}\n')
    assert [(r.line, r.event) for r in L.trace_events(L.read_lines(spark, str(tmp_path / "a.jsonl"))).orderBy("line").collect()] == [(1, "x"), (3, "y")]
    paths = spark.createDataFrame([("/w/7/triton/c0_r0/solution.py",), ("/w/8/solution.cu",), ("/w/8/compile.log",)], "path string")
    assert sorted((r.question_id, r.dialect) for r in L.solution_files(paths).collect()) == [(7, "triton"), (8, "cuda")]


def test_tensors_and_output(spark):
    rows = [("a", struct.pack("<2f", 1.5, -2), "f32", [2]), ("b", b"\x80\x3f", "bf16", [1]), ("c", b"\0\0\0", "i32", [1]), ("d", b"", "f64", [0]), ("e", b"", "q", [1])]
    got = {r.path: r for r in L.tensor_values(spark.createDataFrame(rows, "path string, content binary, dtype string, shape array<int>")).collect()}
    assert got["a"]["values"] == [1.5, -2.0] and got["b"]["values"] == [1.0] and got["d"]["values"] == []
    assert got["c"].error == "0 elements, not 1" and got["e"].error == "type q"
    last = lambda c: F.to_json(L.last_object(c))
    assert one(spark, last, 'x\n{"a":1}\n{"a":2}\nend') == '{"a":2}' and one(spark, last, 'x {"a":\n3} y') == '{"a":3}' and one(spark, last, None) is None


def test_compile_log(spark):
    log = lines(spark, "23:59:50 worker=w1 question=5 compile=FAIL", "00:00:10 worker=w1 question=5 compile=PASS", "noise")
    assert [tuple(r) for r in L.compile_log(log).collect()] == [("w1", 5, 1, 1, 20)]


def test_commits_are_idempotent(spark, tmp_path):
    rows = [("k1", 1, None, "u", "a", "s"), ("k1", 1, None, "u", "a", "s"), ("k2", 2, "triton", "u", "", None)]
    samples = spark.createDataFrame(rows, "sample_key string, id long, dialect string, user string, assistant string, system string")
    for _ in range(2):
        progress = sinks.commit_success(samples, str(tmp_path))
    assert sorted((r.id, r.dialect) for r in progress.collect()) == [(1, "cuda"), (2, "triton")]
    archive = spark.read.parquet(f"{tmp_path}/archive")
    assert archive.count() == 2
    sinks.export_training(archive, f"{tmp_path}/export")
    assert [r.input for r in spark.read.json(f"{tmp_path}/export/input_output").collect()] == ["s\n\nu"]
    assert [[m.role for m in r.messages] for r in spark.read.json(f"{tmp_path}/export/messages").collect()] == [["system", "user", "assistant"]]


def test_audit_split(spark, tmp_path):
    flags = lambda v: F.filter(F.array(F.when(v.contains("bad"), "bad"), F.when(F.length(v) > 5, "long")), lambda x: x.isNotNull())
    counts = sinks.audit_split(lines(spark, "ok ", "bad", "bad long"), flags, str(tmp_path))
    assert sorted(tuple(r) for r in counts.collect()) == [("bad", 2), ("long", 1)]
    assert [r.value for r in spark.read.text(f"{tmp_path}/clean").collect()] == ["ok "]


def test_streams(spark, tmp_path):
    schema = "job long, seq long, passed boolean"
    spark.createDataFrame([(1, 1, False), (1, 2, True), (1, 3, False), (2, 1, False), (2, 2, False)], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    read = lambda: spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    states = trace.candidate_states(read(), max_repairs=1).writeStream.outputMode("update").format("memory").queryName("states").option("checkpointLocation", f"{tmp_path}/s").trigger(availableNow=True).start()
    states.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("states").collect()) == [(1, 1, "success"), (2, 1, "abandoned")]
    for n in range(2):
        trace.commit_stream(read(), f"{tmp_path}/out", ["job"], f"{tmp_path}/c{n}").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_span_pairs(spark, tmp_path):
    spark.sql("select * from values ('a', timestamp'2024-01-01 00:00:00'), ('b', timestamp'2024-01-01 00:01:00') t(span_id, ts)").write.parquet(f"{tmp_path}/starts")
    spark.sql("select * from values ('a', timestamp'2024-01-01 00:00:02'), ('b', timestamp'2024-01-01 03:00:00') t(span_id, ts)").write.parquet(f"{tmp_path}/ends")
    read = lambda n: spark.readStream.schema("span_id string, ts timestamp").parquet(f"{tmp_path}/{n}")
    trace.paired_spans(read("starts"), read("ends")).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert [(r.span_id, r.micros) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("a", 2_000_000)]
