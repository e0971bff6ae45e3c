"""Hand-computed rows for the engine's own operators."""

from pyspark.sql import functions as F

from curatrix.functions import text as X
from curatrix.operators import gates, selection

POOL = "job long, candidate int, repairs int, speedup double, score int, cases_run int, compile string, contract string, oracle_blocked boolean, refval_status string, critic_status string, seq int"


def row(job, candidate, **k):
    d = {"repairs": 0, "speedup": None, "score": None, "cases_run": 3, "compile": "pass", "contract": "pass", "oracle_blocked": False, "refval_status": "pass", "critic_status": None, "seq": 0} | k
    return (job, candidate, *(d[n] for n in "repairs speedup score cases_run compile contract oracle_blocked refval_status critic_status seq".split()))


def test_winner_order(spark):
    rows = [row(1, 1, score=9), row(1, 2, critic_status="verified"), row(2, 1, repairs=1), row(2, 2), row(3, 1), row(3, 2), row(4, 1, oracle_blocked=True), row(5, 1, refval_status="fail"), row(6, 1, speedup=1.0), row(6, 2, speedup=2.0)]
    out = selection.best_per_job(spark.createDataFrame(rows, POOL), ["candidate"], ["seq"])
    assert {r["job"]: r["candidate"] for r in out.collect()} == {1: 2, 2: 2, 3: 1, 6: 2}


def test_versions_newer_wins_ties(spark):
    rows = [row(1, 1, seq=1), row(1, 1, seq=2), row(1, 1, seq=3, repairs=1), row(2, 1, seq=1)]
    out = {r["job"]: (r["version"], r["kept_arrival"]) for r in selection.merge_versions(spark.createDataFrame(rows, POOL), ["seq"]).collect()}
    assert out == {1: (2, 2), 2: (1, 1)}


def test_refval_owner_precedence(spark):
    rows = [
        ("pass", "", "", ""), ("skip", "No GPU here", "", "INFRA"), ("skip", "chosen", "", ""), ("fail", "extract failed", "", "ORACLE"),
        ("fail", "x", "invalid_oracle", "ORACLE"), ("reference_error", "", "", "ORACLE"), ("fail", "harness.cu: error", "signature_mismatch", "INFRA"),
        ("fail", "harness.cu: error\nsolution.cu: error", "signature_mismatch", "KERNEL"), ("fail", "undefined reference to `cufftExec'", "signature_mismatch", "INFRA"), ("fail", None, None, "KERNEL"),
    ]
    df = spark.createDataFrame(rows, "status string, reason string, error_class string, want string")
    bad = df.select("*", gates.refval_owner("status", "reason", "error_class")["owner"].alias("got")).where("got <> want").collect()
    assert bad == []


def test_text_functions(spark):
    df = spark.createDataFrame([("<THINK> a </reasoning>b<think>c</think>", "日本ab", "x\n\n\n\ny ", "done...")], "a string, b string, c string, d string")
    r = df.select(X.strip_thinking(F.col("a")).alias("s"), X.extract_thinking(F.col("a")).alias("t"), X.approx_tokens(F.col("b")).alias("n"), X.collapse_blank_lines(F.col("c")).alias("c"), X.integrity_issues(F.col("d")).alias("i")).first()
    assert (r["s"], r["t"], r["n"], r["c"], r["i"]) == ("b", "a\n\nc", 3, "x\n\ny", ["tail"])


def test_snapshots_lose_their_heavy_fields(spark):
    from pyspark.sql import functions as F

    from curatrix.operators.metadata import merged_metadata, without_heavy

    row = spark.range(1).select(F.struct(F.lit(1).alias("score"), F.lit("x").alias("code"), F.lit("y").alias("gen_user")).alias("s"))
    assert row.select(without_heavy(F.col("s")).alias("s")).first()["s"].asDict() == {"score": 1}
    none = F.lit(None).cast("map<string,string>")
    assert spark.range(1).select(merged_metadata(none, none, none).alias("m")).first()["m"] == {}
    assert spark.range(1).select(merged_metadata(none, none, F.create_map(F.lit("other"), F.lit("v"))).alias("m")).first()["m"] == {"verification_tier": "none"}
