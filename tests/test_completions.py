"""Completions recorded once, found again, and refused where they clash."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from curatrix.operators.completions import Conflict, identified, record, replayed

SCHEMA = "role string, candidate int, repair int, purpose string, system string, messages array<struct<role:string,content:string>>, text string, reasoning string"


def row(n, text="t", role="critic", candidate=1):
    return (role, candidate, 0, "", "s", [("user", f"q{n}"), ("assistant", "é \"x\"\n")], text, None)


def test_keys_equal_those_of_plain_json(spark):
    got = identified(spark.createDataFrame([row(1), (None, None, None, None, None, [], "t", None)], SCHEMA)).select("key_hash", "request_hash").collect()
    messages = [{"role": "user", "content": "q1"}, {"role": "assistant", "content": "é \"x\"\n"}]
    for r, (system, sent, identity) in zip(got, [("s", messages, {"role": "critic", "candidate": 1, "repair": 0, "purpose": ""}), ("", [], {"role": "generator", "candidate": 0, "repair": 0, "purpose": ""})], strict=True):
        dump = lambda x: json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        h = hashlib.sha256((system + dump(sent)).encode()).hexdigest()
        assert r.request_hash == h and r.key_hash == hashlib.sha256(dump({**identity, "request_hash": h}).encode()).hexdigest()


def test_recorded_once_and_found_again(spark, tmp_path):
    root = str(tmp_path)
    frame = lambda *rows: spark.createDataFrame(rows, SCHEMA)
    for _ in range(2):
        table = record(frame(row(1), row(1), row(2, "u")), root)
    assert table.count() == 2
    with pytest.raises(Conflict):
        record(frame(row(3), row(1, "other")), root)
    assert record(frame(row(4, role="judge", candidate=2)), root).count() == 3  # nothing of the refused rows stayed
    asked = frame(row(1, None), row(9, None)).drop("text", "reasoning")
    got = {r.messages[0].content: r for r in replayed(asked, spark.read.parquet(f"{root}/completions")).collect()}
    assert got["q1"].recorded and got["q1"].text == "t" and got["q1"].miss is None
    assert not got["q9"].recorded and got["q9"].miss == "no recorded response for critic/1/0/; closest: critic/1/0/; judge/2/0/"


def test_nothing_recorded(spark):
    asked = spark.createDataFrame([row(1)], SCHEMA)
    none = identified(asked).where("false")
    got = replayed(asked.drop("text", "reasoning"), none.select("key_hash", "role", "candidate", "repair", "purpose", F.lit("").alias("text"), F.lit("").alias("reasoning"))).first()
    assert not got.recorded and got.miss.endswith("closest: ")
