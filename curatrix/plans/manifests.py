"""Queries over manifests that replies and questions bring; a part gives the reply's form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators.manifests import manifest_issues, read_manifest, resolved_manifests
from curatrix.plans.base import Tables, query

_PARAMS = '[{"name": "a", "kind": "src", "dtype": "float32", "shape_from": ["n"]}, {"name": "c", "kind": "dst", "dtype": "double", "rank": 2, "shape_from": ["n"]}, {"name": "n", "kind": "length", "dtype": "int"}, 5]'
_SOURCE = '"reference_source": "def reference(a, n):\\n    return a"'
#: Replies, the issues of each, and the interface that is read; @ is the part's number.
REPLIES = (
    ('```json\n{"abi": {"entry": "launch_@", "params": %s}, %s}\n```' % (_PARAMS, _SOURCE), "", "launch_@ void a:input:f32:1 c:output:f64:2 n:size:i32:0"),
    ('<think>{"abi": 1}</think>{"entry": "f_@", "returns": "float", "params": %s, "reference": "x"}' % _PARAMS, "", "f_@ f32 a:input:f32:1 c:output:f64:2 n:size:i32:0"),
    ('Here it is: {"abi": {"host": "h_@", "params": []}, "reference_source": " "} and no more', "no parameters; no output; empty reference_source", "h_@ void "),
    ('{"abi": {"entry": "not a name", "params": [{"name": "y", "kind": "out", "shape_from": ["m"]}]}, %s}' % _SOURCE, "entry; y from m", "not a name void y:output:f32:1"),
    ('{"abi": {"entry": "g_@", "params": [{"name": "y", "kind": "out"}, {"name": "y", "kind": "inout", "rank": -1}]}, %s}' % _SOURCE, "duplicate names", "g_@ void y:output:f32:1 y:inout:f32:0"),
    ('{"abi": {"params": [{"kind": "tensor", "dtype": "cufft_handle"}], "returns": "cublas_handle"}, %s}' % _SOURCE, "arg must be scalar; handle returned; no plan input", "launch cublas_handle arg:input:cufft_handle:1"),
    ("I can't  do\nthat for @", "response is not a JSON object: I can't do that for @", None),
    (" \n", "empty extractor response", None),
    ("['abi', @", "response is not a JSON object: ['abi', @", None),
)


def _sql(values: list) -> str:
    quoted = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return f"replace([{', '.join(map(quoted, values))}][p_partkey % {len(values)} + 1], '@', CAST(p_partkey AS VARCHAR))"


@query(f"SELECT p_partkey AS part, {_sql([w for _, w, _ in REPLIES])} AS issues, {_sql([a for *_, a in REPLIES])} AS abi FROM part")
def manifest_replies(t: Tables) -> DataFrame:
    """Why an extractor's reply is no manifest, and the interface that was read from it."""
    reply = F.element_at(F.array(*[F.lit(r) for r, *_ in REPLIES]), (F.col("p_partkey") % len(REPLIES) + 1).cast("int"))
    rows = t.part.select(F.col("p_partkey").alias("part"), read_manifest(F.regexp_replace(reply, F.lit("@"), F.col("p_partkey").cast("string"))).alias("m"))
    params = F.array_join(F.transform("m.abi.params", lambda p: F.concat_ws(":", p["name"], p["kind"], p["dtype"], p["rank"].cast("string"))), " ")
    return rows.select("part", F.array_join(manifest_issues(F.col("m")), "; ").alias("issues"), F.concat("m.abi.entry", F.lit(" "), "m.abi.returns", F.lit(" "), params).alias("abi"))


@query("""SELECT p_partkey AS question_id, CASE p_size % 6 WHEN 0 THEN 'none' WHEN 1 THEN 'no entry for cuda' WHEN 2 THEN 'identifies another question or dialect' WHEN 3 THEN 'misfit' WHEN 4 THEN 'misfit' ELSE 'resolved' END AS status,
  CASE p_size % 6 WHEN 3 THEN 'parameter ''c'' type mismatch: source=f64 abi=f32' WHEN 4 THEN 'entry ''run_' || p_partkey || ''' not found in source' ELSE '' END AS issues FROM part""")
def manifest_fits(t: Tables) -> DataFrame:
    """Whether the manifest that a question brings fits the kernel's code."""
    key, form = F.col("p_partkey").cast("string"), F.col("p_size") % 6
    entry = lambda dialect, number: F.concat(F.lit(f'{{"oracle_manifests": {{"{dialect}": {{"question_id": '), number, F.lit(', "dialect": "cuda", "reference_source": "def f", "abi": {"entry": "run_'), key, F.lit('", "params": [{"name": "c", "kind": "output", "dtype": "f32", "shape_from": ["n"]}, {"name": "n", "kind": "size", "dtype": "int"}]}}}}'))
    metadata = F.when(form == 0, '{"a": 1}').when(form == 1, entry("triton", key)).when(form == 2, entry("cuda", F.lit("-1"))).otherwise(entry("cuda", key))
    code = F.concat(F.lit("void "), F.when(form == 4, "other").otherwise(F.concat(F.lit("run_"), key)), F.when(form == 3, "(double* c, int n) {}\n").otherwise("(float* c, int n) {}\n"))
    rows = t.part.select(F.col("p_partkey").alias("question_id"), F.lit("cuda").alias("dialect"), metadata.alias("metadata"), code.alias("code"))
    return resolved_manifests(rows).select("question_id", "status", F.array_join("issues", "; ").alias("issues"))
