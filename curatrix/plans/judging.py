"""Queries over judges and references: a part gives the pieces that a source is put together
from, and the oracles judge by the pieces, without reading the source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.functions import text as X
from curatrix.operators.judges import forbidden, judged
from curatrix.plans.adapters import QUESTIONS_SQL, questions
from curatrix.plans.base import Tables, query

PIECES = {
    "cuda": ("#include <cuda_runtime.h>\n", "__global__ void k(float* a)\n", "const auto p = threadIdx.x;\n", "if (p < n) a[p] = 1;\n", "__shared__ float s[32];\n"),
    "triton": ("@triton.jit\n", "pid = tl.program_id(0)\n", "mask = pid < 9\n", "__global__ void k()\n", "pass\n"),
    "cutlass": ("cute::Tensor t;\n", "cp.async.bulk\n", "cutlass::gemm::device::Gemm g;\n", "__global__ void k()\n", "// as on Hopper\n"),
    "tilelang": ("@T.prim_func\n", "with T.Kernel(1) as b:\n", "T.tma_copy(a)\n", "pass\n", "# SM90\n"),
}
#: What each judge says: (condition on the pieces b0 to b4, i or s, text, points).
SAID = {
    "cuda": (
        ("b1 AND NOT b2", "i", "kernel is missing threadIdx/blockIdx mapping", 2), ("b1 AND NOT b3", "i", "no obvious bounds check on thread indices", 2),
        ("NOT b1", "i", "no __global__ kernel in the translation unit", 2), ("NOT b0", "i", "missing #include (expected at least cuda_runtime.h)", 1), ("b4", "i", "shared memory used without __syncthreads()", 1),
    ),
    "triton": (("NOT b0", "i", "missing @triton.jit kernel", 3), ("NOT b1", "i", "no tl.program_id mapping", 2), ("NOT b2", "s", "add load/store masks for OOB threads", 1), ("b3", "i", "CUDA C++ leaked into a Triton sample", 2)),
    "cutlass": (
        ("NOT b0 AND NOT b2", "i", "no CuTe/CUTLASS 4 APIs detected", 2), ("b1", "i", "Hopper/SM90 API used; target is sm_86", 3), ("b2", "s", "prefer CUTLASS 4 CuTe style over 2.x device::Gemm", 1),
        ("NOT b3", "i", "no __global__ kernel", 2), ("b4", "s", "comments mention Hopper; keep Ampere-only", 0),
    ),
    "tilelang": (("NOT b0", "i", "missing T.prim_func", 3), ("NOT b1", "i", "missing T.Kernel", 2), ("b2 OR b4", "s", "avoid TMA/SM90-only TileLang paths on sm_86", 1)),
}


def _judge_sql(dialect: str) -> str:
    list_of = lambda kind: "array_to_string([x FOR x IN [" + ", ".join(f"CASE WHEN {c} THEN '{m}' END" for c, k, m, _ in SAID[dialect] if k == kind) + "] IF x IS NOT NULL], '; ')"
    suggestions = list_of("s") if any(k == "s" for _, k, _, _ in SAID[dialect]) else "''"
    points = " - ".join(f"CASE WHEN {c} THEN {n} ELSE 0 END" for c, _, _, n in SAID[dialect])
    return f"SELECT part, '{dialect}' AS dialect, greatest(1, 10 - {points}) AS score, {list_of('i')} AS issues, {suggestions} AS suggestions FROM b"


_BITS = ", ".join(f"(p_partkey // {1 << i}) % 2 = 1 AS b{i}" for i in range(5))


@query(f"WITH b AS (SELECT p_partkey AS part, {_BITS} FROM part) " + " UNION ALL ".join(map(_judge_sql, PIECES)))
def dialect_judges(t: Tables) -> DataFrame:
    """Score, issues and suggestions of a source in each dialect, by the dialect's judge."""
    bit = lambda i: F.floor(F.col("p_partkey") / (1 << i)) % 2 == 1
    sources = [F.struct(F.lit(d).alias("dialect"), F.concat(*[F.when(bit(i), p).otherwise("") for i, p in enumerate(pieces)]).alias("code")) for d, pieces in PIECES.items()]
    rows = t.part.select(F.col("p_partkey").alias("part"), F.explode(F.array(*sources)).alias("x"))
    out = rows.select("part", "x.dialect", judged(F.col("x.code"), F.col("x.dialect")).alias("j"))
    return out.select("part", "dialect", "j.score", F.array_join("j.issues", "; ").alias("issues"), F.array_join("j.suggestions", "; ").alias("suggestions"))


#: References, and why they may not be used; N stands for the part's number.
REFERENCES = (
    ("import numpy as np\n\ndef reference(a):\n    return {'c': a + N}\n", None),
    ("```python\ndef reference(input, n=N):\n    return input\n```", None),
    ("```python\n```", "empty reference source"),
    ("import math\nprint(os.getcwd(), N)\n", "reference uses a forbidden module attribute"),
    ("import os, math\n", "reference imports forbidden module 'os'"),
    ("from pickle import loads\nx = N\n", "reference imports forbidden module 'pickle'"),
    ("import pandas as pd\n", "reference imports 'pandas' (only math/numpy/torch allowed)"),
    ("def reference(a):\n    return eval('a + N')\n", "reference uses forbidden name 'eval'"),
    ("def reference(a):\n    return a.system(N)\n", "reference uses forbidden attribute 'system'"),
    ("def reference(a):\n    import torch.nn\n    return open\n", None),
    ("def reference(a):\n    b = [open(N)]\nfrom socket import *\n", "reference imports forbidden module 'socket'"),
    ("", "empty reference source"),
)


@query(f"SELECT p_partkey AS part, [{', '.join('NULL' if w is None else chr(39) + w.replace(chr(39), chr(39) * 2) + chr(39) for _, w in REFERENCES)}][p_partkey % {len(REFERENCES)} + 1] AS why FROM part")
def reference_safety(t: Tables) -> DataFrame:
    """Why a reference may not be used; null where it may. What stands further out counts first."""
    source = F.element_at(F.array(*[F.lit(s) for s, _ in REFERENCES]), (F.col("p_partkey") % len(REFERENCES) + 1).cast("int"))
    return t.part.select(F.col("p_partkey").alias("part"), forbidden(F.regexp_replace(source, F.lit(r"\bN\b"), F.col("p_partkey").cast("string"))).alias("why"))


@query(f"WITH {QUESTIONS_SQL} SELECT question_id, CASE WHEN regexp_matches(question, '{X.HARD}', 'i') THEN 'hard' WHEN regexp_matches(question, '{X.SIMPLE}', 'i') THEN 'simple' ELSE 'medium' END AS difficulty FROM questions")
def kernel_difficulties(t: Tables) -> DataFrame:
    """How hard each question's kernel is, by the words of the whole question."""
    return questions(t).select("question_id", X.kernel_difficulty(F.col("question")).alias("difficulty"))
