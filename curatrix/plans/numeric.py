"""Numeric comparison, reports and validation cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators import cases as C
from curatrix.operators import numeric as N
from curatrix.plans.adapters import QUESTIONS_SQL, TENSORS_SQL, questions, tensors
from curatrix.plans.base import Tables, query

ATOL, RTOL = N.TOLERANCES["f32"]
# A tensor's verdict from its elements, whatever pairs them.
VERDICT_SQL = f"""facts AS (
  SELECT case_id, any_value(job) AS job, any_value(missing) AS missing, any_value(allows_nan) AS allows_nan, count(*) AS n,
    count(*) FILTER (isnan(got)) AS gn, count(*) FILTER (isnan(got) OR isnan(expected)) AS any_nan,
    count(*) FILTER ((isinf(got) OR isinf(expected)) AND got <> expected) AS odd,
    count(*) FILTER (isnan(got) <> isnan(expected)) AS nan_apart,
    count(*) FILTER (isfinite(got) AND isfinite(expected) AND abs(got - expected) > {ATOL}::DOUBLE + {RTOL}::DOUBLE * abs(expected)) AS bad,
    max(abs(got - expected)) FILTER (isfinite(got) AND isfinite(expected)) AS worst
  FROM pairs GROUP BY case_id),
verdicts AS (
  SELECT case_id, job,
    CASE WHEN missing THEN 'missing output' WHEN NOT allows_nan AND any_nan > 0 THEN 'NaN where none is allowed' WHEN odd > 0 THEN 'Inf' WHEN nan_apart > 0 THEN 'NaN' WHEN bad > 0 THEN bad || ' mismatches' ELSE '' END AS error,
    CASE WHEN missing THEN 0 ELSE n END AS n_compared,
    CASE WHEN missing THEN 0 WHEN NOT allows_nan AND any_nan > 0 THEN gn WHEN odd > 0 THEN odd WHEN nan_apart > 0 THEN nan_apart ELSE bad END AS n_mismatch,
    CASE WHEN missing OR (NOT allows_nan AND any_nan > 0) OR odd > 0 OR nan_apart > 0 THEN 0 ELSE worst END AS max_abs
  FROM facts)"""
SELECT_SQL = "SELECT case_id, CASE WHEN error = '' THEN 'pass' ELSE 'fail' END AS status, error, n_compared, n_mismatch, round(max_abs, 6) AS max_abs FROM verdicts"
PLACED_SQL = f"WITH {TENSORS_SQL}, pairs AS (SELECT * FROM elements), {VERDICT_SQL}"
SORTED_SQL = f"""WITH {TENSORS_SQL},
g AS (SELECT case_id, job, missing, allows_nan, got, row_number() OVER (PARTITION BY case_id ORDER BY got) AS rn FROM elements),
x AS (SELECT case_id, expected, row_number() OVER (PARTITION BY case_id ORDER BY expected) AS rn FROM elements),
pairs AS (SELECT g.*, x.expected FROM g JOIN x USING (case_id, rn)), {VERDICT_SQL}"""


def _verdicts(t: Tables, mode: str) -> DataFrame:
    v = N.compared(F.col("got"), F.col("expected"), atol=F.lit(ATOL), rtol=F.lit(RTOL), mode=F.lit(mode), allows_nan=F.col("allows_nan"))
    return tensors(t).select("case_id", "job", v.alias("v"))


def _shown(df: DataFrame) -> DataFrame:
    """Errors without the places that sorting moves."""
    error = F.regexp_replace("v.error", r"^(Inf|NaN) mismatch at .*", "$1")
    return df.select("case_id", "v.status", error.alias("error"), "v.n_compared", "v.n_mismatch", F.round("v.max_abs", 6).alias("max_abs"))


@query(f"{PLACED_SQL} {SELECT_SQL}")
def tensor_compare(t: Tables) -> DataFrame:
    """Each output against its expected values."""
    return _shown(_verdicts(t, "elementwise"))


@query(f"{SORTED_SQL} {SELECT_SQL}")
def tensor_compare_sorted(t: Tables) -> DataFrame:
    """Multiset comparison: both sides sorted."""
    return _shown(_verdicts(t, "sorted"))


@query(
    f"""WITH {TENSORS_SQL}, sets AS (SELECT case_id, any_value(missing) AS missing, list_sort(list(DISTINCT round(got, 1))) AS g, list_sort(list(DISTINCT round(expected, 1))) AS e FROM elements WHERE isfinite(got) AND isfinite(expected) GROUP BY case_id)
SELECT case_id, CASE WHEN missing THEN 'missing output' WHEN len(g) <> len(e) THEN 'numel mismatch got=' || len(g) || ' expected=' || len(e) WHEN g = e THEN '' ELSE len(list_filter(list_zip(g, e), lambda p: p[1] <> p[2])) || ' mismatches' END AS error FROM sets"""
)
def tensor_compare_set(t: Tables) -> DataFrame:
    """Set comparison: different values of both sides, here to one decimal."""
    both = F.filter(F.zip_with(F.coalesce("got", "expected"), "expected", lambda g, e: F.struct(F.round(g, 1).alias("g"), F.round(e, 1).alias("e"))), lambda p: (F.abs(p["g"]) < float("inf")) & (F.abs(p["e"]) < float("inf")))
    g, e = F.transform(both, lambda p: p["g"]), F.transform(both, lambda p: p["e"])
    v = N.compared(F.when(F.col("got").isNotNull(), g), e, atol=F.lit(1e-9), rtol=F.lit(0.0), mode=F.lit("set"))
    return tensors(t).select("case_id", v["error"].alias("error"))


@query(
    """SELECT l_orderkey AS job, count(*) AS n_compared, count(*) FILTER (l_partkey % 50 = 0) AS n_mismatch, CASE WHEN count(*) FILTER (l_partkey % 50 = 0) = 0 THEN '' ELSE count(*) FILTER (l_partkey % 50 = 0) || ' exact integer mismatches' END AS error FROM lineitem GROUP BY l_orderkey"""
)
def integer_compare(t: Tables) -> DataFrame:
    """Integers beyond 2^53 that differ by one."""
    big = F.col("l_partkey").cast("long") + F.lit(1 << 60)
    rows = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", big.alias("e"), (big + (F.col("l_partkey") % 50 == 0).cast("long")).alias("g")))).alias("x"))
    v = N.compared(F.col("x.g"), F.col("x.e"), atol=F.lit(0.0), rtol=F.lit(0.0), kind="int")
    return rows.select(F.col("l_orderkey").alias("job"), v["n_compared"].alias("n_compared"), v["n_mismatch"].alias("n_mismatch"), v["error"].alias("error"))


@query(
    f"""{PLACED_SQL}, k AS (SELECT *, CASE WHEN error = 'missing output' THEN 'numeric_mismatch' WHEN error LIKE 'NaN%' OR error LIKE 'Inf%' THEN 'nan_inf' ELSE 'numeric_mismatch' END AS kind FROM verdicts)
SELECT job, count(*) AS cases_run, CASE WHEN count(*) FILTER (error <> '') = 0 THEN 'pass' ELSE 'fail' END AS status, 'case_' || min(case_id) FILTER (error <> '') AS failed_case, arg_min(kind, case_id) FILTER (error <> '') AS error_class
FROM k GROUP BY job UNION ALL SELECT job + 1000, 1, CASE WHEN error = '' THEN 'pass' ELSE 'fail' END, CASE WHEN error <> '' THEN 'case_' || case_id END, CASE WHEN error <> '' THEN kind END FROM k WHERE case_id % 97 = 0"""
)
def case_fold(t: Tables) -> DataFrame:
    """Tensor results folded to cases and these to a report for each job, and reports of one
    case each. The least failing case and the class come out of pre-aggregated minima."""
    rows = _verdicts(t, "elementwise").select("job", "case_id", N.case_verdict(F.array(F.struct(F.lit(0).alias("ordinal"), F.lit("y").alias("name"), F.col("v").alias("verdict")))).alias("c"))
    bad = F.col("c.status") == "fail"
    kind = N.error_class(F.array(F.struct(F.col("c.error").alias("error"), (~bad).alias("ok"))), F.lit(""))
    by_job = rows.groupBy("job").agg(F.count("*").cast("int").alias("cases_run"), F.min(F.when(bad, F.struct(F.col("case_id"), kind.alias("kind")))).alias("first"))
    folded = by_job.select("job", "cases_run", F.when(F.col("first").isNull(), "pass").otherwise("fail").alias("status"), F.concat(F.lit("case_"), F.col("first.case_id")).alias("failed_case"), F.col("first.kind").alias("error_class"))
    single = rows.where("case_id % 97 = 0").select((F.col("job") + 1000).alias("job"), N.report_verdict(F.array(F.struct(F.col("case_id").alias("ordinal"), F.concat(F.lit("case_"), F.col("case_id")).alias("name"), F.col("c.status").alias("status"), F.col("c.error").alias("error")))).alias("r"))
    return folded.unionByName(single.select("job", "r.cases_run", "r.status", "r.failed_case", "r.error_class"))


STATES = ("atol=1e-6", "rtol: 0.01", "ATOL = 5e-3 and atol=2e-5", "no tolerance", "rtol=1e-9, atol: 3", "xatol=1")
DTYPES = ("f32", "f64", "f16", "i32")


@query(
    f"""WITH {QUESTIONS_SQL}, d AS (SELECT question_id, [{', '.join(repr(x) for x in DTYPES)}][CAST(question_id % 4 AS INT) + 1] AS dtype, CAST(question_id % {len(STATES)} AS INT) AS k, CASE WHEN question_id % 7 = 0 THEN 1e-5::DOUBLE END AS given FROM questions),
b AS (SELECT *, coalesce(given, CASE dtype WHEN 'f32' THEN 1e-4::DOUBLE WHEN 'f64' THEN 1e-8::DOUBLE WHEN 'f16' THEN 1e-2::DOUBLE ELSE 0 END) AS a0, CASE dtype WHEN 'f32' THEN 1e-3::DOUBLE WHEN 'f64' THEN 1e-6::DOUBLE WHEN 'f16' THEN 1e-2::DOUBLE ELSE 0 END AS r0 FROM d)
SELECT question_id, dtype, CASE WHEN dtype = 'i32' THEN a0 ELSE least(a0, [1e-6, NULL, 2e-5, NULL, 3, NULL][k + 1]::DOUBLE) END AS atol, CASE WHEN dtype = 'i32' THEN r0 ELSE least(r0, [NULL, 0.01, NULL, NULL, 1e-9, NULL][k + 1]::DOUBLE) END AS rtol FROM b"""
)
def tolerance_merge(t: Tables) -> DataFrame:
    """Defaults, the manifest's values and the stricter ones that a question states."""
    at = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (F.col("question_id") % len(xs)).cast("int") + 1)
    asked = F.concat_ws(" ", "question", at(STATES))
    given = F.when(F.col("question_id") % 7 == 0, F.lit(1e-5))
    rows = questions(t).select("question_id", at(DTYPES).alias("dtype"), asked.alias("q"), given.alias("given"))
    return rows.select("question_id", "dtype", N.tolerance("atol", F.col("dtype"), F.col("given"), F.col("q")).alias("atol"), N.tolerance("rtol", F.col("dtype"), F.lit(None).cast("double"), F.col("q")).alias("rtol"))


@query(
    """WITH b AS (SELECT p_partkey, CAST((p_partkey * 977) % 65536 AS INT) AS bits FROM part), f AS (SELECT *, (bits >> 10) & 31 AS e, bits & 1023 AS m, CASE WHEN bits >= 32768 THEN -1.0 ELSE 1.0 END::DOUBLE AS s FROM b)
SELECT p_partkey AS part, CASE WHEN e = 31 AND m <> 0 THEN 'NaN' WHEN e = 31 THEN CASE WHEN s < 0 THEN '-Inf' ELSE 'Inf' END ELSE 'number' END AS kind, CASE WHEN e < 31 THEN s * CASE WHEN e = 0 THEN m * pow(2.0, -24) ELSE (1.0 + m / 1024.0) * pow(2.0, e - 15) END END AS value FROM f"""
)
def half_bits(t: Tables) -> DataFrame:
    """Half floats stored as 16-bit integers."""
    x = N.half_value(((F.col("p_partkey") * 977) % 65536).cast("int"))
    kind = F.when(F.isnan(x), "NaN").when(x == float("inf"), "Inf").when(x == float("-inf"), "-Inf").otherwise("number")
    return t.part.select(F.col("p_partkey").alias("part"), kind.alias("kind"), F.when(kind == "number", x).alias("value"))


@query(
    """WITH p AS (SELECT DISTINCT 'c' || l_partkey % 400 AS "case" FROM lineitem), r AS (SELECT 'c' || l_suppkey * 7 % 450 AS "case" FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 11 = 0)
SELECT "case", CAST(p."case" IS NOT NULL AS INT) AS planned, coalesce(n, 0) AS reported FROM p FULL JOIN (SELECT "case", count(*) AS n FROM r GROUP BY ALL) q USING ("case") WHERE p."case" IS NULL OR n IS NULL OR n <> 1"""
)
def unmatched_cases(t: Tables) -> DataFrame:
    """Planned cases and reported results that are no bijection."""
    plans = t.lineitem.select(F.concat(F.lit("c"), F.col("l_partkey") % 400).alias("case")).distinct()
    results = t.lineitem.where("l_linenumber = 1 and l_orderkey % 11 = 0").select(F.concat(F.lit("c"), F.col("l_suppkey") * 7 % 450).alias("case"))
    return N.unmatched_cases(plans, results)


@query(
    f"""WITH {TENSORS_SQL}, e AS (SELECT case_id, job, i, CASE WHEN isfinite(expected) THEN expected ELSE 0 END AS x FROM elements),
s AS (SELECT case_id, any_value(job) AS job, 1e-4::DOUBLE + 1e-3::DOUBLE * greatest(max(abs(x)), 1.0) AS sigma, max(abs(x - CASE WHEN case_id % 3 = 0 THEN x ELSE x + (case_id % 5) / 100.0::DOUBLE END)) AS apart FROM e GROUP BY case_id)
SELECT case_id, CASE WHEN case_id % 23 = 0 THEN 'missing on the second call' WHEN case_id % 7 = 0 THEN 'not deterministic' WHEN NOT apart > 2 * sigma THEN 'does not change with inputs' END AS reason FROM s"""
)
def reference_soundness(t: Tables) -> DataFrame:
    """Recorded references that can't be trusted."""
    v = F.col("case_id")
    out = F.transform("expected", lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x))
    again = F.when(v % 23 != 0, F.transform(out, lambda x, i: F.when((v % 7 == 0) & (i == 1), x + 1e-6).otherwise(x)))
    moved = F.when(v % 3 == 0, out).otherwise(F.transform(out, lambda x: x + (v % 5) / 100.0))
    return tensors(t).select("case_id", N.unsound_reference(out, again, moved, F.lit("f32")).alias("reason"))


def interfaces(t: Tables) -> DataFrame:
    """Interfaces from parts: one, two or three axes and all flags by part number."""
    k = F.col("p_partkey")
    axes = F.when(k % 3 == 0, F.array(F.lit("n"))).when(k % 3 == 1, F.array(F.lit("n"), F.lit("m"))).otherwise(F.array(F.lit("n"), F.lit("m"), F.lit("kernel_size")))
    param = lambda name, kind, dtype, rank, shape, alias="": F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.lit(dtype).alias("dtype"), rank.cast("int").alias("rank"), shape.alias("shape_from"), F.lit("contiguous").alias("layout"), F.lit(alias).alias("alias_of"))
    none = F.array().cast("array<string>")
    sizes = F.transform(axes, lambda a: F.struct(a.alias("name"), F.lit("size").alias("kind"), F.lit("i32").alias("dtype"), F.lit(0).alias("rank"), none.alias("shape_from"), F.lit("contiguous").alias("layout"), F.lit("").alias("alias_of")))
    params = F.concat(F.array(param("x", "input", "f32", F.size(axes), axes), param("y", "output", "f32", F.size(axes), axes), param("alpha", "scalar", "f32", F.lit(0), none), param("x_stride", "scalar", "i32", F.lit(0), none)), sizes)
    abi = F.struct(F.lit("f32").alias("dtype"), F.lit("contiguous").alias("layout"), (k % 2 == 0).alias("allows_nan"), F.lit(False).alias("in_place"), (k % 5 == 0).alias("supports_strided"), (k % 7 == 0).alias("supports_broadcast"), (k % 4 == 0).alias("supports_inplace"), params.alias("params"))
    return t.part.select(k.alias("question_id"), abi.alias("abi"))


WANTED = " UNION ALL ".join(f"SELECT {i} AS i, '{a}' AS name, '{b}' AS kind, {c} AS c" for i, (a, b, c) in enumerate(C.CASES))


@query(
    f"""WITH c AS ({WANTED}), p AS (SELECT p_partkey AS q, CAST(p_partkey % 3 AS INT) + 1 AS rank FROM part),
w AS (SELECT q, rank, i, name, kind, CASE c WHEN -1 THEN CASE WHEN rank = 1 THEN 1000000 ELSE 2000 END WHEN -2 THEN CASE WHEN rank = 1 THEN 33 ELSE 17 END ELSE c END AS n FROM p, c
  WHERE name NOT IN ('non_pow2_1000', 'odd_511') AND CASE name WHEN 'strided' THEN q % 5 = 0 WHEN 'broadcast' THEN q % 7 = 0 WHEN 'rectangular' THEN q % 7 <> 0 AND rank > 1 WHEN 'inplace' THEN q % 4 = 0 WHEN 'row_major_tail' THEN rank > 1 WHEN 'tail_17' THEN rank > 1 WHEN 'tail_33' THEN rank = 1 ELSE true END),
o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY i) - 1 AS ordinal FROM w),
s AS (SELECT *, CASE WHEN name IN ('broadcast', 'rectangular') THEN greatest(n // 2, 1) ELSE n END AS m, [3, 5, 7][CAST(ordinal % 3 AS INT) + 1] AS k FROM o),
f AS (SELECT *, CASE rank WHEN 1 THEN n::DOUBLE WHEN 2 THEN n::DOUBLE * m ELSE n::DOUBLE * m * k END AS numel FROM s),
z AS (SELECT *, CASE WHEN numel > 4000000 THEN pow(4000000.0::DOUBLE / numel, 1.0::DOUBLE / rank) ELSE 1 END AS scale FROM f)
SELECT q AS question_id, ordinal, name, kind, CASE rank WHEN 1 THEN CAST(floor(n * scale) AS INT) || '' WHEN 2 THEN CAST(floor(n * scale) AS INT) || 'x' || CAST(floor(m * scale) AS INT) ELSE CAST(floor(n * scale) AS INT) || 'x' || CAST(floor(m * scale) AS INT) || 'x' || CAST(floor(k * scale) AS INT) END AS out_shape,
  CASE WHEN kind = 'inplace' THEN 'y=x' ELSE '' END AS alias, kind = 'extreme' AND q % 2 = 0 AS generate_nan FROM z"""
)
def case_plan_matrix(t: Tables) -> DataFrame:
    """The standard suite of each interface."""
    plans = C.case_plans(interfaces(t))
    alias = F.array_join(F.transform(F.map_entries("alias"), lambda x: F.concat_ws("=", x["key"], x["value"])), ",")
    return plans.select("question_id", "ordinal", "name", "kind", F.array_join(F.col("shapes")["y"].cast("array<string>"), "x").alias("out_shape"), alias.alias("alias"), "generate_nan")


@query("SELECT p_partkey AS case_id, CASE WHEN p_size % 6 = 0 THEN 0 ELSE (p_size % 6 - 1) * (p_partkey % 4 + 1) * 3 + (p_partkey % 4) * 3 + 2 + 1 END AS storage_numel, (p_partkey % 4 + 1) * 3 AS outer_stride FROM part")
def stride_numel(t: Tables) -> DataFrame:
    """Elements that a row-major tensor of three dimensions spans, and its outer stride."""
    shape = F.array((F.col("p_size") % 6).cast("int"), (F.col("p_partkey") % 4 + 1).cast("int"), F.lit(3))
    strides = C.row_major(shape, F.lit(1))
    return t.part.select(F.col("p_partkey").alias("case_id"), C.storage_numel(shape, strides).alias("storage_numel"), strides[0].alias("outer_stride"))


@query("")
def materialize_case(t: Tables) -> DataFrame:
    """Bytes of the inputs of each interface's small cases, by their hash. CPython's generator
    has no SQL form; the tests hold it against ``random``."""
    plans = C.case_plans(interfaces(t).where("question_id % 20 = 0"), suite="smoke")
    abi = interfaces(t).select("question_id", "abi")
    tensors_of = F.filter(F.col("abi.params"), lambda p: p["kind"].isin(*C.TENSORS))
    params = F.transform(tensors_of, lambda p: F.struct(p["name"].alias("name"), p["kind"].alias("kind"), p["dtype"].alias("dtype"), F.col("shapes")[p["name"]].alias("shape")))
    made = C.filled(plans.join(abi, "question_id").withColumn("params", params))
    return made.select("question_id", "name", "tensor", F.length("data").alias("n_bytes"), F.sha2("data", 256).alias("sha256"))
