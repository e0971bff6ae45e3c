"""Numeric comparison of recorded outputs with expected ones, as column expressions.

A tensor is an array of doubles, of decimals or longs (integer types), or of structs
(re, im) of doubles, with its shape beside it. ``compared`` gives one verdict a tensor;
``case_verdict`` folds a case's tensors and ``report_verdict`` a report's cases.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.text import _bound

# Absolute and relative tolerance of each type; integers are exact.
TOLERANCES = {
    "f32": (1e-4, 1e-3),
    "f64": (1e-8, 1e-6),
    "f16": (1e-2, 1e-2),
    "bf16": (2e-2, 2e-2),
    "i32": (0.0, 0.0),
    "i64": (0.0, 0.0),
    "i8": (0.0, 0.0),
    "u8": (0.0, 0.0),
    "u16": (0.0, 0.0),
    "u32": (0.0, 0.0),
    "bool": (0.0, 0.0),
    "c64": (1e-4, 1e-3),
}
INEXACT = ("f32", "f64", "f16", "bf16", "c64")
# Fixed value: how a question states a tolerance.
STATED = r"(?i)\b(atol|rtol)\s*[:=]\s*((?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)"
#: Mismatches that a verdict lists.
LISTED = 8
VERDICT = "struct<status:string,error:string,n_compared:long,n_mismatch:long,max_abs:double,max_rel:double,mismatches:array<struct<index:int,got:string,exp:string,abs:double,rel:double>>>"


def _default(dtype: Column, which: int) -> Column:
    out = F.lit(TOLERANCES["f32"][which])
    for name, pair in TOLERANCES.items():
        out = F.when(dtype == name, F.lit(pair[which])).otherwise(out)
    return out


def tolerance(which: str, dtype: Column, manifest: Column, question: Column) -> Column:
    """atol or rtol of a type: the manifest's value replaces the default, and the least that
    the question states tightens either, for inexact types only."""
    names, values = (F.regexp_extract_all(F.coalesce(question, F.lit("")), F.lit(STATED), F.lit(g)) for g in (1, 2))
    stated = F.filter(F.arrays_zip(names.alias("name"), values.alias("value")), lambda x: F.lower(x["name"]) == which)
    least = F.array_min(F.transform(stated, lambda x: x["value"].cast("double")))
    base = F.coalesce(manifest, _default(dtype, 0 if which == "atol" else 1))
    return F.when(dtype.isin(*INEXACT), F.least(base, least)).otherwise(base)


def _verdict(status: str, error: Column | None = None, **values: Column) -> Column:
    """A full verdict; what isn't given is nothing found."""
    rows = values.pop("mismatches", None)
    given = {"n_compared": F.lit(0), "n_mismatch": F.lit(0), "max_abs": F.lit(0.0), "max_rel": F.lit(0.0)} | values
    none = F.array().cast("array<struct<index:int,got:string,exp:string,abs:double,rel:double>>")
    return F.struct(F.lit(status).alias("status"), (F.lit("") if error is None else error).alias("error"), *[c.alias(k) for k, c in given.items()], (none if rows is None else rows).alias("mismatches")).cast(VERDICT)


def _number(x: Column, part: str) -> dict[str, Column]:
    """Facts of an element; part: '' for a double, or the field of a complex one."""
    v = x[part] if part else x
    return {"value": v, "nan": F.isnan(v), "inf": F.abs(v) == float("inf")}


def _facts(got: Column, expected: Column, cplx: bool, allows_nan: Column) -> Column:
    """Element by element: NaN, Inf, disagreement about Inf, the error and the magnitude."""

    def one(g: Column, e: Column) -> Column:
        parts = ("re", "im") if cplx else ("",)
        pairs = [(_number(g, p), _number(e, p)) for p in parts]
        any_ = lambda side, what: reduce(lambda a, b: a | b, [p[side][what] for p in pairs])
        g_inf, e_inf = any_(0, "inf"), any_(1, "inf")
        same = reduce(lambda a, b: a & b, [F.when(a["nan"] | b["nan"], a["nan"] & b["nan"] & allows_nan).otherwise(a["value"] == b["value"]) for a, b in pairs])
        apart = [F.abs(a["value"] - b["value"]) for a, b in pairs]
        size = [F.abs(b["value"]) for _, b in pairs]
        norm = (lambda xs: F.hypot(xs[0], xs[1])) if cplx else (lambda xs: xs[0])
        return F.struct(any_(0, "nan").alias("gn"), any_(1, "nan").alias("en"), (g_inf | e_inf).alias("inf"), ((g_inf | e_inf) & ~same).alias("odd"), norm(apart).alias("abs"), norm(size).alias("mag"), g.alias("got"), e.alias("exp"))

    return F.zip_with(got, expected, one)


def _text(value: Column, cplx: bool) -> Column:
    """A value as verdicts show it."""
    return F.format_string("(%s, %s)", value["re"].cast("string"), value["im"].cast("string")) if cplx else value.cast("string")


def _ordered(x: Column, mode: Column) -> Column:
    """sorted: as a multiset; set: different values only; else in place. NaN sorts last."""
    return F.when(mode == "sorted", F.array_sort(x)).when(mode == "set", F.array_sort(F.array_distinct(x))).otherwise(x)


def _listed(marked: Column, most: int, cplx: bool) -> Column:
    rows = F.filter(F.transform(marked, lambda x, i: F.struct(i.alias("index"), x["got"].alias("got"), x["exp"].alias("exp"), x["abs"].alias("abs"), x["rel"].alias("rel"), x["bad"].alias("bad"))), lambda x: x["bad"])
    return F.transform(F.slice(rows, 1, most), lambda x: F.struct(x["index"], _text(x["got"], cplx).alias("got"), _text(x["exp"], cplx).alias("exp"), x["abs"], x["rel"]))


def _inexact(got: Column, expected: Column, atol: Column, rtol: Column, allows_nan: Column, cplx: bool) -> Column:
    def usual_of(facts: Column) -> Column:
        return F.transform(facts, lambda x: F.struct(x["got"], x["exp"], x["abs"], (x["abs"] / F.greatest(x["mag"], F.lit(1e-30))).alias("rel"), (~(x["gn"] | x["en"] | x["inf"])).alias("finite"), (x["abs"] > atol + rtol * x["mag"]).alias("over")))

    return _bound(_facts(got, expected, cplx, allows_nan), lambda facts: _bound(usual_of(facts), lambda usual: _judged(facts, usual, F.size(facts), allows_nan, cplx)))


def _judged(facts: Column, usual: Column, n: Column, allows_nan: Column, cplx: bool) -> Column:
    """The verdict on elements' facts and errors."""
    count = lambda f: F.size(F.filter(facts, f))
    odd_at = F.array_position(F.transform(facts, lambda x: x["odd"]), F.lit(True)) - 1
    odd = F.try_element_at(F.filter(facts, lambda x: x["odd"]), F.lit(1))
    nan_apart = lambda x: x["gn"] != x["en"]
    nan_at = F.array_position(F.transform(facts, nan_apart), F.lit(True)) - 1
    marked = F.transform(usual, lambda x: F.struct(x["got"], x["exp"], x["abs"], x["rel"], (x["finite"] & x["over"]).alias("bad")))
    finite = F.filter(usual, lambda x: x["finite"])
    largest = lambda k: F.when(F.size(finite) > 0, F.array_max(F.transform(finite, lambda x: x[k]))).otherwise(F.lit(float("nan")))
    bad = F.size(F.filter(marked, lambda x: x["bad"]))
    measured = {"n_compared": n, "n_mismatch": bad, "max_abs": largest("abs"), "max_rel": largest("rel")}
    one = F.array(F.struct(odd_at.cast("int").alias("index"), _text(odd["got"], cplx).alias("got"), _text(odd["exp"], cplx).alias("exp"), F.lit(None).cast("double").alias("abs"), F.lit(None).cast("double").alias("rel")))
    return (
        F.when(~allows_nan & (count(lambda x: x["gn"] | x["en"]) > 0), _verdict("fail", F.lit("NaN where none is allowed"), n_compared=n, n_mismatch=count(lambda x: x["gn"])))
        .when(odd.isNotNull(), _verdict("fail", F.concat(F.lit("Inf mismatch at "), odd_at.cast("string")), n_compared=n, n_mismatch=count(lambda x: x["odd"]), mismatches=one))
        .when(allows_nan & (count(nan_apart) > 0), _verdict("fail", F.concat(F.lit("NaN mismatch at "), nan_at.cast("string")), n_compared=n, n_mismatch=count(nan_apart)))
        .when(bad > 0, _verdict("fail", F.concat(bad.cast("string"), F.lit(" mismatches")), mismatches=_listed(marked, LISTED, cplx), **measured))
        .otherwise(_verdict("pass", **measured))
    )


def _exact(got: Column, expected: Column) -> Column:
    bad = F.size(F.filter(F.zip_with(got, expected, lambda g, e: g != e), lambda x: x))
    return F.when(bad > 0, _verdict("fail", F.concat(bad.cast("string"), F.lit(" exact integer mismatches")), n_compared=F.size(expected), n_mismatch=bad)).otherwise(_verdict("pass", n_compared=F.size(expected)))


def compared(got: Column, expected: Column, *, atol: Column, rtol: Column, kind: str = "float", mode: Column | None = None, allows_nan: Column | None = None, got_shape: Column | None = None, shape: Column | None = None, got_dtype: Column | None = None, dtype: Column | None = None) -> Column:
    """The verdict of one tensor. kind: float, int or complex. The contract's shape, which a
    got shape must have, and dtype come first; then sizes; an empty tensor passes. Integers
    are exact at any size. NaN fails unless allowed at the same places; Inf must agree in
    sign; else an element is bad beyond atol + rtol * |expected|. Complex values keep their
    places: they have no order."""
    mode = F.lit("elementwise") if mode is None else mode
    allows_nan = F.lit(False) if allows_nan is None else F.coalesce(allows_nan, F.lit(False))
    g, e = (got, expected) if kind == "complex" else (_ordered(got, mode), _ordered(expected, mode))
    core = _exact(g, e) if kind == "int" else _inexact(g, e, atol, rtol, allows_nan, kind == "complex")
    out = F.when(F.size(g) != F.size(e), _verdict("fail", F.format_string("numel mismatch got=%d expected=%d", F.size(g), F.size(e)), n_compared=F.least(F.size(g), F.size(e)))).when(F.size(e) == 0, _verdict("pass")).otherwise(core)
    if dtype is not None and got_dtype is not None:
        decoded = (dtype == "bf16") & (got_dtype == "f32")  # bf16 is held as f32 once it is decoded
        out = F.when((got_dtype != dtype) & ~decoded, _verdict("fail", F.concat_ws("", F.lit("dtype mismatch got="), got_dtype, F.lit(" expected="), dtype), n_mismatch=F.lit(1))).otherwise(out)
    if shape is not None and got_shape is not None:
        text = lambda s: F.array_join(s.cast("array<string>"), "x")
        out = F.when(got_shape != shape, _verdict("fail", F.concat(F.lit("shape mismatch got="), text(got_shape), F.lit(" expected="), text(shape)))).otherwise(out)
    return F.when(expected.isNull(), _verdict("fail", F.lit("missing reference output"))).when(got.isNull(), _verdict("fail", F.lit("missing output"))).otherwise(out)


def half_value(bits: Column) -> Column:
    """The value of a half float stored in the low 16 bits of an integer."""
    exponent, fraction = F.shiftright(bits, 10).bitwiseAND(F.lit(31)), bits.bitwiseAND(F.lit(1023))
    size = F.when(exponent == 0, fraction * 2.0**-24).when(exponent == 31, F.when(fraction == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))).otherwise((1024 + fraction) * F.pow(F.lit(2.0), exponent - 25))
    return F.when(bits.bitwiseAND(F.lit(0x8000)) != 0, -size).otherwise(size)


def with_expected(got: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Outputs and expected values side by side; what either lacks is null there, so that
    ``compared`` names it. Both have one row a key, columns ``got`` and ``expected``."""
    return got.join(expected, keys, "full_outer")


def unmatched_cases(plans: DataFrame, results: DataFrame, key: str = "case") -> DataFrame:
    """Case names that plans and results don't hold exactly once each: (case, planned, reported)."""
    one = plans.groupBy(key).agg(F.count("*").alias("planned"))
    two = results.groupBy(key).agg(F.count("*").alias("reported"))
    both = one.join(two, key, "full_outer").select(key, F.coalesce("planned", F.lit(0)).alias("planned"), F.coalesce("reported", F.lit(0)).alias("reported"))
    return both.where((F.col("planned") != 1) | (F.col("reported") != 1))


def case_verdict(tensors: Column) -> Column:
    """One verdict from a case's array of (ordinal, name, verdict): tensors in order, ending
    at the first that fails, which gives the error."""
    ordered = F.array_sort(F.transform(tensors, lambda t: F.struct(t["ordinal"].alias("ordinal"), t["name"].alias("name"), t["verdict"].alias("verdict"))), lambda a, b: F.signum(a["ordinal"] - b["ordinal"]).cast("int"))
    fails = F.filter(ordered, lambda t: t["verdict"]["status"] == "fail")
    first = F.try_element_at(fails, F.lit(1))
    seen = F.when(first.isNull(), ordered).otherwise(F.filter(ordered, lambda t: t["ordinal"] <= first["ordinal"]))
    total = lambda k: F.aggregate(seen, F.lit(0).cast("long"), lambda a, t: a + t["verdict"][k])
    most = lambda k: F.aggregate(seen, F.lit(0.0), lambda a, t: F.greatest(a, F.nanvl(t["verdict"][k], F.lit(0.0))))
    return F.struct(F.when(first.isNull(), "pass").otherwise("fail").alias("status"), F.when(first.isNull(), "").otherwise(F.concat(first["name"], F.lit(": "), first["verdict"]["error"])).alias("error"), total("n_compared").alias("n_compared"), total("n_mismatch").alias("n_mismatch"), most("max_abs").alias("max_abs"), most("max_rel").alias("max_rel"))


# Marks of a harness's text, with the class that they mean, in order.
HARNESS_MARKS = (
    ("timeout", ("timeout", "timed out")),
    ("signature_mismatch", ("undeclared", "not declared", "no matching function", "too many arguments", "too few arguments")),
    ("crash", ("error:", "cuda error", "segfault", "aborted", "illegal")),
)


def error_class(errors: Column, harness: Column) -> Column:
    """A report's class: what the harness says, else the first telling result. errors: array of
    (error, ok) in case order."""
    text = F.lower(F.coalesce(harness, F.lit("")))
    has = lambda marks: reduce(lambda a, b: a | b, [text.contains(m) for m in marks])
    told = F.transform(errors, lambda r: F.when(F.lower(r["error"]).startswith("reference raised:"), "reference_error").when(F.lower(r["error"]).contains("nan") | F.lower(r["error"]).contains("inf"), "nan_inf").when(~r["ok"], "numeric_mismatch"))
    first = F.try_element_at(F.filter(told, lambda x: x.isNotNull()), F.lit(1))
    (slow, slow_marks), (wrong, wrong_marks), (dead, dead_marks) = HARNESS_MARKS
    return F.when(has(slow_marks), slow).when(has(wrong_marks), wrong).when(has(dead_marks) & text.contains("error:") & text.contains("nvcc"), wrong).when(has(dead_marks), dead).otherwise(F.coalesce(first, F.lit("numeric_mismatch")))


def report_verdict(cases: Column, harness: Column | None = None) -> Column:
    """A report from its array of (ordinal, name, status, error): status, cases run, the first
    failed case and the class; a report without cases is an error."""
    ordered = F.array_sort(cases, lambda a, b: F.signum(a["ordinal"] - b["ordinal"]).cast("int"))
    failed = F.filter(ordered, lambda c: c["status"] != "pass")
    first = F.try_element_at(failed, F.lit(1))
    errors = F.transform(ordered, lambda c: F.struct(c["error"].alias("error"), (c["status"] == "pass").alias("ok")))
    kind = error_class(errors, F.lit("") if harness is None else harness)
    status = F.when(F.size(ordered) == 0, "error").when(first.isNull(), "pass").otherwise("fail")
    return F.struct(status.alias("status"), F.size(ordered).alias("cases_run"), first["name"].alias("failed_case"), F.when(first.isNotNull(), kind).alias("error_class"))


def unsound_reference(out1: Column, again: Column, out2: Column, dtype: Column) -> Column:
    """Why a reference's recorded outputs can't be trusted, or null: two calls on one input
    differ in shape or value, or a vector output does not move by more than two sigma (the
    type's tolerance at its largest value) when the input changes. Arrays of doubles."""
    sigma = _default(dtype, 0) + _default(dtype, 1) * F.greatest(F.array_max(F.transform(F.filter(out1, lambda x: ~F.isnan(x)), F.abs)), F.lit(1.0))
    unlike = F.exists(F.zip_with(out1, again, lambda a, b: ~(F.isnan(a) & F.isnan(b)) & (F.isnan(a) | F.isnan(b) | (F.abs(a - b) > 1e-12 + 1e-12 * F.abs(b)))), lambda x: x)
    apart = F.array_max(F.filter(F.zip_with(out1, out2, lambda a, b: F.abs(a - b)), lambda x: x.isNotNull() & ~F.isnan(x)))
    n = F.least(F.size(out1), F.size(out2))
    return F.when(again.isNull(), "missing on the second call").when(F.size(out1) != F.size(again), "shape changed across calls").when(unlike, "not deterministic").when((n >= 4) & ~(F.coalesce(apart, F.lit(0.0)) > 2 * F.greatest(sigma, F.lit(1e-12))), "does not change with inputs")
