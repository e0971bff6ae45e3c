"""Failure attribution: who owns a failed gate, and its class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _owner(owner: str | None, error_class: Column | str) -> Column:
    return F.struct(F.lit(owner or "").alias("owner"), (error_class if isinstance(error_class, Column) else F.lit(error_class)).alias("error_class"))


def refval_owner(status: str, reason: str, error_class: str, extract_failed: str = "extract failed", before_gpu: str = "timeout before gpu", gpu_lock: str = "gpu lock timeout", prepare: str = "prepare harness") -> Column:
    """(owner, error_class) of a numeric report, by precedence. The reason constants are
    parameters, as recorded by whoever ran the gate."""
    s, r, c = F.col(status), F.coalesce(reason, F.lit("")), F.coalesce(error_class, F.lit(""))
    low = F.lower(r)
    lines = F.filter(F.split(r, "\n"), lambda x: x.rlike(r"(?i)\berror\b"))
    harness_only = (F.size(lines) > 0) & F.forall(lines, lambda x: F.lower(x).contains("harness.cu") & ~F.lower(x).contains("solution.cu"))
    no_cufft = ~r.contains("-lcufft") & r.rlike(r"(?i)undefined reference to\s+[`'\"]?cufft[A-Za-z0-9_]*")
    bad_signature = c == "signature_mismatch"
    missing = F.lit(False)
    for term in ("not installed", "no gpu", "not available"):
        missing = missing | low.contains(term)
    return (
        F.when(s == "pass", _owner(None, ""))
        .when((s == "skip") & missing, _owner("INFRA", "toolchain_missing"))
        .when(s == "skip", _owner(None, ""))
        .when(r == extract_failed, _owner("ORACLE", "extract_failed"))
        .when(c == "invalid_oracle", _owner("ORACLE", c))
        .when((s == "reference_error") | (c == "reference_error"), _owner("ORACLE", "reference_error"))
        .when(r == before_gpu, _owner("INFRA", "extract_timeout"))
        .when((r == gpu_lock) | (c == "gpu_slot_timeout"), _owner("INFRA", "gpu_slot_timeout"))
        .when((c == "crash") & r.startswith(prepare), _owner("INFRA", "harness_prep_error"))
        .when(bad_signature & (harness_only | no_cufft | r.startswith("nvcc timed out")), _owner("INFRA", "harness_build_error"))
        .when(bad_signature & (r.startswith("failed to launch nvcc") | r.startswith("FileNotFoundError")), _owner("INFRA", "toolchain_missing"))
        .when(s == "fail", _owner("KERNEL", F.when(c != "", c).otherwise("numeric_mismatch")))
        .otherwise(_owner(None, ""))
    )


def compile_owner(ok: str, error_text: str, output: str) -> Column:
    """The owner of a compile result: launch failures are infrastructure."""
    details = F.lower(F.coalesce(F.when(F.col(error_text) != "", F.col(error_text)), F.col(output), F.lit("")))
    silent = F.trim(F.coalesce(output, F.lit(""))) == ""
    infra = details.contains("failed to launch nvcc") | details.contains("filenotfounderror") | (silent & (details.contains("timeout") | details.contains("timed out")))
    return F.when(F.col(ok), "").when(infra, "INFRA").otherwise("KERNEL")
