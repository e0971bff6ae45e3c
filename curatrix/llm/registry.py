"""The queries of this subpackage, for ``__spark_entry__``."""

from __future__ import annotations

import importlib

# Query name to the module that holds it.
OPERATORS = {
    "op1_simhash": "simhash",
    "op2_language_model": "language_model",
    "op3_suffix_dedup": "suffix_dedup",
    "op4_best_fit_packing": "packing",
    "op5_mpeg_audio": "mpeg",
    "op6_line_dedup": "lines",
    "op7_toxicity": "toxicity",
    "op8_pii": "pii",
    "op9_quality": "quality",
    "op10_decontamination": "decontaminate",
    "op11_importance_resampling": "resampling",
    "op12_periodic_runs": "periodic",
    "op13_nearest_neighbours": "neighbours",
}


def queries() -> dict:
    return {name: getattr(importlib.import_module(f"curatrix.llm.{module}"), name) for name, module in OPERATORS.items()}


def oracle_sql() -> dict[str, str]:
    from curatrix.llm import decontaminate

    return {"op10_decontamination": decontaminate.ORACLE}
