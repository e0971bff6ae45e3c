"""All queries of the engine and their oracle SQL."""

from __future__ import annotations

from curatrix.plans import compiles, completions, data, intake, interfaces, judging, loops, manifests, metadata, numeric, prompts, provenance, quality, reports, rows, rules, runs, selecting, selection, texts, trace  # noqa: F401  (they register their queries)
from curatrix.plans.base import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
