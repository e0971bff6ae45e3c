"""Metadata of a row: what a candidate leaves in it, and fields merged without overwriting older ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields too large for metadata, and those that a state and a validation report give.
HEAVY = ("code", "gen_system", "gen_user", "first_turn_reasoning", "final_turn_reasoning")
OF_STATE = ("task_spec", "oracle_spec", "quality_status", "provenance", "candidate_reports")
OF_REPORT = ("cache_hash", "manifest_hash", "validator_version", "harness_version", "schema_version", "case_suite", "case_suite_version", "provenance", "task_spec", "oracle_spec", "oracle_origin")
TIER = "verification_tier"


def without_heavy(snapshot: Column) -> Column:
    """A candidate's struct without its sources, prompts and reasoning, as far as it has them."""
    return snapshot.dropFields(*HEAVY)


def _none() -> Column:
    return F.create_map().cast("map<string,string>")


def merged_metadata(metadata: Column, state: Column, report: Column) -> Column:
    """Maps of texts: what the state has of its fields replaces older values; the report's fields
    are added where there is no value; a row with a report gets its tier, or none."""
    own, of_state = F.coalesce(metadata, _none()), F.map_filter(F.coalesce(state, _none()), lambda k, v: k.isin(*OF_STATE) & v.isNotNull())
    kept = F.map_filter(own, lambda k, _: ~F.map_contains_key(of_state, k))
    known = F.array_union(F.map_keys(own), F.map_keys(of_state))
    added = F.map_filter(F.coalesce(report, _none()), lambda k, _: k.isin(*OF_REPORT) & ~F.array_contains(known, k))
    whole = F.map_concat(kept, of_state, added)
    tier = F.coalesce(F.nullif(F.try_element_at(report, F.lit(TIER)), F.lit("")), F.lit("none"))
    return F.when(report.isNull(), whole).otherwise(F.map_concat(F.map_filter(whole, lambda k, _: k != TIER), F.create_map(F.lit(TIER), tier)))
