"""Queries over rows' metadata; a part gives what a row, its state and its report hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators.metadata import merged_metadata, without_heavy
from curatrix.plans.base import Tables, query


@query("""WITH x AS (SELECT p_partkey AS part, p_partkey % 2 = 0 AS old, p_partkey % 3 = 0 AS stated, p_partkey % 5 > 1 AS reported, p_size % 3 AS tier, CAST(p_size AS VARCHAR) AS v FROM part)
SELECT part, concat_ws(',', CASE WHEN reported THEN 'case_suite=s' || v END, 'id=' || part, CASE WHEN stated THEN 'provenance=state' || v WHEN old THEN 'provenance=old' WHEN reported THEN 'provenance=report' END, CASE WHEN stated THEN 'task_spec=t' || v END,
  CASE WHEN reported THEN 'verification_tier=' || CASE tier WHEN 0 THEN 'full' ELSE 'none' END WHEN old THEN 'verification_tier=old' END) AS metadata FROM x""")
def metadata_merge(t: Tables) -> DataFrame:
    """Older metadata with what the state replaces and the report adds."""
    key, v = F.col("p_partkey"), F.col("p_size").cast("string")
    text = lambda *pairs: F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("k"), x.alias("v")) for k, x in pairs]))
    own = F.when(key % 2 == 0, text(("id", key.cast("string")), ("provenance", F.lit("old")), ("verification_tier", F.lit("old")))).otherwise(text(("id", key.cast("string"))))
    state = F.when(key % 3 == 0, text(("provenance", F.concat(F.lit("state"), v)), ("task_spec", F.concat(F.lit("t"), v)), ("oracle_spec", F.lit(None).cast("string")), ("unrelated", v)))
    tier = F.when(F.col("p_size") % 3 == 0, "full").when(F.col("p_size") % 3 == 1, "")
    report = F.when(key % 5 > 1, text(("case_suite", F.concat(F.lit("s"), v)), ("provenance", F.lit("report")), ("other", v), ("verification_tier", tier)))
    whole = merged_metadata(own, state, report)
    shown = F.array_join(F.transform(F.array_sort(F.map_entries(whole)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return t.part.select(key.alias("part"), shown.alias("metadata"))


@query("SELECT l_orderkey AS job, count(*) AS n, sum(l_quantity) AS score, string_agg(DISTINCT l_shipmode, ',' ORDER BY l_shipmode) AS modes FROM (SELECT l_orderkey, l_quantity, CASE WHEN l_linenumber % 2 = 0 THEN 'even' ELSE 'odd' END AS l_shipmode FROM lineitem) GROUP BY l_orderkey")
def light_snapshots(t: Tables) -> DataFrame:
    """Candidates of a job without their heavy fields, which no row carries to the sum."""
    snapshot = F.struct(F.col("l_quantity").alias("score"), F.repeat(F.lit("x"), 500).alias("code"), F.lit("s").alias("gen_system"), F.when(F.col("l_linenumber") % 2 == 0, "even").otherwise("odd").alias("mode"))
    rows = t.lineitem.select(F.col("l_orderkey").alias("job"), without_heavy(snapshot).alias("s"))
    return rows.groupBy("job").agg(F.count("*").alias("n"), F.sum("s.score").alias("score"), F.array_join(F.array_sort(F.collect_set("s.mode")), ",").alias("modes"))
