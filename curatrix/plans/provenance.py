"""Queries over digests of tables and of groups of their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators.provenance import LANES, changed_groups, digests
from curatrix.plans.base import Tables, query

_FIELD = lambda c: f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


def _digest_sql(source: str, columns: list[str], by: str) -> str:
    """SELECT of (by, n_rows, digest) from a table or subquery."""
    names = sorted(columns)
    row = " || ".join(map(_FIELD, names))
    lanes = ", ".join(f"CAST(coalesce(sum(CAST('0x' || h[{8 * i + 1}:{8 * i + 8}] AS BIGINT)), 0) AS VARCHAR) AS s{i}" for i in range(LANES))
    return f"SELECT {by}, n_rows, sha256(concat_ws('|', '{','.join(names)}', CAST(n_rows AS VARCHAR), {', '.join(f's{i}' for i in range(LANES))})) AS digest FROM (SELECT {by}, count(*) AS n_rows, {lanes} FROM (SELECT {by}, sha256({row}) AS h FROM {source}) GROUP BY {by})"


LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"]


@query(_digest_sql("lineitem", LINE, "l_returnflag"))
def line_digests(t: Tables) -> DataFrame:
    """The digest of each flag's order lines."""
    return digests(t.lineitem, LINE, ["l_returnflag"])


@query(_digest_sql("documents", ["doc_id", "text", "source"], "lang"))
def corpus_digests(t: Tables) -> DataFrame:
    """The digest of each language's whole texts."""
    return digests(t.documents, ["doc_id", "text", "source"], ["lang"])


_NOW, _THEN = "(SELECT *, l_suppkey % 10 AS g FROM lineitem WHERE l_suppkey % 10 <> 3)", "(SELECT *, l_suppkey % 10 AS g FROM lineitem WHERE l_suppkey % 10 <> 4 AND NOT (l_suppkey % 10 IN (5, 6) AND l_quantity > 49))"


@query(f"SELECT coalesce(a.g, b.g) AS g, CASE WHEN b.digest IS NULL THEN 'added' WHEN a.digest IS NULL THEN 'removed' ELSE 'changed' END AS state FROM ({_digest_sql(_NOW, LINE, 'g')}) a FULL JOIN ({_digest_sql(_THEN, LINE, 'g')}) b ON a.g = b.g WHERE a.digest IS DISTINCT FROM b.digest")
def digest_changes(t: Tables) -> DataFrame:
    """Groups of order lines that an earlier state lacked, or held otherwise, or held alone."""
    lines = t.lineitem.withColumn("g", F.col("l_suppkey") % 10)
    then = lines.where("g <> 4 and not (g in (5, 6) and l_quantity > 49)")
    return changed_groups(lines.where("g <> 3"), then, ["g"], LINE)
