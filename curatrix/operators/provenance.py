"""Digests that tell whether two tables, or groups of rows, hold the same rows.

A row's digest is the sha256 of its fields, each with its length, so that no two rows run
together. Digests are added up in eight lanes of 32 bits, which partial sums do before anything
is shuffled: neither the order of rows nor that of files counts, and repeated rows do. The sums,
the count and the columns' names then give the digest of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANES = 8


def row_digest(columns: Sequence[str]) -> Column:
    """sha256 of the fields as text, in the order of their names: ``length:value``, or ``-`` for null."""
    field = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    return F.sha2(F.concat(*[field(c) for c in sorted(columns)]), 256)


def digests(rows: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by, n_rows, digest) over the named columns, all but ``by`` if none are named. Without
    ``by`` there is one row, for no rows too."""
    names = sorted(columns if columns is not None else [c for c in rows.columns if c not in by])
    lane = lambda i: F.conv(F.substring("__digest", 8 * i + 1, 8), 16, 10).cast("decimal(38,0)")
    sums = rows.select(*by, row_digest(names).alias("__digest")).groupBy(*by).agg(F.count("*").alias("n_rows"), *[F.coalesce(F.sum(lane(i)), F.lit(0)).cast("string").alias(f"__{i}") for i in range(LANES)])
    whole = F.concat_ws("|", F.lit(",".join(names)), F.col("n_rows").cast("string"), *[F.col(f"__{i}") for i in range(LANES)])
    return sums.select(*by, "n_rows", F.sha2(whole, 256).alias("digest"))


def changed_groups(rows: DataFrame, other: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(by, state) of the groups that differ: added, removed or changed."""
    renamed = digests(other, columns, by).withColumnsRenamed({c: f"__o_{c}" for c in (*by, "n_rows", "digest")})
    same = F.lit(True)
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"__o_{k}"))
    both = digests(rows, columns, by).join(renamed, same, "full")
    state = F.when(F.col("__o_digest").isNull(), "added").when(F.col("digest").isNull(), "removed").when(F.col("digest") != F.col("__o_digest"), "changed")
    there = F.col("digest").isNotNull()
    return both.select(*[F.when(there, F.col(k)).otherwise(F.col(f"__o_{k}")).alias(k) for k in by], state.alias("state")).where("state is not null")
