"""Places, running sums and exact percentiles over orders of any length.

Rows are dealt to ranges of the order and sorted there; each range counts or sums its own
rows, and the sums of the ranges before it are carried in. Only one row for each range (and
group in it) meets in one place. Rows that are equal in the whole order stay in one range, so
values that repeat are counted before they are dealt (``value_counts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.sources.scratch import written

#: Bits of ``monotonically_increasing_id`` below the number of the partition.
_PART_BITS = 33


def _ranges(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """rows, written once, with the number of their range and their place in it from 0."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(dealt.withColumn("__id", F.monotonically_increasing_id()), "ranges")
    return placed.select("*", F.shiftright("__id", _PART_BITS).alias("__part"), F.col("__id").bitwiseAND(F.lit((1 << _PART_BITS) - 1)).alias("__at")).drop("__id")


def beside(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """left with the other columns of right, which has one row for each ``by`` (null is a key too);
    without ``by`` it has one row in all."""
    named = right.withColumnsRenamed({k: f"__r_{k}" for k in by})
    on = F.lit(True)
    for k in by:
        on = on & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(named if by else F.broadcast(named), on, how).drop(*[f"__r_{k}" for k in by])


def ranked(rows: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """rows with their places from 1. Ties of the whole order get places in any order."""
    placed = _ranges(rows, order)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return placed.join(F.broadcast(starts), "__part").withColumn(name, F.col("__before") + F.col("__at") + 1).drop("__part", "__at", "__before")


def running(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """rows with each of ``sums`` added up from the first row of its group to this one, in order.
    Rows that tie in the whole order are added up in any order."""
    placed = _ranges(rows.select("*", *[v.alias(f"__v_{n}") for n, v in sums.items()]), [*map(F.col, by), *order])
    keys = [*by, "__part"]
    totals = placed.groupBy(*keys).agg(*[F.sum(f"__v_{n}").alias(f"__b_{n}") for n in sums])
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, *[F.coalesce(F.sum(f"__b_{n}").over(before), F.lit(0)).alias(f"__b_{n}") for n in sums])
    own = Window.partitionBy(*keys).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(f"__v_{n}").over(own).alias(f"__l_{n}") for n in sums])
    both = beside(local, carried, keys, "inner")
    return both.select(*rows.columns, *[(F.col(f"__l_{n}") + F.col(f"__b_{n}")).alias(n) for n in sums])


def value_counts(rows: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """How often each group holds each value, nulls not counted."""
    return rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__count"))


def percentiles(rows: DataFrame, value: str, shares: dict[str, float], by: Sequence[str] = (), nearest: bool = False) -> DataFrame:
    """The exact percentiles of each group, by the name given to each share. Between two values
    they are interpolated, or with ``nearest`` the least value with that share of rows at or
    below it is taken. Groups without values have no row; without ``by`` there is one row."""
    up_to = running(value_counts(rows, value, by), [F.col(value)], {"__upto": F.col("__count")}, by)
    totals = up_to.groupBy(*by).agg(F.max("__upto").alias("__total"))
    joined = beside(up_to, totals, by, "inner")
    first, last = F.col("__upto") - F.col("__count"), F.col("__upto") - 1
    n, x = F.col("__total"), F.col(value).cast("double")
    out = []
    for name, share in shares.items():
        at = F.greatest(F.ceil(n * share) - 1, F.lit(0)).cast("double") if nearest else (n - 1) * F.lit(float(share))
        here = lambda place: F.max(F.when((first <= place) & (place <= last), x))
        low, high = here(F.floor(at)), here(F.ceil(at))
        part = F.max(at - F.floor(at))
        out.append(F.when(part == 0, low).otherwise(low + (high - low) * part).alias(name))
    return joined.groupBy(*by).agg(*out)
