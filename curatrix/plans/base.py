"""Query registration: a name, a Spark plan, and the independent oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver tables of one directory, read on demand; timestamps as UTC instants."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark, self.directory = spark, directory

    @property
    def part(self) -> DataFrame:
        """Parts stand for inputs that take work, but their file is small and would be a task or
        two; so their rows are dealt over all cores."""
        cores = self.spark.sparkContext.defaultParallelism
        n = max(4 * cores, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        return self.__getattr__("part").repartition(n, "p_partkey")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")


def query(sql: str):
    """Register f(tables) under its name, with the oracle SQL of the same result."""

    def wrap(f):
        QUERIES[f.__name__] = lambda spark, directory: f(Tables(spark, directory))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return wrap
