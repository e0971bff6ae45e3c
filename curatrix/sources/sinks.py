"""Sinks: idempotent commits, exports, audit split and reports. Files appear by Spark's commit protocol or by one
rename, writers of one folder take turns, and a rerun after a lost job repairs what is missing and doubles nothing."""

from __future__ import annotations

import contextlib
import time
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _place(spark, path)
    return fs.exists(p)


class Busy(TimeoutError):
    """Another writer held the folder for the whole wait."""


@contextlib.contextmanager
def one_writer(spark: SparkSession, root: str, wait: float = 600.0, stale: float = 3600.0, pause: float = 0.2) -> Iterator[None]:
    """Hold the folder's lock: a file that only its first creator gets. A lock that is older than ``stale`` seconds was
    left by a writer that died, and is taken over. The file holds its writer's name and is read back after a pause, as
    not every store creates files in one step."""
    fs, lock = _place(spark, f"{root}/.writer")
    name, began = uuid.uuid4().hex, time.monotonic()

    def owner() -> str | None:
        try:
            with contextlib.closing(fs.open(lock)) as held:
                return str(spark._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8"))
        except Exception:  # it went meanwhile
            return None

    def taken() -> bool:
        try:
            out = fs.create(lock, False)
        except Exception:  # it is there
            return False
        out.write(bytearray(name, "ascii"))
        out.close()
        time.sleep(pause)
        return owner() == name

    while not taken():
        with contextlib.suppress(Exception):  # it went meanwhile
            if time.time() - fs.getFileStatus(lock).getModificationTime() / 1000 > stale:
                fs.delete(lock, False)
                continue
        if time.monotonic() - began > wait:
            raise Busy(f"{root} is held by another writer")
        time.sleep(pause)
    try:
        yield
    finally:
        if owner() == name:
            fs.delete(lock, False)


def first_of_each(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row of each key by ``order``; ties, and rows without an order, go by a hash of the whole row."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.xxhash64(F.to_json(F.struct("*"))), F.to_json(F.struct("*"))))
    return rows.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")


def append_new(rows: DataFrame, path: str, keys: list[str], order: Sequence[str] = ()) -> DataFrame:
    """Append the first row of each key that the table at path lacks; return the table. Only the keys of the table are
    read, and the join may broadcast or shuffle as sizes tell. Writers that may meet hold ``one_writer``."""
    spark = rows.sparkSession
    fresh = first_of_each(rows, keys, order)
    if exists(spark, path):
        known = spark.read.schema(rows.schema).parquet(path).select(*keys).withColumnsRenamed({k: f"__{k}" for k in keys})
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
        fresh = fresh.join(known, same, "left_anti")
    fresh.write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def replaced(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """What write(folder) writes takes the place of path by one rename, when it is complete."""
    staged = f"{path}.{uuid.uuid4().hex}"
    write(staged)
    fs, target = _place(spark, path)
    fs.delete(target, True)
    if not fs.rename(_place(spark, staged)[1], target):
        raise OSError(f"{staged} could not be renamed to {path}")


def commit_success(samples: DataFrame, root: str, order: Sequence[str] = ()) -> DataFrame:
    """(sample_key, id, dialect, user, assistant, system) -> the archive first, then both exports of the whole archive,
    then progress, all derived from the archive, so that a rerun writes whatever an interrupted commit left out.
    Returns the progress table."""
    with one_writer(samples.sparkSession, root):
        archive = append_new(samples, f"{root}/archive", ["sample_key"], order)
        export_training(archive, f"{root}/export")
        progress = archive.select("id", F.coalesce("dialect", F.lit("cuda")).alias("dialect"), F.lit("success").alias("status"), "sample_key")
        return append_new(progress, f"{root}/progress", ["sample_key"])


def commit_abandoned(records: DataFrame, root: str) -> DataFrame:
    """One record for each (id, dialect, question hash, reason)."""
    with one_writer(records.sparkSession, root):
        return append_new(records, f"{root}/abandoned", ["id", "dialect", "question_hash", "reason"])


def export_training(archive: DataFrame, root: str) -> None:
    """Both export shapes as JSON lines, rows without a user or assistant text left out; each replaced as a whole."""
    spark = archive.sparkSession
    usable = archive.where("trim(user) <> '' and trim(assistant) <> ''")
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    messages = F.filter(F.array(F.when(F.trim("system") != "", message("system", F.col("system"))), message("user", F.col("user")), message("assistant", F.col("assistant"))), lambda x: x.isNotNull())
    replaced(spark, f"{root}/messages", usable.select(messages.alias("messages")).write.json)
    joined = F.concat(F.when(F.trim("system") != "", F.concat("system", F.lit("\n\n"))).otherwise(""), "user")
    replaced(spark, f"{root}/input_output", usable.select(joined.alias("input"), F.col("assistant").alias("output")).write.json)


def audit_split(lines: DataFrame, flags, root: str) -> DataFrame:
    """Lines (line, value) with flags(value) -> array<string>: clean lines as they were, flagged ones with their flags,
    and a count of each flag."""
    marked = lines.select("line", "value", flags(F.col("value")).alias("flags"))
    marked.where(F.size("flags") == 0).select("value").write.mode("overwrite").text(f"{root}/clean")
    marked.where(F.size("flags") > 0).select("line", "flags", "value").write.mode("overwrite").json(f"{root}/needs_regen")
    return marked.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def case_lines(cases: DataFrame) -> DataFrame:
    """(case_name, bad, max_abs) -> PASS and FAIL lines of the case log."""
    state = F.when(F.col("bad") == 0, "PASS").otherwise("FAIL")
    return cases.select(F.format_string("%s %s bad=%d max_abs=%.6f", state, F.col("case_name"), F.col("bad").cast("long"), F.col("max_abs").cast("double")).alias("value"))
