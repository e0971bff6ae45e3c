"""Line files as tables: questions, archives, traces, progress, work trees, logs, raw tensors.

Parsers take a frame of lines (file, line, value), so that the same code serves files, tables and streams;
``read_lines`` makes one of files. Objects stay VARIANT: unknown keys survive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TERMINAL = ("success", "abandoned")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of text files, physical lines from 1. Each file is numbered as a whole, as its splits
    don't know how many lines lie before them; cut inputs into many files."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    numbered = whole.select("file", F.posexplode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n", -1)).alias("line", "value"))
    return numbered.select("file", (F.col("line") + 1).cast("long").alias("line"), "value")


def _object(value: Column) -> Column:
    """The line as an object, null for anything else."""
    parsed = F.try_parse_json(value)
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)


def _blank(value: Column) -> Column:
    return F.coalesce(F.regexp_replace(value, r"(?U)\s", "") == "", F.lit(True))


def _where(reason: str) -> Column:
    return F.raise_error(F.concat(F.col("file"), F.lit(":"), F.col("line").cast("string"), F.lit(f": {reason}")))


def questions(lines: DataFrame) -> DataFrame:
    """(question_id, question, row): blank lines, non-objects and blank questions go, malformed JSON raises.
    The id is the physical line."""
    row = F.when(F.try_parse_json("value").isNull(), _where("malformed JSON").cast("variant")).otherwise(_object(F.col("value")))
    rows = lines.where(~_blank(F.col("value"))).select(F.col("line").alias("question_id"), row.alias("row"))
    named = rows.where("row is not null").select("question_id", F.trim(F.try_variant_get("row", "$.question", "string")).alias("question"), "row")
    return named.where("question <> ''")


def objects(lines: DataFrame) -> DataFrame:
    """(file, line, row) of lines that hold an object; others go."""
    return lines.where(~_blank(F.col("value"))).select("file", "line", _object(F.col("value")).alias("row")).where("row is not null")


def line_issues(lines: DataFrame) -> DataFrame:
    """(file, n_lines, n_corrupt): lines that aren't blank, and those of them that are no object."""
    full = lines.where(~_blank(F.col("value")))
    return full.groupBy("file").agg(F.count("*").alias("n_lines"), F.count_if(_object(F.col("value")).isNull()).alias("n_corrupt"))


def trace_events(lines: DataFrame) -> DataFrame:
    """(file, line, event, row); a line that is no object, or has no event, raises with its place."""
    row, event = _object(F.col("value")), F.try_variant_get(_object(F.col("value")), "$.event", "string")
    named = F.when(row.isNull(), _where("no object")).when(event.isNull() | (event == ""), _where("no event")).otherwise(event)
    return lines.where(~_blank(F.col("value"))).select("file", "line", named.alias("event"), row.alias("row"))


def done_keys(lines: DataFrame) -> DataFrame:
    """Distinct (id, track) of terminal progress rows; a missing dialect is cuda. Bad lines go."""
    row = objects(lines)
    get = lambda path, kind: F.try_variant_get("row", path, kind)
    track = F.lower(F.trim(F.coalesce(get("$.dialect", "string"), F.lit(""))))
    rows = row.select(get("$.id", "long").alias("id"), F.when(track == "", "cuda").otherwise(track).alias("track"), get("$.status", "string").alias("status"))
    return rows.where(F.col("status").isin(*TERMINAL) & F.col("id").isNotNull()).select("id", "track").distinct()


def solution_files(paths: DataFrame) -> DataFrame:
    """(path) -> (question_id, dialect, path) of sources in a work tree; a tree without dialect folders is cuda."""
    part = lambda i: F.regexp_extract("path", r"(?:^|/)q?(\d+)(?:/(cuda|cutlass|triton|tilelang))?(?:/[^/]+)*/solution\.(?:cu|py)$", i)
    rows = paths.select(part(1).alias("id"), part(2).alias("dialect"), "path").where("id <> ''")
    return rows.select(F.col("id").cast("long").alias("question_id"), F.when(F.col("dialect") == "", "cuda").otherwise(F.col("dialect")).alias("dialect"), "path")


def last_object(text: Column) -> Column:
    """The last line of a program's output that is an object, else its outermost braces, else null."""
    rows = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n", -1), lambda x: F.when(F.trim(x).startswith("{"), x)), lambda x: x.isNotNull() & _object(x).isNotNull())
    outer = F.regexp_extract(F.coalesce(text, F.lit("")), r"(?s)(\{.*\})", 1)
    return F.coalesce(_object(F.try_element_at(rows, F.lit(-1))), F.when(outer != "", _object(outer)))


def compile_log(lines: DataFrame) -> DataFrame:
    """(worker, question_id, passed, failed, seconds) of a console log; clock times wrap at midnight."""
    grab = lambda p: F.regexp_extract("value", p, 1)
    clock = grab(r"^(?:\[?)(\d{2}:\d{2}:\d{2})")
    at = F.split_part(clock, F.lit(":"), F.lit(1)).cast("int") * 3600 + F.split_part(clock, F.lit(":"), F.lit(2)).cast("int") * 60 + F.split_part(clock, F.lit(":"), F.lit(3)).cast("int")
    timed = lines.where(clock != "").select("line", at.alias("at"), grab(r"\bworker[= ](\w+)").alias("worker"), grab(r"\bquestion[= ](\d+)").alias("question"), grab(r"\bcompile[= ](PASS|FAIL)\b").alias("compile"))
    first, last = F.min_by("at", "line"), F.max_by("at", "line")
    rows = timed.where("question <> ''").groupBy("worker", F.col("question").cast("long").alias("question_id"))
    return rows.agg(F.count_if(F.col("compile") == "PASS").alias("passed"), F.count_if(F.col("compile") == "FAIL").alias("failed"), F.pmod(last - first, F.lit(86400)).cast("long").alias("seconds"))


# Numpy codes of the stored element types; bf16 is the upper half of an f32.
STORED = {"f32": "<f4", "f64": "<f8", "f16": "<f2", "i32": "<i4", "i64": "<i8", "i8": "<i1", "u8": "<u1", "u16": "<u2", "u32": "<u4", "c64": "<c8"}


def tensor_values(rows: DataFrame) -> DataFrame:
    """(path, content, dtype, shape) -> (path, n, values, error). The bytes must fill the shape exactly."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content, dtype, shape in batch[["path", "content", "dtype", "shape"]].itertuples(index=False):
                numel = int(np.prod([int(x) for x in shape], dtype=object)) if len(shape) else 1
                if dtype == "bf16":
                    raw = (np.frombuffer(content[: len(content) // 2 * 2], "<u2").astype("<u4") << 16).view("<f4")
                elif dtype in STORED:
                    size = np.dtype(STORED[dtype]).itemsize
                    raw = np.frombuffer(content[: len(content) // size * size], STORED[dtype])
                else:
                    out.append((path, 0, None, f"type {dtype}"))
                    continue
                raw = raw.view("<f4") if dtype == "c64" else raw
                numel *= 2 if dtype == "c64" else 1
                fits = len(raw) == numel
                out.append((path, len(raw), raw.astype("f8") if fits else None, None if fits else f"{len(raw)} elements, not {numel}"))
            yield pd.DataFrame(out, columns=["path", "n", "values", "error"])

    return rows.select("path", "content", "dtype", "shape").mapInPandas(read, "path string, n long, values array<double>, error string")
