"""Compiler logs cut to a budget: their different diagnostics, counted in all and once each.

A log is rows of lines, (log, at, line), so that one log may be of any length: diagnostics are
counted by key before any of them meet, and what is put together for a log is no longer than
its budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions.reasoning import diagnostic_key, is_noise
from curatrix.sources.scratch import written

# Forms of a diagnostic, and what an empty log says.
PLACED = (
    r"(?i)^(\S.*?)\((\d+)\):\s+(error|warning|fatal error)\b(?:\s+#\S+)?:\s+(.*)$",
    r"(?i)^(\S.*?):(\d+)(?::\d+)?:\s+(error|warning|fatal error)\s*:\s+(.*)$",
)
UNPLACED = r"(?i)^(?:(\S.*?):\s+)?fatal error:\s+(.*)$"
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]"
EMPTY, MAX_CHARS = "(empty compiler output)", 6000


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def log_lines(logs: DataFrame, log: str = "log", text: str = "text") -> DataFrame:
    """(log, at, line) of every line of a log without the blanks around it; a null log is empty."""
    lines = F.split(_stripped(F.coalesce(F.col(text), F.lit(""))), LINE_END, -1)
    return logs.select(F.col(log).alias("log"), F.posexplode(lines).alias("at", "line"))


def diagnostics(lines: DataFrame) -> DataFrame:
    """(log, at, shown, kind, key) of the lines that are a diagnostic."""
    said = F.lower("line")
    likely = lines.where(said.contains("error") | said.contains("warning")).select("log", "at", _stripped(F.col("line")).alias("shown"))
    # Each form turns its line into a line end, the kind, a line end and the message, which no further form fits.
    read = F.col("shown")
    for form, parts in (*[(f, "\n$3\n$4") for f in PLACED], (UNPLACED, "\nfatal error\n$2")):
        read = F.regexp_replace(read, form, parts)
    found = likely.withColumn("read", read).where(F.col("read").startswith("\n") & ~is_noise(F.col("shown")))
    part = lambda n: F.split_part("read", F.lit("\n"), F.lit(n))
    found = found.select("log", "at", "shown", F.lower(part(2)).alias("kind"), part(3).alias("message"))
    return found.withColumn("key", F.concat_ws("|", "kind", diagnostic_key(F.col("message")))).drop("message")


def _joined(rows: DataFrame, name: str, value: str = "line") -> DataFrame:
    """One text a log, its rows by place."""
    return rows.groupBy("log").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", value))), lambda x: x[value]), "\n").alias(name))


def log_summaries(lines: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """(log, n_chars, errors, unique_errors, warnings, unique_warnings, summary). Logs within the
    budget stay as they are. Of longer ones the summary lists different errors, then warnings, each
    at its first place and as far as they fit; logs without a diagnostic keep their end."""
    lines = written(lines, "log-lines")  # several passes follow
    sizes = lines.groupBy("log").agg((F.sum(F.length("line")) + F.count("*") - 1).alias("n_chars"), F.max("at").alias("last"))
    counted = diagnostics(lines).groupBy("log", (F.col("kind") == "warning").alias("warning"), "key").agg(F.count("*").alias("n"), F.min("at").alias("at"), F.min_by("shown", "at").alias("line"))
    of = lambda warning, value, name: F.coalesce(F.sum(F.when(F.col("warning") == warning, value)), F.lit(0)).alias(name)
    counted = written(counted, "diagnostics")
    tally = counted.groupBy("log").agg(of(False, F.col("n"), "errors"), of(False, F.lit(1), "unique_errors"), of(True, F.col("n"), "warnings"), of(True, F.lit(1), "unique_warnings"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    logs = sizes.join(tally, "log", "left").select("log", "n_chars", "last", *map(zero, ("errors", "unique_errors", "warnings", "unique_warnings")))
    number = lambda c: F.col(c).cast("string")
    header = F.concat(number("errors"), F.lit(" errors ("), number("unique_errors"), F.lit(" unique), "), number("warnings"), F.lit(" warnings ("), number("unique_warnings"), F.lit(" unique); log truncated from "), number("n_chars"), F.lit(" chars"))
    logs = logs.withColumn("header", header).withColumn("form", F.when((F.col("n_chars") <= max_chars) | F.lit(max_chars <= 0), "whole").when(F.col("errors") + F.col("warnings") == 0, "end").otherwise("listed"))
    logs = written(logs, "logs")

    # A diagnostic takes its line and a line end, so no more than max_chars of them can fit.
    place = F.row_number().over(Window.partitionBy("log", "warning").orderBy("at"))
    first = counted.withColumn("place", place).where(F.col("place") <= max(1, max_chars))
    upto = F.sum(F.length("line") + 1).over(Window.partitionBy("log", "warning").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    first = first.withColumn("upto", upto).join(logs.where("form = 'listed'").select("log", "header", "unique_errors"), "log")
    start = F.length("header") + len("\n\nerrors:")
    errors = first.where("not warning").withColumn("used", start + F.col("upto")).where(F.col("used") <= max_chars)
    shown_errors = _joined(errors, "errors_shown").join(errors.groupBy("log").agg(F.max("used").alias("used")), "log")
    listed = logs.where("form = 'listed'").join(shown_errors, "log", "left").withColumn("used", F.coalesce("used", start))
    whole = _whole_summary(first, logs, max_chars)
    room = F.col("used") + len("\n\nwarnings:")
    warned = first.where("warning").select("log", "at", "line", "upto").join(listed.select("log", "used"), "log").where((F.col("used") < max_chars - 20) & (room + F.col("upto") <= max_chars))
    cut = listed.join(_joined(warned, "warnings_shown"), "log", "left")
    some_warnings = (F.col("used") < max_chars - 20) & (F.col("unique_warnings") > 0)
    parts = F.concat_ws("\n", "header", F.lit(""), F.lit("errors:"), "errors_shown", F.when(some_warnings, F.lit("")), F.when(some_warnings, F.lit("warnings:")), F.when(some_warnings, F.col("warnings_shown")))
    summary = F.substring(_stripped(parts), 1, max_chars)
    out = cut.join(whole, "log", "left").select("log", F.coalesce("all_shown", summary).alias("summary"))

    keep = max(256, max_chars - 40)
    near_end = lines.join(logs.where("form = 'end'").select("log", "last"), "log").where(F.col("at") > F.col("last") - keep - 1)
    ends = _joined(near_end, "text").join(logs.select("log", "n_chars"), "log")
    ends = ends.select("log", F.concat(F.lit("...[truncated "), (F.col("n_chars") - keep).cast("string"), F.lit(" chars]...\n"), F.substring("text", -keep, keep)).alias("summary"))
    kept = _joined(lines.join(logs.where("form = 'whole'").select("log"), "log", "left_semi"), "text").select("log", F.coalesce(F.nullif("text", F.lit("")), F.lit(EMPTY)).alias("summary"))
    return logs.drop("header", "form", "last").join(out.unionByName(ends).unionByName(kept), "log")


def _whole_summary(first: DataFrame, logs: DataFrame, max_chars: int) -> DataFrame:
    """(log, all_shown): the summary with all diagnostics, where it fits as a whole."""
    last = first.groupBy("log", "warning").agg(F.max("upto").alias("upto"), F.max("place").alias("place")).groupBy("log").agg(F.sum("upto").alias("chars"), F.sum("place").alias("n"))
    about = logs.join(last, "log").where(F.col("n") == F.col("unique_errors") + F.col("unique_warnings"))
    section = lambda n, title: F.when(F.col(n) > 0, len(f"\n\n{title}:")).otherwise(0)
    size = F.length("header") + F.col("chars") + section("unique_errors", "errors") + section("unique_warnings", "warnings")
    fits = about.where(size <= max_chars).select("log", "header")
    rows = first.drop("header").join(fits, "log")
    texts = rows.groupBy("log").agg(F.first("header").alias("header"), *[F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("warning") == w, F.struct("at", "line")))), lambda x: x["line"]), "\n").alias(n) for w, n in ((False, "e"), (True, "w"))])
    shown = lambda c, title: F.when(F.col(c) != "", F.concat(F.lit(f"\n\n{title}:\n"), F.col(c))).otherwise("")
    return texts.select("log", F.concat("header", shown("e", "errors"), shown("w", "warnings")).alias("all_shown"))
