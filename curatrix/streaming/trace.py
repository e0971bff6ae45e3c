"""Structured Streaming over the trace: windows, span pairs, the repair loop, idempotent commits, day files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from curatrix.sources.sinks import append_new


def windowed_kpis(events: DataFrame, keys: list[str], window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Counts and value sums by tumbling window; rows later than the delay are dropped (an extension)."""
    late = events.withWatermark("ts", delay)
    out = late.groupBy(F.window("ts", window), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), *keys, "n", "total")


def paired_spans(starts: DataFrame, ends: DataFrame, within: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """(span_id, ts, ...) starts joined with their ends, at most ``within`` apart, so that state is bounded."""
    a = starts.select("span_id", F.col("ts").alias("began")).withWatermark("began", delay)
    b = ends.select(F.col("span_id").alias("end_id"), F.col("ts").alias("ended")).withWatermark("ended", delay)
    near = (F.col("span_id") == F.col("end_id")) & (F.col("ended") >= F.col("began")) & (F.col("ended") <= F.col("began") + F.expr(f"interval {within}"))
    return a.join(b, near).select("span_id", "began", "ended", (F.unix_micros("ended") - F.unix_micros("began")).alias("micros"))


def candidate_states(attempts: DataFrame, max_repairs: int = 3) -> DataFrame:
    """(job, seq, passed) -> one row for each batch and job: repairs used, status (open, success, abandoned). A job that
    has ended stays ended; later attempts are ignored. State is two numbers a job."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tried, status = state.get if state.exists else (0, "open")
        for passed in pd.concat(list(batches)).sort_values("seq")["passed"]:
            if status != "open":
                break
            tried += 1
            status = "success" if passed else "abandoned" if tried > max_repairs else "open"
        state.update((tried, status))
        yield pd.DataFrame([(key[0], max(0, tried - 1), status)], columns=["job", "repairs", "status"])

    return attempts.groupBy("job").applyInPandasWithState(step, "job long, repairs long, status string", "tried long, status string", "update", GroupStateTimeout.NoTimeout)


def commit_stream(samples: DataFrame, path: str, keys: list[str], checkpoint: str):
    """Append each micro-batch's new keys; a batch that is run again adds nothing."""
    return samples.writeStream.foreachBatch(lambda rows, _: append_new(rows, path, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def day_files(events: DataFrame, path: str, checkpoint: str, every: str = "2 seconds"):
    """One folder a UTC day, written at most every two seconds."""
    return events.withColumn("date", F.to_date("ts")).writeStream.partitionBy("date").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
