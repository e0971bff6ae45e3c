"""The repair loop of a candidate, over a table or a stream of attempts.

An attempt has job, candidate, seq (its order), ts, ok, compiled, owner and version. One that
passes ends the candidate. One that an oracle or the infrastructure failed is tried again
without counting as a repair, after a longer wait each time, until too many were; the candidate
is then blocked. Any other failure is repaired until the budget is spent. A retry that doesn't
come within ``patience`` of its due time is lost, which on a stream a timer tells. Versions that
compiled are banked. One function takes a candidate a step on, for both ways.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTSIDE = ("ORACLE", "INFRA")
BACKOFF = (5.0, 20.0)
ROW = "job long, candidate int, seq long, at timestamp, action string, repairs int, retries int, wait_s double, banked int"
STATE = "status string, repairs int, retries int, due_ms long, banked array<string>"
ATTEMPT = ["job", "candidate", "seq", "ts", "ok", "compiled", "owner", "version"]
ENDED = ("success", "abandoned", "blocked", "lost")


@dataclass(frozen=True)
class Limits:
    repairs: int = 3
    retries: int = 2
    patience_s: float = 600.0
    #: How long, in event time, a stream remembers that a candidate has ended.
    keep_s: float = 86_400.0


@dataclass
class Candidate:
    status: str = "open"
    repairs: int = 0
    retries: int = 0
    due_ms: int = 0
    banked: list[str] = field(default_factory=list)

    def lost_at(self, limits: Limits) -> int:
        return self.due_ms + int(1000 * limits.patience_s)

    def lose(self) -> None:
        self.status = "lost"

    def step(self, at_ms: int, ok: bool, compiled: bool, owner: str | None, version: str | None, limits: Limits) -> float:
        """Take one attempt in; returns the wait before the next."""
        if compiled and version and version not in self.banked:
            self.banked.append(version)
        if ok:
            self.status = "success"
        elif owner in OUTSIDE:
            if self.retries >= limits.retries:
                self.status = "blocked"
            else:
                wait = BACKOFF[min(self.retries, len(BACKOFF) - 1)]
                self.retries += 1
                self.status, self.due_ms = "retry", at_ms + int(1000 * wait)
                return wait
        elif self.repairs >= limits.repairs:
            self.status = "abandoned"
        else:
            self.repairs += 1
            self.status = "repair"
        return 0.0


class _Attempt(NamedTuple):
    seq: int | None
    ts: pd.Timestamp | int
    ok: bool | None
    compiled: bool | None
    owner: str | None
    version: str | None


def _stamp(ms: int) -> pd.Timestamp:
    return pd.Timestamp(ms, unit="ms")


def _us(at: pd.Timestamp | int) -> int:
    """Microseconds of a stream's time, or of a table's, which has them."""
    return at if isinstance(at, int) else at.value // 1000


def _walk(key: tuple, candidate: Candidate, attempts: Iterable, limits: Limits) -> list[tuple]:
    """The rows that further attempts of a candidate give, in order; what comes after its end gives none."""
    rows: list[tuple] = []
    for a in attempts:
        if candidate.status in ENDED:
            break
        at_ms = _us(a.ts) // 1000
        if candidate.status == "retry" and at_ms > candidate.lost_at(limits):
            rows.append(_lost(key, candidate, limits))
            break
        wait = candidate.step(at_ms, bool(a.ok), bool(a.compiled), a.owner, a.version, limits)
        rows.append((*key, a.seq, a.ts, candidate.status, candidate.repairs, candidate.retries, wait, len(candidate.banked)))
    return rows


def _lost(key: tuple, candidate: Candidate, limits: Limits) -> tuple:
    candidate.lose()
    return (*key, None, _stamp(candidate.lost_at(limits)), "lost", candidate.repairs, candidate.retries, 0.0, len(candidate.banked))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["job", "candidate", "seq", "at", "action", "repairs", "retries", "wait_s", "banked"])
    return out.astype({"seq": "Int64", "at": "datetime64[ns]", "repairs": "int32", "retries": "int32", "candidate": "int32", "banked": "int32"})


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 9
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32())
    columns[3] = [_us(x) for x in columns[3]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["job", "candidate", "seq", "at", "action", "repairs", "retries", "wait_s", "banked"])


def repair_loop(attempts: DataFrame, limits: Limits = Limits(), delay_s: float = 600.0) -> DataFrame:
    """All steps of all candidates of a table. A retry that never came is lost if the table reaches
    ``delay_s`` beyond its time, as a stream's watermark would. A task walks its candidates' attempts
    in order, and holds one candidate and one batch of them."""
    last = attempts.agg(F.max(F.unix_millis(F.col("ts").cast("timestamp"))).alias("ms")).first()["ms"]
    reached = (last or 0) - int(1000 * delay_s)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, candidate = None, Candidate()

        def end() -> list[tuple]:
            return [_lost(key, candidate, limits)] if candidate.status == "retry" and candidate.lost_at(limits) < reached else []

        for batch in batches:
            rows = []
            for job, number, *values in zip(*[batch.column(n).to_pylist() for n in ATTEMPT], strict=True):
                if key != (job, number):
                    rows += end()
                    key, candidate = (job, number), Candidate()
                if candidate.status not in ENDED:
                    rows += _walk(key, candidate, [_Attempt(*values)], limits)
            yield _rows(rows)
        yield _rows(end())

    order = [F.col("job"), F.col("candidate"), F.col("seq").asc_nulls_last()]
    in_order = attempts.select(ATTEMPT).repartition("job", "candidate").sortWithinPartitions(*order)
    timed = in_order.withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")))
    found = timed.mapInArrow(walk, ROW.replace("at timestamp", "at long"))
    return found.withColumn("at", F.timestamp_micros("at"))


class RepairLoop(StatefulProcessor):
    """The same on a stream: the candidate is the state, and a timer marks a retry as lost or,
    after the end, lets the state go."""

    def __init__(self, limits: Limits) -> None:
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("candidate", STATE)

    def _load(self) -> Candidate:
        if not self.state.exists():
            return Candidate()
        status, repairs, retries, due_ms, banked = self.state.get()
        return Candidate(status, repairs, retries, due_ms, list(banked))

    def _save(self, c: Candidate) -> None:
        self.state.update((c.status, c.repairs, c.retries, c.due_ms, list(c.banked)))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        candidate, attempts = self._load(), pd.concat(list(rows))
        before = candidate.status
        out = _frame(_walk(key, candidate, attempts.sort_values("seq").itertuples(), self.limits))
        self._save(candidate)
        if candidate.status == "retry":
            self.handle.registerTimer(candidate.lost_at(self.limits))
        elif candidate.status in ENDED and before not in ENDED:
            self.handle.registerTimer(int(attempts["ts"].max().value // 1_000_000) + int(1000 * self.limits.keep_s))
        yield out

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        candidate, rows = self._load(), []
        if candidate.status == "retry" and candidate.lost_at(self.limits) <= expiredTimerInfo.getExpiryTimeInMs():
            rows.append(_lost(key, candidate, self.limits))
            self._save(candidate)
            self.handle.registerTimer(candidate.lost_at(self.limits) + int(1000 * self.limits.keep_s))
        elif candidate.status in ENDED:
            self.state.clear()
        yield _frame(rows)

    def close(self) -> None:
        pass


def repair_stream(attempts: DataFrame, limits: Limits = Limits(), delay_s: float = 600.0) -> DataFrame:
    """``repair_loop`` over a stream, whose order of arrival is that of each candidate's attempts.
    Needs the RocksDB state store (spark.sql.streaming.stateStore.providerClass)."""
    timed = attempts.select(ATTEMPT).withWatermark("ts", f"{int(delay_s)} seconds")
    return timed.groupBy("job", "candidate").transformWithStateInPandas(RepairLoop(limits), ROW, "Append", "EventTime")
