"""Progress of jobs as keyed state: which records are worth telling, at what rate a phase goes on, and which jobs are silent.

Records: jobId, phase, completed, total, outputBytes, at (event time). A job's state is its phase and when that began, its
newest record and when it was last told of. A record is told when the phase changes, when the phase is complete, or a
second or more after the last one told. Records that are older than the job's newest one change nothing. A job whose
newest record lies ``silent`` seconds behind the watermark is told once as silent, with what it came to.

The state store must be RocksDB (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

RECORD = "jobId string, phase string, completed long, total long, outputBytes long, at timestamp"
OUTPUT = "jobId string, reason string, phase string, completed long, total long, outputBytes long, at timestamp, phaseSeconds double, itemsPerSecond double, etaSeconds double"
#: Milliseconds between two records of a phase that are told; the state store's class.
EVERY = 1000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "phase string, began long, newest long, told long, completed long, total long, outputBytes long"


def rates(completed: int | None, total: int | None, seconds: float) -> tuple[float | None, float | None]:
    """Items a second and seconds to go; unknown without a count, a total or time gone by, and while nothing is done."""
    rate = completed / seconds if completed is not None and seconds > 0 else None
    return rate, max(0.0, (total - completed) / rate) if total is not None and rate else None


def advance(state: tuple | None, record: tuple) -> tuple[tuple, str | None]:
    """The state after a record, and why it is told, if it is. ``record``: phase, completed, total, outputBytes, at (milliseconds)."""
    phase, completed, total, size, at = record
    if state and at < state[2]:
        return state, None
    changed = state is None or phase != state[0]
    done = total is not None and completed == total
    due = state is not None and at - state[3] >= EVERY
    reason = "phase" if changed else "complete" if done else "interval" if due else None
    return (phase, at if changed else state[1], at, at if reason else state[3], completed, total, size), reason


def whole(x) -> int | None:
    return None if x is None or pd.isna(x) else int(x)


class Progress(StatefulProcessor):
    def __init__(self, silent: float):
        self.silent = int(silent * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("progress", STATE)

    def told(self, key: tuple, state: tuple, reason: str) -> dict:
        phase, began, newest, _, completed, total, size = state
        seconds = (newest - began) / 1000
        rate, left = rates(completed, total, seconds)
        return {"jobId": key[0], "reason": reason, "phase": phase, "completed": completed, "total": total, "outputBytes": size, "at": pd.Timestamp(newest, unit="ms"), "phaseSeconds": seconds, "itemsPerSecond": rate, "etaSeconds": left}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        records = sorted(
            ((r.phase, whole(r.completed), whole(r.total), whole(r.outputBytes), int(pd.Timestamp(r.at).timestamp() * 1000)) for part in rows for r in part.itertuples()),
            key=lambda r: r[4],
        )
        state = tuple(whole(x) if i else x for i, x in enumerate(self.state.get())) if self.state.exists() else None
        out = []
        for record in records:
            state, reason = advance(state, record)
            if reason:
                out.append(self.told(key, state, reason))
        self.state.update(state)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(max(state[2], timerValues.getCurrentWatermarkInMs()) + self.silent)
        yield frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = tuple(whole(x) if i else x for i, x in enumerate(self.state.get()))
        yield frame([self.told(key, state, "silent")])

    def close(self) -> None:
        pass


def frame(rows: list[dict]) -> pd.DataFrame:
    names = [f.split()[0] for f in OUTPUT.split(", ")]
    out = pd.DataFrame(rows, columns=names)
    return out.astype({"completed": "Int64", "total": "Int64", "outputBytes": "Int64", "phaseSeconds": "Float64", "itemsPerSecond": "Float64", "etaSeconds": "Float64", "at": "datetime64[ns]"})


def progress_records(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(RECORD).json(folder)


def throttled(records: DataFrame, silent: float = 60, late: str = "10 seconds") -> DataFrame:
    """What is told of the jobs of a stream; in update or append mode."""
    keyed = records.withWatermark("at", late).groupBy("jobId")
    return keyed.transformWithStateInPandas(statefulProcessor=Progress(silent), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
