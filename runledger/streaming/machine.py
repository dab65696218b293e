"""Run machines of a stream of records, one event at a time, with keyed state.

The state of a window (a node's records of a day and the next) is in the state store (RocksDB): the machine as it stood
before the last few events, and these events in a buffer, in order of time and line. The windows of a day are kept in groups by a hash of their
node, since a call of Python and its way to the store and back cost far more than the events of a window. A batch reads and writes the groups
of the windows that it touches and no others, whatever has been seen before. An event that comes late is put into its place in the
buffer. Where the buffer is full, its older half goes through the machine for good; an event that is older than those
makes its window ``disordered``, and :func:`settled` computes such windows, and only these, from the records of their days.
A window that has had no event for a while is closed by its group's timer: its buffer goes through the machine, and only the machine stays.
Timers go by the time of arrival, which is what the watermark is on, so no record is ever too late to be taken.

A batch's rows are written to ``updates/batch=<n>``, which a batch that runs again replaces; of a window's rows the last counts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.clock import run_key
from ..operators.runs import RUN, TASK, Machine, calendar, is_status, situations
from . import append_new

#: Events of a window that are kept in order before they count for good; idle milliseconds after which a window is closed.
BUFFER, IDLE_MS = 512, 6 * 3600 * 1000
#: Groups of a day's windows. A checkpoint goes with the number that it was written with.
GROUPS = 512
#: The state store; and no batches without records, since timers may wait for the next one.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
POINTS = ("submitted", "active", "complete", "aborted")
OUT = (
    "node_path string, run_date date, n_records long, situation string, tp_submitted timestamp_ntz, tp_active timestamp_ntz, "
    "tp_complete timestamp_ntz, tp_aborted timestamp_ntz, disordered boolean, closed boolean"
)
_STATE = "windows string"
#: Stands for a null line number, and is numpy's sign of no time.
_NONE = -(1 << 63)


def step(machine: Machine, state: list, status: str, at: int) -> list:
    """``[situation, submitted, active, complete, aborted]`` after one more status change; times are microseconds."""
    now, submitted, active, _, aborted = state
    if now == "Complete" or (machine.stops_on_error and now == "Error"):
        return state
    if status == "aborted":
        fails = now in ("Submitted", "Active") and not machine.ignore_aborted
        return ["Error" if fails else now, submitted, active, None, at]
    if status == "queued":
        return ["Queued", None, None, None, aborted]
    if status == "submitted" and ("submitted" in machine.reopens or now in ("Initial", "Queued")):
        return ["Submitted", at, None, None, aborted]
    if status == "active" and now == "Submitted":
        return ["Active", submitted, at, None, aborted]
    if status == "complete" and (now == "Active" or (now == "Submitted" and not machine.needs_active)):
        return ["Complete", submitted, active, at, aborted]
    return [now, submitted, active, None, aborted]


class Window:
    """What is known of one window: the machine behind the older events, and the younger ones in order."""

    def __init__(self, machine: Machine, stored: list | None, size: int):
        self.rules, self.size, self.seen = machine, size, None
        if stored is None:
            # The last event that counts for good, and the machine after it.
            self.front, self.state, self.buffer, self.n, self.disordered, self.arrived = None, ["Initial", None, None, None, None], [], 0, False, 0
        else:
            self.front, self.state, self.buffer, self.n, self.disordered, self.arrived = stored

    def add(self, at: int, line: int, status: str) -> None:
        if self.front is not None and [at, line] <= self.front:
            self.disordered = True
            return
        if self.seen is None:
            self.seen = set(map(tuple, self.buffer))
        if line == _NONE or (at, line, status) not in self.seen:  # else sent again
            self.seen.add((at, line, status))
            self.buffer.append([at, line, status])
            self.n += 1

    def _through(self, events: list, state: list) -> list:
        for at, _, status in events:
            state = step(self.rules, state, status, at)
        return state

    def settle(self, keep: int) -> None:
        self.buffer.sort()
        old, self.buffer = self.buffer[: len(self.buffer) - keep], self.buffer[len(self.buffer) - keep :]
        if old:
            self.state, self.front, self.seen = self._through(old, self.state), old[-1][:2], None

    def result(self) -> list:
        if len(self.buffer) > self.size:
            self.settle(self.size // 2)
        self.buffer.sort()
        return self._through(self.buffer, self.state)

    def stored(self, arrived: int) -> list:
        """``arrived``: when the last events came; 0 once the window is closed."""
        return [self.front, self.state, self.buffer, self.n, self.disordered, arrived]


class RunMachine(StatefulProcessor):
    """The machines of one group of a day's windows; see the module."""

    def __init__(self, machine: Machine, buffer: int, idle_ms: int):
        self.machine, self.buffer, self.idle_ms = machine, buffer, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.store = handle, handle.getValueState("group", _STATE)

    def _known(self) -> dict[str | None, list]:
        known = self.store.get()
        return {} if known is None else {node: stored for node, *stored in json.loads(known[0])}

    def _keep(self, known: dict[str | None, list]) -> None:
        self.store.update((json.dumps([[node, *stored] for node, stored in known.items()], separators=(",", ":")),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self._known()
        waits = any(stored[5] for stored in known.values())
        touched: dict[str | None, Window] = {}
        for f in rows:
            for node, at, line, status in zip(f["node_path"].tolist(), f["at"].tolist(), f["line_no"].tolist(), f["status"].tolist(), strict=True):
                window = touched.get(node)
                if window is None:
                    window = touched[node] = Window(self.machine, known.get(node), self.buffer)
                if status is not None:
                    window.add(at, line, status)
            arrived = int(f["arrived_ms"].iloc[-1])
            for window in touched.values():
                if len(window.buffer) > 2 * self.buffer:
                    window.settle(self.buffer)
        out = self._rows(key, touched, False)
        for node, window in touched.items():
            known[node] = window.stored(arrived)
        if not waits:
            self.handle.registerTimer(arrived + self.idle_ms)  # where more events come, it finds so and is set anew
        self._keep(known)
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known, now = self._known(), expiredTimerInfo.getExpiryTimeInMs()
        due = {node: Window(self.machine, stored, self.buffer) for node, stored in known.items() if stored[5] and stored[5] + self.idle_ms <= now}
        for node, window in due.items():
            window.settle(0)
            known[node] = window.stored(0)
        left = [stored[5] for stored in known.values() if stored[5]]
        if left:
            self.handle.registerTimer(min(left) + self.idle_ms)
        if due:
            self._keep(known)
            yield self._rows(key, due, True)

    @staticmethod
    def _rows(key, windows: dict[str | None, Window], closed: bool) -> pd.DataFrame:
        names, moments = [], []
        for window in windows.values():
            name, *times = window.result()
            times[2] = times[2] if name == "Complete" else None
            names.append(name)
            moments.append([_NONE if t is None else t for t in times])
        columns = {"node_path": list(windows), "run_date": [key[1]] * len(windows), "n_records": [w.n for w in windows.values()], "situation": names}
        columns |= dict(zip((f"tp_{p}" for p in POINTS), np.array(moments, "int64").T.copy().view("datetime64[us]"), strict=True))
        return pd.DataFrame(columns | {"disordered": [w.disordered for w in windows.values()], "closed": closed})

    def close(self) -> None:
        pass


def stream_machine(records: DataFrame, table: str, updates: str, checkpoint: str, machine: Machine = TASK, buffer: int = BUFFER, idle_ms: int = IDLE_MS):
    """Two streams over the records: one keeps them in ``table`` by day, one keeps the windows; both are started and returned.

    ``records``: ``node_path, record_date, ts, line_no, command``. Records of other commands, or without a time, make their node known and count nothing.
    """
    kept = records.writeStream.foreachBatch(lambda batch, _: append_new(batch, table, ("line_no",)))
    kept = kept.option("checkpointLocation", f"{checkpoint}/records").trigger(availableNow=True).start()
    changes = records.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "1 minute").select(
        "arrived", F.unix_millis("arrived").alias("arrived_ms"), F.pmod(F.xxhash64("node_path"), F.lit(GROUPS)).cast("int").alias("of"), "node_path",
        F.explode(F.array(F.col("record_date"), F.date_sub("record_date", 1))).alias("run_date"), F.coalesce(_micros("ts"), F.lit(_NONE)).alias("at"),
        F.coalesce("line_no", F.lit(_NONE)).alias("line_no"), F.when(is_status(F.col("command")) & F.col("ts").isNotNull(), F.col("command")).alias("status"),
    )
    windows = changes.groupBy("of", "run_date").transformWithStateInPandas(RunMachine(machine, buffer, idle_ms), OUT, "Update", "EventTime")

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{updates}/part={number}")

    said = windows.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{checkpoint}/windows")
    with _settings(records.sparkSession, SETTINGS):  # a stream keeps those that it was started with
        return kept, said.trigger(availableNow=True).start()


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _micros(column: str) -> Column:
    """Microseconds of a zone-less moment, read as UTC."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {column})")


def settled(spark: SparkSession, table: str, updates: str, start, stop, machine: Machine = TASK) -> DataFrame:
    """Every node on every day of ``[start, stop)`` as the stream has left it; as :func:`runledger.operators.runs.situations` gives it."""
    rows = spark.read.schema(OUT + ", batch long").parquet(updates)
    last = rows.groupBy(*RUN).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in RUN]), "batch").alias("r")).select(*RUN, "r.*")
    wrong = last.filter("disordered").select(*RUN)
    stored = spark.read.parquet(table)
    # The records of disordered windows: their nodes, on their days and the next.
    days = wrong.select("node_path", F.explode(F.array("run_date", F.date_add("run_date", 1))).alias("record_date")).distinct()
    again = situations(stored.join(days, ["node_path", "record_date"], "left_semi"), start, stop, machine).join(wrong, list(RUN), "left_semi")
    names = ["n_records", "situation", *(f"tp_{p}" for p in POINTS)]
    known = last.filter("not disordered").select(*RUN, *names).unionByName(again.select(*RUN, *names))
    # Windows of nodes without any event that day are not in the store.
    nodes = last.select("node_path").distinct()
    every = calendar(nodes, start, stop).join(known, list(RUN), "left")
    return every.withColumns(
        {"n_records": F.coalesce("n_records", F.lit(0)), "situation": F.coalesce("situation", F.lit("Initial")), "run_key": run_key(F.col("run_date"))}
    )
