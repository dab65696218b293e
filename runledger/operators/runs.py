"""Runs of a node by day: windows, calendars, state machines, the node table.

A record's date and the one after make a day's window. The two built-in machines are
written as windows over ``(node_path, run_date)``, which spill; any other machine
is a transition table, whose statuses are composed as maps (:func:`situations_by_table`).
Records of one node are ordered by ``(ts, line_no)``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import micros_between, run_key
from ..functions.predicate import as_day, is_status, later_than

RUN = ("node_path", "run_date")


def status_changes(log: DataFrame) -> DataFrame:
    """Status records alone."""
    return log.filter(is_status(F.col("command")))


def calendar(log: DataFrame, start, stop) -> DataFrame:
    """Every node of the log on every day of ``[start, stop)``."""
    days = F.sequence(as_day(start), F.date_sub(as_day(stop), 1))
    return log.select("node_path").distinct().withColumn("run_date", F.explode(days))


def of_nodes(log: DataFrame, node_paths=None) -> DataFrame:
    """The records of some nodes, or of all."""
    if node_paths is None:
        return log
    return log.filter(F.col("node_path").isin(*([node_paths] if isinstance(node_paths, str) else node_paths)))


def assign_run_window(log: DataFrame, start, stop, earliest_time=None, clip_to_stop: bool = False) -> DataFrame:
    """Each record on its own date and on the day before, within ``[start, stop)``.

    ``earliest_time``: drop records before that time of the run's day, for nodes that run over midnight. ``clip_to_stop``: drop
    records from ``stop`` on, at which the last day's window looks otherwise.
    """
    if clip_to_stop:
        log = log.filter(F.col("record_date") < as_day(stop))
    lean = log.select("node_path", "ts", "line_no", "command", "record_date")
    days = F.array(F.col("record_date"), F.date_sub("record_date", 1))
    placed = lean.withColumn("run_date", F.explode(days)).filter((F.col("run_date") >= as_day(start)) & (F.col("run_date") < as_day(stop)))
    if earliest_time is not None:
        placed = placed.filter(later_than(F.col("ts"), F.col("run_date"), earliest_time))
    return placed.drop("record_date")


def run_calendar(log: DataFrame, start, stop) -> DataFrame:
    """Number of status records in every node's window on every day, 0 where there is none."""
    counts = assign_run_window(status_changes(log), start, stop).groupBy(*RUN).agg(F.count("*").alias("n_records"))
    return calendar(log, start, stop).join(counts, list(RUN), "left").withColumn("n_records", F.coalesce("n_records", F.lit(0)))


@dataclass(frozen=True)
class Machine:
    """How a node's status changes make up a run.

    ``reopens``: statuses that start over. A run counts from the first ``submitted`` after
    that; ``needs_active``: it must turn active before it may complete. An abort ends it
    unless ``ignore_aborted``; ``stops_on_error``: and the day with it.
    """

    reopens: tuple[str, ...]
    needs_active: bool
    ignore_aborted: bool
    stops_on_error: bool


TASK = Machine(("submitted", "queued"), needs_active=True, ignore_aborted=False, stops_on_error=False)
FAMILY = Machine(("queued",), needs_active=False, ignore_aborted=True, stops_on_error=True)
STRICT_FAMILY = Machine(("queued",), needs_active=False, ignore_aborted=False, stops_on_error=True)


def situations(log: DataFrame, start, stop, machine: Machine = TASK, earliest_time=None, clip_to_stop: bool = False, node_paths=None) -> DataFrame:
    """One row per node and day of ``[start, stop)``: how far its run came, and when. ``node_paths``: of these nodes alone.

    ``situation`` is Initial, Queued, Submitted, Active, Complete or Error; the ``tp_`` columns
    are those of the run that decided it, ``tp_aborted`` is the last abort before its completion.
    """
    log = of_nodes(log, node_paths)
    placed = assign_run_window(status_changes(log), start, stop, earliest_time, clip_to_stop)
    run = Window.partitionBy(*RUN).orderBy("ts", "line_no")
    status = F.col("command")
    opened = placed.withColumn("rn", F.row_number().over(run)).withColumn(
        "part", F.sum(status.isin(*machine.reopens).cast("int")).over(run.rowsBetween(Window.unboundedPreceding, 0))
    )
    whole = Window.partitionBy(*RUN, "part")
    at = F.struct("rn", "ts")

    def first(condition: Column) -> Column:
        return F.min(F.when(condition, at))

    steps = opened.withColumn("s", first(status == "submitted").over(whole))
    steps = steps.withColumn("a", first((status == "active") & (F.col("rn") > F.col("s.rn"))).over(whole))
    ready = F.col("a.rn") if machine.needs_active else F.col("s.rn")
    steps = steps.withColumn("c", first((status == "complete") & (F.col("rn") > ready)).over(whole))
    parts = steps.groupBy(*RUN, "part").agg(
        F.first("s").alias("s"),
        F.first("a").alias("a"),
        F.first("c").alias("c"),
        first((status == "aborted") & (F.col("rn") > F.col("s.rn"))).alias("e"),
        F.max(F.when(status == "aborted", at)).alias("last_abort"),
        F.max(F.when((status == "aborted") & (F.col("rn") < F.col("c.rn")), at)).alias("abort_before"),
        F.count("*").alias("n"),
    )
    error = F.lit(False) if machine.ignore_aborted else F.col("e").isNotNull()
    done = F.col("c").isNotNull() & (~error | F.coalesce(F.col("e.rn") > F.col("c.rn"), F.lit(True)))
    # What comes behind the completion or the error is not of this run.
    end = F.when(done, F.col("c.rn")).when(error, F.col("e.rn"))
    parts = parts.withColumn("a", F.when(end.isNull() | (F.col("a.rn") < end), F.col("a")))
    name = (
        F.when(done, "Complete").when(error, "Error").when(F.col("s").isNull(), F.when(F.col("part") > 0, "Queued").otherwise("Initial"))
        .when(F.col("a").isNotNull(), "Active").otherwise("Submitted")
    )
    stopped = error if machine.stops_on_error else F.lit(False)
    own = F.when(done, F.col("abort_before")).when(stopped, F.col("e")).otherwise(F.col("last_abort"))
    ahead = Window.partitionBy(*RUN).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    judged = parts.withColumn("situation", name).withColumn("stops", done | stopped).withColumn("earlier", F.max("last_abort").over(ahead))
    shown = F.struct("part", "situation", "s", "a", "c", F.greatest("earlier", own).alias("e"))
    days = judged.groupBy(*RUN).agg(F.min(F.when(F.col("stops"), shown)).alias("stop"), F.max(shown).alias("last"), F.sum("n").alias("n_records"))
    days = days.withColumn("r", F.coalesce("stop", "last"))
    picked = days.select(
        *RUN, "n_records", "r.situation", F.col("r.s.ts").alias("tp_submitted"), F.col("r.a.ts").alias("tp_active"),
        F.when(F.col("r.situation") == "Complete", F.col("r.c.ts")).alias("tp_complete"), F.col("r.e.ts").alias("tp_aborted"),
    )
    return (
        calendar(log, start, stop)
        .join(picked, list(RUN), "left")
        .withColumn("n_records", F.coalesce("n_records", F.lit(0)))
        .withColumn("situation", F.coalesce("situation", F.lit("Initial")))
        .withColumn("run_key", run_key(F.col("run_date")))
    )


@dataclass(frozen=True)
class Table:
    """A machine as data: ``moves[state][status]`` is the next state; other statuses change nothing."""

    moves: dict[str, dict[str, str]]
    stops: tuple[str, ...]
    initial: str = "Initial"


# The tables of the built-in machines.
TASK_TABLE = Table(
    {
        "Initial": {"queued": "Queued", "submitted": "Submitted"},
        "Queued": {"submitted": "Submitted"},
        "Submitted": {"queued": "Queued", "active": "Active", "aborted": "Error"},
        "Active": {"queued": "Queued", "submitted": "Submitted", "complete": "Complete", "aborted": "Error"},
        "Error": {"queued": "Queued", "submitted": "Submitted"},
    },
    ("Complete",),
)
FAMILY_TABLE = Table(
    {
        "Initial": {"queued": "Queued", "submitted": "Submitted"},
        "Queued": {"submitted": "Submitted"},
        "Submitted": {"queued": "Queued", "active": "Active", "complete": "Complete"},
        "Active": {"queued": "Queued", "complete": "Complete"},
    },
    ("Complete", "Error"),
)


#: Records of a node's window from which it is cut into ranges that are composed apart.
CROWDED = 100_000
#: States that fit into a long, four bits each.
PACKED_STATES = 16


def _maps(table: Table) -> tuple[list[str], dict[str, list[int]]]:
    """The states in order, the initial one first, and for each status the number of the state that follows each state."""
    states = [table.initial, *table.stops, *table.moves, *(s for m in table.moves.values() for s in m.values())]
    states = list(dict.fromkeys(states))
    place = {s: k for k, s in enumerate(states)}
    statuses = dict.fromkeys(c for m in table.moves.values() for c in m)
    after = {c: [place[s if s in table.stops else table.moves.get(s, {}).get(c, s)] for s in states] for c in statuses}
    return states, after


def compose(first: Column, then: Column, states: int) -> Column:
    """The map that does what ``first`` and ``then`` do one after the other; maps of up to 16 states are longs, others arrays."""
    if states > PACKED_STATES:
        return F.transform(first, lambda s: F.get(then, s))
    out = None
    for k in range(states):
        at = F.shiftright(first, 4 * k).bitwiseAND(F.lit(15))
        to = F.call_function("shiftright", then, (at * 4).cast("int")).bitwiseAND(F.lit(15))
        part = F.shiftleft(to, 4 * k)
        out = part if out is None else out.bitwiseOR(part)
    return out


def _as_map(after: list[int]) -> Column:
    if len(after) > PACKED_STATES:
        return F.array(*map(F.lit, after))
    packed = sum(s << (4 * k) for k, s in enumerate(after))
    return F.lit(packed - (1 << 64) if packed >= 1 << 63 else packed).cast("bigint")


def cut(records: DataFrame, n: int, size: int) -> DataFrame:
    """``records`` (``n`` of them) in ranges of about ``size`` by window, time and line; ``part`` numbers them in order."""
    # A number of its own, since Spark would join ranges that have few bytes.
    return records.repartitionByRange(n // size + 1, *RUN, "ts", "line_no").withColumn("part", F.spark_partition_id())


def situations_by_table(log: DataFrame, start, stop, table: Table, earliest_time=None, crowded: int = CROWDED) -> DataFrame:
    """``node_path, run_date, situation`` by a transition table of the caller.

    A status is a map of states to states, and maps compose associatively. So a window with very many records is cut
    into ranges of (time, line), each is composed to one map by itself, and these few maps are composed in order.
    A window with fewer is composed at once. Whatever the size, what is gathered for a task is bounded.
    """
    states, after = _maps(table)
    n = len(states)
    placed = assign_run_window(status_changes(log), start, stop, earliest_time)
    status = F.col("command")
    step = None
    for name, moves in after.items():
        step = F.when(status == name, _as_map(moves)) if step is None else step.when(status == name, _as_map(moves))
    nothing = calendar(log, start, stop).withColumn("situation", F.lit(table.initial))
    if step is None:
        return nothing
    steps = placed.filter(status.isin(*after)).select(*RUN, "ts", "line_no", step.alias("m"))
    identity = _as_map(list(range(n)))

    def composed(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        listed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, "m"))).alias("w"))
        return listed.select(*keys, F.aggregate("w", identity, lambda f, x: compose(f, x["m"], n)).alias("m"))

    # At most a row for every ``crowded`` records.
    hot = steps.groupBy(*RUN).count().filter(F.col("count") > crowded)
    n_hot = hot.agg(F.sum("count")).first()[0]
    if not n_hot:
        whole = composed(steps, list(RUN), ["ts", "line_no"])
    else:
        parts = composed(cut(steps.join(hot, list(RUN), "left_semi"), n_hot, crowded), [*RUN, "part"], ["ts", "line_no"])
        whole = composed(steps.join(hot, list(RUN), "left_anti"), list(RUN), ["ts", "line_no"]).unionByName(composed(parts, list(RUN), ["part"]))
    end = F.get("m", F.lit(0)) if n > PACKED_STATES else F.col("m").bitwiseAND(F.lit(15))
    names = F.array(*map(F.lit, states))
    folded = whole.select(*RUN, F.get(names, end.cast("int")).alias("situation"))
    return calendar(log, start, stop).join(folded, list(RUN), "left").withColumn("situation", F.coalesce("situation", F.lit(table.initial)))


def situations_by_function(log: DataFrame, start, stop, step: Callable[[str, str], str], initial: str = "Initial", stops=(), earliest_time=None) -> DataFrame:
    """``node_path, run_date, situation`` by ``step(state, status)``, for machines that no table can state.

    Windows are dealt by hash and sorted by Spark, which spills; Python goes over the sorted rows in Arrow batches and
    carries one state, so no window has to fit into memory. A table is to be preferred: it needs no Python.
    """
    placed = assign_run_window(status_changes(log), start, stop, earliest_time)
    ordered = placed.select(*RUN, "ts", "line_no", "command").repartition(*RUN).sortWithinPartitions(*RUN, "ts", "line_no").select(*RUN, "command")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, out = None, initial, []
        for f in frames:
            for node, day, status in zip(f["node_path"].tolist(), f["run_date"].tolist(), f["command"].tolist(), strict=True):
                if (node, day) != key:
                    if key is not None:
                        out.append((*key, state))
                    key, state = (node, day), initial
                if state not in stops:
                    state = step(state, status)
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=[*RUN, "situation"])
                out = []
        if key is not None:
            out.append((*key, state))
        if out:
            yield pd.DataFrame(out, columns=[*RUN, "situation"])

    found = ordered.mapInPandas(run, "node_path string, run_date date, situation string")
    return calendar(log, start, stop).join(found, list(RUN), "left").withColumn("situation", F.coalesce("situation", F.lit(initial)))


def node_table(found: DataFrame, target: str = "Complete") -> DataFrame:
    """Points and periods of each day's run; all null unless it reached ``target``."""
    hit = F.col("situation") == target
    points = {c: F.when(hit, F.col(f"tp_{c}")) for c in ("submitted", "active", "complete", "aborted")}
    spans = {"in_all": ("submitted", "complete"), "in_submitted": ("submitted", "active"), "in_active": ("active", "complete")}
    periods = []
    for name, (a, b) in spans.items():
        both = points[a].isNotNull() & points[b].isNotNull()
        periods += [
            F.when(both, micros_between(points[a], points[b])).alias(f"time_period_{name}"),
            F.when(both, points[a]).alias(f"time_period_{name}_start"),
            F.when(both, points[b]).alias(f"time_period_{name}_end"),
        ]
    return found.select(
        "node_path", "run_date", "run_key", F.col("run_date").cast("timestamp_ntz").alias("start_time"), "situation",
        *[p.alias(f"time_point_{c}") for c, p in points.items()], *periods,
    )
