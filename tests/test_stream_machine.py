import random

import pytest
from pyspark.sql import functions as F

from runledger.operators import runs
from runledger.streaming import machine

from .test_log import LOG, random_log

SPAN = ("2024-01-01", "2024-01-12")
COLUMNS = ["node_path", "run_date", "situation", "n_records", "tp_submitted", "tp_active", "tp_complete", "tp_aborted", "run_key"]


@pytest.mark.parametrize("rules", [runs.TASK, runs.FAMILY, runs.STRICT_FAMILY])
@pytest.mark.parametrize("size", [4, 50])
def test_one_event_at_a_time_equals_windows(spark, rules, size):
    """Events in random order; windows that say that they cannot be right are the only ones that may be wrong."""
    records = random_log(spark, 6, n=300)
    placed = runs.assign_run_window(runs.status_changes(records), *SPAN).select("*", machine._micros("ts").alias("at")).collect()
    random.Random(size).shuffle(placed)
    stored = {}
    for r in placed:
        window = machine.Window(rules, stored.get((r.node_path, r.run_date)), size)
        window.add(r.at, r.line_no, r.command)
        window.result()
        stored[r.node_path, r.run_date] = window.stored(0)
        assert len(window.buffer) <= size
    want = {(r.node_path, r.run_date): r for r in runs.situations(records, *SPAN, rules).select(*COLUMNS, *[machine._micros(c).alias(f"us_{c}") for c in COLUMNS[4:8]]).collect()}
    disordered = 0
    for key, state in stored.items():
        window = machine.Window(rules, state, size)
        disordered += window.disordered
        if not window.disordered:
            name, *times = window.result()
            times[2] = times[2] if name == "Complete" else None
            assert (name, window.n, *times) == (want[key].situation, want[key].n_records, *want[key][9:])
    assert disordered if size == 4 else not disordered


def test_stream_with_late_repeated_and_disordered_events(spark, tmp_path):
    records = random_log(spark, 7, nodes_=3, n=240)
    source, table, updates, mark = (str(tmp_path / x) for x in ("in", "table", "updates", "mark"))
    seen = []
    for part in (2, 0, 1, 0):  # the last part is sent again
        records.filter(f"line_no % 3 = {part}").write.mode("append").parquet(source)
        stream = spark.readStream.schema(LOG).parquet(source)
        for q in machine.stream_machine(stream, table, updates, mark, buffer=8):
            q.awaitTermination()
            if "stateOperators" in q.lastProgress and q.lastProgress["stateOperators"]:
                seen.append(q.lastProgress["stateOperators"][0]["numRowsUpdated"])
    got = machine.settled(spark, table, updates, *SPAN).select(COLUMNS)
    want = runs.situations(records, *SPAN).select(COLUMNS)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    rows = spark.read.parquet(updates)
    assert rows.filter("disordered").count() > 0
    # A batch writes the windows that it touches, and no others.
    late = records.filter("line_no = 5").withColumn("line_no", F.lit(9999).cast("long"))
    late.write.mode("append").parquet(source)
    for q in machine.stream_machine(spark.readStream.schema(LOG).parquet(source), table, updates, mark, buffer=8):
        q.awaitTermination()
        if q.lastProgress["stateOperators"]:
            assert q.lastProgress["numInputRows"] == 1 and q.lastProgress["stateOperators"][0]["numRowsUpdated"] <= 8
    newest = spark.read.parquet(updates).agg(F.max("batch")).first()[0]
    assert spark.read.parquet(updates).filter(f"batch = {newest}").count() == 2


def test_idle_windows_are_closed_and_taken_up_again(spark, tmp_path):
    records = random_log(spark, 9, nodes_=2, n=40)
    source, table, updates, mark = (str(tmp_path / x) for x in ("in", "table", "updates", "mark"))
    parts = [records.filter("line_no < 30"), records.filter("line_no = 30"), records.filter("line_no > 30")]
    for k, part in enumerate(parts):
        part.write.mode("append").parquet(source)
        # The watermark stays a minute behind, so timers that are due long ago fire with the next batch.
        for q in machine.stream_machine(spark.readStream.schema(LOG).parquet(source), table, updates, mark, idle_ms=-3_600_000):
            q.awaitTermination()
        assert (spark.read.parquet(updates).filter("closed").count() > 0) == (k > 0)
    got = machine.settled(spark, table, updates, *SPAN).select(COLUMNS)
    want = runs.situations(records, *SPAN).select(COLUMNS)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_windows_share_calls(spark, tmp_path):
    """The windows of a day go to Python in groups, whatever their number; records without a time or a line make their node known."""
    made = spark.range(12_000).select(
        "id", F.concat(F.lit("/s/t"), (F.col("id") % 6000).cast("string")).alias("node_path"),
        F.expr("timestamp_ntz'2024-01-03 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"),
    )
    records = made.select(
        F.col("id").alias("line_no"), F.col("ts").cast("date").alias("record_date"), "ts", "node_path",
        F.when(F.col("id") < 6000, "submitted").otherwise("active").alias("command"), F.lit(None).cast("string").alias("info"),
    )
    odd = records.limit(2).withColumns({"node_path": F.lit("/odd"), "ts": F.lit(None).cast("timestamp_ntz"), "record_date": F.lit(None).cast("date")})
    source, table, updates, mark = (str(tmp_path / x) for x in ("in", "table", "updates", "mark"))
    records.unionByName(odd).write.parquet(source)
    for q in machine.stream_machine(spark.readStream.schema(records.schema).parquet(source), table, updates, mark):
        q.awaitTermination()
        if q.lastProgress["stateOperators"]:
            rows = sum(p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress)
            assert rows <= 6 * machine.GROUPS  # a group's state and timer, on two days and on none
    got = machine.settled(spark, table, updates, *SPAN).select(COLUMNS)
    want = runs.situations(records.unionByName(odd), *SPAN).select(COLUMNS)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.filter("node_path = '/odd'").count() == 11
