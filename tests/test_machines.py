import random

import pytest
from pyspark.sql import functions as F

from runledger.operators import runs

from .test_log import log, random_log

SPAN = ("2024-01-01", "2024-01-12")


def rows(frame):
    return sorted((r.node_path, str(r.run_date), r.situation) for r in frame.select("node_path", "run_date", "situation").collect())


def folded(records, table):
    """One status after the other, in plain Python."""
    out = {}
    for r in sorted(runs.assign_run_window(runs.status_changes(records), *SPAN).collect(), key=lambda r: (r.ts, r.line_no)):
        state = out.get((r.node_path, str(r.run_date)), table.initial)
        if state not in table.stops:
            state = table.moves.get(state, {}).get(r.command, state)
        out[r.node_path, str(r.run_date)] = state
    return sorted((r.node_path, str(r.run_date), out.get((r.node_path, str(r.run_date)), table.initial)) for r in runs.calendar(records, *SPAN).collect())


def any_table(seed, states):
    rng = random.Random(seed)
    names = [f"s{k}" for k in range(states)]
    words = ["queued", "submitted", "active", "complete", "aborted"]
    moves = {s: {c: rng.choice(names) for c in words if rng.random() < 0.7} for s in names}
    return runs.Table(moves, tuple(rng.sample(names, 1)), names[0])


@pytest.mark.parametrize("states", [2, 8, 16, 17, 40])
@pytest.mark.parametrize("crowded", [10**9, 5])
def test_any_table_equals_a_plain_fold(spark, states, crowded):
    table, records = any_table(states, states), random_log(spark, states, n=300)
    assert rows(runs.situations_by_table(records, *SPAN, table, crowded=crowded)) == folded(records, table)


@pytest.mark.parametrize("table", [runs.TASK_TABLE, runs.FAMILY_TABLE, runs.Table({}, ())])
def test_a_hot_node_is_cut(spark, table):
    rng = random.Random(3)
    words = ["queued", "submitted", "active", "complete", "aborted"]
    many = [("/hot", f"2 {k // 3600 % 24:02d}:{k // 60 % 60:02d}:{k % 60:02d}", rng.choice(words[:3])) for k in range(3000)]
    few = [(f"/n{k}", f"{1 + k % 5} 10:00", rng.choice(words)) for k in range(60)]
    records = log(spark, many + few)
    want = folded(records, table)
    assert rows(runs.situations_by_table(records, *SPAN, table, crowded=100)) == want
    assert rows(runs.situations_by_table(records, *SPAN, table)) == want


def test_what_a_task_gathers_is_bounded(spark):
    """A window with a third of all records is spread over tasks before anything is gathered."""
    hot = spark.range(40_000).select(F.lit("/hot").alias("node_path"), "id")
    rest = spark.range(80_000).select(F.concat(F.lit("/n"), (F.col("id") % 500).cast("string")).alias("node_path"), "id")
    names = F.array(*map(F.lit, ["queued", "submitted", "active", "aborted"]))
    ts = F.expr("timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, 0, id % 80000)")
    records = hot.unionByName(rest).select("node_path", F.lit("2024-01-02").cast("date").alias("record_date"), ts.alias("ts"), F.col("id").alias("line_no"), F.get(names, F.pmod(F.hash("id"), F.lit(4))).alias("command"))
    placed = runs.assign_run_window(runs.status_changes(records), *SPAN)
    parts = runs.cut(placed.filter("node_path = '/hot'"), 80_000, 1000).groupBy("part").agg(F.count("*").alias("n"))
    assert parts.agg(F.max("n")).first()[0] < 4000
    by_table = runs.situations_by_table(records, *SPAN, runs.TASK_TABLE, crowded=1000).select("node_path", "run_date", "situation")
    by_windows = runs.situations(records, *SPAN).select("node_path", "run_date", "situation")
    assert by_table.exceptAll(by_windows).isEmpty() and by_windows.exceptAll(by_table).isEmpty()


def test_functions_fold_over_batches(spark):
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        records, table = random_log(spark, 4, n=300), runs.TASK_TABLE
        got = runs.situations_by_function(records, *SPAN, lambda s, c: table.moves[s].get(c, s), stops=table.stops)
        assert rows(got) == folded(records, table)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
