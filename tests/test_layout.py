import datetime as dt
import json
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from runledger.operators import nodes, reports
from runledger.sources import deltas, layout, sinks

from .test_log import log, random_log


def test_bits_are_interleaved(spark):
    rng = random.Random(1)
    rows = [tuple(rng.randrange(1 << 20) for _ in range(3)) for _ in range(200)]
    got = spark.createDataFrame(rows, "a long, b long, c long").select("a", "b", "c", layout.interleave(F.col("a"), F.col("b"), F.col("c")).alias("z")).collect()
    for r in got:
        assert r.z == sum(((r.a >> k & 1) << (3 * k + 2)) | ((r.b >> k & 1) << (3 * k + 1)) | ((r.c >> k & 1) << (3 * k)) for k in range(20))


def test_ranks_follow_the_order(spark):
    cuts = ["b", "d", "d/x", "k"]
    got = spark.createDataFrame([(v,) for v in ["a", "b", "c", "d", "d/w", "d/x", "j", "k", "z", None]], "v string").select("v", layout.rank(F.col("v"), cuts).alias("r")).collect()
    assert {r.v: r.r for r in got} == {"a": 0, "b": 1, "c": 1, "d": 2, "d/w": 2, "d/x": 3, "j": 3, "k": 4, "z": 4, None: 0}


def groups_read(path, column, low, high):
    """Row groups whose range admits a value in ``[low, high]``, and all."""
    read = every = 0
    for f in path.glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        place = meta.schema.names.index(column)
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(place).statistics
            every += 1
            read += stats.min <= high and stats.max >= low
    return read, every


def test_each_predicate_skips_row_groups(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    words = ["queued", "submitted", "active", "complete", "aborted", "suspend", "force", "alter"]
    rng = random.Random(2)
    rows = [(start + dt.timedelta(minutes=k), rng.choice(words), f"/s/n{rng.randrange(64):02d}", k) for k in range(20_000)]
    records = spark.createDataFrame(rows, "ts timestamp_ntz, command string, node_path string, line_no long")
    layout.write_clustered(records, str(tmp_path / "z"), file_rows=400)
    back = spark.read.parquet(str(tmp_path / "z"))
    assert back.columns == records.columns and back.exceptAll(records).isEmpty() and records.exceptAll(back).isEmpty()
    day = groups_read(tmp_path / "z", "ts", start + dt.timedelta(days=3), start + dt.timedelta(days=4))
    command = groups_read(tmp_path / "z", "command", "active", "active")
    node = groups_read(tmp_path / "z", "node_path", "/s/n17", "/s/n17")
    for read, every in (day, command, node):
        assert every >= 40 and 0 < read <= 0.6 * every, (day, command, node)
    layout.write_clustered(records.limit(0), str(tmp_path / "empty"))


# ---- keyed store ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "pattern,want",
    [("^01ab.*", ("by_key", "01ab")), ("^[0-7].*-659[0-9a-f]{5}$", ("by_time", "659")), ("^0*1", ("by_key", "")), ("abc", ("by_key", "")),
     ("-65a", ("by_time", "65a")), ("^12|34", ("by_key", "")), ("^1234-65", ("by_key", "1234-65")), ("^a.-6{2}", ("by_key", "a")), ("[0-9a-f]+-[0-9]", ("by_key", ""))],
)
def test_ranges_of_patterns(pattern, want):
    assert sinks.key_range(pattern) == want


def test_scans_open_the_files_of_their_range(spark, tmp_path):
    records = random_log(spark, 2, n=3000).withColumn("version_id", F.date_format("record_date", "yyyyMMdd"))
    keyed = sinks.export_keyed(records).select("row_key", "line_no")
    sinks.write_sorted_keys(keyed, str(tmp_path / "keyed"), file_rows=200)
    keys = sorted(r.row_key for r in keyed.collect())
    for pattern in ("^0", "^ab", f"^{keys[500]}$", "^[0-7].*-659[0-9a-f]{5}$", f"-{keys[9][-8:]}$", "a.*f", "^zz", "^[ab]|0$"):
        got = sinks.scan_sorted(spark, str(tmp_path / "keyed"), pattern)
        want = sinks.scan_by_key(keyed, pattern)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    files = lambda df: len(df.inputFiles())
    every = files(spark.read.parquet(str(tmp_path / "keyed/by_key")))
    assert every > 10 and files(sinks.scan_sorted(spark, str(tmp_path / "keyed"), f"^{keys[500]}$")) <= 2
    assert files(sinks.scan_sorted(spark, str(tmp_path / "keyed"), "^a")) < every / 4
    ends = spark.read.parquet(str(tmp_path / "keyed/by_key_files")).orderBy("low").collect()  # files follow each other
    assert all(a.high <= b.low for a, b in zip(ends, ends[1:], strict=False)) and sum(e.n for e in ends) == len(keys)


# ---- nested trees, maintained means --------------------------------------------------------------------------------


def test_nested_trees(spark):
    paths = ["/s", "/s/a", "/s/a/x", '/s/a/"q"', "/s/b", "/t/deep/er/still", "/s/a/x/y"]
    edges = nodes.node_tree(log(spark, [(p, "1 00:00", "queued") for p in paths]))
    got = {r.suite: r for r in nodes.nested_trees(edges).collect()}

    def leaf(name):
        return {"name": name, "nodes": 1, "leaves": 1, "children": []}

    def node(name, *children):
        return {"name": name, "nodes": 1 + sum(c["nodes"] for c in children), "leaves": sum(c["leaves"] for c in children), "children": list(children)}

    assert json.loads(got["/s"].document) == node("s", node("a", leaf('"q"'), node("x", leaf("y"))), leaf("b"))
    assert json.loads(got["/t"].document) == node("t", node("deep", node("er", leaf("still"))))
    assert (got["/s"].n_nodes, got["/s"].n_leaves) == (6, 3)
    assert nodes.nested_trees(edges.limit(0)).collect() == []


def test_maintained_means_equal_a_new_report(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(deltas, "FOLD", 3)
    rng = random.Random(6)
    store, before, clocks = deltas.DeltaCounts(spark, str(tmp_path / "means")), None, ["start_clock", "end_clock"]
    for batch in range(5):
        rows = [(f"/n{n}", rng.choice([None, rng.randrange(50) * 10**6]), rng.choice([None, rng.randrange(10**9)])) for n in range(3) for _ in range(batch * 4 % 11)]
        after = spark.createDataFrame(rows, "node_path string, start_clock long, end_clock long")
        changes = deltas.value_changes(before, after, ["node_path"], clocks)
        assert store.add("report", batch, changes) and not store.add("report", batch, changes)
        got = sorted(map(tuple, reports.summary_of_counts(store.read()).collect()))
        assert got == sorted(map(tuple, reports.time_period_summary(after).collect()))
        before = after
    assert len(store._last()["attempts"]) < 3


def test_a_task_writes_many_small_files(spark, tmp_path):
    """Thousands of files are not as many ranges, each of which would cost the driver samples and results."""
    keyed = spark.range(20_000).select(sinks.row_key(F.lit("v"), F.col("id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id % 50000, 0)")).alias("row_key"), F.col("id").alias("line_no"))
    spark.sparkContext.setJobGroup("sorted", "sorted")
    try:
        sinks.write_sorted_keys(keyed, str(tmp_path / "keyed"), file_rows=50)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("sorted") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s is not None) <= 64
    for order in ("by_key", "by_time"):
        ends = spark.read.parquet(str(tmp_path / f"keyed/{order}_files")).orderBy("low").collect()
        assert len(ends) == 400 and max(e.n for e in ends) <= 50 and sum(e.n for e in ends) == 20_000
        assert all(a.high <= b.low for a, b in zip(ends, ends[1:], strict=False))
    got = sinks.scan_sorted(spark, str(tmp_path / "keyed"), "^[0-7].*-6592[0-9a-f]{4}$")
    want = sinks.scan_by_key(keyed, "^[0-7].*-6592[0-9a-f]{4}$")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 100
