import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from runledger import queries
from runledger.functions import format_clock
from runledger.operators import daily, nodes, reports, runs, versions
from runledger.sources import grammar, ingest, sinks

LOG = "node_path string, record_date date, ts timestamp_ntz, line_no long, command string, info string"


def log(spark, rows):
    """Rows of ``(path, 'day hour:minute', command[, info])`` of January 2024."""
    out = []
    for k, (path, when, command, *info) in enumerate(rows):
        day, clock = when.split()
        ts = dt.datetime.fromisoformat(f"2024-01-{int(day):02d} {clock}")
        out.append((path, ts.date(), ts, k, command, info[0] if info else None))
    return spark.createDataFrame(out, LOG)


def random_log(spark, seed, nodes_=6, n=400):
    rng = random.Random(seed)
    words = ("queued", "submitted", "active", "complete", "aborted", "suspend")
    return log(spark, sorted(((f"/s/n{rng.randrange(nodes_)}", f"{rng.randrange(1, 9):02d} {rng.randrange(24):02d}:00", rng.choice(words)) for _ in range(n)), key=lambda r: r[1]))


def clocks(*texts):
    out = []
    for t in texts:
        h, m, s = t.split(":")
        out.append((int(h) * 3600 + int(m) * 60 + int(s)) * 1_000_000)
    return out


# ---- trimmed means -------------------------------------------------------------------------------------------------


def brute_trimmed(values, ratio):
    values = sorted(v for v in values if v is not None)
    k = int(len(values) * ratio)
    kept = values[k : len(values) - k]
    return sum(kept) // len(kept) if kept else None


@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.25, 0.49])
def test_trimmed_mean_equals_brute_force(spark, ratio):
    rng = random.Random(4)
    groups = {f"k{n}": [rng.choice([None, 5, rng.randrange(10**8)]) for _ in range(n)] for n in (1, 2, 3, 4, 5, 40, 333)}
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    got = reports.trimmed_mean(spark.createDataFrame(rows, "k string, v long"), ["k"], "v", ratio).collect()
    want = {k: brute_trimmed(vs, ratio) for k, vs in groups.items() if any(v is not None for v in vs)}
    assert {r.k: r.trimmed_mean for r in got} == want


# Published sample outputs of ten and seven days, and their means.
STARTS = "04:36:51 04:37:33 04:38:30 04:38:01 04:37:40 04:37:29 04:37:40 04:38:29 04:37:35 04:37:28"
ENDS = "05:39:09 05:47:03 05:40:24 05:50:08 05:48:27 05:43:24 05:43:01 05:49:52 05:39:51 05:42:19"
POINTS = "22:39:44 23:04:29 22:37:49 22:40:37 22:53:59 22:41:17 22:47:47 22:43:02 22:40:50 22:41:33"
WEEK = "05:50:38 06:00:40 05:50:06 06:22:54 05:44:59 06:15:17 06:18:29"


def test_goldens(spark):
    rows = [("/a", a, b) for a, b in zip(clocks(*STARTS.split()), clocks(*ENDS.split()))]
    periods = spark.createDataFrame(rows, "node_path string, start_clock long, end_clock long")
    got = reports.time_period_summary(periods).select(format_clock(F.col("start_mean")).alias("s"), format_clock(F.col("end_mean")).alias("e")).first()
    assert (got.s, got.e) == ("0 days 04:37:39.666666", "0 days 05:44:06.333333")
    for texts, mean, trimmed in (
        (POINTS, "0 days 22:45:06.700000", "0 days 22:42:31"),
        (WEEK, "0 days 06:03:17.571428", "0 days 06:03:02"),
    ):
        points = spark.createDataFrame([("/a", v) for v in clocks(*texts.split())], "node_path string, clock long")
        got = reports.time_point_summary(points).select(format_clock(F.col("mean")).alias("m"), format_clock(F.col("trimmed_mean")).alias("t")).first()
        assert (got.m, got.t) == (mean, trimmed)


def test_summaries_ask_for_their_columns(spark):
    empty = log(spark, [("/a", "1 00:00", "queued")])
    with pytest.raises(ValueError):
        reports.time_point(empty, "queued", "2024-01-01", "2024-01-02")
    with pytest.raises(ValueError):
        reports.time_point_summary(empty)
    with pytest.raises(ValueError):
        reports.time_period_summary(empty)


# ---- machines ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("machine,table", [(runs.TASK, runs.TASK_TABLE), (runs.FAMILY, runs.FAMILY_TABLE)])
def test_windows_equal_the_fold(spark, machine, table):
    records = random_log(spark, 7)
    by_windows = runs.situations(records, "2024-01-01", "2024-01-12", machine).select("node_path", "run_date", "situation")
    by_table = runs.situations_by_table(records, "2024-01-01", "2024-01-12", table)
    assert sorted(map(tuple, by_windows.collect())) == sorted(map(tuple, by_table.collect()))


def test_a_machine_may_be_a_function(spark):
    records, table = random_log(spark, 8, n=120), runs.TASK_TABLE
    step = lambda state, status: table.moves[state].get(status, state)
    got = runs.situations_by_function(records, "2024-01-01", "2024-01-12", step, stops=("Complete",))
    want = runs.situations_by_table(records, "2024-01-01", "2024-01-12", table)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_task_runs(spark):
    rows = [
        ("/a", "1 01:00", "complete"),  # the tail of yesterday's run
        ("/a", "1 02:00", "submitted"), ("/a", "1 03:00", "active"), ("/a", "1 04:00", "aborted"),
        ("/a", "1 05:00", "submitted"), ("/a", "1 05:00", "active"), ("/a", "2 00:30", "complete"), ("/a", "2 00:40", "aborted"),
        ("/a", "4 00:10", "queued"), ("/a", "4 00:20", "suspend"),
    ]
    got = {r.run_date.day: r for r in runs.situations(log(spark, rows), "2024-01-01", "2024-01-06").collect()}
    assert {d: r.situation for d, r in got.items()} == {1: "Complete", 2: "Initial", 3: "Queued", 4: "Queued", 5: "Initial"}
    assert got[1].tp_submitted == dt.datetime(2024, 1, 1, 5) and got[1].tp_complete == dt.datetime(2024, 1, 2, 0, 30)
    assert got[1].tp_aborted == dt.datetime(2024, 1, 1, 4) and got[1].run_key == "2024010100"
    assert got[5].n_records == 0
    table = {r.run_date.day: r for r in runs.node_table(runs.situations(log(spark, rows), "2024-01-01", "2024-01-06")).collect()}
    assert table[1].time_period_in_all == (19 * 3600 + 1800) * 10**6 and table[1].time_period_in_submitted == 0
    assert table[4].time_point_submitted is None and table[4].situation == "Queued"


def test_earliest_time(spark):
    rows = [("/a", "1 01:00", "submitted"), ("/a", "1 01:10", "active"), ("/a", "1 01:20", "complete"), ("/a", "1 20:00", "submitted"), ("/a", "1 21:00", "active"), ("/a", "2 02:00", "complete")]
    got = runs.situations(log(spark, rows), "2024-01-01", "2024-01-02", earliest_time="12:00").first()
    assert got.tp_submitted == dt.datetime(2024, 1, 1, 20) and got.tp_complete == dt.datetime(2024, 1, 2, 2)


def test_family_runs(spark):
    rows = [("/f", "1 01:00", "queued"), ("/f", "1 02:00", "submitted"), ("/f", "1 03:00", "aborted"), ("/f", "1 04:00", "submitted"), ("/f", "1 05:00", "complete")]
    loose = runs.situations(log(spark, rows), "2024-01-01", "2024-01-02", runs.FAMILY).first()
    assert loose.situation == "Complete" and loose.tp_submitted.hour == 2 and loose.tp_aborted.hour == 3
    strict = runs.situations(log(spark, rows), "2024-01-01", "2024-01-02", runs.STRICT_FAMILY).first()
    assert strict.situation == "Error" and strict.tp_complete is None


# ---- daily situations ----------------------------------------------------------------------------------------------


def test_daily_tasks(spark):
    rows = [
        ("/e", "1 01:00", "submitted"), ("/e", "1 02:00", "aborted"), ("/e", "1 03:00", "submitted"), ("/e", "1 04:00", "active"), ("/e", "1 05:00", "complete"),
        ("/r", "1 01:00", "complete"), ("/r", "1 01:00", "complete", "by rule"),
        ("/n", "1 01:00", "submitted"), ("/n", "1 02:00", "complete"), ("/n", "1 03:00", "active"), ("/n", "1 23:00", "complete"),
        ("/u", "1 01:00", "submitted"), ("/u", "1 02:00", "complete"), ("/u", "1 03:00", "active"),
        ("/q", "1 01:00", "queued"),
    ]
    got = {r.node_path: r for r in daily.task_situation_daily(log(spark, rows)).collect()}
    assert {p: r.situation for p, r in got.items()} == {"/e": "error", "/r": "complete by rule", "/n": "normal", "/u": "unknown"}
    assert (got["/n"].in_all_days, got["/n"].in_all_seconds, got["/n"].in_submitted_seconds) == (0, 22 * 3600, 2 * 3600)
    assert got["/e"].submitted is None


def test_daily_families(spark):
    rows = [
        ("/a", "1 01:00", "submitted"), ("/a", "1 02:00", "active"), ("/a", "1 03:00", "complete"),
        ("/b", "1 01:00", "complete"), ("/b", "1 02:00", "submitted"), ("/b", "1 03:00", "active"), ("/b", "2 04:00", "complete"), ("/b", "2 05:00", "aborted"),
        ("/c", "1 01:00", "complete"), ("/c", "1 02:00", "submitted"), ("/c", "2 01:00", "aborted"),
        ("/d", "1 01:00", "active"), ("/d", "1 02:00", "complete"),
        ("/g", "1 01:00", "complete"), ("/g", "1 02:00", "submitted"), ("/g", "3 03:00", "complete"),
    ]
    got = {(r.node_path, r.record_date.day): r for r in daily.family_situation_daily(log(spark, rows)).collect()}
    want = {("/a", 1): "normal", ("/b", 1): "normal", ("/b", 2): "error", ("/c", 1): "error", ("/c", 2): "error", ("/d", 1): "unknown", ("/g", 1): "unknown", ("/g", 3): "unknown"}
    assert {k: r.situation for k, r in got.items()} == want
    assert got["/b", 1].in_all_days == 1 and got["/b", 1].in_all_seconds == 2 * 3600


# ---- nodes ---------------------------------------------------------------------------------------------------------


def test_node_types(spark):
    paths = ["/s", "/s/f/t", "/s/f", "/s/f/t/alias0", "/s/g/alias0", "/s/g", "/s/f/t:limit", "/x/y", "/w/alias1/z", "/w", "/w/v"]
    asked = [*paths, "/", "/x", "nothing", "/s/absent", "/w/alias1"]
    records = log(spark, [(p, "1 00:00", "queued") for p in paths])
    got = {r.node_path: r.node_type for r in nodes.node_types(records, spark.createDataFrame([(p,) for p in asked], "node_path string")).collect()}
    assert got == {
        "/s": "suite", "/s/f/t": "task", "/s/f": "family", "/s/f/t/alias0": "task", "/s/g/alias0": "task", "/s/g": "task", "/s/f/t:limit": "non-task",
        "/x/y": "task", "/w/alias1/z": "task", "/w": "suite", "/w/v": "task", "/": "root", "/x": "unknown", "nothing": "unknown", "/s/absent": "unknown", "/w/alias1": "unknown",
    }
    tree = {r.path: (r.parent, r.name, r.depth, r.is_leaf) for r in nodes.node_tree(records.filter("node_path like '/x%'")).collect()}
    assert tree == {"/x": ("/", "x", 1, False), "/x/y": ("/x", "y", 2, True)}


# ---- files ---------------------------------------------------------------------------------------------------------


@pytest.fixture
def log_files(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    for f in range(3):
        lines = ["head of the file"]
        for k in range(1, 2000):
            day = 1 + k // 500
            lines.append({0: "", 1: "no mark", 2: "# ERR undated"}.get(k % 50, f"# LOG:[1:{k % 60}:0 {day}.1.2024] complete:/s{f}/n{k % 9}"))
        (folder / f"{f}.log").write_text("\n".join(lines) + "\n")
    return folder


def test_line_numbers_over_blocks(spark, log_files):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = ingest.with_line_no(ingest.read_lines(spark, str(log_files)))
        got = {(r.file_path[-5:], r.line_no): r.value for r in lines.collect()}
        assert lines.select("block").distinct().count() > 5
        for f in range(3):
            text = (log_files / f"{f}.log").read_text().split("\n")[:-1]
            assert [got[f"{f}.log", k] for k in range(len(text))] == text
        dated = ingest.with_log_date(grammar.parse_sms(lines)).collect()
        for f in range(3):
            day = dt.date(2024, 1, 1)
            for r in sorted((r for r in dated if r.file_path.endswith(f"{f}.log")), key=lambda r: r.line_no):
                day = r.record_date or day
                assert r.log_date == day
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_loads(spark, log_files, tmp_path):
    out = str(tmp_path / "table")
    ingest.ingest_logs(spark, str(log_files / "0.log"), "me", "r0", "2024010101", out)
    ingest.ingest_logs(spark, str(log_files / "1.log"), "me", "r1", "2024010101", out)
    one = ingest.record_table(spark, out, "me", "r0")
    assert one.filter("line_no = 0").count() == 1  # the head line stays, though it has no mark
    whole = one.count()
    assert whole == sum(1 for k in range(1, 2000) if k % 50 not in (0, 1)) + 1
    records = ingest.parse_file(spark, str(log_files / "0.log"), "me", "r0", "2024010101")
    assert ingest.incremental_rows(records, one).count() == 0
    assert ingest.incremental_rows(records, one.filter("line_no < 100")).count() == one.filter("line_no > 99").count()
    ingest.ingest_range(spark, str(log_files / "0.log"), "me", "r0", "2024010101", "2024-01-02", "2024-01-03", out)
    assert ingest.record_table(spark, out, "me", "r0").count() == whole and ingest.record_table(spark, out, "me", "r1").count() == whole
    undated = ingest.record_table(spark, out, "me", "r0").filter("log_date = '2024-01-02' and record_date is null")
    assert undated.count() > 0
    lines = grammar.parse_sms(ingest.with_line_no(ingest.read_lines(spark, str(log_files))))
    assert {r.line_count for r in ingest.log_file_info(lines).collect()} == {2000}


def test_ecflow_lines(spark):
    lines = {
        "LOG:[22:36:46 13.2.2020]  submitted: /s/18/m/f job_size:5267": ("LOG", dt.datetime(2020, 2, 13, 22, 36, 46), "submitted", "/s/18/m/f", "job_size:5267"),
        "MSG:[22:36:47 13.2.2020] chd:init /s/18/m/f": ("MSG", dt.datetime(2020, 2, 13, 22, 36, 47), None, None, None),
        "LOG:[1:2:3 4.5.2020]  complete: /s": ("LOG", dt.datetime(2020, 5, 4, 1, 2, 3), "complete", "/s", None),
        "junk": (None, None, None, None, None), "": (None, None, None, None, None), "LOG:[x]  active: /a": ("LOG", None, "active", "/a", None),
    }
    got = grammar.parse_ecflow(spark.createDataFrame([(v,) for v in lines], "value string")).collect()
    assert {r.value: (r.record_type, r.ts, r.command, r.node_path, r.info) for r in got} == lines


# ---- versions, keys, sinks -----------------------------------------------------------------------------------------


def test_a_day_may_have_any_number_of_versions(spark):
    files = [(1, f"head {k}", dt.date(2024, 1, 1), k) for k in range(130)] + [(1, "next day", dt.date(2024, 1, 2), 500)]
    schema = "repo_id long, head_line string, version_day date, seen_at long"
    found = versions.register_versions(spark.createDataFrame(files, schema))
    ids = {r.head_line: r.version_id for r in found.collect()}
    assert len(set(ids.values())) == 131
    assert (ids["head 6"], ids["head 99"], ids["next day"]) == ("2024010107", "20240101100", "2024010201")
    again = versions.register_versions(spark.createDataFrame([*files, (1, "late", dt.date(2024, 1, 1), 900)], schema), found)
    assert {r.head_line: r.version_seq for r in again.collect()}["late"] == 131 and again.count() == 132
    asked = versions.resolve_version(spark.createDataFrame([(1, "head 6"), (1, "unheard")], "repo_id long, head_line string"), found)
    assert {r.head_line: r.version_id for r in asked.collect()} == {"head 6": "2024010107", "unheard": None}


def test_sinks(spark, tmp_path):
    rows = [("/a", "1 01:00", "submitted"), ("/a", "1 02:00", "active"), ("/a", "1 03:00", "complete"), ("/b", "1 01:00", "submitted"), ("/b", "1 02:00", "active"), ("/b", "1 05:00", "complete")]
    report = reports.model_run_report(log(spark, rows), "2024-01-03", days=2)
    sinks.write_report_csv(report, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns[0] == "run_key" and back.count() == 2
    line = daily.run_timeline(log(spark, rows), "2024-01-01", "2024-01-03")
    sinks.export_timeline_json(line, str(tmp_path / "json"))
    assert (tmp_path / "json" / "run_date=2024-01-01").is_dir() and spark.read.json(str(tmp_path / "json")).count() == 2


# ---- plans ---------------------------------------------------------------------------------------------------------


def test_plans_have_no_python_and_no_cross_join(spark):
    for name, query in queries.QUERIES.items():
        if name.startswith("stream_"):
            continue
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_date_range_reaches_the_scan(spark, tmp_path):
    random_log(spark, 1).write.parquet(str(tmp_path / "log"))
    rows = spark.read.parquet(str(tmp_path / "log")).filter(queries.in_date_range(F.col("record_date"), "2024-01-02", "2024-01-03"))
    plan = rows.groupBy("node_path").count()._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(record_date" in plan and "ReadSchema: struct<node_path:string,record_date:date>" in plan
