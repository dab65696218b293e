import datetime as dt
import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from runledger.sources import grammar, ingest, lines, loads, storage, zones

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(d) for d in range(10)]


def sms_lines(seed, n):
    """Lines of ten days in order; some undated, some that are no records."""
    rng, out = random.Random(seed), []
    for k in range(n):
        d = DAYS[k * len(DAYS) // n]
        out.append(rng.choice([f"# LOG:[{k % 24}:{k % 60}:{k % 60} {d.day}.{d.month}.{d.year}] complete:/s/t{k % 7}"] * 8 + [f"# MSG:open {k}", "no record"]))
    return out


def write(path, rows, end="\n"):
    path.write_text("\n".join(rows) + end)


def content(frame):
    return sorted((r.version_id, r.line_no, str(r.log_date), r.raw) for r in frame.collect())


def expected(rows, version="v"):
    day, out = None, []
    first = next(d for d in map(date_of, rows) if d)
    for n, r in enumerate(rows):
        day = date_of(r) or day
        if r.startswith("#") or n == 0:
            out.append((version, n, str(day or first), r))
    return sorted(out)


def date_of(line):
    if "[" not in line:
        return None
    d, m, y = line.split("]")[0].split(" ")[2].split(".")
    return dt.date(int(y), int(m), int(d))


def test_loads_resume_and_count_once(spark, tmp_path):
    log, rows = tmp_path / "a.log", sms_lines(1, 900)
    store = loads.RecordStore(spark, str(tmp_path / "table"))
    write(log, rows[:500])
    assert store.load(str(log), "me", "r", "v", block_bytes=3000) == 500
    assert store.load(str(log), "me", "r", "v") == 0 and len(store.commits()) == 1
    assert content(store.read("me", "r")) == expected(rows[:500])
    write(log, rows, end="")
    assert store.load(str(log), "me", "r", "v", closed=False, block_bytes=3000) == 399  # the last line waits
    assert store.load(str(log), "me", "r", "v", block_bytes=3000) == 1
    assert content(store.read("me", "r")) == expected(rows)
    assert store.ends("me", "r", "v") == {str(log): {"byte": log.stat().st_size, "line": 900}}
    assert store.read("me", "other").count() == 0 and store.load(str(log), "me", "other", "v") == 900
    assert content(store.read("me", "r")) == expected(rows)


def test_a_torn_load_counts_nothing(spark, tmp_path, monkeypatch):
    log, rows = tmp_path / "a.log", sms_lines(2, 200)
    write(log, rows)
    store = loads.RecordStore(spark, str(tmp_path / "table"))
    with monkeypatch.context() as m:
        m.setattr(storage, "create_once", lambda *_: 1 / 0)  # lost after the rows are written, before they count
        with pytest.raises(ZeroDivisionError):
            store.load(str(log), "me", "r", "v")
    assert store.read().count() == 0 and storage.names(spark, str(tmp_path / "table/attempts"))
    assert store.load(str(log), "me", "r", "v") == 200
    assert content(store.read()) == expected(rows)
    assert store.sweep() == 2 and content(store.read()) == expected(rows)  # the rows and the plan of the torn one


def test_of_two_loads_at_once_one_counts(spark, tmp_path, monkeypatch):
    log, rows = tmp_path / "a.log", sms_lines(3, 100)
    write(log, rows)
    store = loads.RecordStore(spark, str(tmp_path / "table"))
    before = store.commits()
    store.load(str(log), "me", "r", "v")
    with monkeypatch.context() as m:
        m.setattr(store, "commits", lambda: before)  # what a load that began earlier has seen
        with pytest.raises(RuntimeError, match="again"):
            store.load(str(log), "me", "r", "v")
    assert content(store.read()) == expected(rows)


def test_ranges_batches_and_compaction(spark, tmp_path):
    log, rows = tmp_path / "a.log", sms_lines(4, 600)
    write(log, rows)
    store = loads.RecordStore(spark, str(tmp_path / "table"))
    day = lambda r: r[2]
    want = expected(rows)
    store.load_days(str(log), "me", "r", "v", "2024-01-03", "2024-01-05", block_bytes=5000)
    assert content(store.read()) == [r for r in want if "2024-01-03" <= day(r) < "2024-01-05"]
    store.load_days(str(log), "me", "r", "v", "2024-01-04", "2024-01-06")
    assert content(store.read()) == [r for r in want if "2024-01-03" <= day(r) < "2024-01-06"]
    store.load(str(log), "me", "r", "v")  # comes to the same lines
    assert content(store.read()) == want
    zoned = zones.zone_map(spark, str(log), grammar.parse_sms, zone_bytes=2000)
    store.load_days(str(log), "me", "r", "v", "2024-01-02", "2024-01-04", zoned)
    assert content(store.read()) == want
    store.compact()
    assert len(store.commits()) == 1 and content(store.read("me", "r")) == want
    assert store.load(str(log), "me", "r", "v") == 0
    more = sms_lines(5, 50)
    write(log, rows + more)
    assert store.load(str(log), "me", "r", "v") == 50
    days = [str(d) for *_, d, _ in expected(rows + more)]
    assert store.read().count() == len(days) and store.sweep() > 0
    batch = store.read().limit(20).withColumn("version_id", F.lit("w"))
    assert store.add(batch, "me", "r", "w", "stream", 3) and not store.add(batch, "me", "r", "w", "stream", 3)
    assert not store.add(batch, "me", "r", "w", "stream", 2) and store.add(batch, "me", "r", "w", "stream", 4)
    assert store.read().count() == len(days) + 40


def test_incremental_loads(spark, tmp_path):
    log, rows = tmp_path / "a.log", sms_lines(6, 300)
    write(log, rows)
    out = str(tmp_path / "table")
    records = ingest.parse_file(spark, str(log), "me", "r", "v")
    assert ingest.ingest_incremental(records.filter("line_no < 120"), spark, out) == 1
    assert ingest.ingest_incremental(records, spark, out) == 1
    assert ingest.ingest_incremental(records, spark, out) == 0
    assert content(ingest.record_table(spark, out, "me", "r")) == expected(rows)


def ecflow_lines(n):
    out = []
    for k in range(n):
        d = DAYS[k * len(DAYS) // n]
        out.append(f"LOG:[{k % 24}:{k % 60}:0 {d.day}.{d.month}.{d.year}]  complete: /s/t{k}" if k % 9 else "a line without a date")
    return out


def test_a_range_of_dates_reads_its_zones_alone(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    for name in ("a.log", "b.log"):
        write(folder / name, ecflow_lines(1500))
    found = zones.zone_map(spark, str(folder), zone_bytes=4000)
    found.write.parquet(str(tmp_path / "zones"))
    found = spark.read.parquet(str(tmp_path / "zones"))
    total = sum(f.stat().st_size for f in folder.iterdir())
    assert found.agg(F.sum(F.col("end_byte") - F.col("first_byte"))).first()[0] == total
    read = spark.sparkContext.accumulator(0)
    columns = ["record_date", "ts", "command", "node_path"]
    got = zones.read_days(found, "2024-01-04", "2024-01-05", bytes_read=read).select(*columns, "line_no")
    got = sorted(map(str, got.collect()))
    whole = ingest.read_ecflow_logs(spark, str(folder)).filter("record_date = '2024-01-04'")
    assert len(got) == whole.count() > 0
    assert {r.split(", line_no")[0] for r in got} == {str(r).removesuffix(")") for r in whole.select(columns).collect()}
    assert 0 < read.value < total / 5
    with (folder / "a.log").open("a") as f:
        f.write("LOG:[1:2:3 20.1.2024]  aborted: /s/late\nLOG:[1:2:4 20.1.2024]  half a li")
    grown = zones.zone_map(spark, str(folder), known=found, zone_bytes=4000)
    late = zones.read_days(grown, "2024-01-20", "2024-01-21").collect()
    assert [(r.node_path, r.line_no) for r in late] == [("/s/late", 1500)]
    assert grown.count() == found.count() + 1


def test_planned_ranges_cover_all_lines_once(spark, tmp_path):
    f = tmp_path / "a.log"
    rng = random.Random(1)
    rows = ["x" * rng.choice([0, 1, 5, 90, 700]) for _ in range(60)]
    for end in ("\n", ""):
        write(f, rows + ["last"], end)
        for block in (33, 10**6):
            ranges = lines.plan_ranges(spark, {str(f): (0, 0, f.stat().st_size)}, block)
            got = sorted((r.line_no, r.value) for r in lines.read_ranges(ranges, 3).collect())
            assert got == list(enumerate(rows + ["last"]))


def test_small_zones_share_tasks(spark, tmp_path):
    """Thousands of zones do not make thousands of tasks, in the making of the map or in a load by it; days are as a plain reading has them."""
    log, rows = tmp_path / "a.log", sms_lines(7, 3000)
    write(log, rows)

    def stages(name, run):
        spark.sparkContext.setJobGroup(name, name)
        try:
            out = run()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        tracker = spark.sparkContext.statusTracker()
        found = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(j).stageIds]
        return out, max(s.numTasks for s in found if s is not None)

    made, most = stages("map", lambda: zones.zone_map(spark, str(log), grammar.parse_sms, zone_bytes=400).collect())
    assert len(made) > 250 and most <= 16
    found = spark.createDataFrame(made, "file_path string, first_byte long, end_byte long, first_line long, lines long, first_ts timestamp_ntz, last_ts timestamp_ntz, first_day date, last_day date, start_day date")
    store = loads.RecordStore(spark, str(tmp_path / "table"))
    _, most = stages("load", lambda: store.load_days(str(log), "me", "r", "v", "2024-01-02", "2024-01-09", found))
    assert most <= 16
    want = expected(rows)
    assert content(store.read()) == [r for r in want if "2024-01-02" <= r[2] < "2024-01-09"]
    days, day = [], None
    for r in rows:
        day = date_of(r) or day
        days.append(day)
    days = [d or DAYS[0] for d in days]
    made.sort(key=lambda z: z.first_byte)
    assert [z.first_byte for z in made[1:]] + [log.stat().st_size] == [z.end_byte for z in made]
    for z in made:
        of = days[z.first_line : z.first_line + z.lines]
        assert (z.start_day, z.first_day, z.last_day) == (of[0], min(of), max(of))


def test_reading_a_range_holds_a_part_of_it(tmp_path):
    """What a task holds does not grow with its range, and lines longer than a part come whole."""
    log = tmp_path / "a.log"
    rows = [f"# LOG:[1:2:{k % 60} 3.1.2024] complete:/suite0/fam{k % 9}/t{k}" for k in range(350_000)]
    rows[1000] = "x" * (3 << 20)
    write(log, rows)
    want = list(rows)
    n = at = 0
    tracemalloc.start()
    try:
        for batch in lines.read_range(str(log), 0, log.stat().st_size, 5):
            assert batch.column("line_no")[0].as_py() == n + 5 and batch.column("byte")[0].as_py() == at
            at += sum(len(v) + 1 for v in want[n : n + batch.num_rows])
            n += batch.num_rows
            last = batch.column("value")[-1].as_py()
            assert last == want[n - 1]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len(want) and at == log.stat().st_size and most < 24 << 20
