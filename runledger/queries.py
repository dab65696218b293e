"""Queries over the log that the ``events`` table stands for, and the DuckDB SQL that they equal.

Timestamps leave as text, durations as whole microseconds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import streaming
from .functions.clock import format_clock
from .functions.predicate import in_date_range
from .operators import daily, nodes, reports, runs, versions
from .schema import LOG_SCHEMA
from .sources import deltas, grammar, ingest, lines, sinks, zones
from .sources.loads import RecordStore
from .sources.storage import shared_folder
from .streaming import machine

START, STOP = "2024-01-01", "2024-01-31"
TASKS, FAMILIES = "node_type = 'task'", "node_type = 'family'"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_of(events(spark, sf_dir))


def log_of(e: DataFrame) -> DataFrame:
    """Each event as a record of a task, and as one of the family around it."""
    group = F.floor(F.col("user_id") / 10)
    family = F.concat(F.lit("/suite"), (group % 5).cast("string"), F.lit("/fam"), group.cast("string"))
    kind = F.col("event_type")
    command = (
        F.when(kind == "signup", "queued").when(kind == "view", "submitted").when(kind == "click", "active")
        .when(kind == "purchase", "complete").otherwise(F.when(F.col("event_id") % 10 == 0, "aborted").otherwise("suspend"))
    )
    by_rule = F.when((kind == "purchase") & (F.col("event_id") % 3 == 0), "by rule")
    task = F.struct(
        (F.col("event_id") * 2).alias("line_no"), F.concat(family, F.lit("/t"), F.col("user_id").cast("string")).alias("node_path"),
        F.lit("task").alias("node_type"), by_rule.alias("info"),
    )
    around = F.struct(
        (F.col("event_id") * 2 + 1).alias("line_no"), family.alias("node_path"), F.lit("family").alias("node_type"), F.lit(None).cast("string").alias("info")
    )
    rows = e.select("ts", command.alias("command"), F.explode(F.array(task, around)).alias("r"))
    return rows.select("r.line_no", F.col("ts").cast("date").alias("record_date"), "ts", "r.node_path", "r.node_type", "command", "r.info")


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_view(spark, sf_dir).filter(TASKS)


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_view(spark, sf_dir).filter(FAMILIES)


def hourly(log: DataFrame) -> DataFrame:
    """The same log with clocks cut to the hour, so that many records tie and ``line_no`` decides."""
    return log.withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))


def _shown(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _texts(df: DataFrame) -> DataFrame:
    return df.select(*[_shown(n).alias(n) if t == "timestamp_ntz" else F.col(n) for n, t in df.dtypes])


def status_changes(spark, sf_dir):
    return _texts(runs.status_changes(log_view(spark, sf_dir)).select("line_no", "node_path", "record_date", "ts", F.col("command").alias("status")))


def node_day_counts(spark, sf_dir):
    log = log_view(spark, sf_dir).filter(in_date_range(F.col("record_date"), "2024-01-05", "2024-01-20"))
    return log.groupBy("node_path", "record_date").agg(F.count("*").alias("n_records"), F.bool_or(F.col("command") == "aborted").alias("any_abort"))


def run_windows(spark, sf_dir):
    return runs.assign_run_window(runs.status_changes(log_view(spark, sf_dir)), START, STOP).select("node_path", "run_date", "line_no")


def run_calendar(spark, sf_dir):
    return runs.run_calendar(log_view(spark, sf_dir), START, STOP)


def situations_task(spark, sf_dir):
    return _texts(runs.situations(tasks(spark, sf_dir), START, STOP))


def situations_ties(spark, sf_dir):
    return _texts(runs.situations(hourly(tasks(spark, sf_dir)), START, STOP))


def situations_family(spark, sf_dir):
    return _texts(runs.situations(families(spark, sf_dir), START, STOP, runs.FAMILY))


def situations_family_strict(spark, sf_dir):
    return _texts(runs.situations(families(spark, sf_dir), START, STOP, runs.STRICT_FAMILY))


def situations_by_table(spark, sf_dir):
    return runs.situations_by_table(tasks(spark, sf_dir), START, STOP, runs.TASK_TABLE)


def earliest_time_runs(spark, sf_dir):
    return _texts(runs.situations(tasks(spark, sf_dir), START, STOP, earliest_time="06:00"))


def node_table(spark, sf_dir):
    return _texts(runs.node_table(runs.situations(tasks(spark, sf_dir), START, STOP)))


def time_point(spark, sf_dir):
    out = reports.time_point(tasks(spark, sf_dir), "submitted", START, STOP)
    return out.withColumn("shown", format_clock(F.col("clock")))


def time_point_summary(spark, sf_dir):
    return reports.time_point_summary(reports.time_point(families(spark, sf_dir), "complete", START, STOP, runs.FAMILY))


def time_period(spark, sf_dir):
    return reports.time_period(tasks(spark, sf_dir), START, STOP)


def time_period_summary(spark, sf_dir):
    return reports.time_period_summary(reports.time_period(families(spark, sf_dir), START, STOP, runs.FAMILY))


def late_runs(spark, sf_dir):
    return reports.late_runs(reports.time_period(families(spark, sf_dir), START, STOP, runs.FAMILY))


def model_run_report(spark, sf_dir):
    return reports.model_run_report(tasks(spark, sf_dir), STOP)


def trimmed_mean_value(spark, sf_dir):
    amounts = events(spark, sf_dir).select("event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))
    return reports.trimmed_mean(amounts, ["event_type"], "cents", 0.1)


def task_situation_daily(spark, sf_dir):
    return _texts(daily.task_situation_daily(tasks(spark, sf_dir)))


def complete_by_rule(spark, sf_dir):
    return daily.complete_by_rule(tasks(spark, sf_dir))


def family_situation_daily(spark, sf_dir):
    return _texts(daily.family_situation_daily(families(spark, sf_dir)))


def run_timeline(spark, sf_dir):
    log = families(spark, sf_dir)
    number = F.regexp_extract("node_path", "([0-9]+)$", 1).cast("int")
    classes = log.select("node_path").distinct().select(
        "node_path", F.when(number % 3 == 0, "serial").when(number % 3 == 1, "operation").otherwise("nothing known").alias("class")
    )
    return _texts(daily.run_timeline(log, "2024-01-03", "2024-01-28", classes))


def _nodes(spark, sf_dir):
    """Node paths with more kinds among them: suites, events of tasks, aliases."""
    log = log_view(spark, sf_dir).select("node_path", "record_date", "line_no")
    path, number = F.col("node_path"), F.col("line_no") % 7
    suite = F.when(number == 1, F.substring_index(path, "/", 2))
    mark = F.when(number == 2, F.concat(path, F.lit(":limit")))
    alias = F.when(number == 4, F.concat(path, F.lit("/alias0")))
    beside = F.when((number == 6) & (F.col("line_no") % 2 == 0), F.concat(path, F.lit("/alias1/deep")))
    every = F.explode(F.array_compact(F.array(path, suite, mark, alias, beside)))
    return log.select(every.alias("node_path"), "record_date")


def _asked(spark, sf_dir):
    log = _nodes(spark, sf_dir)
    p = F.col("node_path")
    more = F.array(p, F.substring_index(p, "/", 2), F.substring_index(p, "/", 3), F.lit("/"), F.concat(p, F.lit("/absent")), F.substring(p, 2, 100))
    return log.select(F.explode(more).alias("node_path")).distinct()


def node_tree(spark, sf_dir):
    return nodes.node_tree(_nodes(spark, sf_dir), "2024-01-10")


def node_types(spark, sf_dir):
    return nodes.node_types(_nodes(spark, sf_dir), _asked(spark, sf_dir))


def node_exists(spark, sf_dir):
    return nodes.node_exists(_nodes(spark, sf_dir), _asked(spark, sf_dir))


def _clock_text() -> Column:
    t = F.col("ts")
    return F.concat_ws(
        "", F.hour(t), F.lit(":"), F.minute(t), F.lit(":"), F.second(t).cast("int"), F.lit(" "), F.dayofmonth(t), F.lit("."), F.month(t), F.lit("."), F.year(t)
    )


#: Forms of the older log by the number of an event, and what each is to give: line, type, command, path, info.
_FORMS = (
    ("# LOG:[{t}] {c}:{p}", "LOG", "{c}", "{p}", None),
    ("# MSG:[{t}] complete:{p} by rule", "MSG", "complete", "{p}", "by rule"),
    ("# MSG:[{t}] alter:{p} [limit to 5] by user", "MSG", "alter", "{p}", "limit to 5"),
    ("# MSG:[{t}] alter:{p} [open", "MSG", "alter", "{p}", None),
    ("# MSG:[{t}] meter:{p}:wait to 20", "MSG", "meter", "{p}:wait", "20"),
    ("# ERR:[{t}] meter:{p}:Wait: 55 out of range [0 - 40]", "ERR", "meter", "{p}:Wait", "55 out of range [0 - 40]"),
    ("# ERR:[{t}] meter:Wait for {p}:the node was not found:", "ERR", "meter", None, None),
    ("# MSG:[{t}] begin:{p} now", "MSG", "begin", "{p}", None),
    ("# MSG:[{t}] autorepeat date:{p}", "MSG", "autorepeat date", "{p}", None),
    ("# MSG:[{t}] force:{p} to complete by someone", "MSG", "force", "{p}", "complete"),
    ("# MSG:[{t}] force(recursively):{p} by someone", "MSG", "force(recursively)", "{p}", None),
    ("# MSG:[{t}] delete:{p} someone else", "MSG", "delete", "{p}", "someone"),
    ("# MSG:[{t}] set:{p}:event a", "MSG", "set", "{p}", "event a"),
    ("# MSG:[{t}] clear:nothing", "MSG", "clear", None, None),
    ("# WAR:[{t}] requeue:{p} from aborted", "WAR", "requeue", "{p}", "from aborted"),
    ("# MSG:[{t}] requeue:user someone@1:{p}", "MSG", "requeue", "{p}", "user someone@1"),
    ("# MSG:[{t}] login:User someone@1 with password", "MSG", "login", None, None),
    ("# WAR:[{t}] no script at all", "WAR", None, None, None),
)


def _lines(spark, sf_dir):
    """Lines of the older log rendered from events, all forms of the grammar among them."""
    log = tasks(spark, sf_dir).withColumn("n", F.floor(F.col("line_no") / 2) % (len(_FORMS) + 3))
    t, c, p = _clock_text(), F.col("command"), F.col("node_path")
    value = F.when(F.col("n") == len(_FORMS), F.lit("readlists")).when(F.col("n") == len(_FORMS) + 1, F.lit("#x without a space"))
    value = value.when(F.col("n") == len(_FORMS) + 2, F.concat(F.lit("# MSG:open "), c))
    for k, (form, *_rest) in enumerate(_FORMS):
        parts = form.replace("{t}", "\0t\0").replace("{c}", "\0c\0").replace("{p}", "\0p\0").split("\0")
        pieces = [{"t": t, "c": c, "p": p}[x] if i % 2 else F.lit(x) for i, x in enumerate(parts)]
        value = value.when(F.col("n") == k, F.concat(*pieces))
    return log.select("line_no", F.lit("one.log").alias("file_path"), value.alias("value"))


def parse_sms(spark, sf_dir):
    return _texts(grammar.parse_sms(grammar.keep_records(_lines(spark, sf_dir))).drop("file_path", "value"))


def _ecflow_lines(spark, sf_dir):
    log = tasks(spark, sf_dir)
    value = F.concat(
        F.lit("LOG:["), _clock_text(), F.lit("]"),
        F.when(F.col("line_no") % 5 == 0, F.concat(F.lit(" chd:complete "), F.col("node_path")))
        .otherwise(F.concat(F.lit("  "), F.col("command"), F.lit(": "), F.col("node_path"), F.coalesce(F.concat(F.lit(" "), F.col("info")), F.lit("")))),
    )
    return log.select("line_no", value.alias("value"))


def parse_ecflow(spark, sf_dir):
    return _texts(grammar.parse_ecflow(_ecflow_lines(spark, sf_dir)).drop("value"))


def pre_filter(spark, sf_dir):
    return grammar.pre_filter(_lines(spark, sf_dir), r"/fam\d*[02468]/t\d+(?!\d|:)").select("line_no", "value")


def log_file_info(spark, sf_dir):
    parsed = grammar.parse_sms(_lines(spark, sf_dir)).withColumn("file_path", F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit("undated")))
    return _texts(ingest.log_file_info(parsed))


def _versioned(spark, sf_dir):
    """One log file for each suite and day, and its lines."""
    log = log_view(spark, sf_dir)
    return log.withColumn("repo_id", F.regexp_extract("node_path", "^/suite([0-9]+)", 1).cast("long"))


def register_versions(spark, sf_dir):
    log = _versioned(spark, sf_dir)
    files = log.groupBy("repo_id", F.col("record_date").alias("day"), F.hour("ts").alias("h")).agg(F.min_by("node_path", "line_no").alias("head"), F.min("line_no").alias("seen_at"))
    files = files.select("repo_id", F.concat_ws(" ", "head", F.col("seen_at").cast("string")).alias("head_line"), F.col("day").alias("version_day"), "seen_at")
    known = versions.register_versions(files.filter(F.col("seen_at") % 4 < 2))
    return versions.register_versions(files, known.drop("version_id", "version_name"))


def incremental_rows(spark, sf_dir):
    log = _versioned(spark, sf_dir).select(F.lit("o").alias("owner"), F.col("repo_id").cast("string").alias("repo"), F.date_format("record_date", "yyyyMMdd").alias("version_id"), "line_no")
    stored = log.filter((F.col("line_no") % 11 == 0) & (F.col("version_id") < "20240120"))
    return ingest.incremental_rows(log, stored)


def resolve_repo(spark, sf_dir):
    log = _versioned(spark, sf_dir)
    users = log.select(F.col("repo_id").alias("user_id"), F.concat(F.lit("suite"), F.col("repo_id").cast("string")).alias("user_name")).distinct()
    repos = families(spark, sf_dir).select(F.substring_index("node_path", "/", -1).alias("repo_name"), F.regexp_extract("node_path", "^/suite([0-9]+)", 1).cast("long").alias("user_id")).distinct()
    return versions.resolve_repo(users, repos).select("user_name", "repo_name")


def upsert_dim(spark, sf_dir):
    log = _versioned(spark, sf_dir)
    every = log.select("repo_id", "node_path").distinct()
    first = every.filter("repo_id < 2").withColumn("state", F.lit("old"))
    return versions.upsert_dim(first, every.withColumn("state", F.lit("new")), ["repo_id", "node_path"])


def export_keyed(spark, sf_dir):
    log = tasks(spark, sf_dir).withColumn("version_id", F.date_format("record_date", "yyyyMMdd"))
    return sinks.export_keyed(log, "2024-01-10").select("row_key", "line_no", "node_path")


def scan_by_key(spark, sf_dir):
    log = tasks(spark, sf_dir).withColumn("version_id", F.date_format("record_date", "yyyyMMdd"))
    return sinks.scan_by_key(sinks.export_keyed(log), "^[0-7].*-659[0-9a-f]{5}$").select("row_key", "line_no")


def records_as_json(spark, sf_dir):
    return sinks.records_as_json(tasks(spark, sf_dir).select("line_no", "node_path", "command", "info"))


def _streamed(spark, sf_dir, run) -> DataFrame:
    """What ``run(log stream, table, out, checkpoint)`` leaves in ``out``; all in the folder that executors share."""
    top = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = events(spark, sf_dir).schema
    # A pattern, since a stream takes a plain path for a folder, and the table may be one file.
    stream = log_of(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))
    run(stream, f"{top}/table", f"{top}/out", f"{top}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{top}/out")


def stream_run_windows(spark, sf_dir):
    out = _streamed(spark, sf_dir, lambda log, *paths: streaming.stream_run_windows(log, *paths, START, STOP))
    return out.select("node_path", "run_date", "n_records")


def stream_situations(spark, sf_dir):
    out = _streamed(spark, sf_dir, lambda log, *paths: streaming.stream_situations(log.filter(TASKS), *paths, START, STOP))
    return _texts(out.drop("bucket"))


class _Logs:
    """Log files rendered from events, one for each suite and ten days, in the order of time; they grow."""

    def __init__(self, spark, sf_dir):
        self.spark, self.top = spark, f"{shared_folder(spark)}/logs-{uuid.uuid4().hex}"
        rendered = _lines(spark, sf_dir).select("line_no", "value").join(tasks(spark, sf_dir).select("line_no", "ts", "node_path"), "line_no")
        rendered = rendered.withColumn("file", F.concat(F.substring("node_path", 2, 6), F.lit("-"), F.floor(F.dayofmonth("ts") / 10).cast("string")))
        rendered = rendered.repartition("file").sortWithinPartitions("file", "ts", "line_no")
        rendered.select("value", "file").write.partitionBy("file").text(f"{self.top}/written")

    def grow(self, part: int, parts: int) -> str:
        """The folder of the files, of which so much is written by now, wherever that cuts a line."""
        made = lines.list_files(f"{self.top}/written")
        rows = [(path, f"{self.top}/logs/{path.split('file=')[1].split('/')[0]}.log", size * part // parts) for path, size in made.items()]
        files = self.spark.createDataFrame(rows, "path string, target string, size long").repartition(max(1, len(rows)))

        def copy(batches):
            for b in batches:
                for path, target, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    lines.copy_start(path, target, size)
                yield b

        files.mapInArrow(copy, files.schema).write.format("noop").mode("overwrite").save()
        return f"{self.top}/logs"


def _loaded(store: RecordStore) -> DataFrame:
    name = F.regexp_extract("file_path", "([^/]*)[.]log$", 1)
    return _texts(store.read("me", "r").select(name.alias("file"), "line_no", "log_date", "record_type", "ts", "command", "node_path", "info"))


def load_resumes(spark, sf_dir):
    """Files that grow between loads; one load is sent twice, and rows of a torn one lie about."""
    logs = _Logs(spark, sf_dir)
    store = RecordStore(spark, f"{logs.top}/table")
    for part in (1, 1, 3):
        store.load(logs.grow(part, 3), "me", "r", "v", closed=part == 3)
    store._stage(store.read())
    return _loaded(store)


def load_days(spark, sf_dir):
    """Twice some days, by a zone map; only zones of these days are read."""
    logs = _Logs(spark, sf_dir)
    folder = logs.grow(1, 1)
    store = RecordStore(spark, f"{logs.top}/table")
    zones.zone_map(spark, folder, grammar.parse_sms, zone_bytes=1 << 16).write.parquet(f"{logs.top}/zones")
    found = spark.read.parquet(f"{logs.top}/zones")
    for start, stop in (("2024-01-08", "2024-01-13"), ("2024-01-11", "2024-01-22")):
        store.load_days(folder, "me", "r", "v", start, stop, found)
    return _loaded(store)


def stream_tail(spark, sf_dir):
    """A stream that follows growing files, started anew from its checkpoint each time that they have grown."""
    logs = _Logs(spark, sf_dir)
    store = RecordStore(spark, f"{logs.top}/table")

    def add(batch: DataFrame, number: int) -> None:
        parsed = grammar.keep_records(grammar.parse_sms(batch)).withColumnsRenamed({"value": "raw"})
        named = parsed.select("*", F.lit("me").alias("owner"), F.lit("r").alias("repo"), F.lit("v").alias("version_id"), F.col("record_date").alias("log_date"))
        store.add(named, "me", "r", "v", "tail", number)

    for part in (1, 2, 2, 3):
        stream = lines.tail(spark, logs.grow(part, 3)).writeStream.foreachBatch(add)
        stream.option("checkpointLocation", f"{logs.top}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return _loaded(store).drop("log_date")


def stream_machine(spark, sf_dir):
    """Events that come in two parts, each with half of the events of all days, so that those of the second are late."""
    top = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    log = tasks(spark, sf_dir).drop("node_type")
    for part in (1, 0):
        log.filter(F.floor(F.col("line_no") / 2) % 2 == part).write.mode("append").parquet(f"{top}/in/{part}")
        stream = spark.readStream.schema(log.schema).parquet(f"{top}/in/*")
        for query in machine.stream_machine(stream, f"{top}/table", f"{top}/updates", f"{top}/checkpoint"):
            query.awaitTermination()
    return _texts(machine.settled(spark, f"{top}/table", f"{top}/updates", START, STOP))


def stream_fold(spark, sf_dir):
    """A machine that is a function, folded over sorted batches."""
    table = runs.TASK_TABLE
    return runs.situations_by_function(tasks(spark, sf_dir), START, STOP, lambda state, status: table.moves[state].get(status, state), stops=table.stops)


def node_tree_nested(spark, sf_dir):
    return nodes.nested_trees(nodes.node_tree(_nodes(spark, sf_dir), "2024-01-10"))


def maintained_means(spark, sf_dir):
    """Means of periods that were first computed from a part of the log and then corrected; the correction is sent twice."""
    log = families(spark, sf_dir)
    store = deltas.DeltaCounts(spark, f"{shared_folder(spark)}/means-{uuid.uuid4().hex}")
    before = reports.time_period(log.filter("line_no % 10 < 7"), START, STOP, runs.FAMILY)
    after = reports.time_period(log, START, STOP, runs.FAMILY)
    clocks = ["start_clock", "end_clock"]
    store.add("report", 1, deltas.value_changes(None, before, ["node_path"], clocks))
    for _ in range(2):
        store.add("report", 2, deltas.value_changes(before, after, ["node_path"], clocks))
    return reports.summary_of_counts(store.read())


def scan_sorted(spark, sf_dir):
    log = tasks(spark, sf_dir).withColumn("version_id", F.date_format("record_date", "yyyyMMdd"))
    path = f"{shared_folder(spark)}/keyed-{uuid.uuid4().hex}"
    sinks.write_sorted_keys(sinks.export_keyed(log).select("row_key", "line_no"), path, file_rows=500)
    return sinks.scan_sorted(spark, path, "^[0-7].*-659[0-9a-f]{5}$")


#: Nodes whose paths are known from how the log is rendered.
SOME = ("/suite0/fam0/t3", "/suite0/fam0/t7", "/suite1/fam1/t12", "/suite2/fam2/t21")


def situations_clipped(spark, sf_dir):
    return _texts(runs.situations(tasks(spark, sf_dir), START, "2024-01-15", clip_to_stop=True, node_paths=SOME))


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def line_numbers(spark, sf_dir):
    found = ingest.with_line_no(ingest.read_lines(spark, f"{_Logs(spark, sf_dir).top}/written"))
    return found.select(F.regexp_extract("file_path", "file(?:=|%3D)([^/]*)/", 1).alias("file"), "line_no", "value")


def read_ecflow(spark, sf_dir):
    path = _fresh(spark, "ecflow")
    _ecflow_lines(spark, sf_dir).select("value").write.text(path)
    return _texts(ingest.read_ecflow_logs(spark, path).drop("file_path", "value"))


def report_csv(spark, sf_dir):
    path = _fresh(spark, "report")
    sinks.write_report_csv(model_run_report(spark, sf_dir), path)
    return spark.read.option("header", True).csv(path)


def timeline_json(spark, sf_dir):
    path = _fresh(spark, "timeline")
    sinks.export_timeline_json(run_timeline(spark, sf_dir), path)
    schema = "run_date date, node_path string, start string, end string, class string"
    return spark.read.schema(schema).json(path)


def import_csv(spark, sf_dir):
    path = _fresh(spark, "records")
    log = tasks(spark, sf_dir).withColumns({"owner": F.lit("o"), "repo": F.lit("r, with a comma"), "version_id": F.date_format("record_date", "yyyyMMdd")})
    log = log.withColumns({"file_path": F.lit("a.log"), "record_type": F.lit("LOG"), "raw": F.concat(F.lit('say "'), "node_path", F.lit('", '), "command")})
    log.withColumn("ts", _shown("ts")).select(*LOG_SCHEMA.fieldNames()).write.option("header", True).option("escape", '"').csv(path)
    return _texts(ingest.import_records_csv(spark, path).drop("file_path", "record_type"))


def resolve_version(spark, sf_dir):
    log = _versioned(spark, sf_dir)
    files = log.groupBy("repo_id", F.col("record_date").alias("day")).agg(F.min_by("node_path", "line_no").alias("head_line"), F.min("line_no").alias("seen_at"))
    known = versions.register_versions(files.filter("seen_at % 3 < 2").withColumn("version_day", F.col("day")).select("repo_id", "head_line", "version_day", "seen_at"))
    return versions.resolve_version(files.select("repo_id", "head_line", "seen_at"), known).fillna(0, ["version_seq"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        status_changes, node_day_counts, run_windows, run_calendar, situations_task, situations_ties, situations_family,
        situations_family_strict, situations_by_table, earliest_time_runs, node_table, time_point, time_point_summary, time_period,
        time_period_summary, late_runs, model_run_report, trimmed_mean_value, task_situation_daily, complete_by_rule,
        family_situation_daily, run_timeline, node_tree, node_types, node_exists, parse_sms, parse_ecflow, pre_filter, log_file_info,
        register_versions, incremental_rows, resolve_repo, upsert_dim, export_keyed, scan_by_key, records_as_json,
        stream_run_windows, stream_situations, load_resumes, load_days, stream_tail, stream_machine, stream_fold,
        node_tree_nested, maintained_means, scan_sorted, situations_clipped, line_numbers, read_ecflow, report_csv,
        timeline_json, import_csv, resolve_version,
    )
}
