"""Line grammars of two schedulers as Column expressions, without Python per row.

Lines that fail a step keep the fields found so far and nulls for the rest. Where a form
has no space after the path, the whole remainder is the path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import parse_log_time
from ..schema import STATUSES

# Commands of the older log format by the form of what follows them.
STATUS_FORM = (*STATUSES, "suspend")
FIELDS = ("record_type", "record_date", "ts", "command", "node_path", "info")


def pre_filter(df: DataFrame, pattern: str, col: str = "value") -> DataFrame:
    """Raw lines that match a regular expression, before any parsing."""
    return df.filter(F.col(col).rlike(pattern))


def parse_ecflow(df: DataFrame, col: str = "value") -> DataFrame:
    """``TYPE:[H:M:S d.m.Y]  status: /path [info]`` to the record fields.

    Only a known status before a path makes a status record; the messages of
    running jobs (``chd:...``) and all others keep type and time alone.
    """
    line = F.col(col)
    form = r"^([A-Z]+):\[([^\]]*)\]\s*(?:(\w+): (/\S*)(?: (.*))?)?"
    part = lambda k: F.regexp_extract(line, form, k)
    status = part(3).isin(*STATUS_FORM)
    time = parse_log_time(part(2))
    return df.select(
        "*",
        _text(part(1)).alias("record_type"),
        time.cast("date").alias("record_date"),
        time.alias("ts"),
        F.when(status, part(3)).alias("command"),
        F.when(status, part(4)).alias("node_path"),
        F.when(status, _text(part(5))).alias("info"),
    )


def _text(c: Column) -> Column:
    return F.when(c != "", c)


def keep_records(df: DataFrame, col: str = "value", line_no: str | None = "line_no") -> DataFrame:
    """Lines that start with ``#``, and the first line of a file whatever it is."""
    keep = F.col(col).startswith("#")
    if line_no in df.columns:
        keep = keep | (F.col(line_no) == 0)
    return df.filter(keep)


def parse_sms(df: DataFrame, col: str = "value") -> DataFrame:
    """The older format, ``# TYPE:[H:M:S d.m.Y] command:rest``, to the record fields.

    The head is taken apart once; ``rest`` then goes by the rule of its command.
    """
    helpers = ["_line", "_at", "_rest"]
    line = F.col("_line")
    step = df.withColumn("_line", F.trim(F.col(col)))
    # Where the clock's bracket closes, and where the command's colon stands behind it (0: nowhere).
    close = F.when(line.startswith("# "), F.locate("]", line, 1)).otherwise(0)
    step = step.withColumn("_at", F.struct(F.locate(":", line).alias("kind"), close.alias("close")))
    kind = F.when(line.startswith("# ") & (F.col("_at.kind") > 0), F.substr(line, F.lit(3), F.col("_at.kind") - 3))
    closed = line.startswith("# ") & (F.col("_at.close") > F.col("_at.kind"))
    time = parse_log_time(F.when(closed, F.substr(line, F.col("_at.kind") + 2, F.col("_at.close") - F.col("_at.kind") - 2)))
    tail = F.when(closed, F.substr(line, F.col("_at.close") + 2))
    step = step.select(
        "*", kind.alias("record_type"), time.cast("date").alias("record_date"), time.alias("ts"),
        F.when(F.locate(":", tail) > 0, F.substring_index(tail, ":", 1)).alias("command"),
        F.when(F.locate(":", tail) > 0, F.substr(tail, F.locate(":", tail) + 1)).alias("_body"),
    )
    command, kind, rest = F.col("command"), F.col("record_type"), F.col("_body")

    def up_to(mark: str) -> Column:
        return F.substring_index(rest, mark, 1)

    def after(mark: str) -> Column:
        return F.when(F.locate(mark, rest) > 0, F.substr(rest, F.locate(mark, rest) + len(mark)))

    status = command.isin(*STATUS_FORM)
    alter = command == "alter"
    meter, meter_err = (command == "meter") & (kind != "ERR"), (command == "meter") & (kind == "ERR") & rest.rlike("^/[^ ]*: ")
    begin = command.isin("begin", "autorepeat date")
    force = command.isin("force", "force(recursively)")
    delete = command == "delete"
    assign = command.isin("set", "clear") & (F.locate(":", rest) > 0)
    requeue_war = (command == "requeue") & (kind == "WAR") & (F.locate(" ", rest) > 0)
    requeue_msg = (command == "requeue") & (kind == "MSG") & (F.locate(":", rest) > 0)

    path = (
        F.when(status | meter | begin | force | delete | requeue_war, up_to(" "))
        .when(alter & (F.locate(" [", rest) > 0), up_to(" ["))
        .when(meter_err, F.regexp_extract(rest, "^(/[^ ]*): ", 1))
        .when(assign, up_to(":"))
        .when(requeue_msg, after(":"))
    )
    # After a meter's path stand two characters and a space; `force` names the new state after " to ".
    info = (
        F.when(status | meter_err | requeue_war, after(" "))
        .when(alter & (F.locate("] ", after(" [")) > 0), F.substring_index(after(" ["), "] ", 1))
        .when(meter, F.substr(after(" "), F.lit(4)))
        .when(force & after(" ").startswith("to "), F.substring_index(F.substr(after(" "), F.lit(4)), " ", 1))
        .when(delete, F.substring_index(after(" "), " ", 1))
        .when(assign, after(":"))
        .when(requeue_msg, up_to(":"))
    )
    return step.select(*[c for c in step.columns if c not in (*helpers, "_body")], path.alias("node_path"), info.alias("info"))
