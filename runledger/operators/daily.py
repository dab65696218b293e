"""Daily situations of tasks and families from the commands of a calendar day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import days_and_seconds, micros_between
from ..functions.predicate import commands_in
from ..schema import TIMELINE_CLASSES

DAY = ("node_path", "record_date")


def _ordered(log: DataFrame) -> DataFrame:
    day = Window.partitionBy(*DAY).orderBy("ts", "line_no")
    lean = log.filter(commands_in(F.col("command"))).select(*DAY, "ts", "line_no", "command", "info")
    return lean.withColumns(
        {
            "rn": F.row_number().over(day),
            "next_command": F.lead("command").over(day),
            "next_info": F.lead("info").over(day),
            "next_ts": F.lead("ts").over(day),
        }
    )


def _period(name: str, a: Column, b: Column) -> list[Column]:
    days, seconds = days_and_seconds(micros_between(a, b))
    return [days.alias(f"{name}_days"), seconds.alias(f"{name}_seconds")]


def task_situation_daily(log: DataFrame) -> DataFrame:
    """Per node and day with a run command: error, unknown, complete by rule, or normal with its points and periods.

    An abort makes the day an error. Otherwise the first submitted, the first active after it and the
    first complete after that make it normal. Without a submitted, a first complete that is
    followed at once by another one ``by rule`` is complete by rule.
    """
    rows = _ordered(log)
    whole = Window.partitionBy(*DAY)
    is_ = lambda c: F.col("command") == c
    rows = rows.withColumn("s", F.min(F.when(is_("submitted"), F.struct("rn", "ts"))).over(whole))
    rows = rows.withColumn("a", F.min(F.when(is_("active") & (F.col("rn") > F.col("s.rn")), F.struct("rn", "ts"))).over(whole))
    by_rule = (F.col("next_command") == "complete") & (F.col("next_info") == "by rule")
    days = rows.groupBy(*DAY).agg(
        F.bool_or(is_("aborted")).alias("aborted"),
        F.first("s").alias("s"),
        F.first("a").alias("a"),
        F.min(F.when(is_("complete") & (F.col("rn") > F.col("a.rn")), F.struct("rn", "ts"))).alias("c"),
        F.min(F.when(is_("complete"), F.struct("rn", F.coalesce(by_rule, F.lit(False)).alias("rule")))).alias("k"),
    )
    situation = (
        F.when(F.col("aborted"), "error")
        .when(F.col("s").isNull(), F.when(F.col("k.rule"), "complete by rule").otherwise("unknown"))
        .when(F.col("c").isNull(), "unknown")
        .otherwise("normal")
    )
    days = days.withColumn("situation", situation)
    normal = F.col("situation") == "normal"
    out = days.select(*DAY, "situation", *[F.when(normal, F.col(f"{k}.ts")).alias(n) for k, n in (("s", "submitted"), ("a", "active"), ("c", "complete"))])
    return out.select(
        "*",
        *_period("in_submitted", F.col("submitted"), F.col("active")),
        *_period("in_active", F.col("active"), F.col("complete")),
        *_period("in_all", F.col("submitted"), F.col("complete")),
    )


def complete_by_rule(log: DataFrame) -> DataFrame:
    """Node-days whose completion a rule set."""
    return task_situation_daily(log).filter("situation = 'complete by rule'").select(*DAY)


def family_situation_daily(log: DataFrame) -> DataFrame:
    """Per node and day with a run command: error, unknown, or normal with its points and period.

    An abort makes the day an error. A day that ends in complete is normal if it began with
    submitted. Otherwise the run crosses midnight: it begins with the submitted right after
    the day's first complete, and the next day's first complete or aborted decides.

    Days are summed up once; each sum then stands for its own day and, as what comes next, for the
    day before, so the log is read and shuffled once.
    """
    rows = _ordered(log)
    at = F.struct("rn", "ts", "command")
    is_ = lambda c: F.col("command") == c
    days = rows.groupBy(*DAY).agg(
        F.bool_or(is_("aborted")).alias("aborted"),
        F.min(at).alias("first"),
        F.max(at).alias("last"),
        F.min(F.when(is_("complete"), F.struct("rn", "next_command", "next_ts"))).alias("c"),
        F.min(F.when(F.col("command").isin("complete", "aborted"), at)).alias("end"),
    )
    own = F.struct("aborted", "first", "last", "c")
    # An array of two: the day itself, and what the day before sees of it.
    seen = F.array(
        F.struct(F.col("record_date").alias("d"), own.alias("own"), F.lit(None).cast("struct<rn:int,ts:timestamp_ntz,command:string>").alias("next")),
        F.struct(F.date_sub("record_date", 1).alias("d"), F.lit(None).cast(_kind(days, own)).alias("own"), F.col("end").alias("next")),
    )
    both = days.select("node_path", F.explode(seen).alias("x")).select("node_path", F.col("x.d").alias("record_date"), "x.own", "x.next")
    met = both.groupBy(*DAY).agg(F.first("own", True).alias("o"), F.first("next", True).alias("n")).filter("o is not null")
    same_day = F.col("o.last.command") == "complete"
    crosses = ~same_day & (F.col("o.c.next_command") == "submitted")
    situation = (
        F.when(F.col("o.aborted"), "error")
        .when(same_day & (F.col("o.first.command") == "submitted"), "normal")
        .when(crosses & (F.col("n.command") == "aborted"), "error")
        .when(crosses & (F.col("n.command") == "complete"), "normal")
        .otherwise("unknown")
    )
    met = met.withColumn("situation", situation)
    normal = F.col("situation") == "normal"
    out = met.select(
        *DAY, "situation",
        F.when(normal, F.when(same_day, F.col("o.first.ts")).otherwise(F.col("o.c.next_ts"))).alias("submitted"),
        F.when(normal, F.when(same_day, F.col("o.last.ts")).otherwise(F.col("n.ts"))).alias("complete"),
    )
    return out.select("*", *_period("in_all", F.col("submitted"), F.col("complete")))


def _kind(df: DataFrame, c: Column):
    return df.select(c.alias("x")).schema["x"].dataType


def run_timeline(log: DataFrame, first, stop, classes: DataFrame | None = None) -> DataFrame:
    """``run_date, node_path, start, end, class`` of the normal family runs of ``[first, stop)``.

    ``classes``: ``node_path, class``; nodes without one, or with an unheard-of one, are ``unknown``.
    """
    from ..functions.predicate import in_calendar

    runs = family_situation_daily(log).filter("situation = 'normal'").filter(in_calendar(F.col("record_date"), first, stop))
    if classes is None:
        named = runs.withColumn("class", F.lit("unknown"))
    else:
        known = classes.filter(F.col("class").isin(*TIMELINE_CLASSES)).select("node_path", "class")
        named = runs.join(known, "node_path", "left").withColumn("class", F.coalesce("class", F.lit("unknown")))
    return named.select(F.col("record_date").alias("run_date"), "node_path", F.col("submitted").alias("start"), F.col("complete").alias("end"), "class")
