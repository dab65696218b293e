"""Shapes and fixed vocabularies shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# The status names a scheduler writes for a node.
STATUSES = ("queued", "submitted", "active", "complete", "aborted")

# The commands the daily task/family rules look at.
RUN_COMMANDS = ("submitted", "active", "complete", "aborted")

# The classes a timeline interval may carry.
TIMELINE_CLASSES = (
    "unknown",
    "serial",
    "serial_op",
    "serial_op1",
    "operation",
    "operation1",
    "operation2",
    "normal",
    "largemem",
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("owner", T.StringType()),
        T.StructField("repo", T.StringType()),
        T.StructField("version_id", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_date", T.DateType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("command", T.StringType()),
        T.StructField("node_path", T.StringType()),
        T.StructField("info", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)
