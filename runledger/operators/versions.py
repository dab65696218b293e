"""Log versions and the small tables of owners and repos."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def version_id(day: Column, seq: Column) -> Column:
    """``yyyymmdd`` and the day's number in at least two digits; longer numbers only lengthen it."""
    return F.format_string("%s%02d", F.date_format(day, "yyyyMMdd"), seq)


def resolve_version(files: DataFrame, known: DataFrame) -> DataFrame:
    """``files`` with the version that has their head line, null where none has."""
    return files.join(known.select("repo_id", "head_line", "version_id", "version_day", "version_seq"), ["repo_id", "head_line"], "left")


def register_versions(files: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """All versions after these files: known head lines keep theirs, new ones count on from the day's highest.

    ``files``: ``repo_id, head_line, version_day, seen_at`` (order of arrival). Days order by
    ``(version_day, version_seq)``, never by the text of the id, so a day may have any number.
    """
    kept = ["repo_id", "version_day", "version_seq", "head_line"]
    first = files.groupBy("repo_id", "head_line").agg(F.min(F.struct("seen_at", "version_day")).alias("f"))
    new = first.select("repo_id", "head_line", F.col("f.version_day").alias("version_day"), F.col("f.seen_at").alias("seen_at"))
    if known is None:
        top, old = None, None
        base = F.lit(0)
    else:
        old = known.select(*kept)
        new = new.join(old.select("repo_id", "head_line"), ["repo_id", "head_line"], "left_anti")
        top = old.groupBy("repo_id", "version_day").agg(F.max("version_seq").alias("top"))
        new = new.join(top, ["repo_id", "version_day"], "left")
        base = F.coalesce(F.col("top"), F.lit(0))
    day = Window.partitionBy("repo_id", "version_day").orderBy("seen_at", "head_line")
    new = new.withColumn("version_seq", (base + F.row_number().over(day)).cast("bigint")).select(*kept)
    every = new if old is None else old.unionByName(new)
    d, n = F.col("version_day"), F.col("version_seq")
    name = F.format_string("version.%s.%d", F.date_format(d, "yyyy-MM-dd"), n)
    return every.select(*kept, version_id(d, n).alias("version_id"), name.alias("version_name"))


def resolve_repo(users: DataFrame, repos: DataFrame, user_name: str | None = None, repo_name: str | None = None) -> DataFrame:
    """Repos with their user's name, of one user or repo if named."""
    out = repos.join(users.select("user_id", "user_name"), "user_id")
    if user_name is not None:
        out = out.filter(F.col("user_name") == user_name)
    return out if repo_name is None else out.filter(F.col("repo_name") == repo_name)


def upsert_dim(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` and the incoming rows whose keys it lacks, one row a key."""
    new = incoming.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(new, allowMissingColumns=True)
