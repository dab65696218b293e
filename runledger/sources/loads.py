"""A record table whose loads count once, whatever happens to them.

A load writes its rows into a folder of its own, an attempt, and then one commit record that names it. Records are numbered
and never replaced, so of two loads at once one has to try again. Rows without a commit record are not read: a load
that was torn leaves nothing behind that counts, and is simply run again. The record tells up to which byte and line of each
file the version is loaded; the next load of the file reads on from there, and one that finds nothing new commits nothing.

    folder/commits/00000001.json ...        what counts, in order
    folder/attempts/attempt=<id>/log_date=.../   rows, sorted by node and time

A range load replaces the days of its range in its version. Where a later load comes to lines that a range load has
brought, they count once. :meth:`RecordStore.compact` writes all rows anew as one attempt; :meth:`RecordStore.sweep` deletes attempts that nothing names.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.predicate import as_day
from ..schema import LOG_SCHEMA
from . import lines, storage
from .grammar import keep_records, parse_sms
from .ingest import in_range, with_log_date
from .zones import zone_tasks

ORDER = ["log_date", "node_path", "ts"]
#: Bytes of log for each task that a day's nodes are dealt to, were all of one day.
DAY_BYTES = 256 << 20
SCHEMA = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LOG_SCHEMA.fields) + ", log_date date"


class RecordStore:
    """The records of any number of owners, repos and versions under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # ---- commit records -------------------------------------------------------------------------------------------

    def commits(self) -> list[dict]:
        """The records that count, in order: from the last compaction on."""
        every = [n for n in storage.names(self.spark, f"{self.folder}/commits") if n.endswith(".json") and n[0] != "."]
        out: list[dict] = []
        for name in reversed(every):
            out.append(json.loads(storage.read_text(self.spark, f"{self.folder}/commits/{name}")) | {"number": int(name.removesuffix(".json"))})
            if out[-1]["kind"] == "compact":
                break
        return out[::-1]

    def _commit(self, known: list[dict], record: dict) -> None:
        number = known[-1]["number"] + 1 if known else 1
        if not storage.create_once(self.spark, f"{self.folder}/commits/{number:08d}.json", json.dumps(record)):
            raise RuntimeError("another load has committed in the meantime; run this one again")

    @staticmethod
    def _versions(known: list[dict]) -> dict[str, dict]:
        """``owner/repo/version`` -> ``{"files": {file: {byte, line, day}}, "batches": {source: last}, "seen": last line}``."""
        out: dict[str, dict] = {}
        for c in known:
            if c["kind"] == "compact":
                out = {k: v | {"files": dict(v["files"]), "batches": dict(v["batches"])} for k, v in c["versions"].items()}
                continue
            mine = out.setdefault(c["key"], {"files": {}, "batches": {}, "seen": -1})
            mine["files"].update(c.get("files", {}))
            mine["batches"].update(c.get("batches", {}))
            mine["seen"] = max([mine["seen"], c.get("seen", -1), *(f["line"] - 1 for f in c.get("files", {}).values())])
        return out

    def ends(self, owner: str, repo: str, version_id: str) -> dict[str, dict]:
        """Up to where each file of a version is loaded: the offsets behind which a tail goes on."""
        mine = self._versions(self.commits()).get(_key(owner, repo, version_id), {"files": {}})
        return {f: {"byte": e["byte"], "line": e["line"]} for f, e in mine["files"].items()}

    # ---- loads ----------------------------------------------------------------------------------------------------

    def _stage(self, records: DataFrame, size: int = 0) -> str:
        attempt = uuid.uuid4().hex
        # By hash: ranges would be sampled first, which reads and parses everything once more.
        dealt = records.repartition("log_date", F.pmod(F.xxhash64("node_path"), F.lit(1 + size // DAY_BYTES)))
        laid = dealt.sortWithinPartitions(*ORDER)
        laid.write.partitionBy("log_date").parquet(f"{self.folder}/attempts/attempt={attempt}")
        return attempt

    def _records(self, ranges: DataFrame, owner: str, repo: str, version_id: str, days: dict[str, str | None], tasks: int) -> DataFrame:
        found = lines.read_ranges(ranges, tasks)
        known = self.spark.createDataFrame([(f, d and dt.date.fromisoformat(d)) for f, d in days.items()], "file_path string, known date")
        # One row a file.
        return _named(with_log_date(parse_sms(found.join(F.broadcast(known), "file_path", "left")), "known"), owner, repo, version_id)

    def _records_of_zones(self, zones: DataFrame, owner: str, repo: str, version_id: str) -> DataFrame:
        """Undated lines ahead of a zone's first dated one are of the day that the zone map has for its start."""
        parsed = parse_sms(lines.read_ranges(zones, zone_tasks(zones)))
        starts = zones.select("file_path", F.col("first_byte").alias("block"), "start_day")
        inside = Window.partitionBy("file_path", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
        dated = parsed.join(starts, ["file_path", "block"]).withColumn("log_date", F.coalesce(F.last("record_date", True).over(inside), "start_day"))
        return _named(dated, owner, repo, version_id)

    def load(self, path: str, owner: str, repo: str, version_id: str, closed: bool = True, block_bytes: int = lines.BLOCK_BYTES) -> int:
        """Load what is new in a file or a folder's files; the number of lines.

        ``closed``: a last line without a line feed is complete. For a log that is still written give False: then such a line waits.
        """
        known = self.commits()
        key = _key(owner, repo, version_id)
        before = self._versions(known).get(key, {"files": {}})["files"]
        wanted, days = {}, {}
        for file, size in lines.list_files(path).items():
            e = before.get(file, {"byte": 0, "line": 0, "day": None})
            if size < e["byte"]:
                raise ValueError(f"{file} has become shorter; a rolled log needs a new name or version")
            stop = size if closed else lines.last_line_end(file, e["byte"], size)
            if stop > e["byte"]:
                wanted[file], days[file] = (e["byte"], e["line"], stop), e["day"]
        if not wanted:
            return 0
        # Ranges are few, and used twice.
        planned = f"{self.folder}/attempts/ranges-{uuid.uuid4().hex}"
        lines.plan_ranges(self.spark, wanted, block_bytes).write.parquet(planned)
        ranges = self.spark.read.schema(lines.RANGE_SCHEMA).parquet(planned)
        counts = {r.file_path: r.n for r in ranges.groupBy("file_path").agg(F.sum("lines").alias("n")).collect()}  # a row a file
        size = sum(stop - a for a, _, stop in wanted.values())
        tasks = lines.range_tasks(self.spark, sum(-(-(stop - a) // block_bytes) for a, _, stop in wanted.values()), size)
        attempt = self._stage(self._records(ranges, owner, repo, version_id, days, tasks), size)
        staged = self._attempt(attempt)
        last = {r.file_path: r.d for r in staged.groupBy("file_path").agg(F.max_by("log_date", "line_no").alias("d")).collect()}
        files = {}
        for f, (_, line, stop) in wanted.items():
            day = last[f].isoformat() if last.get(f) else days[f]
            files[f] = {"byte": stop, "line": line + counts.get(f, 0), "day": day, "from": line}
        self._commit(known, {"kind": "load", "key": key, "owner": owner, "repo": repo, "version": version_id, "attempt": attempt, "files": files})
        storage.delete(self.spark, planned)
        return sum(counts.values())

    def load_days(self, path: str, owner: str, repo: str, version_id: str, start, stop, zones: DataFrame | None = None, block_bytes: int = lines.BLOCK_BYTES) -> None:
        """Put the days of ``[start, stop)`` of the files in place of those that the version has.

        With a zone map (:func:`runledger.sources.zones.zone_map`) only the zones of these days are read.
        """
        known = self.commits()
        first, end = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(stop))
        sizes = lines.list_files(path)
        if zones is None:
            ranges = lines.plan_ranges(self.spark, {f: (0, 0, size) for f, size in sizes.items()}, block_bytes)
            tasks = lines.range_tasks(self.spark, sum(-(-s // block_bytes) for s in sizes.values()), sum(sizes.values()))
            records = self._records(ranges, owner, repo, version_id, dict.fromkeys(sizes), tasks)
        else:
            mine = zones.filter(F.col("file_path").isin(*sizes) & (F.col("first_day") < as_day(end)) & (F.col("last_day") >= as_day(first)))
            records = self._records_of_zones(mine, owner, repo, version_id)
        attempt = self._stage(in_range(records, first, end).select(*LOG_SCHEMA.fieldNames(), "log_date"), sum(sizes.values()))
        days = [first.isoformat(), end.isoformat()]
        key = _key(owner, repo, version_id)
        self._commit(known, {"kind": "range", "key": key, "owner": owner, "repo": repo, "version": version_id, "attempt": attempt, "days": days})

    def add_behind(self, records: DataFrame) -> int:
        """Add the records behind each version's last committed line, a commit a version; the number of commits."""
        known, n = self.commits(), 0
        keys = ["owner", "repo", "version_id"]
        for v in records.groupBy(*keys).agg(F.max("line_no").alias("last")).collect():  # a row a version
            key = _key(v.owner, v.repo, v.version_id)
            seen = self._versions(known).get(key, {"seen": -1})["seen"]
            if v.last is None or v.last <= seen:
                continue
            mine = records.filter(F.col("owner").eqNullSafe(v.owner) & F.col("repo").eqNullSafe(v.repo) & F.col("version_id").eqNullSafe(v.version_id))
            attempt = self._stage(mine.filter(F.col("line_no") > seen).select(*LOG_SCHEMA.fieldNames(), "log_date"))
            self._commit(known, {"kind": "rows", "key": key, "owner": v.owner, "repo": v.repo, "version": v.version_id, "attempt": attempt, "seen": v.last})
            known, n = self.commits(), n + 1
        return n

    def add(self, records: DataFrame, owner: str, repo: str, version_id: str, source: str, batch: int) -> bool:
        """Add a numbered batch of a source, unless it or a later one has been added. False: it had been."""
        known = self.commits()
        key = _key(owner, repo, version_id)
        if self._versions(known).get(key, {"batches": {}})["batches"].get(source, -1) >= batch:
            return False
        attempt = self._stage(records.select(*LOG_SCHEMA.fieldNames(), "log_date"))
        self._commit(known, {"kind": "rows", "key": key, "owner": owner, "repo": repo, "version": version_id, "attempt": attempt, "batches": {source: batch}})
        return True

    # ---- reading --------------------------------------------------------------------------------------------------

    def _attempt(self, attempt: str) -> DataFrame:
        return self._attempts([attempt])

    def _attempts(self, attempts: list[str]) -> DataFrame:
        """One scan of several attempts."""
        top = f"{self.folder}/attempts"
        found = self.spark.read.schema(SCHEMA).option("basePath", top).parquet(*[f"{top}/attempt={a}" for a in attempts])
        return found.select(*LOG_SCHEMA.fieldNames(), "log_date")

    def read(self, owner: str | None = None, repo: str | None = None) -> DataFrame:
        """The records of all, of an owner, or of one repo. Attempts of others are not opened."""
        known = self.commits()
        plain, parts = [], []
        for n, c in enumerate(known):
            if c["kind"] != "compact" and ((owner or c["owner"]) != c["owner"] or (repo or c["repo"]) != c["repo"]):
                continue
            hidden = self._hidden(c, known[n + 1 :])
            if hidden is None:
                plain.append(c["attempt"])
            else:
                parts.append(self._attempt(c["attempt"]).filter(~hidden))
        if plain:
            parts.append(self._attempts(plain))
        out = reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], SCHEMA)
        for name, value in (("owner", owner), ("repo", repo)):
            if value is not None:
                out = out.filter(F.col(name) == value)
        return out

    @staticmethod
    def _hidden(c: dict, later: list[dict]) -> Column | None:
        """Rows of a commit that a later one stands for; None where there are none."""
        out = []
        for d in later:
            of = (F.col("owner") == d["owner"]) & (F.col("repo") == d["repo"]) & (F.col("version_id") == d["version"])
            same = c["kind"] == "compact" or c["key"] == d["key"]
            if same and d["kind"] == "range":
                out.append(of & (F.col("log_date") >= as_day(d["days"][0])) & (F.col("log_date") < as_day(d["days"][1])))
            if same and d["kind"] == "load" and c["kind"] in ("range", "compact"):
                for file, e in d["files"].items():
                    out.append(of & (F.col("file_path") == file) & (F.col("line_no") >= e["from"]) & (F.col("line_no") < e["line"]))
        return F.coalesce(reduce(Column.__or__, out), F.lit(False)) if out else None

    # ---- upkeep ---------------------------------------------------------------------------------------------------

    def compact(self) -> None:
        """All rows as one attempt, so that a table of many loads opens few files."""
        known = self.commits()
        if not known:
            return
        size = sum(f["byte"] for v in self._versions(known).values() for f in v["files"].values())
        attempt = self._stage(self.read(), size)
        self._commit(known, {"kind": "compact", "attempt": attempt, "versions": self._versions(known)})

    def sweep(self) -> int:
        """Delete attempts that no commit names. No load may be running."""
        named = {f"attempt={c['attempt']}" for c in self.commits()}
        lost = [a for a in storage.names(self.spark, f"{self.folder}/attempts") if a not in named]
        for a in lost:
            storage.delete(self.spark, f"{self.folder}/attempts/{a}")
        return len(lost)


def _named(dated: DataFrame, owner: str, repo: str, version_id: str) -> DataFrame:
    named = dated.select("*", F.lit(owner).alias("owner"), F.lit(repo).alias("repo"), F.lit(version_id).alias("version_id"), F.col("value").alias("raw"))
    return keep_records(named).select(*LOG_SCHEMA.fieldNames(), "log_date")


def _key(owner: str, repo: str, version_id: str) -> str:
    return json.dumps([owner, repo, version_id])
