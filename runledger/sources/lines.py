"""Lines of log files by byte range, and a stream that follows growing files.

Spark's file source takes a file once: lines that are added later are never seen. The source ``log_tail`` keeps,
for each file, how many bytes and lines it has given out, reads what was added behind them, and
numbers the lines as in the whole file. Its offsets are in the stream's checkpoint, so a stream that starts again reads no line twice.

Only whole lines are given out, up to the last line feed; the rest waits until it is complete. A carriage return
at a line's end goes. Files are known by name: a log that is rolled needs a new one, and a file that
has become shorter is an error. Paths may be of any file system that pyarrow opens.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

LINE_SCHEMA = "file_path string, byte long, line_no long, value string"
RANGE_SCHEMA = "file_path string, first_byte long, end_byte long, first_line long, lines long"
_ARROW = pa.schema([("file_path", pa.string()), ("byte", pa.int64()), ("line_no", pa.int64()), ("value", pa.string())])
#: Bytes that are read at once, and bytes of one task of a stream's batch, about.
READ_BYTES, TASK_BYTES = 8 << 20, 32 << 20
#: Bytes that are taken apart into lines at once; as Python's objects they take some ten times as much.
LINE_BYTES = 1 << 20
#: Bytes of a range that batch jobs read as one, about.
BLOCK_BYTES = 16 << 20
#: Bytes that a task of a batch job reads at least, where ranges are smaller.
RANGES_BYTES = 4 << 20


def file_system(path: str) -> tuple[files.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("s3a://"):
        path = "s3://" + path.removeprefix("s3a://")
    return files.FileSystem.from_uri(path) if "://" in path else (files.LocalFileSystem(), os.path.abspath(path))


def list_files(folder: str) -> dict[str, int]:
    """Sizes of a folder's files (of a file: its own) by path; names that start with a dot or an underscore do not count."""
    system, top = file_system(folder)
    head = folder[: -len(top)] if folder.endswith(top) else ""
    info = system.get_file_info(top)
    if info.type == files.FileType.File:
        return {head + info.path: info.size}
    found = system.get_file_info(files.FileSelector(top, recursive=True, allow_not_found=True))
    hidden = lambda path: any(p[:1] in "._" for p in path[len(top) :].split("/") if p)
    return {head + f.path: f.size for f in sorted(found, key=lambda f: f.path) if f.type == files.FileType.File and not hidden(f.path)}


def copy_start(path: str, target: str, size: int) -> None:
    """The first ``size`` bytes of a file in place of the target, which changes at once or not at all."""
    system, name = file_system(path)
    other, into = file_system(target)
    other.create_dir(into.rsplit("/", 1)[0], recursive=True)
    half = f"{into.rsplit('/', 1)[0]}/._{uuid.uuid4().hex}"
    with system.open_input_file(name) as f, other.open_output_stream(half) as out:
        while size:
            data = f.read(min(READ_BYTES, size))
            out.write(data)
            size -= len(data)
    other.move(half, into)


def read_range(path: str, start: int, stop: int, line_no: int) -> Iterator[pa.RecordBatch]:
    """The lines of ``[start, stop)``, which begins and ends at line starts (or at the file's end)."""
    system, name = file_system(path)
    with system.open_input_file(name) as f:
        f.seek(start)
        at, rest = start, b""
        while at + len(rest) < stop:
            data = f.read(min(max(LINE_BYTES, len(rest)), stop - at - len(rest)))  # a long line in ever larger pieces
            if not data:
                raise OSError(f"{path} ends before byte {stop}")
            rest += data
            end = len(rest) if at + len(rest) == stop else rest.rfind(b"\n") + 1
            if not end:
                continue
            raw = rest[:end].removesuffix(b"\n").split(b"\n")
            places, place = [], at
            for line in raw:
                places.append(place)
                place += len(line) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path] * len(raw), pa.string()),
                    pa.array(places, pa.int64()),
                    pa.array(range(line_no, line_no + len(raw)), pa.int64()),
                    pa.array([line.removesuffix(b"\r").decode("utf-8", "replace") for line in raw], pa.string()),
                ],
                schema=_ARROW,
            )
            line_no += len(raw)
            at, rest = at + end, rest[end:]


def last_line_end(path: str, start: int, size: int) -> int:
    """The place behind the last line feed of ``[start, size)``; ``start`` if there is none."""
    system, name = file_system(path)
    with system.open_input_file(name) as f:
        stop = size
        while stop > start:
            at = max(start, stop - READ_BYTES)
            f.seek(at)
            found = f.read(stop - at).rfind(b"\n")
            if found >= 0:
                return at + found + 1
            stop = at
    return start


def _line_start(f, at: int, start: int, stop: int) -> int:
    """The first place from ``at`` on in ``[start, stop]`` where a line starts; ``start`` is one."""
    if at <= start:
        return start
    f.seek(at - 1)
    at -= 1
    while at < stop:
        data = f.read(min(1 << 16, stop - at))
        found = data.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(data)
        if not data:
            break
    return stop


def range_tasks(spark: SparkSession, ranges: int, size: int) -> int:
    """Tasks for so many ranges of so many bytes in all: small ranges share one, but no fewer run than can at once."""
    return max(1, min(ranges, max(-(-size // RANGES_BYTES), spark.sparkContext.defaultParallelism), 100_000))


def plan_ranges(spark: SparkSession, wanted: dict[str, tuple[int, int, int]], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Ranges of whole lines with their numbers: ``file_path, first_byte, end_byte, first_line, lines``.

    ``wanted``: file -> (byte to start at, number of the line there, byte to stop at). Tasks find the line starts next to the
    blocks' ends and count what is between; sums over a file's blocks give the numbers. So no line passes the driver.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for path, start, stop, line, k in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                system, name = file_system(path)
                with system.open_input_file(name) as f:
                    first = _line_start(f, start + k * block_bytes, start, stop)
                    end = _line_start(f, min(start + (k + 1) * block_bytes, stop), start, stop)
                    n, at = 0, first
                    f.seek(first)
                    data = b""
                    while at < end:
                        data = f.read(min(READ_BYTES, end - at))
                        n += data.count(b"\n")
                        at += len(data)
                    # A file's last line may lack its line feed.
                    rows.append((path, first, end, line, n + (first < end and not data.endswith(b"\n"))))
            yield pa.RecordBatch.from_pylist([dict(zip(("file_path", "first_byte", "end_byte", "first_line", "lines"), r, strict=True)) for r in rows])

    rows = [(f, a, stop, line) for f, (a, line, stop) in wanted.items() if a < stop]
    files_ = spark.createDataFrame(rows, "file_path string, start long, stop long, line long")
    blocks = files_.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(stop - start - 1) div {block_bytes}"))))
    tasks = range_tasks(spark, sum(-(-(stop - a) // block_bytes) for _, a, stop, _ in rows), sum(stop - a for _, a, stop, _ in rows))
    measured = blocks.repartition(tasks).mapInArrow(measure, RANGE_SCHEMA).filter("first_byte < end_byte")
    before = Window.partitionBy("file_path").orderBy("first_byte").rowsBetween(Window.unboundedPreceding, -1)
    return measured.withColumn("first_line", F.col("first_line") + F.coalesce(F.sum("lines").over(before), F.lit(0)))


def read_ranges(ranges: DataFrame, tasks: int, bytes_read=None) -> DataFrame:
    """The lines of planned ranges; ``block`` is the first byte of a line's range.

    ``bytes_read``: an accumulator that takes the bytes of each range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start, stop, line_no in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if bytes_read is not None:
                    bytes_read.add(stop - start)
                for lines in read_range(path, start, stop, line_no):
                    yield lines.append_column("block", pa.array([start] * lines.num_rows, pa.int64()))

    # A number of its own: the rows are small whatever they name, so Spark would put all into one task.
    dealt = ranges.select("file_path", "first_byte", "end_byte", "first_line").repartition(max(1, min(tasks, 100_000)))
    return dealt.mapInArrow(run, LINE_SCHEMA + ", block long")


class TailReader(DataSourceStreamReader):
    """Offsets are ``{file: {"byte": b, "line": n}}``: what has been given out."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.task_bytes = int(options.get("taskbytes", TASK_BYTES))
        self.first = json.loads(options.get("after", "{}"))
        #: What is known of files: places where lines start, with their numbers, at the ends of tasks. Facts, so never stale.
        self.marks: dict[str, list[tuple[int, int]]] = {f: [(0, 0), (o["byte"], o["line"])] for f, o in self.first.items()}

    def initialOffset(self) -> dict:
        return self.first

    def _known(self, path: str, at: dict | None) -> None:
        marks = self.marks.setdefault(path, [(0, 0)])
        if at is not None and (at["byte"], at["line"]) not in marks:
            marks.append((at["byte"], at["line"]))
            marks.sort()

    def _advance(self, path: str, size: int) -> tuple[int, int]:
        """Count lines from the last mark on; a mark every ``task_bytes``, and one behind the last whole line."""
        marks = self.marks.setdefault(path, [(0, 0)])
        byte, line = marks[-1]
        if size < byte:
            raise ValueError(f"{path} has become shorter; a rolled log needs a new name")
        if size == byte:
            return byte, line
        system, name = file_system(path)
        with system.open_input_file(name) as f:
            f.seek(byte)
            at = byte
            while at < size:
                data = f.read(min(READ_BYTES, size - at))
                if not data:
                    break
                end = data.rfind(b"\n") + 1
                if end:
                    line += data.count(b"\n", 0, end)
                    byte = at + end
                    if byte - marks[-1][0] >= self.task_bytes:
                        marks.append((byte, line))
                at += len(data)
        if marks[-1] != (byte, line):
            marks.append((byte, line))
        return byte, line

    def latestOffset(self) -> dict:
        out = {}
        for path, size in list_files(self.path).items():
            byte, line = self._advance(path, size)
            if byte:
                out[path] = {"byte": byte, "line": line}
        for path, marks in self.marks.items():  # a file that has gone for a while has still been read
            if path not in out and marks[-1][0]:
                out[path] = {"byte": marks[-1][0], "line": marks[-1][1]}
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for path, stop in end.items():
            begin = start.get(path, {"byte": 0, "line": 0})
            self._known(path, begin)
            if self.marks[path][-1][0] < stop["byte"]:  # planned again after a restart
                self._advance(path, stop["byte"])
            self._known(path, stop)
            cuts = [m for m in self.marks[path] if begin["byte"] <= m[0] <= stop["byte"]]
            out += [InputPartition((path, a[0], b[0], a[1])) for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def commit(self, end: dict) -> None:
        for path, done in end.items():
            self.marks[path] = [m for m in self.marks.get(path, ()) if m[0] >= done["byte"]] or [(done["byte"], done["line"])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return read_range(*partition.value)


class LogTail(DataSource):
    """``spark.readStream.format("log_tail").load(folder)``, after :func:`register`.

    Options: ``path``; ``taskBytes``; ``after``, JSON of offsets behind which a new stream starts
    (where a load has ended: :meth:`runledger.sources.loads.RecordStore.ends`). The driver reads what
    is new to count its lines, and keeps counts alone; so a large log is loaded first and followed from there.
    """

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return LINE_SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LogTail)


def tail(spark: SparkSession, folder: str, after: dict | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """A stream of the lines of a folder's files, as they grow."""
    register(spark)
    return spark.readStream.format("log_tail").option("after", json.dumps(after or {})).option("taskBytes", task_bytes).load(folder)
