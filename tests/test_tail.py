import pytest

from runledger.sources import lines


def follow(spark, folder, out, mark, **options):
    def load(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = lines.tail(spark, str(folder), **options).writeStream.foreachBatch(load).option("checkpointLocation", str(mark))
    stream.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(str(out)).collect()
    return sorted((r.file_path.rsplit("/", 1)[1], r.line_no, r.byte, r.value) for r in rows)


def expected(folder):
    out = []
    for f in sorted(folder.glob("[!._]*.log")):
        data, at = f.read_bytes(), 0
        whole = data[: data.rfind(b"\n") + 1]
        for n, line in enumerate(whole.split(b"\n")[:-1]):
            out.append((f.name, n, at, line.removesuffix(b"\r").decode("utf-8", "replace")))
            at += len(line) + 1
    return sorted(out)


def test_appended_lines_are_read_once(spark, tmp_path):
    folder, out, mark = tmp_path / "logs", tmp_path / "out", tmp_path / "mark"
    folder.mkdir()
    a, b = folder / "a.log", folder / "b.log"
    a.write_bytes(b"one\ntwo\r\n\nthr")
    (folder / "_hidden.log").write_bytes(b"no\n")
    assert follow(spark, folder, out, mark) == expected(folder)
    assert len(expected(folder)) == 3
    with a.open("ab") as f:
        f.write("ee é\n".encode() + b"\xff\xfe\n" * 3)
    b.write_bytes(b"first of b\n")
    assert follow(spark, folder, out, mark) == expected(folder)
    assert follow(spark, folder, out, mark) == expected(folder)  # nothing new
    with b.open("ab") as f:
        f.write(b"".join(b"line %d\n" % k for k in range(5000)) + b"open end")
    got = follow(spark, folder, out, mark, task_bytes=1 << 12)
    assert got == expected(folder)
    assert len({(r[0], r[1]) for r in got}) == len(got)


def test_a_stream_may_start_behind_a_load(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    a = folder / "a.log"
    a.write_bytes(b"old 0\nold 1\nnew 2\n")
    (name,) = lines.list_files(str(folder))
    got = follow(spark, folder, tmp_path / "out", tmp_path / "mark", after={name: {"byte": 12, "line": 2}})
    assert got == [("a.log", 2, 12, "new 2")]


def test_a_batch_is_split_and_planned_again_after_a_restart(tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "READ_BYTES", 100)
    f = tmp_path / "a.log"
    f.write_bytes(b"".join(b"%d %s\n" % (k, b"x" * (k % 40)) for k in range(300)))
    first = lines.TailReader({"path": str(tmp_path), "taskbytes": "500"})
    end = first.latestOffset()
    parts = first.partitions({}, end)
    assert len(parts) > 5
    fresh = lines.TailReader({"path": str(tmp_path), "taskbytes": "500"})  # another driver: only the offsets are known
    middle = {str(f): {"byte": parts[2].value[1], "line": parts[2].value[3]}}
    for reader, begin, n in ((first, {}, 0), (fresh, middle, parts[2].value[3])):
        rows = [r for p in reader.partitions(begin, end) for b in reader.read(p) for r in b.to_pylist()]
        assert [r["line_no"] for r in rows] == list(range(n, 300))
        assert [r["value"].split()[0] for r in rows] == [str(k) for k in range(n, 300)]
    with pytest.raises(ValueError, match="shorter"):
        f.write_bytes(b"short\n")
        first.latestOffset()


def test_a_line_longer_than_a_read(tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "READ_BYTES", 16)
    (tmp_path / "a.log").write_bytes(b"short\n" + b"y" * 1000 + b"\nend\n")
    reader = lines.TailReader({"path": str(tmp_path)})
    rows = [r["value"] for p in reader.partitions({}, reader.latestOffset()) for b in reader.read(p) for r in b.to_pylist()]
    assert rows == ["short", "y" * 1000, "end"]


def test_a_file_that_goes_and_comes_back_is_not_read_again(tmp_path):
    f = tmp_path / "a.log"
    f.write_bytes(b"one\ntwo\n")
    reader = lines.TailReader({"path": str(tmp_path)})
    first = reader.latestOffset()
    f.rename(tmp_path / ".away")
    assert reader.latestOffset() == first and reader.partitions(first, reader.latestOffset()) == []
    (tmp_path / ".away").rename(f)
    with f.open("ab") as more:
        more.write(b"three\n")
    rows = [r for p in reader.partitions(first, reader.latestOffset()) for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["line_no"], r["value"]) for r in rows] == [(2, "three")]
