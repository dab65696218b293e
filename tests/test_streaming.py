import json

from runledger import streaming
from runledger.operators import runs

from .test_log import LOG, random_log


def test_late_files_correct_their_windows(spark, tmp_path):
    records = random_log(spark, 3, n=300)
    source, table, out, mark = (str(tmp_path / x) for x in ("source", "table", "out", "mark"))
    parts = [records.filter(f"line_no % 3 = {k}") for k in (2, 0, 1)]
    for k, part in enumerate(parts):  # the second file is earlier than the first in every way
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LOG).parquet(source)
        streaming.stream_situations(stream, table, out, mark, "2024-01-01", "2024-01-12").awaitTermination()
    parts[0].coalesce(1).write.mode("append").parquet(source)  # the same rows once more
    streaming.stream_situations(spark.readStream.schema(LOG).parquet(source), table, out, mark, "2024-01-01", "2024-01-12").awaitTermination()
    assert spark.read.parquet(table).count() == 300
    columns = ["node_path", "run_date", "situation", "n_records"]
    want = runs.situations(records, "2024-01-01", "2024-01-12").select(columns)
    assert sorted(map(tuple, spark.read.parquet(out).select(columns).collect())) == sorted(map(tuple, want.collect()))


def test_run_windows(spark, tmp_path):
    records = random_log(spark, 5, n=200)
    source, table, out, mark = (str(tmp_path / x) for x in ("source", "table", "out", "mark"))
    for k in (1, 0):
        records.filter(f"line_no % 2 = {k}").coalesce(1).write.mode("append").parquet(source)
        streaming.stream_run_windows(spark.readStream.schema(LOG).parquet(source), table, out, mark, "2024-01-01", "2024-01-12").awaitTermination()
    got = {(r.node_path, str(r.run_date)): r.n_records for r in spark.read.parquet(out).collect()}
    want = runs.run_calendar(records, "2024-01-01", "2024-01-12").filter("n_records > 0").collect()
    assert got == {(r.node_path, str(r.run_date)): r.n_records for r in want}


def test_ingest_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = "owner string, repo string, version_id string, line_no long, value string"
    rows = [{"owner": "o", "repo": "r", "version_id": "v", "line_no": k, "value": f"# LOG:[1:0:{k} 1.1.2024] complete:/a/b{k}"} for k in range(20)]
    (folder / "a.json").write_text("\n".join(map(json.dumps, rows[5:])))
    (folder / "b.json").write_text("\n".join(map(json.dumps, rows)))
    lines = spark.readStream.schema(schema).json(str(folder))
    streaming.stream_ingest(lines, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.node_path for r in got.collect()) == sorted(f"/a/b{k}" for k in range(20))
