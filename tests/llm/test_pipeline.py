import importlib

import pytest

from runledger.llm import registry


@pytest.fixture(scope="module")
def pipeline():
    return importlib.import_module("corpus_pipeline")


def test_stages_by_brute_force(spark, pipeline, tmp_path):
    from .test_text_operators import brute_classes, brute_lines, documents, near_copies, some_texts

    texts = [t for t in some_texts(80, 3, 60)] + near_copies(1, 20, 80) + ["# " * 40, None, "short", "over and over again we say " * 20]
    header = "subscribe to our weekly letter"
    texts = [f"{header}\n{t}" if t and i % 2 else t for i, t in enumerate(texts)]
    sources = [f"s{i % 15}" for i in range(len(texts))]
    documents(spark, texts, sources=sources).drop("extra").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    kept = pipeline.quality(spark, docs, str(tmp_path))
    assert kept.columns == columns
    stay = {r.doc_id: r.text for r in kept.collect()}
    assert 0 < len(stay) < len(texts) and not {len(texts) - k for k in (1, 2, 3, 4)} & set(stay)
    clean = pipeline.line_dedup(spark, kept, str(tmp_path))
    assert clean.columns == columns
    ids = sorted(stay)
    want = brute_lines([stay[i] for i in ids], [sources[i] for i in ids], ids, 10, 4)
    want = {i: t for i, (_, n, t) in want.items() if not (n and not t.strip())}
    got = {r.doc_id: r.text for r in clean.collect()}
    assert got == want
    ids = sorted(got)
    _, root = brute_classes([got[i] for i in ids])
    single = pipeline.near_dedup(spark, clean, str(tmp_path))
    assert single.columns == columns
    assert {r.doc_id for r in single.collect()} == {ids[k] for k, r in enumerate(root) if r == k}
    packed = pipeline.packing(spark, single, str(tmp_path)).toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in single.collect()}
    whole = pipeline.run(spark, str(tmp_path)).toPandas()
    order = ["doc_id", "piece"]
    assert whole.drop(columns=["sequence_id", "offset"]).sort_values(order).values.tolist() == packed.drop(columns=["sequence_id", "offset"]).sort_values(order).values.tolist()


def test_registry_names_each_operator_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(registry.ORACLES) <= set(registry.QUERIES)
