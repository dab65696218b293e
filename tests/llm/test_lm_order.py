"""The registered query scores with trigrams, so that a state has somewhere to fail to before the root."""

import pytest

from runledger.llm import backoff_lm, registry

from .test_text_operators import EDGES, brute_lm, documents, some_texts


def test_query_uses_trigrams(spark, tmp_path):
    texts = EDGES + some_texts(80) * 2
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in registry.QUERIES["op2_backoff_lm"](spark, str(tmp_path)).collect()}
    _, two = brute_lm(texts, 2, backoff_lm.STRENGTH)
    _, three = brute_lm(texts, 3, backoff_lm.STRENGTH)
    for i in range(len(texts)):
        assert got[i].score == pytest.approx(three[i][4])
    assert any(a[4] != pytest.approx(b[4]) for a, b in zip(two, three, strict=True))
