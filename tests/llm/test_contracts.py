"""Columns, types and row counts of the registered queries on the smallest tables."""

import pytest

from runledger.llm import registry

SF = "/root/testdata/sf0.001"

# What each query returns at least.
CONTRACTS = {
    1: "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    2: "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    3: "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    5: "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    7: "page_id bigint, host string, path string, rule string, verdict string",
    8: "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    9: "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    10: "doc_id bigint, n_shingles bigint, component_id bigint",
    11: "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    13: "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
}


@pytest.mark.parametrize("number", sorted(CONTRACTS))
def test_contract(spark, number):
    name = next(n for n in registry.QUERIES if n.startswith(f"op{number}_"))
    found = registry.QUERIES[name](spark, SF)
    types = dict(found.dtypes)
    for column in CONTRACTS[number].split(", "):
        c, kind = column.split(" ")
        assert types[c] == kind
    key = "vec_id" if number == 1 else "page_id" if number == 7 else "conv_id" if number in (9, 13) else "doc_id"
    table = {"vec_id": "embeddings", "page_id": "pages", "conv_id": "conversations", "doc_id": "documents"}[key]
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).distinct().collect()}
    got = [r[0] for r in found.select(key).collect()]
    assert set(got) == (ids | {-7} if number == 9 else ids)
    assert number == 5 or len(got) == len(set(got))


def test_spelling_contract(spark):
    found = registry.QUERIES["op12_spelling_groups"](spark, SF)
    assert dict(found.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}


def test_rollup_equals_a_plain_count(spark):
    from collections import Counter

    from runledger.llm import bin_slack

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids, first = bin_slack.encoder(bin_slack.ranks_path()), {}
    for r in sorted(docs, key=lambda r: r.doc_id):
        first.setdefault(r.text, r.doc_id)
    want = Counter()
    for r in docs:
        words = len((r.text or "").encode().split())
        for tokenizer, n, tokens in (("bpe50k-1", 1, len(ids(r.text))), ("words-1", int(first[r.text] == r.doc_id), (words + 1) * (first[r.text] == r.doc_id))):
            want[r.source, r.lang, tokenizer, "docs"] += n
            want[r.source, r.lang, tokenizer, "tokens"] += tokens
    got = Counter()
    for r in registry.QUERIES["op6_token_rollup"](spark, SF).collect():
        got[r.source, r.lang, r.tokenizer, "docs"] = r.n_docs
        got[r.source, r.lang, r.tokenizer, "tokens"] = r.n_tokens
    assert +got == +want
