"""Runs of white space that tiktoken's pattern cannot hold get the ids of the tokenizers library."""

import zlib

import numpy as np
import pytest

from runledger.llm import bin_slack, bpe_codec, token_rollup

from .test_text_operators import documents

N = 2_000_000
TEXTS = {
    "spaces": " " * N,
    "before a word": "one" + " " * N + "two  three",
    "newlines": "a b" + "\n" * N + "'s 42",
    "newline last": " " * N + "\n" + "x",
    "wide": "　 \x85\r\n\t " * (N // 7) + "é",
    "at a special": "q" + " " * N + "<|endoftext|>" + " " * N + "<|endoftext|> z",
    "two runs": "\t" * N + "." + " " * N + "\x1c" + " " * 100_000 + "漢",
    "short and long": (" " * 99_999 + "a") * 3 + " " * 100_000 + "a" + " " * 100_001,
    "words": "lorem  ipsum \n dolor " * 10_000,
}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_codec.vocabulary())


@pytest.mark.parametrize("name", TEXTS)
def test_ids_of_long_runs(library, name):
    want = library.encode(TEXTS[name], add_special_tokens=False).ids
    assert bin_slack.encoder(bin_slack.ranks_path())(TEXTS[name]) == want


def test_a_long_run_beside_other_rows(spark, library):
    texts = ["one two", TEXTS["before a word"], None]
    docs, path = documents(spark, texts), bin_slack.ranks_path()
    ids = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for t in texts]
    assert [r.n_tokens for r in token_rollup.bpe_counts(docs, path).orderBy("doc_id").collect()] == [len(x) - 1 for x in ids]
    for r in bin_slack.pack(docs, path).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
