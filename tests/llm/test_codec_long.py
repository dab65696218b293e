import random
import time

import pytest
from tokenizers import Tokenizer

from runledger.llm import bpe_codec


@pytest.mark.parametrize(
    "make",
    [
        lambda rng: "a1" * 500_000,
        lambda rng: "".join(rng.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(1_000_000)),
        lambda rng: "".join(rng.choice("的一是不了人我在有他这，。！") for _ in range(300_000)),
        lambda rng: "x" * 1_000_000,
    ],
)
def test_long_texts_without_spaces_take_linear_time(make):
    text = make(random.Random(1))
    path = bpe_codec.vocabulary()
    codec = bpe_codec.Codec(path)
    codec.encode("warm up")
    began = time.perf_counter()
    ids = codec.encode(text)
    assert time.perf_counter() - began < 60  # quadratic work took half an hour
    assert ids == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert codec.decode(ids) == text
