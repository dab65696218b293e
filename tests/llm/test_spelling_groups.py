import random
import re
import zlib
from collections import Counter

import pytest

from runledger.llm import spelling_groups as spelling

DOCS = "doc_id long, text string"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows):
    out = Counter()
    lower = str.maketrans(spelling.UPPER, spelling.LOWER)
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            k = h % len(w)
            out[w[:k] + w[k + 1 :] if h % 97 == 0 else w] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def grouped(counts):
    close = {w: [x for x in counts if near(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        if close[w]:
            best = min(close[w], key=lambda x: (-counts[x], x))
            if counts[best] >= 2 * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(close[w]), counts.get(form.get(w))) for w, n in counts.items()}


def told(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def words(rng, letters, n, longest):
    return {"".join(rng.choice(letters) for _ in range(rng.randrange(5, longest + 1))) for _ in range(n)}


@pytest.mark.parametrize("letters,longest", [("ab", 9), ("abc", 8), ("abcdé", 7), ("aÿz", 30)])
def test_search_finds_each_neighbour_once(letters, longest):
    rng = random.Random(longest)
    for size in (1, 2, 7, 90):
        found = sorted(words(rng, letters, size, longest))
        got = []
        for side in (0, 1):
            turn = (lambda w: w) if side == 0 else (lambda w: w[::-1])
            place = sorted(map(turn, found))
            exact = [len(w) - len(w) // 2 if side == 0 else len(w) // 2 for w in found]
            q, at = spelling.neighbours(spelling.FMIndex(place), list(map(turn, found)), exact, side == 1)
            got += [(found[i], turn(place[j])) for i, j in zip(q, at, strict=True)]
        assert sorted(got) == sorted((a, b) for a in found for b in found if near(a, b))


def test_characters_that_an_index_lacks():
    q, at = spelling.neighbours(spelling.FMIndex(["aaaab", "abcde"]), ["zbcde", "zzzzz", "abcde"], [3, 3, 3], False)
    assert list(zip(q, at, strict=True)) == [(0, 1)]


@pytest.mark.parametrize("shard", [500_000, 60])
def test_groups_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(spelling, "SHARD_CHARS", shard)  # 60: halves with more than four words are split into chunks
    rng = random.Random(11)
    counts = {w: rng.choice([3, 4, 7, 9, 20, 50, 120]) for w in words(rng, "abc", 500, 8)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n int")
    assert told(spelling.groups(frame)) == grouped(counts)


def test_long_chains_lead_to_the_last_form(spark):
    counts = {"a" * 5 + "b" * k: 3 * 2**k for k in range(20)}
    got = told(spelling.groups(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == grouped(counts)
    assert got["aaaaa"][1] == "a" * 5 + "b" * 19


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    vocabulary = list(words(rng, "abé", 120, 7)) + ["x" * 2000, "x" * 1999, "y" * 1999 + "x"]
    rows = [(k if k % 9 else None, " ".join(rng.choice([w, w, w.upper(), w[1:]]) for w in rng.choices(vocabulary, k=60)) + "×ÿ1_") for k in range(60)]
    rows += [(1, None), (2, ""), (3, "😀 abcde " * 4), rows[0]]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    assert told(spelling.op12_spelling_groups(spark, str(tmp_path))) == grouped(counted(rows))


def test_empty_and_lonely(spark):
    assert told(spelling.groups(spark.createDataFrame([], "word string, n long"))) == {}
    docs = spark.createDataFrame([(1, "abc abcd", "x")], DOCS + ", word string")
    assert spelling.counted_words(docs).count() == 0
    one = spark.createDataFrame([("alone", 5)], "word string, n long")
    assert told(spelling.groups(one)) == {"alone": (None, "alone", 5, 0, None)}
