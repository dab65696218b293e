"""Clashing names, ties, repeated ids, torn commits."""

import random

import pytest
from pyspark.sql import functions as F

from runledger.llm import line_spread, rule_ledger, shingle_join, token_rollup, url_digest
from runledger.sources import storage

from .test_text_operators import documents

HELPERS = ["_lost", "_lines", "_kept", "_r", "_rest", "_text", "_words", "_windows", "_repeats", "_sorted", "_starts", "first", "at", "line", "place", "m", "a.b"]


@pytest.mark.parametrize("run,replaced", [(line_spread.dedup, ()), (rule_ledger.ledger, ("m",))])
def test_columns_of_any_name_stay(spark, run, replaced):
    texts = ["one two three four five\nown line of text number one", "one two three four five\nanother line of this text"]
    docs = documents(spark, texts).withColumns({c: F.lit(f"my {c}") for c in HELPERS})
    got = run(docs).orderBy("doc_id").collect()
    assert len(got) == 2 and got[0].text == texts[0]
    for c in HELPERS:
        assert c in replaced or got[1][c] == f"my {c}"


def test_lines_need_sites_by_their_length(spark):
    passage, short, plain = " ".join(f"w{k}" for k in range(20)), "all rights reserved", "five words stand right here"
    for sites, gone in ((3, ()), (4, (passage,)), (10, (passage, plain)), (15, (passage, plain)), (16, (passage, plain, short))):
        texts = ["\n".join([passage, short, plain, f"own {k}"]) for k in range(sites)]
        docs = documents(spark, texts, sources=[f"s{k}" for k in range(sites)])
        got = line_spread.dedup(docs, more=line_spread.MORE).orderBy("doc_id").collect()
        assert got[0].text == texts[0]
        assert all(r.text == "\n".join(x for x in texts[r.doc_id].split("\n") if x not in gone) for r in got[1:])


def test_rules_answer_alike_from_array_join_and_frame(spark):
    rng = random.Random(2)
    hosts = ["a.org", "org", "x.a.org", "b.com", "com"]
    paths = ["/", "/x/", "/x/y/", "/xx/yyyy/", "/x/y/z"]
    rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(40)]
    rules += [("a.org", "/x/", "allow"), ("org", "/x/y/", "block"), ("a.org", "/x/", "block"), ("a.org", "/x/", "allow")]
    urls = [f"http://{h}{p}{q}" for h in [*hosts, "q.x.a.org", "aorg"] for p in paths for q in ("", "z", "?k")] + [None, "none"]

    def brute(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, _, path = rest.partition("/")
        path = "/" + path.split("?")[0] if "/" in rest else ""
        fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (max(fits)[2], max(fits)[3]) if fits else (None, "allow")

    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    frame = spark.createDataFrame(rules, "host string, path string, action string")
    want = {k: brute(u) for k, u in enumerate(urls)}
    for got in (url_digest.judge(pages, rules, ()), url_digest.judge_by_join(pages, rules, ()), url_digest.judge(pages, frame, ()), url_digest.judge_by_join(pages, frame, ())):
        assert {r.page_id: (r.rule, r.verdict) for r in got.collect()} == want
    assert {r.verdict for r in url_digest.judge_by_join(pages, [], ()).collect()} == {"allow"}


def test_a_torn_batch_leaves_the_last_totals(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("s", "en", "t", 1, 5), ("s", "de", "t", 1, 7)], "source string, lang string, tokenizer string, d_docs long, d_tokens long")
    store = token_rollup.Rollup(spark, str(tmp_path / "store"))
    total = lambda: sorted(map(tuple, store.totals().collect()), key=str)
    assert store.commit("a", rows) and not store.commit("a", rows)
    before = total()
    with monkeypatch.context() as m:
        m.setattr(storage, "create_once", lambda *_: 1 / 0)
        for batch in ("a", "b"):
            with pytest.raises(ZeroDivisionError):
                store.commit(batch, rows.filter("lang = 'de'"))
            assert total() == before and store.batches() == ["a"]
    assert store.commit("b", rows) and store.commit("a", rows.filter("lang = 'de'"))
    assert total() == [("s", "de", "t", 2, 14), ("s", "en", "t", 1, 5)]
    store.compact()
    assert store.batches() == ["a", "b"] and total() == [("s", "de", "t", 2, 14), ("s", "en", "t", 1, 5)]
    assert not store.commit("b", rows)
    with pytest.raises(ValueError, match="compacted"):
        store.commit("b", rows.filter("lang = 'en'"))
    assert store.commit("c", rows.limit(0)) and total() == [("s", "de", "t", 2, 14), ("s", "en", "t", 1, 5)]


def test_an_id_with_several_texts_loses_no_link(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    base = [[word() for _ in range(60)] for _ in range(5)]
    near = [[*b[:58], word(), word()] for b in base]
    rows = [(1, " ".join(b)) for b in base] + [(10 + k, " ".join(n)) for k, n in enumerate(near)] + [(2, "alone and far from all of them")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in shingle_join.join(docs).collect()}
    assert got == {(1, 1), (2, 2), *((10 + k, 1) for k in range(5))}
    # The tiles find them without the pods as well.
    sets = shingle_join.document_sets(docs)
    assert sets.filter("doc_id = 1").count() == 5


def test_links_of_twins_without_pods(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "_pods", lambda sets, percent: sets.sparkSession.createDataFrame([], "a long, b long"))
    test_an_id_with_several_texts_loses_no_link(spark)
