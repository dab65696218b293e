"""Passages that stand on few sites, since a third of all rows come from one source."""

import collections
import random

import corpus_pipeline
from runledger.llm import line_spread

from .test_text_operators import documents


def skewed(n_passages=6, copies=14):
    """Documents of own prose; each passage of 60 words stands in ``copies`` of them, on 5 to 8 sites."""
    rng = random.Random(5)
    texts, sources = [], []
    for p in range(n_passages):
        passage = " ".join(f"p{p}w{k}" for k in range(60))
        sites = [f"s{p}-{k}" for k in range(4 + p)]
        for c in range(copies):
            own = [" ".join(f"own{rng.randrange(10**9)}" for _ in range(20)) for _ in range(2)]
            texts.append("\n".join([own[0], passage, own[1]]))
            sources.append("hot" if c % 3 == 0 else sites[c % len(sites)])
    return texts, sources


def test_a_hot_source_hides_no_passage(spark):
    texts, sources = skewed()
    docs = documents(spark, texts, sources=sources)
    seen = collections.Counter()
    for r in corpus_pipeline.line_dedup(spark, docs, "").collect():
        words = r.text.split()
        seen.update({tuple(words[i : i + 50]) for i in range(len(words) - 49)})
    assert max(seen.values()) == 1
    # Each passage stays whole where it stands first.
    assert sum(f"p{p}w0 " in r.text for p in range(6) for r in [docs.collect()[14 * p]]) == 6
    assert all(tuple(f"p{p}w{k}" for k in range(50)) in seen for p in range(6))


def test_sites_needed_by_length(spark):
    line = {n: " ".join(f"l{n}w{k}" for k in range(n)) for n in (3, 4, 7, 8, 20)}
    for sites in (2, 3, 4, 5, 6):
        docs = documents(spark, ["\n".join(line.values())] * sites, sources=[f"s{i}" for i in range(sites)])
        got = {r.doc_id: r.text.split("\n") for r in line_spread.dedup(docs, min_sites=5, more=((8, 3), (20, 6))).collect()}
        need = {3: 99, 4: 5, 7: 5, 8: 3, 20: 6}
        assert got[0] == list(line.values())
        assert got[1] == ([line[n] for n in line if sites < need[n]] or [""])
