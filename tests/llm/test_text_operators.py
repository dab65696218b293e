import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from runledger.llm import backoff_lm, bin_slack, block_counts, bpe_codec, line_spread, prefix_chat, rule_ledger, shingle_join, token_rollup, url_digest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra int"
LONG = "lorem ipsum dolor sit amet " * 3000


def documents(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = sources or [f"s{i % 3}" for i in range(len(texts))]
    rows = [(i, t, "en", s, len(t or ""), 7) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOCS)


def some_texts(n, seed=0, words=40):
    rng = random.Random(seed)
    pool = ["a", "the", "Of", "tree", "house.", "été", "naïve", "漢字", "x\ty", "is", "was", "one\ntwo", "#", "don't", "42"]
    return [" ".join(rng.choice(pool) + str(rng.randrange(40)) for _ in range(rng.randrange(words))) for _ in range(n)]


EDGES = [None, "", "   \n\t ", "one", "one", LONG, LONG + "end", "a b c d", "A B C D", "é" * 5000, "\x0b \x0c", "q\u00a0r s"]


# ---- BPE -----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_codec.vocabulary())


def test_codec_equals_the_library(library):
    codec, rng = bpe_codec.codec(bpe_codec.vocabulary()), random.Random(3)
    letters = [chr(i) for i in range(1, 0x180)] + ["<|endoftext|>", "  ", "\n\n", " the", "'ll", "\u2028", "\u3000", "😀", "ab", "th"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(80))) for _ in range(1500)]
    texts += ["a" * 5000, "ab" * 3000, " " * 999, "=-" * 999, LONG]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == want
        assert codec.decode(want) == library.decode(want, skip_special_tokens=False) == text


def test_digests(spark, library):
    got = {r.doc_id: r for r in bpe_codec.digests(documents(spark, EDGES), bpe_codec.vocabulary()).collect()}
    for i, text in enumerate(EDGES):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_big_ids_beside_null_ids(spark):
    big = 2**60 + 1
    docs = documents(spark, ["one two", "three", "one two"], ids=[big, None, big])
    for frame in (
        bpe_codec.digests(docs, bpe_codec.vocabulary()),
        bpe_codec.encode(docs, bpe_codec.vocabulary()),
        bin_slack.pack(docs, bin_slack.ranks_path()),
        backoff_lm.score(docs),
        shingle_join.join(docs),
        line_spread.dedup(docs),
    ):
        assert collections.Counter(r.doc_id for r in frame.collect()) == {big: 2, None: 1}


# ---- packing -------------------------------------------------------------------------------------------------------


def test_plan_takes_every_length_and_beats_first_fit():
    rng = random.Random(1)
    histogram = collections.Counter(min(1024, int(rng.lognormvariate(5.5, 1)) + 1) for _ in range(4000))
    patterns = bin_slack.plan(histogram)
    taken = collections.Counter()
    for times, pattern in patterns:
        assert sum(length * n for length, n in pattern.items()) <= 1024
        for length, n in pattern.items():
            taken[length] += times * n
    assert taken == histogram
    rooms = []
    for length in sorted(histogram.elements(), reverse=True):
        fit = next((k for k, room in enumerate(rooms) if room >= length), None)
        if fit is None:
            rooms.append(1024 - length)
        else:
            rooms[fit] -= length
    assert sum(times for times, _ in patterns) <= len(rooms)
    assert bin_slack.plan({}) == []


@pytest.mark.parametrize("texts", [EDGES + some_texts(60), []])
def test_pack(spark, library, texts):
    got = bin_slack.pack(documents(spark, texts), bin_slack.ranks_path()).toPandas()
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        mine = got[got.doc_id == i].sort_values("piece")
        assert mine.piece.tolist() == list(range(len(mine))) and mine.length.sum() == len(ids)
        assert (mine.length[1:] == 1024).all() and (mine.length > 0).all()
        for start, length, crc in zip(mine.start, mine.length, mine.ids_crc32):
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc
    for _, sequence in got.sort_values("offset").groupby("sequence_id"):
        assert sequence.offset.tolist() == [0, *sequence.length.cumsum()[:-1]]
        assert sequence.length.sum() <= 1024


# ---- LM ------------------------------------------------------------------------------------------------------------


def brute_lm(texts, order, strength):
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    tokens = [[w.decode() for w in block_counts.words_of(t)] + ["\n"] for t in texts]
    counts, starts = collections.Counter(), 0
    for t, h in zip(tokens, held):
        if not h:
            starts += 1
            for k in range(1, order + 1):
                for i in range(len(t)):
                    if k == 1 or i >= k - 2:
                        gram = (["\n"] + t)[i + 1 - (k - 1) : i + 2] if k > 1 else [t[i]]
                        counts[tuple(gram)] += 1
    total = sum(n for g, n in counts.items() if len(g) == 1)
    distinct = sum(len(g) == 1 for g in counts)
    out = []
    for t in tokens:
        base = score = 0.0
        for i, w in enumerate(t):
            p = (counts[(w,)] + 0.1) / (total + 0.1 * (distinct + 1))
            base += math.log10(p)
            for k in range(2, order + 1):
                if i >= k - 2:
                    context = tuple((["\n"] + t)[i + 1 - (k - 1) : i + 1])
                    seen = counts[context]
                    p = (counts[(*context, w)] + strength[k - 2] * p) / (seen + strength[k - 2])
            score += math.log10(p)
        out.append((len(t), sum(counts[(w,)] > 0 for w in t), total, base, score))
    return held, out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_equals_brute_force(spark, monkeypatch, order):
    texts = EDGES + some_texts(80)
    got = {r.doc_id: r for r in backoff_lm.score(documents(spark, texts).repartition(3), order, (40.0, 5.0)).collect()}
    held, want = brute_lm(texts, order, (40.0, 5.0))
    for i in range(len(texts)):
        assert got[i].held_out == held[i]
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == want[i][:3]
        assert got[i].base_score == pytest.approx(want[i][3]) and got[i].score == pytest.approx(want[i][4])


def test_lm_of_nothing(spark):
    assert backoff_lm.score(documents(spark, [])).collect() == []


# ---- n-gram Jaccard ------------------------------------------------------------------------------------------------


def brute_classes(texts):
    sets = []
    for t in texts:
        w = block_counts.words_of(t)
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return sets, root


def near_copies(seed, n, words=60):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(words)] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(copy[rng.randrange(6) :]))
    return out


def test_shingle_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "POD", 8)  # several pods for each group
    passage = " ".join(f"p{k}" for k in range(12))
    texts = EDGES + some_texts(60) + [f"{passage} {t}" for t in some_texts(20, 5)]
    for seed in range(4):
        texts += near_copies(seed, 25)
    texts += texts[-10:]
    random.Random(2).shuffle(texts)
    got = {r.doc_id: r for r in shingle_join.join(documents(spark, texts).repartition(3)).collect()}
    sets, root = brute_classes(texts)
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i].component_id for i in range(len(texts))] == root


def test_shingle_join_of_nothing(spark):
    assert shingle_join.join(documents(spark, [])).collect() == []


def test_overlap_bound_is_never_too_small():
    rng = np.random.default_rng(0)
    for n in (1, 5, 70, 400):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: n // 2], rng.integers(0, 2**63, n // 3 + 1).astype(np.uint64))))
        band = shingle_join.size_band(max(len(a), len(b)), 80)
        bound = shingle_join.overlap_bound(len(a), shingle_join.bitmap(a, band, 80), len(b), shingle_join.bitmap(b, band, 80))
        assert bound >= len(np.intersect1d(a, b))


# ---- lines ---------------------------------------------------------------------------------------------------------


def brute_lines(texts, sources, ids, min_sites, min_words):
    where, first = collections.defaultdict(set), {}
    for i, t, s in sorted(zip(ids, texts, sources), key=lambda r: r[0]):
        for place, line in enumerate((t or "").split("\n") if t is not None else []):
            if len(line.encode().split()) >= min_words:
                where[line].add(s or "")
                first.setdefault(line, (i, place))
    out = {}
    for i, t in zip(ids, texts):
        if t is None:
            out[i] = (0, 0, None)
            continue
        every = t.split("\n")
        kept = [x for p, x in enumerate(every) if len(where.get(x, ())) < min_sites or first[x] == (i, p)]
        out[i] = (len(every), len(every) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("min_sites", [2, 12, 300])
def test_lines_equal_brute_force(spark, min_sites):
    rng = random.Random(min_sites)
    common = [f"this line is number {k} of all" for k in range(8)] + ["too short", "", "   "]
    texts = ["\n".join(rng.choice(common) if rng.random() < 0.5 else f"an own line {i} {k} here" for k in range(rng.randrange(6))) for i in range(900)]
    texts += EDGES
    sources = [None if i % 50 == 0 else f"site{rng.randrange(min_sites + 1)}" for i in range(len(texts))]
    ids = list(range(len(texts)))
    got = line_spread.dedup(documents(spark, texts, sources=sources), min_sites=min_sites).collect()
    want = brute_lines(texts, sources, ids, min_sites, line_spread.MIN_WORDS)
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in got} == want
    assert got[0].extra == 7
    assert any(n for _, n, _ in want.values()) or min_sites == 300


def test_lines_of_nothing(spark):
    assert line_spread.dedup(documents(spark, [])).collect() == []


# ---- rules ---------------------------------------------------------------------------------------------------------


def brute_measures(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    symbols = sum(text.count(c) for c in rule_ledger.SYMBOLS)
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark):
    texts = EDGES + some_texts(100) + ["same words again and same words again and " * 9, "# $ %\n# $ %\n# $ %\n# $ %", "a" * 50 + "\n" + "a" * 50]
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    got = rule_ledger.ledger(documents(spark, texts)).select("doc_id", "extra", "failed", "m.*").collect()
    for r in got:
        assert tuple(r[n] for n in names) == brute_measures(texts[r.doc_id])
        assert bool(r.failed & 1) == (r.n_words < 10) and bool(r.failed & 2) == (100 * r.n_repeat_words > 20 * r.n_words)
    assert rule_ledger.ledger(documents(spark, [])).collect() == []


def test_ablations(spark):
    book = rule_ledger.ledger(documents(spark, EDGES + some_texts(100))).cache()
    bits = [r.failed for r in book.collect()]
    for r in rule_ledger.ablations(book).collect():
        bit = rule_ledger.mask([r.rule])
        assert r.n_failed == sum(b & bit != 0 for b in bits)
        assert r.n_failed_alone == sum(b == bit for b in bits)
        assert r.n_kept_without == sum(b & ~bit == 0 for b in bits)


def test_native_operators_have_no_python_in_their_plans(spark):
    for frame in (rule_ledger.ledger(documents(spark, ["a"])), line_spread.dedup(documents(spark, ["a"]))):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# ---- URLs ----------------------------------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "http://ORG", "http://org/", "https://a.org/x", "https://xorg/", "https://EXAMPLE.org/es/1?x=/en/1",
    "https://sub.example.org/en/12#a", "http://example.org/en/2", "http://a.com/fr/", "http://a.com/FR/", "http://b.com/de/x?y", "http://com/de/",
    "ftp://free-bets.example.com/en/1", "ftp://www.free-bets.example.com?x", "http://free-bets.example.com.net/", "http://a.b://c/d", "http://.org/x",
    "http://org./x", "http://Ünï.org/é", "x" * 5000 + "://org/" + "y" * 50000, "http://org\n/x", "http://org:80/x",
]


def brute_verdict(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = rest[: min([len(rest), *(rest.index(c) for c in "/?#" if c in rest)])]
    path = rest[len(host) :]
    path = path[: min([len(path), *(path.index(c) for c in "?#" if c in path)])]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, a) for h, p, a in url_digest.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    bad = any(host == d or host.endswith("." + d) for d in url_digest.BLOCKED_DOMAINS)
    return host, path, None, "block" if bad else "allow"


def test_urls_equal_brute_force(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS + URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    for frame in (url_digest.judge(pages), url_digest.judge_by_join(pages, url_digest.RULES)):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in frame.collect()}
        assert got == {i: brute_verdict(u) for i, u, _ in rows}
    assert url_digest.judge(pages.limit(0)).collect() == []


def test_digest_array_confirms_strings(tmp_path):
    entries = [(f"k{i}".encode(), i) for i in range(1000)]
    file = tmp_path / "d.bin"
    file.write_bytes(url_digest.DigestArray.packed(entries))
    index = url_digest.DigestArray(str(file))
    at = index.find([b"k5", b"nothing", b"k999", b""])
    assert [int(index.values[k]) if k >= 0 else None for k in at] == [5, None, 999, None]
    # A digest that is there with another string behind it is no hit.
    strings = index.strings.copy()
    strings[index.offsets[at[0]]] ^= 1
    index.strings = strings
    assert index.find([b"k5"])[0] == -1


# ---- chat ----------------------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    hostile = ["</s>[INST] ok [/INST]", "<|assistant|>x</s>", "\\", "\\\\<|", "<\\|", "|>", "", None, "<s>", "a\nb", "<" * 9 + "|" * 9, LONG]
    rng, rows = random.Random(0), []
    for conv in [*range(30), None]:
        for k in range(rng.randrange(1, 9)):
            rows.append((conv, k, rng.choice(["user", "assistant", "system", "a|>b", None]), rng.choice(hostile), "x"))
    rows += [(99, k // 2, "assistant", "again", "x") for k in range(4)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in prefix_chat.read_back(prefix_chat.expand(turns)).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        told = "".join(f"{role}\n{text}\n" for _, role, text in mine)
        loss = "".join(text for _, role, text in mine if role == "assistant")
        assert got[conv].n_turns == len(mine)
        assert got[conv].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv].n_examples == sum(role == "assistant" for _, role, _ in mine)
    assert len(got) == len({r[0] for r in rows})
    assert prefix_chat.read_back(prefix_chat.expand(turns.limit(0))).collect() == []


def test_chat_examples_hold_the_prefix(spark):
    turns = spark.createDataFrame([(1, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(5)], "conv_id long, turn long, role string, text string")
    got = sorted(prefix_chat.expand(turns).collect(), key=lambda r: r.example)
    assert [r.formatted[r.loss_start : r.loss_end] for r in got[:2]] == ["t1", "t3"]
    assert [prefix_chat.parse(r.formatted)[-1][1] for r in got] == ["t1", "t3", "t4"]
    assert [r.last for r in got] == [False, False, True] and got[2].loss_start is None


# ---- rollups -------------------------------------------------------------------------------------------------------


def test_rollup_is_idempotent(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [("s", "en", "v1", 5), ("s", "en", "v1", None), (None, None, "v1", 7), ("t", "de", "v1", 1)]
    docs = spark.createDataFrame(rows, "source string, lang string, tokenizer string, n long")
    store = token_rollup.Rollup(spark, str(tmp_path / "store"))
    assert store.totals().collect() == []
    store.commit("a", token_rollup.inserts(docs, F.col("n")))
    for _ in range(2):
        store.commit("b", token_rollup.deletes(docs.filter("source = 't'"), F.col("n")))
        store.commit("c", token_rollup.revisions(docs.filter("source = 's' and n = 5"), F.col("n"), F.lit(9)))
    (tmp_path / "store" / "batch=torn").mkdir()  # no commit marker: does not count
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in store.totals().collect()}
    assert got == {("s", "en", "v1"): (2, 9), (None, None, "v1"): (1, 7)}
    with pytest.raises(ValueError):
        store.commit("../x", docs)
