import numpy as np

from runledger.llm import embed_join

from .test_embed_join import SCHEMA, brute


def near_groups(rng, width, n, spread):
    base = rng.normal(size=(n, width))
    out = [base[k % n] + rng.normal(size=width) * spread * rng.uniform() for k in range(3 * n)]
    return [list(map(float, np.float32(v))) for v in out]


def test_vectors_of_every_width_are_joined(spark, monkeypatch):
    monkeypatch.setattr(embed_join, "TILE_ROWS", 25)  # trees with several leaves
    rng = np.random.default_rng(3)
    vectors = near_groups(rng, 8, 50, 0.6) + near_groups(rng, 12, 7, 0.4) + near_groups(rng, 3, 30, 0.2) + [[1.0], [-1.0], [2.0]] + near_groups(rng, 40, 1, 0.1)[:1]
    ids = rng.permutation(5000)[: len(vectors)].tolist()
    rows = [(int(i), v, 0, "") for i, v in zip(ids, vectors, strict=True)]
    got = {r.vec_id: r for r in embed_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    links, root = dict.fromkeys(ids, 0), {}
    for width in {len(v) for v in vectors}:
        mine = [(i, v) for i, v in zip(ids, vectors, strict=True) if len(v) == width]
        a, b = brute([v for _, v in mine], [i for i, _ in mine])
        links.update(a)
        root.update(b)
    assert {i: got[i].n_links for i in ids} == links
    assert {i: got[i].component_id for i in ids} == root
    assert sum(links.values()) > 300


def test_the_index_looks_at_few_pairs():
    """Eight blocks would look at 8 times all pairs without an index; the share falls as the number of vectors grows."""
    rng = np.random.default_rng(4)
    shares = []
    for n, depth in ((1500, 0), (12_000, 3)):
        x = rng.normal(size=(n, 64))
        x[: n // 10] = x[n // 10 : 2 * (n // 10)] + rng.normal(size=(n // 10, 64)) * 0.2
        plan = embed_join.Plan(64, 0.9, 8, depth, 2, x[:4000])
        turned, compared, found = plan.turn(x), [], set()
        for b in range(8):
            at, leaf, guest = plan.places(turned, b)
            for k in range(plan.leaves):
                here = np.flatnonzero(leaf == k)
                i, j = plan.links(x[at[here]], turned[at[here]], guest[here], np.zeros(len(here)), b, False, compared)
                pairs = set(map(tuple, np.sort(np.stack((at[here][i], at[here][j]), axis=1)).tolist()))
                assert not pairs & found
                found |= pairs
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        i, j = np.nonzero(np.triu(unit @ unit.T >= 0.9, 1))
        assert found == set(zip(i.tolist(), j.tolist(), strict=True)) and len(found) > n // 20
        shares.append(sum(compared) / (n * (n - 1) / 2))
    assert shares[1] < 0.7 * shares[0] and shares[1] < 2.5


def test_rows_that_no_split_tells_apart():
    x = np.tile(np.random.default_rng(1).normal(size=(1, 16)), (700, 1))
    plan = embed_join.Plan(16, 0.9, 4, 0, 2, x[:0])
    i, j = plan.links(x, plan.turn(x), np.zeros(700, np.int64), np.zeros(700), 0, False)
    assert len(i) == len(set(zip(i.tolist(), j.tolist(), strict=True))) == 700 * 699 // 2
