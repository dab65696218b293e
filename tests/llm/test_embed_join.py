import numpy as np
import pytest

from runledger.llm import embed_join

SCHEMA = "vec_id long, embedding array<float>, label int, component_id string"


def brute(vectors, ids):
    good = [v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v) for v in vectors]
    unit = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v, g in zip(ids, vectors, good) if g}
    links, root = dict.fromkeys(ids, 0), {i: i for i in ids}
    names = sorted(unit)
    for k, a in enumerate(names):
        for b in names[:k]:
            if unit[a] @ unit[b] >= 0.9:
                links[a] += 1
                links[b] += 1
                x, y = root[a], root[b]
                root = {i: min(x, y) if r in (x, y) else r for i, r in root.items()}
    return links, root


@pytest.mark.parametrize("tile_rows", [20_000, 40])
def test_links_equal_brute_force(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(embed_join, "TILE_ROWS", tile_rows)  # small: tiles split into chunk pairs
    rng = np.random.default_rng(tile_rows)
    base = rng.normal(size=(60, 16))
    vectors = [list(map(float, np.float32(v))) for v in base]
    for k in range(4):
        vectors += [list(map(float, np.float32(base[k] + rng.normal(size=16) * s))) for s in rng.uniform(0, 0.5, 30)]
    vectors += [vectors[0], vectors[0], None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16]
    ids = rng.permutation(1000)[: len(vectors)].tolist()
    rows = [(int(i), v, 1, "clash") for i, v in zip(ids, vectors)]
    got = {r.vec_id: r for r in embed_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    links, root = brute(vectors, ids)
    assert {i: got[i].n_links for i in ids} == links
    assert {i: got[i].component_id for i in ids} == root
    assert all(got[i].kept == (i == root[i]) for i in ids)


def test_null_ids_and_nothing(spark):
    rows = [(None, [1.0, 0.0], 1, ""), (1, [1.0, 0.0], 1, ""), (2, [1.0, 0.0, 0.0], 1, "")]
    got = {r.vec_id: r for r in embed_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 3 and got[1].n_links == 0
    assert embed_join.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_every_linked_pair_meets_in_one_cell_of_an_admitting_block():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 16))
    x[150:] = x[:150] + rng.normal(size=(150, 16)) * 0.1
    plan = embed_join.Plan(16, 0.9, 4, 2, 3, x[:50])
    turned = plan.turn(x)
    gaps = (turned[:150] - turned[150:]) ** 2
    for b, cut in enumerate(plan.cuts):
        rows, cell, guest = plan.places(turned, b)
        seen = {}
        for r, c, g in zip(rows.tolist(), cell.tolist(), guest.tolist()):
            seen.setdefault(r, {})[c] = g
        for k in range(150):
            if gaps[k, cut].sum() <= plan.budget[b]:
                meet = [c for c in seen[k] if c in seen[k + 150] and not seen[k][c] & seen[k + 150][c]]
                assert len(meet) == 1
