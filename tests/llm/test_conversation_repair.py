import hashlib
import itertools
import random
import zlib

import pytest

from runledger.llm import conversation_repair as repair

SPACE = " \t\n\x0b\f\r"
ROWS = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if fault == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


MOVES = {"": "su", "s": "u", "u": "a", "a": "u"}


def least(rows, most_inserts=4):
    """Every sequence of edits, in full: ``(cost, audit, lines)`` of the least."""
    kinds, best = faults(rows), None

    def go(i, last, cost, audit, lines, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and last in ("", "a"):
            best = min(best, (cost, audit, lines)) if best else (cost, audit, lines)
        if inserts < most_inserts:
            for r in MOVES[last].replace("s", ""):
                go(i, r, cost + 5, audit + "I", lines + (("user:" if r == "u" else "assistant:"),), inserts + 1)
        if i == len(rows):
            return
        _, role, text = rows[i]
        go(i + 1, last, cost + 2, audit + "D", lines, inserts)
        if kinds[i] in ("blank", "duplicate"):
            return
        extra = 5 if kinds[i] == "truncated" else 0
        if role[:1] and role[:1] in MOVES[last]:
            go(i + 1, role[0], cost + extra, audit + "K", lines + (f"{role}:{text}",), inserts)
        for r in MOVES[last].replace("s", ""):
            go(i + 1, r, cost + extra + 1, audit + "R", lines + (f"{'user' if r == 'u' else 'assistant'}:{text}",), inserts)

    go(0, "", 0, "", (), 0)
    return best


def layered(rows):
    """The same by plain strings, row by row; for longer conversations."""
    kinds, best = faults(rows), {"": (0, "", ())}

    def inserts(states):
        for _ in range(3):
            for last, (cost, audit, lines) in list(states.items()):
                for r in MOVES[last].replace("s", ""):
                    new = (cost + 5, audit + "I", lines + (("user:" if r == "u" else "assistant:"),))
                    states[r] = min(states.get(r, new), new)
        return states

    best = inserts(best)
    for (_, role, text), kind in zip(rows, kinds, strict=True):
        new = {}
        for last, (cost, audit, lines) in best.items():
            offers = [(last, (cost + 2, audit + "D", lines))]
            if kind not in ("blank", "duplicate"):
                extra = 5 if kind == "truncated" else 0
                if role[:1] and role[:1] in MOVES[last]:
                    offers.append((role[0], (cost + extra, audit + "K", lines + (f"{role}:{text}",))))
                for r in MOVES[last].replace("s", ""):
                    offers.append((r, (cost + extra + 1, audit + "R", lines + (f"{'user' if r == 'u' else 'assistant'}:{text}",))))
            for state, offer in offers:
                new[state] = min(new.get(state, offer), offer)
        best = inserts(new)
    return min(best[s] for s in ("", "a") if s in best)


def expected(rows, solve):
    rows = damage(rows)
    kinds = faults(rows)
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, lines = solve(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations(seed, n, longest):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", None, ""], ["a.", "b!", "ok", "so?", "", " \t", None, "x. ", "c.", "d."]
    rows = []
    for conv in range(n):
        for k in range(rng.randrange(1, longest + 1)):
            turn = None if rng.random() < 0.05 else k + 2 * (rng.random() < 0.1)
            rows.append((conv if conv else None, turn, rng.choice(roles), rng.choice(texts)))
    rng.shuffle(rows)
    return rows


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def run(spark, rows):
    got = repair.repair(repair.damaged(spark.createDataFrame(rows, ROWS).repartition(3))).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def test_equals_every_sequence_of_edits(spark):
    rows = conversations(1, 150, 5)
    assert run(spark, rows) == {c: expected(rs, least) for c, rs in by_conversation(rows).items()}


def test_longer_conversations(spark):
    rows = conversations(2, 12, 90)
    assert run(spark, rows) == {c: expected(rs, layered) for c, rs in by_conversation(rows).items()}


def test_a_conversation_of_many_batches(spark):
    rng = random.Random(5)
    rows = [(7, k, rng.choice(["user", "assistant"]), f"{rng.randrange(9000)}{rng.choice(['.', '!', ''])}") for k in range(25_000)]
    rows += [(8, None, None, None)]
    got = run(spark, rows)
    want = layered_costs(damage([r for r in rows if r[0] == 7]))
    assert got[7][5] == want and len(got[7][6]) >= 20_000
    assert got[8] == expected([(8, None, None, None)], least)


def layered_costs(rows):
    kinds, best = faults(rows), {"": 0, "u": 5, "a": 10}
    for (_, role, _text), kind in zip(rows, kinds, strict=True):
        new = {}
        for last, cost in best.items():
            new[last] = min(new.get(last, 10**9), cost + 2)
            if kind in ("blank", "duplicate"):
                continue
            for r in MOVES[last]:
                if r == role[:1] or r != "s":
                    step = cost + (5 if kind == "truncated" else 0) + (r != role[:1])
                    new[r] = min(new.get(r, 10**9), step)
        for _ in range(3):
            for last in list(new):
                for r in MOVES[last].replace("s", ""):
                    new[r] = min(new.get(r, 10**9), new[last] + 5)
        best = new
    return min(best[""], best["a"])


@pytest.mark.parametrize("modulus", [1, 2, 3, 7])
def test_colliding_hashes_change_nothing(modulus):
    rng = random.Random(modulus)
    for _ in range(60):
        rows = damage([(rng.randrange(99), k, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c!", f"{k}.", f"{k}"])) for k in range(40)])
        work = repair.Repair(modulus)
        for (turn, role, text), kind in zip(rows, faults(rows), strict=True):
            work.row(turn, role, text, kind == "duplicate")
        cost, audit, _ = layered(rows)
        assert work.result()[5:7] == (cost, audit)


def test_audits_compare_like_strings():
    rng, audits = random.Random(3), repair.Audits(5)
    nodes = [(audits.root, "")]
    for _ in range(400):
        node, text = rng.choice(nodes)
        letter = rng.choice("DIK")
        nodes.append((audits.add(node, letter), text + letter))
    for _ in range(3000):
        (x, a), (y, b) = rng.choice(nodes), rng.choice(nodes)
        assert audits.less(x, y) == (a < b)


def test_empty_table_and_lost_conversations(spark):
    empty = spark.createDataFrame([], ROWS)
    assert repair.repair(repair.damaged(empty)).count() == 0
    dropped = next((c, t) for c in range(500) for t in range(5) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got = run(spark, [(*dropped, "user", "hello.")])
    assert got == {dropped[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_extra_columns_and_long_texts(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", "word " * 100_000 + f"{k}.") for k in range(4)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], ROWS + ", repeated int, digest string")
    got = repair.repair(repair.damaged(frame)).first()
    assert tuple(got)[1:] == expected(rows, least)
