"""Conversation structure repair by a dynamic program over persistent audits.

A conversation is repaired by edits of its rows, in order: Keep, Rerole, Delete, and Insert anywhere. The cheapest edits
are sought that leave role initials ``(s?(ua)+)?``; among equally cheap ones, those whose initials are least in ASCII.
The program goes from row to row with four states (nothing yet, system, user, assistant came last).

Each state holds its audit as a node of a tree: a character and the node before it, so audits share their
beginnings and a row adds a few nodes, whatever the length of what came before. A node knows its ancestors at distances of powers of two and the
rolling hash of its whole string. Two audits are compared at their longest common prefix, found by
descending the ancestors while hashes differ. Equal hashes are verified node by node up to a node that both share;
a collision moves the difference to where it is.

Where all states agree, edits are decided: their rows are written into the hash of the repaired text and their nodes go.
So memory holds the undecided end of one conversation, a few rows as a rule, and conversations of any length stream through a task in
Arrow batches. A state that can no longer win is dropped: system (nothing) when assistant costs less (less by more than 2).

Spark deals conversations out by id, finds repeated rows by a window and sorts by turn; one exchange does all
three. A conversation is one task's work, since the hash of its text is sequential; rows stream, so it need not fit into memory.

Defined cases: null texts and roles count as one space, as do null ids and turns in the damage's key; a null id is one conversation; null
turns come first; rows of one turn are ordered by role and text. An empty role has an empty initial. Repeated rows are
judged in turn, each but the first being a duplicate. A conversation without rows after damage has zeros, an empty audit and the hash of nothing; an
empty table gives an empty result. Extra columns are not read. Texts of any length are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import nullable, table

# Faults by the remainder of the damage's key, and the costs of edits.
DROP, EMPTY, UNSTOP, REPEAT, AS_USER, REMAINDERS = 0, 1, 2, 3, 4, 20
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACE = " \t\n\x0b\f\r"

#: States: nothing yet, system, user or assistant came last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: What may follow a state, by the initial of the role.
AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The state that an inserted or renamed row leads to, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}

MODULUS, FACTOR = (1 << 61) - 1, 0x1F3D5B79A2C4E68
#: Rows between two looks for decided edits; more where looks find nothing.
LOOK = 64


class Audits:
    """Strings as nodes of a tree, compared through ancestors at powers of two and rolling hashes."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.root = (None, "", 0, 0, (), None)

    def add(self, parent: tuple, letter: str, tag=None) -> tuple:
        """``(parent, letter, depth, hash, ancestors, tag)``; ``ancestors[k]`` is ``2 ** k`` nodes up."""
        up, ancestors = parent, [parent]
        while len(up[4]) >= len(ancestors):
            up = up[4][len(ancestors) - 1]
            ancestors.append(up)
        return (parent, letter, parent[2] + 1, (parent[3] * FACTOR + ord(letter)) % self.modulus, tuple(ancestors), tag)

    @staticmethod
    def ancestor(node: tuple, depth: int) -> tuple:
        while node[2] > depth:
            node = node[4][(node[2] - depth).bit_length() - 1]
        return node

    def split(self, x: tuple, y: tuple) -> tuple[tuple, tuple]:
        """The nodes of the first letters that differ, or a node and itself (where one string begins with the other)."""
        depth = min(x[2], y[2])
        x, y = self.ancestor(x, depth), self.ancestor(y, depth)
        if x is not y and x[3] != y[3]:
            for k in range(len(x[4]) - 1, -1, -1):
                if k < len(x[4]) and x[4][k] is not y[4][k] and x[4][k][3] != y[4][k][3]:
                    x, y = x[4][k], y[4][k]
            differ, x, y = (x, y), x[0], y[0]
        else:
            differ = (x, x)
        # Equal hashes: the strings are equal if all letters are, up to a node that both have.
        while x is not y:
            if x[1] != y[1]:
                differ = (x, y)
            x, y = x[0], y[0]
        return differ

    def less(self, x: tuple, y: tuple) -> bool:
        a, b = self.split(x, y)
        return x[2] < y[2] if a is b else a[1] < b[1]

    def shared(self, x: tuple, y: tuple) -> tuple:
        """The last node that both have."""
        depth = min(x[2], y[2])
        x, y = self.ancestor(x, depth), self.ancestor(y, depth)
        for k in range(len(x[4]) - 1, -1, -1):
            if k < len(x[4]) and x[4][k] is not y[4][k]:
                x, y = x[4][k], y[4][k]
        return x if x is y else x[0]


class Repair:
    """One conversation, row by row."""

    def __init__(self, modulus: int = MODULUS):
        self.audits = Audits(modulus)
        #: For each state (cost, audit); no entry where the state cannot be.
        self.best: dict[int, tuple[int, tuple]] = {NOTHING: (0, self.audits.root)}
        self.letters: list[str] = []
        self.hash, self.first = hashlib.sha256(), True
        self.since, self.look = 0, LOOK
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.turn = self.initial = None
        self._insert()

    def _offer(self, into: dict, state: int, cost: int, parent: tuple, letter: str, tag) -> None:
        known = into.get(state)
        if known is not None and (known[0] < cost or known[0] == cost and known[1][0] is parent and known[1][1] == letter):
            return
        node = self.audits.add(parent, letter, tag)
        if known is None or cost < known[0] or self.audits.less(node, known[1]):
            into[state] = (cost, node)

    def _insert(self) -> None:
        """Rows inserted here: from cheaper states to dearer ones, until none gains."""
        for _ in range(3):
            for state, (cost, node) in sorted(self.best.items(), key=lambda s: s[1][0]):
                self._offer(self.best, NEXT[state], cost + INSERT, node, "I", (NEXT[state], ""))
        a = self.best[ASSISTANT][0]
        for state, slack in ((NOTHING, DELETE), (SYSTEM, 0)):
            if state in self.best and self.best[state][0] > a + slack:
                del self.best[state]

    def row(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        bare = text.strip(SPACE)
        blank, cut = not bare, bool(bare) and bare[-1] not in ".!?"
        initial = role[:1]
        self.rows += 1
        self.blank += blank
        self.duplicate += not blank and repeated
        self.truncated += not blank and not repeated and cut
        if self.rows > 1:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if turn is not None:
            self.turns += turn != self.turn
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        must_go = blank or repeated
        extra = TRUNCATED if cut else 0
        new: dict[int, tuple[int, tuple]] = {}
        for state, (cost, node) in self.best.items():
            self._offer(new, state, cost + DELETE, node, "D", None)
            if not must_go:
                kept = AFTER[state].get(initial)
                if kept is not None:
                    self._offer(new, kept, cost + extra, node, "K", (role, text))
                self._offer(new, NEXT[state], cost + extra + REROLE, node, "R", (NEXT[state], text))
        self.best = new
        self._insert()
        self.since += 1
        if self.since >= self.look:
            self._settle()

    def _settle(self) -> None:
        """Write what all states agree on and forget it."""
        nodes = [node for _, node in self.best.values()]
        last = nodes[0]
        for node in nodes[1:]:
            last = self.audits.shared(last, node)
        if last[2] == 0:
            self.look *= 2
        else:
            self._write(last)
            self.best = self._moved(last)
            self.look = LOOK
        self.since = 0

    def _path(self, node: tuple) -> list[tuple]:
        out = []
        while node[2]:
            out.append(node)
            node = node[0]
        return out[::-1]

    def _write(self, node: tuple) -> None:
        for _, letter, _, _, _, tag in self._path(node):
            self.letters.append(letter)
            if tag is not None:
                role, text = tag
                line = f"{ROLES.get(role, role)}:{text}"
                self.hash.update((line if self.first else "\n" + line).encode("utf-8", "replace"))
                self.first = False

    def _moved(self, last: tuple) -> dict[int, tuple[int, tuple]]:
        """The states' audits behind ``last``, as strings of their own that still share what they shared."""
        copies: dict[int, tuple] = {id(last): self.audits.root}
        out = {}
        for state, (cost, node) in self.best.items():
            chain = []
            while id(node) not in copies:
                chain.append(node)
                node = node[0]
            copy = copies[id(node)]
            for old in reversed(chain):
                copy = copies[id(old)] = self.audits.add(copy, old[1], old[5])
            out[state] = (cost, copy)
        return out

    def result(self) -> tuple:
        ends = [self.best[s] for s in (NOTHING, ASSISTANT) if s in self.best]
        cost, node = ends[0]
        for other in ends[1:]:
            if other[0] < cost or (other[0] == cost and self.audits.less(other[1], node)):
                cost, node = other
        self._write(node)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(self.letters), self.hash.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone`` after the damage. What is dropped stays as a mark, so that its conversation does."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % REMAINDERS
    text = F.when(F.col("fault").isin(DROP, EMPTY), "").when(F.col("fault") == UNSTOP, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == DROP, "").when(F.col("fault") == AS_USER, "user").otherwise(F.col("role"))
    step = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fault.alias("fault"))
    copies = F.explode(F.when(F.col("fault") == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return step.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") == DROP).alias("gone"), copies.alias("copy")).drop("copy")


SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
COLUMNS = [f.split()[0] for f in SCHEMA.split(", ")]


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id, turn, role, text, gone``): its faults, the edits and the repaired text's hash."""
    whole = rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("conv_id"), F.col("conv_id").isNull().alias("no_id"),
        F.col("turn").cast("long").alias("turn"), "role", "text", "gone",
    )
    group = ["conv_id", "no_id"]
    dealt = whole.repartition(*group)
    # A dropped row is no earlier row, so it stands in a group of its own. The digests are of 128 bits and two more hashes.
    digest: Column = F.concat_ws(":", F.col("gone").cast("int"), F.length("role"), F.length("text"), F.md5(F.concat("role", F.lit(":"), "text")), F.xxhash64("role", "text"))
    seen = Window.partitionBy(*group, "digest").orderBy("turn", "role", "text")
    # Partitions hold whole conversations already: the window and the sort need no exchange.
    marked = dealt.withColumn("digest", digest).withColumn("repeated", F.row_number().over(seen) > 1).drop("digest")
    ordered = marked.sortWithinPartitions(*group, F.col("turn").asc_nulls_first(), "role", "text", F.col("repeated"))
    ordered = ordered.select(*group, F.coalesce("turn", F.lit(0).cast("long")).alias("turn"), F.col("turn").isNull().alias("no_turn"), "role", "text", "gone", "repeated")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, work, out = None, None, []

        def told() -> pd.DataFrame:
            frame = pd.DataFrame([r for _, r in out], columns=COLUMNS[1:])
            frame.insert(0, "conv_id", nullable([k[0] for k, _ in out], [k[1] for k, _ in out]))
            return frame

        for f in frames:
            for conv, no_id, turn, no_turn, role, text, gone, repeated in zip(*(f[c].tolist() for c in f.columns), strict=True):
                if (conv, no_id) != key:
                    if work is not None:
                        out.append((key, work.result()))
                    key, work = (conv, no_id), Repair()
                if not gone:
                    work.row(None if no_turn else turn, role, text, repeated)
            if len(out) >= 1000:
                yield told()
                out = []
        if work is not None:
            out.append((key, work.result()))
        if out:
            yield told()

    return ordered.mapInPandas(run, SCHEMA)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


QUERIES = {"op13_conversation_repair": op13_conversation_repair}
ORACLES: dict[str, str] = {}
