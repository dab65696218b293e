"""Exact BPE encoding by backtracking, and decoding by an offset table.

The merges of a byte-level BPE vocabulary define one encoding of a piece of text.
A sequence of tokens is that encoding exactly if every two neighbours are
compatible, that is, if the two tokens' joint text encodes to just these two.
So an encoder need not run merges: an Aho-Corasick automaton over the vocabulary
gives the leftmost longest tokens in one pass, the compatibility table judges each
neighbouring pair, and where a pair is refused the encoder falls back to the next
shorter prefix of its token, or, if none is left, one token back. A bit for each
position that has failed keeps the work linear. The table is filled on demand from
the merges by undoing them from the boundary outwards.

Text is split by the vocabulary's pattern first; special strings are found as the
tokenizers library finds them. Pieces repeat, so each worker keeps a bounded memo.
Decoding gathers token bytes out of one buffer by an offset table.

Null texts count as empty: no tokens, the hash of nothing.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import nullable, table, whole_ids

#: Entries in each of a worker's two memos (words as they stand, pieces of them); one starts afresh when full.
MEMO = 300_000

# White space as Unicode defines it, and the pattern that splits text before merging.
_SPACE = r"\t-\r \x85\xa0  -     　"
_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file (``tokenizers`` JSON, byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = lambda t: bytes(letters[c] for c in t).decode("latin-1")
        vocabulary = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        tokens = {raw(t): i for t, i in vocabulary.items() if t not in special}
        self.tokens = tokens
        self.size = {i: len(t) for t, i in tokens.items()}
        # Position of each token in the order of merging; single bytes come before all merges.
        self.made = {i: -1 for t, i in tokens.items() if len(t) == 1}
        self.halves = {}
        self.joined = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (raw(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            a, b, whole = tokens[left], tokens[right], tokens[left + right]
            self.joined.setdefault((a, b), rank)
            if whole not in self.made:
                self.made[whole] = rank
                self.halves[whole] = (a, b)
        self.longest = ahocorasick.Automaton()
        for t, i in tokens.items():
            self.longest.add_word(t, i)
        self.longest.make_automaton()
        self.shorter = {}
        for t, i in tokens.items():
            self.shorter[i] = next((tokens[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in tokens), None)
        self.special = special
        self.split_special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.pattern = regex.compile(_PATTERN)
        self.odd_space = regex.compile(rf"(?:^|[ ])[{_SPACE}]|[{_SPACE}](?:[ ]|$)")
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        size = max([*tokens.values(), *special.values()]) + 1
        pieces = [b""] * size
        for t, i in tokens.items():
            pieces[i] = t.encode("latin-1")
        for t, i in special.items():
            pieces[i] = t.encode()
        self.buffer = np.frombuffer(b"".join(pieces), np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int64)

    def compatible(self, left: int, right: int) -> bool:
        """Does the text of the two tokens encode to just these two?

        Walk back in the order of merging: whichever side was made last is undone
        to its part next to the boundary. Were there a merge across the boundary
        that comes before the merge just undone, it would have been made instead.
        """
        known = self.fits.get((left, right))
        if known is not None:
            return known
        a, b, made, joined = left, right, self.made, self.joined
        # Merges before `limit` may cross; among equal ranks the one further left is made first.
        limit, last_undone_left = len(joined) + 1, True
        while True:
            across = joined.get((a, b))
            if across is not None and (across < limit or (across == limit and not last_undone_left)):
                fit = False
                break
            if made[a] < 0 and made[b] < 0:
                fit = True
                break
            if made[a] >= made[b] and made[a] >= 0 and not (made[a] == made[b] and made[b] >= 0):
                limit, last_undone_left = made[a], True
                a = self.halves[a][1]
            else:
                limit, last_undone_left = made[b], False
                b = self.halves[b][0]
        self.fits[(left, right)] = fit
        return fit

    def _backtrack(self, piece: str, greedy: list[tuple[int, int]], good: int) -> list[int]:
        """Go on from the first pair that does not fit; ``good`` tokens stand before it."""
        out = [token for _, token in greedy[:good]]
        starts = [0] + [end + 1 for end, _ in greedy[: good - 1]]
        failed = bytearray(len(piece) + 1)
        longest = {greedy[k - 1][0] + 1: greedy[k][1] for k in range(good, len(greedy))}
        at = greedy[good - 1][0] + 1
        token, size, fits = greedy[good][1], self.size, self.fits
        while True:
            end = at + size[token]
            fit = not failed[end]
            if fit and out:
                pair = (out[-1], token)
                fit = fits[pair] if pair in fits else self.compatible(*pair)
            if fit:
                out.append(token)
                starts.append(at)
                at = end
                if at == len(piece):
                    return out
                token = longest.get(at)
                if token is None:
                    token = longest[at] = self._longest_at(piece, at)
                continue
            shorter = self.shorter[token]
            while shorter is None:
                failed[at] = 1
                token, at = out.pop(), starts.pop()
                shorter = self.shorter[token]
            token = shorter

    def _longest_at(self, piece: str, at: int) -> int:
        reach = at + self.longest.longest_prefix(piece[at : at + 512])
        tokens = self.tokens
        while True:
            token = tokens.get(piece[at:reach])
            if token is not None:
                return token
            reach -= 1

    def _piece(self, piece: str) -> tuple[int, ...]:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1")
        whole = self.tokens.get(piece)
        if whole is not None:
            return (whole,)
        greedy = list(self.longest.iter_long(piece))
        fits, good, last = self.fits, 0, -1
        for _, token in greedy:
            if good:
                pair = (last, token)
                if not (fits[pair] if pair in fits else self.compatible(last, token)):
                    return tuple(self._backtrack(piece, greedy, good))
            last = token
            good += 1
        return tuple([token for _, token in greedy])

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        pieces, found = self.pieces, []
        for piece in self.pattern.findall(chunk):
            got = pieces.get(piece)
            if got is None:
                got = self._piece(piece)
                if len(piece) < 64:
                    if len(pieces) >= MEMO:
                        pieces.clear()
                    pieces[piece] = got
            found.extend(got)
        ids = tuple(found)
        if len(chunk) < 64:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[chunk] = ids
        return ids

    def _plain(self, text: str) -> list[int]:
        ids: list[int] = []
        memo, add = self.memo, ids.extend
        if self.odd_space.search(text):  # runs of white space: no cut at single spaces
            for piece in self.pattern.findall(text):
                got = memo.get(piece)
                add(self._chunk(piece) if got is None else got)
            return ids
        # Every space stands between other characters, so it opens the next piece.
        first, *rest = text.split(" ")
        got = memo.get(first)
        add(self._chunk(first) if got is None else got)
        for word in rest:
            word = " " + word
            got = memo.get(word)
            add(self._chunk(word) if got is None else got)
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.split_special is None or not self.split_special.search(text):
            return self._plain(text)
        ids, at = [], 0
        for m in self.split_special.finditer(text):
            if m.start() > at:
                ids += self._plain(text[at : m.start()])
            ids.append(self.special[m[0]])
            at = m.end()
        if at < len(text):
            ids += self._plain(text[at:])
        return ids

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        starts = self.offsets[ids]
        lengths = self.offsets[ids + 1] - starts
        ends = np.cumsum(lengths)
        if not len(ids):
            return b""
        at = np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)
        return self.buffer[at].tobytes()

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a vocabulary file, built once in each process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, ids)`` of every row, token ids as ``array<int>``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for f in frames:
            ids = nullable(f[id_column], f["no_id"])
            yield pd.DataFrame({id_column: ids, "ids": [np.array(c.encode(t), np.int32) for t in f[text_column]]})

    return docs.select(*whole_ids(id_column), text_column).mapInPandas(run, f"{id_column} long, ids array<int>")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text; counts and hashes of both directions."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for f in frames:
            rows = []
            for text in f["text"]:
                ids = np.array(c.encode(text), "<u4")
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(c.decode(ids).encode()).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", nullable(f["doc_id"], f["no_id"]))
            yield out

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(*whole_ids("doc_id"), "text").mapInPandas(run, schema)


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary())


QUERIES = {"op3_bpe_codec": op3_bpe_codec}
ORACLES: dict[str, str] = {}
