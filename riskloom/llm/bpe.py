"""Byte-level BPE by longest matches and backtracking, and back."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import kept_names, sealed, unsealed
from riskloom.sources.ship import ship_package

OUTPUTS = ("ids", "decoded")
#: Entries that a Python worker remembers, of pieces and of pairs each; then it starts anew.
REMEMBERED = 250_000
#: Longer pieces are encoded without being remembered.
LONGEST_KEPT = 64
#: Rows whose results a task holds at once, besides the batch that Spark sent.
ROWS_HELD = 256
#: The pieces of longer texts, in characters, are not listed at once.
LISTED_TEXT = 1 << 20


def parse_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base64 tokens and ranks."""
    pairs = (line.split() for line in lines.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class BytePairs:
    """Encoder for one table of ranks.

    Every single byte must be a token, and every longer token must be what the merges of
    lower rank, and then one more, make of its bytes; other tables are refused.

    A sequence of tokens is what the merges give exactly if every two neighbours are:
    merging the bytes of two neighbours on their own must leave them apart. So the
    encoder takes the longest token at each place, steps back to shorter ones where
    neighbours do not hold, and never tries a place twice that led nowhere.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("the ranks must hold every single byte")
        self.ranks = ranks
        self.parts: dict[int, tuple[int, int]] = {}  # the last merge of a token
        self.merged: dict[tuple[int, int], int] = {}  # and the other way round
        many = max(ranks.values()) + 1
        self.size = [0] * many
        self.shorter: list[int | None] = [None] * many  # longest token that a token begins with
        self.apart = _Pairs(self, many)
        self.pieces = _Pieces(self)
        self._learn()

    def _learn(self) -> None:
        """Find the last merge of each token, and the token that each begins with."""
        known: dict[bytes, int] = {}
        for token, rank in sorted(self.ranks.items(), key=lambda pair: pair[1]):
            for cut in range(len(token) - 1, 0, -1):
                left, right = known.get(token[:cut]), known.get(token[cut:])
                if left is not None and right is not None and self.apart.of(left, right):
                    self.parts[rank] = left, right
                    self.merged[left, right] = rank
                    break
            else:
                if len(token) > 1:
                    raise ValueError(f"token {rank} is no merge of two earlier tokens")
            known[token] = rank
        self.apart.clear()  # judged before all merges were known
        self.automaton = ahocorasick.Automaton()  # of Latin-1 characters, which stand for bytes
        self.named = {token.decode("latin-1"): rank for token, rank in known.items()}
        for token, rank in self.named.items():
            self.automaton.add_word(token, rank)
        self.automaton.make_automaton()
        for token, rank in known.items():
            self.size[rank] = len(token)
            starts = (known.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((r for r in starts if r is not None), None)
        self.longest = max(self.size)

    def judge(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes end in just these two tokens.

        Undoes the merges beside the border, latest first. A merge across the border counts
        if its rank comes before the merge that, on one of its sides, next changes what lies
        at the border; of equal ranks the left place is merged first.
        """
        before: float = float("inf")  # merges of lower rank find this border as it is now
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < before:
                return False
            undo_left = left in self.parts and (left > right or right not in self.parts)
            if undo_left:
                before, left = left, self.parts[left][1]
            elif right in self.parts:
                before, right = right + 1, self.parts[right][0]
            else:
                return True

    def encode_bytes(self, piece: bytes) -> list[int]:
        """Token ids of one piece, in time linear in its length."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self.backtracked(piece.decode("latin-1"))

    def longest_at(self, latin: str, at: int) -> int:
        """The longest token at a place; the trie bounds where to look for it."""
        end = at + self.automaton.longest_prefix(latin[at : at + self.longest])
        while (token := self.named.get(latin[at:end])) is None:
            end -= 1
        return token

    def backtracked(self, latin: str) -> list[int]:
        apart, many, size, shorter = self.apart, self.apart.many, self.size, self.shorter
        dead: set[int] = set()  # places from which there is no way on
        found: list[int] = []
        at, goal = 0, len(latin)
        while at < goal:
            token: int | None = self.longest_at(latin, at)
            while True:
                if found:
                    left = found[-1] * many
                    while token is not None and not apart[left + token]:
                        token = shorter[token]
                if token is None:  # nothing fits here: take the last token back
                    dead.add(at)
                    token = found.pop()
                    at -= size[token]
                elif not dead or at + size[token] not in dead:
                    break
                token = shorter[token]
            found.append(token)
            at += size[token]
        return found

    def encode(self, text: str, pattern: regex.Pattern) -> bytes:
        """Ids, as 32-bit integers, of all matches of ``pattern``; the rest of a text has none."""
        if len(text) <= LISTED_TEXT:
            pieces = pattern.findall(text)
        else:
            pieces = map(itemgetter(0), pattern.finditer(text))
        return b"".join(map(self.pieces.__getitem__, pieces))


class _Pairs(dict):
    """Which tokens hold beside each other, by left * many + right; remembered up to a bound."""

    def __init__(self, pairs: BytePairs, many: int):
        self.pairs, self.many = pairs, many

    def __missing__(self, key: int) -> bool:
        if len(self) >= REMEMBERED:
            self.clear()
        holds = self[key] = self.pairs.judge(*divmod(key, self.many))
        return holds

    def of(self, left: int, right: int) -> bool:
        return self[left * self.many + right]


class _Pieces(dict):
    """Encoded pieces, remembered up to a bound."""

    def __init__(self, pairs: BytePairs):
        self.pairs = pairs

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", self.pairs.encode_bytes(piece.encode())).tobytes()
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def _encoder(lines: bytes) -> BytePairs:
    return BytePairs(parse_ranks(lines))  # once per Python worker


@lru_cache(maxsize=2)
def _tokens(lines: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in parse_ranks(lines).items()}


def decode_ids(ids: Iterable[int], tokens: dict[int, bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids))


def _rank_lines(docs: DataFrame, ranks: str):
    """The file of ranks, some hundred kB, for every executor."""
    ship_package(docs.sparkSession)
    with open(ranks, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _lists(parts: list[bytes]) -> pa.Array:
    starts = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int64)
    ids = np.frombuffer(b"".join(parts), np.int32)
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))


def _parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for start in range(0, max(len(batch), 1), ROWS_HELD):
            yield batch.slice(start, ROWS_HELD)


def encode_bpe(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Add ``ids``, the tokens of each whole ``text``; an input column of that name goes.

    ``ranks`` is a file on the driver of base64 tokens and their ranks, ``pattern`` the
    expression each of whose matches is encoded on its own. The ids are those that
    merging bytes by rank gives; a match that is a token is that token. There are no
    special tokens: their strings are ordinary text. A NULL or empty text has no ids.
    Each row is encoded alone, so repeated rows, missing ids and other columns make no
    difference; no rows give no rows. A very long text takes memory for its ids.
    """
    lines, names = _rank_lines(docs, ranks), kept_names(docs, ["ids"])

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs, pieces = _encoder(lines.value), regex.compile(pattern)
        for part in _parts(batches):
            yield _lists([pairs.encode(text.as_py() or "", pieces) for text in part])

    found = docs.select(*sealed(names), encoded(F.col("text")).alias("ids"))
    return found.select(*unsealed(names), "ids")


def decode_bpe(docs: DataFrame, ranks: str) -> DataFrame:
    """Add ``decoded``, the bytes that each row's ``ids`` stand for.

    An input column of that name goes. NULL or no ids give no bytes. An id that is no
    rank in the file is an error. What the pattern of :func:`encode_bpe` did not match
    is not in its ids; a pattern that matches all text makes both an exact round trip.
    """
    lines, names = _rank_lines(docs, ranks), kept_names(docs, ["decoded"])

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = _tokens(lines.value)
        for part in _parts(batches):
            rows = (row.values.to_numpy().tolist() if row.is_valid else () for row in part)
            yield pa.array([decode_ids(ids, tokens) for ids in rows], pa.binary())

    found = docs.select(*sealed(names), decoded(F.col("ids")).alias("decoded"))
    return found.select(*unsealed(names), "decoded")
