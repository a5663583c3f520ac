"""Byte-level BPE in numpy: encoding and decoding by a table of byte ranks.

A text is cut by the tokenizer's pattern and each match is encoded by itself:
a match that is a token is that token; else its bytes are merged, the adjacent
pair of least rank first and the leftmost of equals, until no pair is a token.

New matches of a batch are dealt by length into padded matrices, a row a match.
Every round each row merges its leftmost pair of least rank: the matrix of pair
ranks gives it by ``argmin``, the merged cells' right halves are dropped from
all rows at once (compaction: every row gets one cell shorter), and only the
two pairs beside each merge are looked up again, in a hash table of pairs held
in two arrays. Rows without a pair left are read out and leave the matrix.

A match longer than ``LONGEST`` bytes is a matrix of its own, in which a round
merges *all* places of the least rank, left to right: merging one place leaves
that rank the least as long as no pair beside it ranks lower, which is checked
(else the round merges the leftmost alone). So its rounds are as many as the
distinct ranks it meets, not as its bytes.

What a match gives is remembered by the worker, in bounded memory.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import memo
from .common import small_batches

NO_RANK = np.int32(2**31 - 1)
#: Matches that a worker remembers (twice as many at most).
REMEMBERED = 150_000
#: Bytes of a match that gets a row among others.
LONGEST = 256
SCHEMA = "doc_id long, ids binary, decoded binary"
_EMPTY = np.uint64(2**64 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """bytes -> rank of a rank file (a line holds base64 and the rank)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PairTable:
    """Hash table from a pair of ids to the rank of the token they make: open
    addressing in two arrays, looked up for whole arrays of pairs."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(2 * max(len(rank), 1) - 1).bit_length() + 1)
        self.keys = np.full(1 << self.bits, _EMPTY, np.uint64)
        self.ranks = np.full(1 << self.bits, NO_RANK, np.int32)
        keys = self._key(left, right)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == _EMPTY]
            _, one = np.unique(slot[free], return_index=True)      # one newcomer a slot
            placed = free[one]
            self.keys[slot[placed]], self.ranks[slot[placed]] = keys[placed], rank[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK if it makes no token; a negative id (no
        cell) makes none."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(len(left), NO_RANK, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = self._key(left[todo], right[todo])
        slot = self._slot(keys)
        while len(todo):
            held = self.keys[slot]
            hit = held == keys
            out[todo[hit]] = self.ranks[slot[hit]]
            more = ~hit & (held != _EMPTY)
            todo, keys, slot = todo[more], keys[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)


class BytePairs:
    """One vocabulary in one worker. Its ranks are the ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a rank: {missing[:8]}")
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        made = np.array(pairs, np.int64).reshape(-1, 3)
        self.pair = PairTable(made[:, 0], made[:, 1], made[:, 2].astype(np.int32))
        self.memo = memo.Memo(self._new, REMEMBERED, together=1 << 17)

    def _new(self, matches: list[str]) -> list[bytes]:
        """Packed ids (little-endian, 32 bits) of each new match."""
        raw = [m.encode() for m in matches]
        out: list[bytes] = [b""] * len(raw)
        buckets: dict[int, list[int]] = {}
        for i, word in enumerate(raw):
            rank = self.ranks.get(word)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(word) > LONGEST:
                out[i] = self.merge_long(word).astype("<u4").tobytes()
            else:
                buckets.setdefault(_bucket(len(word)), []).append(i)
        for width, members in buckets.items():
            for at in range(0, len(members), 1 << 14):
                some = members[at:at + (1 << 14)]
                for i, ids in zip(some, self.merge([raw[i] for i in some], width)):
                    out[i] = ids
        return out

    def merge(self, words: list[bytes], width: int) -> list[bytes]:
        """Packed ids of words of at most ``width`` bytes, merged as a matrix."""
        size = np.array([len(w) for w in words])
        ids = np.full((len(words), width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        rank = self.pair(ids[:, :-1], ids[:, 1:])
        row = np.arange(len(words))
        out: list[bytes] = [b""] * len(words)
        while len(row):
            width = ids.shape[1]
            at = rank.argmin(axis=1) if width > 1 else np.zeros(len(row), np.int64)
            least = rank[np.arange(len(row)), at] if width > 1 else np.full(len(row), NO_RANK)
            done = least == NO_RANK
            if done.any():
                cells = ids[done].astype("<u4")
                for r, own, n in zip(row[done].tolist(), cells, (ids[done] >= 0).sum(axis=1).tolist()):
                    out[r] = own[:n].tobytes()
                go = ~done
                row, ids, rank, at, least = row[go], ids[go], rank[go], at[go], least[go]
                if not len(row):
                    break
            every = np.arange(len(row))
            ids[every, at] = least
            keep = np.ones(ids.shape, bool)
            keep[every, at + 1] = False
            ids = ids[keep].reshape(len(row), width - 1)
            keep = np.ones(rank.shape, bool)
            keep[every, at] = False
            rank = rank[keep].reshape(len(row), width - 2)
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
            rank[before, at[before] - 1] = self.pair(ids[before, at[before] - 1], ids[before, at[before]])
            rank[after, at[after]] = self.pair(ids[after, at[after]], ids[after, at[after] + 1])
        return out

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long match: all places of the least rank in one round."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)]
        rank = self.pair(ids[:-1], ids[1:])
        while len(ids) > 1:
            least = rank.min()
            if least == NO_RANK:
                break
            at = np.flatnonzero(rank == least)
            # of places that follow each other, every second one, from the left
            run = np.cumsum(np.concatenate([[0], np.diff(at) > 1]))
            first = np.searchsorted(run, np.arange(run[-1] + 1))
            at = at[(np.arange(len(at)) - first[run]) % 2 == 0]
            merged = np.concatenate([[-1], np.where(np.isin(np.arange(len(ids)), at), least, ids), [-1]])
            ahead = np.concatenate([ids, [-1, -1]])[at + 2]         # the cell behind, before its merge
            behind = np.where(np.isin(at - 2, at), least, merged[at])   # the cell before, after its merge
            new = np.full(len(at), least, np.int32)
            if len(at) > 1 and min(self.pair(behind, new).min(), self.pair(new, ahead).min()) < least:
                at = at[:1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids[at] = least
            ids, rank = ids[keep], rank[keep[1:]]
            place = at - np.arange(len(at))                         # where the merges are now
            redo = np.unique(np.concatenate([place - 1, place]))
            redo = redo[(redo >= 0) & (redo < len(ids) - 1)]
            rank = rank[:len(ids) - 1]
            rank[redo] = self.pair(ids[redo], ids[redo + 1])
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        return [b"".join(own) for own in self.memo.values([self.find(t) for t in texts])]

    def decode(self, packed: bytes) -> bytes:
        """Bytes of packed ids."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(packed, "<u4").tolist()])


def _bucket(length: int) -> int:
    """Matrix width for a match: exact while short, then steps of an eighth."""
    step = max(1, 1 << (length - 1).bit_length() >> 4)
    return -(-length // step) * step


def _coder(path: str, pattern: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        codec = memo.held(("byte pairs", path, pattern), lambda: BytePairs(read_ranks(path), pattern))
        for batch in small_batches(batches, "text"):
            packed = codec.encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(packed, pa.binary()),
                 pa.array([codec.decode(p) for p in packed], pa.binary())], ["doc_id", "ids", "decoded"])
    return run


def encode_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (packed: little-endian unsigned 32-bit integers), decoded
    (the bytes that the ids stand for) of every row of ``docs`` (doc_id, text).

    A null or empty text has no ids. A null doc_id is kept; repeated rows give
    repeated rows, an empty table an empty result; other columns are not read.
    ``path`` is the rank file's place on every worker, ``pattern`` what cuts a
    text into matches.
    """
    return docs.select("doc_id", "text").mapInArrow(_coder(path, pattern), SCHEMA)
