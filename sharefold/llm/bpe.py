"""Byte-level BPE: encoding with a segment tree over byte positions, and decoding.

A text is cut by the tokenizer's pattern. Of each piece, a segment tree over its byte positions holds the leftmost pair
of lowest rank; a merge takes the root and changes at most three leaves, each in logarithmic time. Pieces of like
length are merged together, one merge of each at a time, as numpy arrays.
"""

from __future__ import annotations

import base64
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NONE = np.iinfo(np.int64).max

# Memory bounds inside a task; neither changes a result.
CACHED_PIECES = 60_000
BLOCK_CHARS = 500_000


class PairRanks:
    """Rank of a pair of neighbouring tokens, as an open-addressed table that is read for whole arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, -1, np.int32)
        key = np.array([a << 32 | b for a, b in pairs], np.int64)
        rank = np.array(list(pairs.values()), np.int32)
        at = self._slot(key)
        while len(key):
            free = self.keys[at] == -1
            self.keys[at[free]] = key[free]  # of several keys for a slot one stays, the others move on
            placed = self.keys[at] == key
            self.ranks[at[placed]] = rank[placed]
            key, rank, at = key[~placed], rank[~placed], (at[~placed] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = self._slot(key)
        seen = self.keys[at]
        todo = np.flatnonzero((seen != key) & (seen != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[todo]]
            todo = todo[(seen != key[todo]) & (seen != -1)]
        return np.where(self.keys[at] == key, self.ranks[at].astype(np.int64), NONE)


class _Numbered(dict):
    """Numbers new keys in order."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class ByteBpe:
    """A tokenizer from the ranks of its tokens; ids are ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.tokens = dict(zip(ranks.values(), ranks, strict=True))
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self.pair_ranks = PairRanks(pairs)
        self._reset()

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBpe:
        """From a rank file: a token in base 64 and its rank on each line."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def _reset(self) -> None:
        self.numbers, self.known = _Numbered(), 0
        self.starts, self.counts, self.flat = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)]

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("ranks", "pattern", "tokens", "byte_ids", "pair_ranks")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._reset()

    def merge(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of at most ``width`` (a power of two) bytes, one after another, and how many each has."""
        n, shift = len(pieces), width.bit_length() - 1
        size = np.array([len(p) for p in pieces], np.int64)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        place = np.arange(width)
        alive = place < size[:, None]
        token = np.zeros((n, width + 1), np.int64)
        token[:, :width] = self.byte_ids[raw]
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        tree = np.full((n, 2 * width), NONE, np.int64)
        rank = self.pair_ranks(token[:, : width - 1].ravel(), token[:, 1:width].ravel()).reshape(n, width - 1)
        pair = alive[:, 1:] & (rank != NONE)
        tree[:, width : 2 * width - 1][pair] = ((rank << shift) | place[:-1])[pair]
        half = width // 2
        while half:
            np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2], out=tree[:, half : 2 * half])
            half //= 2
        rows = np.arange(n)
        while True:
            root = tree[rows, 1]
            rows, root = rows[root != NONE], root[root != NONE]
            if not len(rows):
                break
            pos, new = root & (width - 1), root >> shift
            gone = after[rows, pos]
            right, left = after[rows, gone], before[rows, pos]
            token[rows, pos], alive[rows, gone], after[rows, pos], before[rows, right] = new, False, right, pos
            has_right, has_left = right < size[rows], left >= 0
            ahead = np.where(has_right, self.pair_ranks(new, token[rows, right]), NONE)
            behind = self.pair_ranks(token[rows[has_left], left[has_left]], new[has_left])
            leaf = np.concatenate([gone, pos, left[has_left]])
            value = np.concatenate([np.full(len(rows), NONE), ahead, behind])
            value = np.where(value == NONE, NONE, (value << shift) | leaf)
            row, node = np.concatenate([rows, rows, rows[has_left]]), leaf + width
            tree[row, node] = value
            for _ in range(shift):
                node >>= 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
        return token[:, :width][alive].astype(np.int32), alive.sum(axis=1)

    def _learn(self, pieces: list[str]) -> None:
        """Encodes new pieces and appends them to the cache."""
        groups: dict[int, list[int]] = {}
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        ids: list[np.ndarray] = []
        order: list[np.ndarray] = []
        counts = np.ones(len(raw), np.int64)
        whole = [(i, self.ranks[p]) for i, p in enumerate(raw) if p in self.ranks]
        if whole:
            order.append(np.array([i for i, _ in whole]))
            ids.append(np.array([r for _, r in whole], np.int32))
        for i, p in enumerate(raw):
            if p not in self.ranks:
                groups.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for width, members in groups.items():
            step = max(1, (1 << 17) // width)
            for start in range(0, len(members), step):
                block = members[start : start + step]
                found, many = self.merge([raw[i] for i in block], width)
                ids.append(found)
                order.append(np.array(block))
                counts[block] = many
        at = sum(len(x) for x in self.flat)
        starts = np.empty(len(raw), np.int64)
        for block in order:
            many = counts[block]
            starts[block] = at + np.cumsum(many) - many
            at += int(many.sum())
        self.starts, self.counts = [np.concatenate([*self.starts, starts])], [np.concatenate([*self.counts, counts])]
        self.flat = [np.concatenate([*self.flat, *ids])]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each text has; a null text has none."""
        find = regex.compile(self.pattern).findall
        flat, counts, block, chars = [], [], [], 0

        def flush() -> None:
            if len(self.numbers) > self.known:
                self._learn(list(islice(self.numbers, self.known, None)))
                self.known = len(self.numbers)
            piece = np.concatenate(block) if block else np.empty(0, np.int64)
            many = self.counts[0][piece] if len(piece) else np.empty(0, np.int64)
            ends = np.cumsum(many)
            if len(piece):
                source = np.repeat(self.starts[0][piece] - (ends - many), many) + np.arange(ends[-1])
                flat.append(self.flat[0][source])
            bounds = np.concatenate([[0], ends])[np.cumsum([0] + [len(b) for b in block])]
            counts.append(np.diff(bounds))
            if len(self.numbers) > CACHED_PIECES:
                self._reset()

        for text in texts:
            block.append(np.fromiter(map(self.numbers.__getitem__, find(text or "")), np.int64))
            chars += len(text or "")
            if chars >= BLOCK_CHARS:
                flush()
                block, chars = [], 0
        if block:
            flush()
        return np.concatenate([np.empty(0, np.int32), *flat]), np.concatenate([np.empty(0, np.int64), *counts])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for; an unknown id raises KeyError."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def share_tokenizer(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The tokenizer, read on the driver and sent to the executors; its size is that of the vocabulary."""
    return spark.sparkContext.broadcast(ByteBpe.load(path, pattern))


def encode_column(tokenizer: Broadcast, text: str = "text") -> Column:
    """array<int> of token ids of whole texts; null counts as empty."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        parts = []
        for start in range(0, len(texts), 256):
            ids, counts = tokenizer.value.encode(texts.slice(start, 256).to_pylist())
            bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            parts.append(pa.ListArray.from_arrays(bounds, pa.array(ids, pa.int32())))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return encode(F.col(text))


def decode_column(tokenizer: Broadcast, ids: str = "ids") -> Column:
    """The text of an array of ids, as binary; null ids give no bytes."""

    @F.arrow_udf("binary")
    def decode(rows: pa.Array) -> pa.Array:
        return pa.array([tokenizer.value.decode(np.array(r or [], np.int64)) for r in rows.to_pylist()], pa.binary())

    return decode(F.col(ids))


def tokenize(docs: DataFrame, tokenizer: Broadcast, text: str = "text") -> DataFrame:
    """``docs`` with a column ``_ids``; a null text has none, other columns stay."""
    return docs.withColumn("_ids", encode_column(tokenizer, text))
