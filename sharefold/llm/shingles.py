"""Sets of word shingles in numpy, and a sketch of how common shingles are."""

from __future__ import annotations

import numpy as np
import xxhash

SIZE = 4
SKETCH_BITS = 22
SLICES = 64


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of a whole text, A-Z in lower case. With fewer words
    the whole sequence is one shingle; without words there is none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    mixed = h[: len(h) - size + 1].copy()
    for k in range(1, size):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - size + 1 + k]
    return np.unique(mixed)


def digest(members: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    both = np.frombuffer(xxhash.xxh3_128_digest(members.tobytes()), np.int64)
    return int(both[0]), int(both[1])


def slots(members: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    return (members & np.uint64((1 << bits) - 1)).astype(np.int64)


def parity(members: np.ndarray) -> bytes:
    """A bit for each of at least as many slots as the set has members, always a power of two: whether an odd number of
    them falls in the slot. It takes 1/64 to 1/32 of the set's own space, and more for small sets only."""
    bits = max(64, 1 << (len(members) - 1).bit_length()) if len(members) else 64
    return np.packbits((np.bincount(slots(members, bits.bit_length() - 1), minlength=bits) & 1).astype(np.uint8)).tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """Members that are in one of two sets only, at least: each changes one bit between the two parities, and common ones
    none. The longer parity is folded to the length of the shorter one."""
    short, long = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    return int(np.bitwise_count(short ^ np.bitwise_xor.reduce(long.reshape(-1, len(short)), axis=0)).sum())


def rarest_first(members: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The set in one order for all sets: by how common the sketch says a shingle is, then by hash."""
    return members[np.lexsort((members, sketch[slots(members, len(sketch).bit_length() - 1)]))]


def prefix_length(size: int, percent: int) -> int:
    """So many first shingles of a set: two sets that reach ``percent`` have one of theirs in common."""
    return size - -(-percent * size // 100) + 1
