"""Word splitting and 64-bit window hashes over whole batches of texts, in NumPy.

Words are runs of bytes other than space and 0x09-0x0D.  A word's hash is a polynomial over its
bytes, taken from prefix sums, and then mixed; a window's hash is a polynomial over word hashes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np

U = np.uint64
BATCH = 1 << 20  # bytes of text hashed at once; one longer text makes a batch of its own


def cache() -> dict:
    """Things that live as long as the worker process."""
    return sys.__dict__.setdefault("_orbitframe_cache", {})


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64, n of each at least."""
    have = cache().get("powers")
    if have is None or len(have[0]) < n:
        size = max(1 << 21, 1 << int(n).bit_length())
        base = 0x9E3779B97F4A7C15
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, U(b))
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=U))
        have = cache()["powers"] = tuple(both)
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that each bit depends on all bits."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def low(part: float) -> int:
    """The 64-bit number that this part of all are not above."""
    return min((1 << 63) - 1, -(1 << 63) + int(part * (1 << 64)))


def tables(lower: bool, letters: bool, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value for each byte, and whether it is part of a word (letters: no ASCII signs are)."""
    key = ("tables", lower, letters, second)
    if key not in cache():
        values = mix(np.arange(1, 257, dtype=U) * U(0xC2B2AE3D27D4EB4F if second else 0xD6E8FEB86659FD93))
        if lower:
            values[65:91] = values[97:123]
        inside = np.ones(256, dtype=bool)
        inside[[9, 10, 11, 12, 13, 32]] = False
        if letters:
            inside[[b for b in range(128) if not chr(b).isalnum()]] = False
        cache()[key] = values, inside
    return cache()[key]


class Words:
    """The words of some texts, given as bytes: hashes, places, and the text each belongs to."""

    def __init__(self, texts: list[bytes], lower: bool = False, letters: bool = False):
        self.blob = b"\n".join(texts)
        self.buf = buf = np.frombuffer(self.blob, dtype=np.uint8)
        values, inside = tables(lower, letters)
        word = np.zeros(len(buf) + 2, dtype=np.int8)
        word[1:-1] = inside[buf]
        edge = np.diff(word)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        self.text_start = np.concatenate([[0], np.cumsum(sizes)])
        #: words first[t] to first[t + 1] are those of text t
        self.first = np.searchsorted(self.start, self.text_start)
        self.hash = self.hashed(values)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def hashed(self, values: np.ndarray) -> np.ndarray:
        """Each word's hash from the values of its bytes."""
        up, down = powers(len(self.buf) + 1)
        total = np.zeros(len(self.buf) + 1, dtype=U)
        np.cumsum(values[self.buf] * up[: len(self.buf)], out=total[1:])
        h = (total[self.end] - total[self.start]) * down[self.start]
        return mix(h + (self.end - self.start).astype(U) * U(0xA24BAED4963EE407))

    def windows(self, k: int, words: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Start word and hash of each window of k words that lies in one text; words: other hashes to take."""
        words = self.hash if words is None else words
        n = len(words)
        if n < k:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
        up, down = powers(n + 1)
        total = np.zeros(n + 1, dtype=U)
        np.cumsum(words * up[:n], out=total[1:])
        at = np.flatnonzero(self.text[: n - k + 1] == self.text[k - 1 :])
        return at, mix((total[at + k] - total[at]) * down[at] + U(k))


def batches(arrow_batches, columns: list[str], most: int = BATCH) -> Iterator[list[tuple]]:
    """Rows of Arrow batches, text first and as bytes (null: empty), about `most` bytes at a time."""
    import pyarrow as pa

    rows, size = [], 0
    for b in arrow_batches:
        cols = [b.column(b.schema.get_field_index(c)) for c in columns]
        cols[0] = cols[0].cast(pa.large_binary() if pa.types.is_large_string(cols[0].type) else pa.binary())
        for row in zip(*(c.to_pylist() for c in cols)):
            text = row[0] or b""
            rows.append((text, *row[1:]))
            size += len(text)
            if size >= most:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows
