"""Texts of an Arrow batch as one byte array, and 64-bit digests of its parts, for the functions that run inside tasks.

Digests are products of powers of an odd multiplier over a random value per byte or word, modulo 2**64, then mixed.
They depend on the content alone, so every task gives the same content the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15
NO_ID = np.iinfo(np.int64).max
_POWERS: dict[str, np.ndarray] = {}

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n of the multiplier and of its inverse."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, 1 << 16)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


class Sums:
    """Digests of any span of a sequence of 64-bit values in constant time."""

    def __init__(self, values: np.ndarray):
        up, self.down = _powers(len(values))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + length * np.uint64(0xD6E8FEB86659FD93))


class Texts:
    """Texts laid end to end: `data` bytes, text i at data[at[i]:at[i + 1]]. Null texts are empty."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        if isinstance(column, pa.ChunkedArray):
            column = column.cast(pa.large_binary()).combine_chunks()
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
        at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
        whole = column.buffers()[2] if len(column) else None
        first, last = int(at[0]), int(at[-1])
        self.data = np.frombuffer(whole, np.uint8)[first:last] if whole is not None else np.zeros(0, np.uint8)
        self.at = at - first

    def __len__(self) -> int:
        return len(self.at) - 1

    def digests(self) -> np.ndarray:
        return Sums(BYTE_VALUE[self.data]).span(self.at[:-1], self.at[1:])


class Words:
    """The words of texts: word j is data[start[j]:end[j]], the words of text i are first[i] .. first[i + 1]."""

    def __init__(self, data: np.ndarray, at: np.ndarray, is_word: np.ndarray = IS_WORD):
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = is_word[data]
        begins = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        borders = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
        begins[borders] = inside[1:-1][borders]
        ends[borders - 1] = inside[1:-1][borders - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)
        self.names = Sums(BYTE_VALUE[data]).span(self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def covered(n: int, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Which of n positions lie in a span [start, start + length)."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:-1]) > 0


def runs_of(flags: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of set flags that cross no border."""
    padded = np.zeros(len(flags) + 2, bool)
    padded[1:-1] = flags
    begins, ends = padded[1:-1] & ~padded[:-2], padded[1:-1] & ~padded[2:]
    inner = borders[(borders > 0) & (borders < len(flags))]
    begins[inner], ends[inner - 1] = flags[inner], flags[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def parts(batch: pa.Table, column: str, most_bytes: int) -> Iterator[pa.Table]:
    """Slices of a batch with about so many bytes of text each; a longer text makes a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    if isinstance(sizes, np.ndarray) and len(sizes):
        groups = np.cumsum(sizes) // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1), len(sizes)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(a, b - a)
