"""Hashes of words and of word runs for whole batches of texts at once.

A word is a run of bytes other than space and 0x09-0x0D. All sums are modulo 2**64: a run's hash is a difference of
prefix sums, divided by the power at its start (the bases are odd, so powers have inverses).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
SLICE_BYTES = 1 << 20  # of text that is worked on at a time; one longer text is a slice of its own

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x + U((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Powers:
    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            steps = np.full(size, U(self.base))
            steps[0] = U(1)
            self.up = np.multiply.accumulate(steps)
            steps[1:] = U(self.inverse)
            self.down = np.multiply.accumulate(steps)
        return self.up[:n], self.down[:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair, the same wherever the run stands."""
    powers = _POWERS.setdefault(base, _Powers(base))
    up, down = powers.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


_POWERS: dict[int, _Powers] = {}


@dataclass
class Words:
    """The words of a slice of rows: ``first[r]:first[r + 1]`` are those of row r."""

    rows: int
    hashes: np.ndarray
    first: np.ndarray
    row: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with a bounded amount of text each."""
    texts = batch.column(column)
    lengths = np.zeros(len(texts), dtype=np.int64)
    if len(texts):
        lengths = np.nan_to_num(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    begin = total = 0
    for i, n in enumerate(lengths):
        if i > begin and total + n > SLICE_BYTES:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if begin < len(texts):
        yield batch.slice(begin)


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Words of each text, as hashes; null texts have none. ``lower``: A-Z count as a-z."""
    texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    base = int(offsets[0]) if len(offsets) else 0
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[base : int(offsets[-1])] if data is not None and len(offsets) else np.zeros(0, np.uint8)
    bounds = offsets - base
    inside = ~_SPACE[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edge = bounds[:-1][bounds[:-1] < len(raw)]
    starts[edge] = inside[edge]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = bounds[1:][bounds[1:] > 0] - 1
    ends[edge] = inside[edge]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    values = (_LOWER[raw] if lower else raw).astype(U) + U(1)
    hashes = run_hashes(values, starts, ends, BYTE_BASE)
    first = np.searchsorted(starts, bounds)
    row = np.repeat(np.arange(len(texts)), np.diff(first)) if len(texts) else np.zeros(0, np.int64)
    return Words(len(texts), hashes, first, row, starts, ends)


def shingle_sets(texts: pa.Array, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word runs of each text (lower-cased A-Z); of all words if there are fewer."""
    words = words_of(texts, lower=True)
    n = len(words.hashes)
    runs = run_hashes(words.hashes, np.arange(max(0, n - k + 1)), np.arange(min(k, n), n + 1), WORD_BASE) if n >= k else np.zeros(0, U)
    out = []
    for r in range(words.rows):
        a, b = int(words.first[r]), int(words.first[r + 1])
        if b - a >= k:
            out.append(np.unique(runs[a : b - k + 1]))
        elif b > a:
            whole = run_hashes(words.hashes[a:b], np.array([0]), np.array([b - a]), WORD_BASE)
            out.append(mix(whole, b - a))
        else:
            out.append(np.zeros(0, U))
    return out
