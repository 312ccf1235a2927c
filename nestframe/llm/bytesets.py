"""Vectorised helpers on blocks of texts: one byte buffer per block, numpy over all of it at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BLANKS = np.zeros(256, bool)
_BLANKS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def gaps_between(words: bytes, high: bool = True) -> np.ndarray:
    """The bytes that are none of ``words``, nor, with ``high``, part of a character beyond ASCII."""
    gaps = np.ones(256, bool)
    gaps[list(words)] = False
    if high:
        gaps[128:] = False
    return gaps


def buffer_of(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column with the start and end of each row; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
    base = offsets[0]
    data = np.frombuffer(column.buffers()[2], np.uint8)[base : offsets[-1]]
    starts, ends = offsets[:-1] - base, offsets[1:] - base
    if column.null_count:
        ends = np.where(np.asarray(column.is_valid()), ends, starts)
    return data, starts, ends


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, gaps: np.ndarray = _BLANKS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of each word: runs of bytes that are no ``gaps``, none of them over the end of a row."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = ~gaps[data]
    filled = np.flatnonzero(starts < ends)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    first[starts[filled]] = inside[starts[filled]]
    last[:-1] &= ~inside[1:]
    last[ends[filled] - 1] = inside[ends[filled] - 1]
    begin, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, stop, filled[np.searchsorted(starts[filled], begin, side="right") - 1]


class Hasher:
    """64-bit hashes of any stretches of a buffer: sums of byte times power, whose differences are hashes."""

    def __init__(self, data: np.ndarray, lower: bool = True):
        n = len(data)
        power = np.cumprod(np.full(n, _MULTIPLIER, np.uint64))
        self.inverse = np.cumprod(np.full(n, np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64)), np.uint64))
        plain = _LOWER[data] if lower else data
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((plain.astype(np.uint64) + np.uint64(1)) * power)))

    def __call__(self, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[begin]) * self.inverse[begin] + (stop - begin).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word between blanks (ASCII letters in lower case) and the row it lies in."""
    begin, stop, row = word_bounds(data, starts, ends)
    return (Hasher(data)(begin, stop) if len(begin) else np.zeros(0, np.uint64)), row


def shingles(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``width`` words and its row; of all words of a row that has fewer."""
    words, row = word_hashes(data, starts, ends)
    if not len(words):
        return words, row
    counts = np.bincount(row, minlength=len(starts))
    place = np.arange(len(words)) - np.concatenate(([0], np.cumsum(counts)[:-1]))[row]
    take = (place + width <= counts[row]) | ((place == 0) & (counts[row] < width))
    at = np.flatnonzero(take)
    span = np.minimum(counts[row[at]], width)
    value = np.zeros(len(at), np.uint64)
    for i in range(width):
        here = i < span
        value = np.where(here, mix(value * np.uint64(3) + words[np.minimum(at + i, len(words) - 1)]), value)
    return value, row[at]


def spans_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) if total else 0
    return np.arange(total) + shift


def batched(function: Callable[[pa.Table], pa.Table], max_bytes: int = 1 << 20, column: str = "text", rows: int = 10_000):
    """A function for ``mapInArrow`` that hands on blocks of at most ``max_bytes`` of text and ``rows`` rows.

    A longer text is a block of its own; batches are cut, not joined. What operators make of a block takes some forty
    times its size.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            _, starts, ends = buffer_of(table.column(column))
            sizes = np.cumsum(ends - starts)
            begin = 0
            while begin < table.num_rows:
                base = sizes[begin - 1] if begin else 0
                stop = min(max(begin + 1, int(np.searchsorted(sizes, base + max_bytes, side="right"))), begin + rows)
                yield from function(table.slice(begin, stop - begin)).to_batches()
                begin = stop

    return run
