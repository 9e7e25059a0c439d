"""Words of UTF-8 texts as numpy arrays, block by block.

Words are the maximal runs of bytes outside 0x20 and 0x09-0x0D. Those bytes never occur inside a
multi-byte character, so this splits exactly where ``[^\\x20\\x09-\\x0D]+`` splits the characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text taken at once; one longer text forms a block of its own.
BLOCK_BYTES = 1 << 20
#: Longer words are hashed by a digest, so that the power tables stay small.
LONG_WORD = 1 << 14

_BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: All ASCII but letters: what is left are runs of letters, accented and other scripts' ones included.
NO_LETTER = np.ones(256, dtype=bool)
NO_LETTER[65:91] = NO_LETTER[97:123] = NO_LETTER[128:] = False
#: The same with digits in words.
NO_ALNUM = NO_LETTER.copy()
NO_ALNUM[48:58] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = []


class Block(NamedTuple):
    """Rows ``first`` and on of a column: their bytes, and where each row's bytes begin (and the end)."""

    first: int
    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Start and end of each word in the block's bytes; ``bounds[i]``: the first word of row i."""

    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a string column in blocks of about ``limit`` bytes; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(column))
        bounds = offsets[first : last + 1]
        yield Block(first, data[bounds[0] : bounds[-1]], bounds - bounds[0])
        first = last


def lowered(block: Block) -> Block:
    """The block with A-Z lower-cased."""
    return block._replace(data=_LOWER[block.data])


def split(block: Block, gaps: np.ndarray = SPACE) -> Words:
    """Where words begin and end; ``gaps`` marks the bytes that are in no word."""
    n = len(block.data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, np.zeros(len(block.bounds), dtype=np.int64))
    gap = np.ones(n + 1, dtype=bool)  # gap[i]: no word goes on from byte i-1 to byte i
    space = gaps[block.data]
    gap[1:n] = space[:-1]
    gap[block.bounds] = True
    start = np.flatnonzero(gap[:n] & ~space)
    gap[1:n] = space[1:]
    gap[block.bounds] = True
    end = np.flatnonzero(gap[1:] & ~space) + 1
    return Words(start, end, np.searchsorted(start, block.bounds))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        grown = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            table[0] = 1
            grown.append(np.multiply.accumulate(table))
        _powers[:] = grown
    return _powers


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges (ordered by start): equal bytes, equal hash, wherever they stand."""
    out = np.zeros(len(start), dtype=np.uint64)
    long = np.flatnonzero(end - start > LONG_WORD)
    for i in long:
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    at, step = 0, 1 << 18
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(start, start[at] + step)))
        if to == at + 1 and end[at] - start[at] > LONG_WORD:
            at = to
            continue
        low, high = int(start[at]), int(min(end[to - 1], start[to - 1] + LONG_WORD))
        power, inverse = _tables(high - low + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=sums[1:])
        s, e = start[at:to] - low, np.minimum(end[at:to] - low, high - low)
        value = mixed((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        short = end[at:to] - start[at:to] <= LONG_WORD
        out[at:to][short] = value[short]
        at = to
    return out


def shingles(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of each row, repeats included, and each row's first one.
    A row with fewer words gives its whole sequence as one; a row without words gives none."""
    count = np.diff(bounds)
    per_row = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out_bounds = np.concatenate([[0], np.cumsum(per_row)])
    row = np.repeat(np.arange(len(count)), per_row)
    first = bounds[row] + np.arange(out_bounds[-1]) - out_bounds[row]
    length = np.minimum(count, width)[row]
    value = np.zeros(len(first), dtype=np.uint64)
    for i in range(width):
        more = length > i
        at = np.minimum(first + i, max(len(words) - 1, 0))
        value = np.where(more, mixed(value * np.uint64(_BASE) + words[at] + np.uint64(i + 1)), value) if len(first) else value
    return value, out_bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values sorted and without repeats."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[keep], np.searchsorted(row[keep], np.arange(len(bounds)))
