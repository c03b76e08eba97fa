"""Words of many texts at once, as numpy arrays: their places and 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_table(separators: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


#: Bytes between words split at white space, [\x20\x09-\x0D].
SPACES = byte_table(bytes([0x20, *range(0x09, 0x0E)]))
#: Bytes between words of digits, letters and everything beyond ASCII.
NOT_ALPHANUMERIC = byte_table(bytes(b for b in range(128) if not (chr(b).isascii() and chr(b).isalnum())))
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end, and where each text starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a run of texts. ``first[i]`` is the number of words before text ``i``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def text(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> Words:
    """Words are the longest runs of bytes that aren't separators, within one text."""
    inside = ~separators[data]
    before = np.empty(len(data) + 1, bool)  # before[i]: the byte at i - 1 is in a word
    before[0], before[1:] = False, inside
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & (~before[:-1] | edge[:-1]))
    after = np.empty(len(data), bool)
    if len(data):
        after[:-1], after[-1] = inside[1:], False
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(start, end, np.searchsorted(start, offsets), _hashes(data, start, end))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """Hash of each word's bytes; a few words at a time, to bound memory."""
    letters = mix(np.arange(1, 257, dtype=U64))
    out = np.empty(len(start), U64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + step)))
        length = end[at:to] - start[at:to]
        places = np.cumsum(length) - length
        inner = np.arange(int(length.sum())) - np.repeat(places, length)
        powers = np.cumprod(np.full(int(length.max()), _BASE))
        part = letters[data[inner + np.repeat(start[at:to], length)]] * powers[inner]
        out[at:to] = mix(np.add.reduceat(part, places) + length.astype(U64))
        at = to
    return out


def window_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``size`` words from each word on; the last ``size - 1`` have none."""
    n = max(0, len(hashes) - size + 1)
    if seed:
        hashes = mix(hashes + mix(np.array([seed], U64)))
    out, power = np.zeros(n, U64), U64(1)
    for k in range(size):
        out += hashes[k : k + n] * power
        power = U64((int(power) * int(_BASE)) & 0xFFFFFFFFFFFFFFFF)
    return mix(out)


def whole_windows(first: np.ndarray, size: int) -> np.ndarray:
    """For each place a window of ``size`` words can start, does it stay within its text?"""
    total = int(first[-1])
    n = max(0, total - size + 1)
    ok = np.ones(total, bool)
    for end in first[1:]:
        ok[max(0, end - size + 1) : end] = False
    return ok[:n]
