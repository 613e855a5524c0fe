"""Words and rolling hashes of Arrow text columns as numpy arrays, inside Spark tasks.

Texts are read as their UTF-8 bytes. White space and A-Z are single bytes in UTF-8, so byte work
equals code point work for the word rule ``[^\\x20\\x09-\\x0D]+`` and for lower-casing A-Z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once; temporary arrays take about 60 times as much.
PIECE = 1 << 18
U64 = np.uint64

_rng = np.random.default_rng(20240229)
#: One random number per byte value; A-Z share the numbers of a-z in the second table.
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
LOWER_CODES = BYTE_CODES.copy()
LOWER_CODES[65:91] = BYTE_CODES[97:123]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True

BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.cumprod(out, out=out)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(29)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(32)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a text column with start and end of each row; a null row is empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not wide and not pa.types.is_string(column.type) and not pa.types.is_binary(column.type):
        column, wide = column.cast(pa.large_string()), True
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n, np.int64), np.zeros(n, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    starts, ends = ends[:-1].copy(), ends[1:].copy()
    if column.null_count:
        ends[column.is_null().to_numpy(zero_copy_only=False)] = 0
        ends = np.maximum(starts, ends)
    return np.frombuffer(data, np.uint8), starts, ends


def pieces(starts: np.ndarray, ends: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows [a, b) with about ``size`` bytes together; a longer text is a run of its own."""
    a, n = 0, len(starts)
    while a < n:
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + size, "right")))
        yield a, b
        a = b


def rolling(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of codes times powers, and the inverse powers that make them free of position."""
    sums = np.zeros(len(codes) + 1, U64)
    np.cumsum(codes * powers(BASE, len(codes)), out=sums[1:])
    return sums, powers(BASE_INVERSE, len(codes) + 1)


def span_hashes(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span that depends on nothing but these bytes."""
    length = (ends - starts).astype(U64)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + length * U64(0xD6E8FEB86659FD93))


def words_of(data: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word of one text, made piece by piece for long texts."""
    found, a, n = [], 0, len(data)
    while a < n:
        b = min(n, a + PIECE)
        while b < n:  # a piece ends at white space
            gap = np.flatnonzero(IS_SPACE[data[a:b]][::-1])
            if len(gap):
                b -= int(gap[0])
                break
            b = min(n, b + PIECE)
        found.append(_words(data[a:b], a, lower))
        a = b
    if not found:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _words(data: np.ndarray, at: int, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums, inverse = rolling((LOWER_CODES if lower else BYTE_CODES)[data])
    return span_hashes(sums, inverse, starts, ends), starts + at, ends + at


def batch_words(column: pa.Array, lower: bool = True, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, word starts, word ends, first word of each row and the end).

    Starts and ends are byte positions in the column's buffer.
    """
    data, starts, ends = text_bytes(column)
    for a, b in pieces(starts, ends, size):
        if b == a + 1:
            hashes, ws, we = words_of(data[starts[a] : ends[a]], lower)
            yield a, b, hashes, ws + starts[a], we + starts[a], np.array([0, len(hashes)])
            continue
        # rows of one run, a blank between them
        lengths = ends[a:b] - starts[a:b]
        first = np.concatenate([[0], np.cumsum(lengths + 1)])
        joined = np.full(int(first[-1]), 32, np.uint8)
        if starts[b - 1] - starts[a] == lengths[:-1].sum():  # no gaps between the rows
            keep = np.ones(len(joined), bool)
            keep[first[1:] - 1] = False
            joined[keep] = data[starts[a] : ends[b - 1]]
        else:
            for k in range(b - a):
                joined[first[k] : first[k] + lengths[k]] = data[starts[a + k] : ends[a + k]]
        hashes, ws, we = _words(joined, 0, lower)
        bounds = np.searchsorted(ws, first)
        row = np.repeat(np.arange(b - a), np.diff(bounds))
        shift = starts[a:b][row] - first[:-1][row]
        yield a, b, hashes, ws + shift, we + shift, bounds


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """A hash for each run of ``size`` words; for fewer words one hash of the whole sequence."""
    n = len(words)
    if n == 0:
        return np.zeros(0, U64)
    width = min(size, n)
    out = np.zeros(n - width + 1, U64)
    factor = 1
    for k in range(width):
        out += words[k : n - width + 1 + k] * U64(factor)
        factor = factor * 0xA0761D6478BD642F % (1 << 64)
    return mix(out + U64(width * 0xE7037ED1A0B428DB % (1 << 64)))


def split_rows(values: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    return [values[bounds[k] : bounds[k + 1]] for k in range(len(bounds) - 1)]


def binary_column(parts: list[bytes | None]) -> pa.Array:
    return pa.array(parts, pa.binary())
