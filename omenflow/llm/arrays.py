"""Words and shingles of whole Arrow batches as numpy arrays: no Python step for each word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: One odd multiplier for positions, and a random number for each byte (A-Z as a-z).
STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))
LETTERS = np.random.Generator(np.random.PCG64(20240117)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LETTERS[65:91] = LETTERS[97:123]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP and its inverse to the powers 0 to n."""
    if len(_powers[0]) <= n:
        size = 1 << int(n).bit_length()
        for k, base in enumerate((STEP, INVERSE)):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _powers[k] = np.cumprod(run, dtype=np.uint64)
    return _powers[0][: n + 1], _powers[1][: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed scramble of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each row begins and ends; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word in order, and how many words each row has."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    inside = ~SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = at[:-1][at[:-1] < n]  # a row's first byte begins a word, and the byte before it ends one
    begins[edge] = inside[edge]
    last = at[1:][at[1:] > 0] - 1
    ends[last] = inside[last]
    first, final = np.flatnonzero(begins), np.flatnonzero(ends)
    up, down = _power(n)
    total = np.cumsum(LETTERS[raw] * up[:n], dtype=np.uint64)
    before = np.where(first > 0, total[first - 1], np.uint64(0))
    hashes = mix((total[final] - before) * down[first] + (final - first).astype(np.uint64))
    where = np.searchsorted(first, at)
    return hashes, np.diff(where)


def shingle_rows(hashes: np.ndarray, counts: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingles of each row; a row with fewer words than ``width`` has its words as one shingle."""
    ends = np.cumsum(counts)
    n = len(hashes)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * STEP)
    if n >= width:
        sums = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            sums += mix(hashes[k : n - width + 1 + k] + factors[k]) * factors[k]
        sums = mix(sums)
    out = []
    for c, e in zip(counts.tolist(), ends.tolist(), strict=True):
        if c >= width:
            x = np.sort(sums[e - c : e - width + 1])
            keep = np.ones(len(x), bool)
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            out.append(x[keep])
        elif c:
            part = mix(hashes[e - c : e] + factors[:c]) * factors[:c]
            out.append(mix(np.array([part.sum(dtype=np.uint64) + np.uint64(c)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def pack(keys: np.ndarray) -> bytes:
    """Sorted numbers as differences."""
    return planes(np.diff(keys, prepend=keys.dtype.type(0)))


def planes(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return len(x).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(raw).tobytes(), "zstd", asbytes=True) if len(x) else b""


def unplanes(data: bytes, kind) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(data[8:], n * width, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, n).T).view(kind).ravel()


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, np.uint64), dtype=np.uint64)
