"""Words, hashes and shingles of whole Arrow text columns in numpy, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Text bytes worked on at once; a longer text is one piece of its own.
PIECE = 2_000_000


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


BASE = 0x9E3779B97F4A7C15 | 1
_SEP = np.zeros(256, bool)
_SEP[[0x20, 9, 10, 11, 12, 13]] = True
#: For words() by letters only: every byte that is neither an ASCII letter nor part of a wider character.
NON_LETTERS = ~np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])
_LOWER = np.arange(256)
_LOWER[65:91] += 32
with np.errstate(over="ignore"):
    _VALUE = mix64((np.arange(256).astype(U) + U(1)) * U(BASE))[_LOWER]
_POW = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POW["n"] < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            up, down = np.full(size, BASE, U), np.full(size, _inverse(BASE), U)
            up[0] = down[0] = 1
            _POW.update(n=size, up=np.cumprod(up, dtype=U), down=np.cumprod(down, dtype=U))
    return _POW["up"], _POW["down"]


def pieces(column: pa.Array, most: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets from 0) of consecutive rows with about ``most`` bytes. Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.binary()), np.int32
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        end = int(np.searchsorted(off, off[start] + most, "right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end - start, raw[off[start] : off[end]], off[start : end + 1] - off[start]
        start = end


def words(data: np.ndarray, off: np.ndarray, sep: np.ndarray = _SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, word offsets per row): every run of bytes that don't separate, inside its row."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    w = np.zeros(n + 1, bool)
    w[:n] = ~sep[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    start = w[:n].copy()
    start[1:] &= ~w[: n - 1] | cut[1:n]
    end = w[:n] & (~w[1:] | cut[1:])
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, off)


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes with A-Z lowered."""
    if not len(s):
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        up, down = _powers(len(data) + 1)
        c = np.zeros(len(data) + 1, U)
        np.cumsum(_VALUE[data] * up[: len(data)], dtype=U, out=c[1:])
        return mix64((c[e] - c[s]) * down[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))


_STEP = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(h: np.ndarray, wo: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row of each): k-word shingles inside each row; a row with 1 to k-1 words has its whole sequence as one."""
    rows = np.repeat(np.arange(len(wo) - 1), np.diff(wo))
    n = len(h)
    with np.errstate(over="ignore"):
        if n >= k:
            g = np.zeros(n - k + 1, U)
            for i in range(k):
                g += mix64(h[i : n - k + 1 + i] + _STEP[i % 5] * U(i // 5 + 1))
            whole = rows[: n - k + 1] == rows[k - 1 :]
            g, r = mix64(g)[whole], rows[: n - k + 1][whole]
        else:
            g, r = np.zeros(0, U), np.zeros(0, np.int64)
        count = np.diff(wo)
        short = np.flatnonzero((count > 0) & (count < k))
        if len(short):
            extra = np.zeros(len(short), U)
            for i in range(k - 1):
                has = count[short] > i
                extra[has] += mix64(h[wo[short[has]] + i] + _STEP[i % 5] * U(i // 5 + 1))
            g = np.concatenate([g, mix64(extra + count[short].astype(U) * U(0xE7037ED1A0B428DB))])
            r = np.concatenate([r, short])
            order = np.argsort(r, kind="stable")
            g, r = g[order], r[order]
    return g, r


def distinct(g: np.ndarray, r: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, and row offsets into them."""
    order = np.lexsort((g, r))
    g, r = g[order], r[order]
    keep = np.ones(len(g), bool)
    keep[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    g, r = g[keep], r[keep]
    return g, np.searchsorted(r, np.arange(n_rows + 1))
