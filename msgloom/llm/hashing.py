"""Rolling hashes of bytes with numpy, over several texts laid end to end."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _table(base: int, size: int) -> np.ndarray:
    """base ** 0, 1, 2 … modulo 2 ** 64."""
    kept = _powers.get(base)
    if kept is None or len(kept) < size:
        steps = np.full(max(size, 1 << 16), base, np.uint64)
        steps[0] = 1
        kept = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return kept[:size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any slice follows."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _table(BASE, len(data)), out=sums[1:])
    return sums


def slice_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each slice; equal slices have equal hashes wherever they stand."""
    inverse = _table(INVERSE, len(sums))
    sizes = (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + sizes)


def window_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """Hash of every slice of one size."""
    inverse = _table(INVERSE, len(sums))
    return mix((sums[size:] - sums[:-size]) * inverse[: len(sums) - size])


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` neighbours."""
    n = len(values)
    rows = -(-n // size)
    padded = np.full(rows * size, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(rows, size)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - size + 1], ahead[size - 1 : n])
