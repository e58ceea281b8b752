"""Means and deviations of whole numbers, as arrays, rounded like ``functions.columns.rnd``.

Readings come in ten-thousandths, squares in two parts (multiples of SPLIT and
the rest). Results are ten-thousandths again, of type READING.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa

# Readings carry four decimals; sums run over whole ten-thousandths.
SCALE = 10_000
# Squares are summed in two parts, multiples of this and the rest: each part
# stays within 64 bits for ninety billion readings, and nothing is rounded.
SPLIT = 100_000_000
READING = pa.decimal128(8, 4)


def rounded(x: np.ndarray) -> np.ndarray:
    """Ten-thousandths of ``x``, half away from zero, after ten decimals are fixed in the same way.

    A number so close to the middle of two tenth decimals that the product with 1e10
    does not tell, where that changes the fourth, is rounded in decimals.
    """
    shifted = np.abs(x) * 1e10
    ten = np.floor(shifted + 0.5).astype(np.int64)
    four = (ten + 500_000) // 1_000_000
    near = np.abs(shifted - np.floor(shifted) - 0.5) < 0.1
    unsure = np.flatnonzero(near & np.isin(ten % 1_000_000, (499_999, 500_000)))
    for i in unsure:
        fixed = Decimal(repr(float(abs(x[i])))).quantize(Decimal("1e-10"), ROUND_HALF_UP)
        four[i] = int((fixed * SCALE).quantize(Decimal(1), ROUND_HALF_UP))
    return np.where(x < 0, -four, four)


def reading(ten_thousandths: np.ndarray, absent: np.ndarray) -> pa.Array:
    """Whole ten-thousandths as decimals, null where ``absent``."""
    low_high = np.column_stack([ten_thousandths, ten_thousandths >> 63]).astype("<i8")
    bits = np.packbits(~absent, bitorder="little")
    return pa.Array.from_buffers(READING, len(absent), [pa.py_buffer(bits), pa.py_buffer(np.ascontiguousarray(low_high))])


def mean(n: np.ndarray, s: np.ndarray) -> pa.Array:
    count = np.where(n == 0, 1, n).astype(float)
    return reading(rounded(s / count / SCALE), n == 0)


def deviation(n: np.ndarray, s: np.ndarray, q: np.ndarray, r: np.ndarray) -> pa.Array:
    """Population deviation: n * sum(x^2) - sum(x)^2 is a whole number, hence exact."""
    spread = n * (q * SPLIT + r) - s * s  # whatever wraps around on the way, right if it fits 64 bits
    squares = n.astype(float) * (q.astype(float) * SPLIT + r)
    exact = spread.astype(float)
    for i in np.flatnonzero(squares - s.astype(float) ** 2 + squares * 1e-14 > 9e18):
        exact[i] = float(int(n[i]) * (int(q[i]) * SPLIT + int(r[i])) - int(s[i]) ** 2)
    count = np.where(n == 0, 1, n).astype(float)
    return reading(rounded(np.sqrt(exact) / count / SCALE), n == 0)
