"""Special functions as Spark columns.

``lgamma`` / ``digamma`` are closed-form native expressions (shift the argument
above 8 with the recurrence, then the asymptotic series), so likelihoods built
on them stay inside whole-stage codegen.  The Gauss hypergeometric function
needs a series summed to convergence; it is an Arrow-batched pandas UDF that
sums the series for a whole batch with numpy.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SHIFT = 8
_HALF_LOG_2PI = 0.5 * math.log(2.0 * math.pi)


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def _stirling_lgamma(w: Column) -> Column:
    inv = 1.0 / w
    inv2 = inv * inv
    # 1/(12w) - 1/(360w^3) + 1/(1260w^5) - 1/(1680w^7) + 1/(1188w^9) - 691/(360360w^11)
    series = inv * (1.0 / 12 + inv2 * (-1.0 / 360 + inv2 * (1.0 / 1260 + inv2 * (
        -1.0 / 1680 + inv2 * (1.0 / 1188 + inv2 * (-691.0 / 360360))))))
    return (w - 0.5) * F.log(w) - w + F.lit(_HALF_LOG_2PI) + series


def lgamma(z) -> Column:
    """log Γ(z) for z > 0 (absolute error below 1e-13).

    Γ(z) = Γ(z + 8) / (z (z+1) ... (z+7)); the product is taken in two halves
    so it cannot overflow for any argument below 1e75.
    """
    z = _lit(z)
    lo = z * (z + 1) * (z + 2) * (z + 3)
    hi = (z + 4) * (z + 5) * (z + 6) * (z + 7)
    return _stirling_lgamma(z + _SHIFT) - F.log(lo) - F.log(hi)


def _asym_digamma(w: Column) -> Column:
    inv = 1.0 / w
    inv2 = inv * inv
    series = inv2 * (1.0 / 12 - inv2 * (1.0 / 120 - inv2 * (1.0 / 252 - inv2 * (
        1.0 / 240 - inv2 * (1.0 / 132)))))
    return F.log(w) - 0.5 * inv - series


def digamma(z) -> Column:
    """ψ(z) = d/dz log Γ(z) for z > 0 (recurrence to z + 8, then the
    asymptotic series)."""
    z = _lit(z)
    shifted = _asym_digamma(z + _SHIFT)
    for j in range(_SHIFT):
        shifted = shifted - 1.0 / (z + j)
    return shifted


def lgamma_np(z) -> np.ndarray:
    """log Γ(z) for z > 0 on numpy arrays (same scheme as ``lgamma``)."""
    z = np.asarray(z, dtype=float)
    w = z + _SHIFT
    inv = 1.0 / w
    inv2 = inv * inv
    series = inv * (1.0 / 12 + inv2 * (-1.0 / 360 + inv2 * (1.0 / 1260 + inv2 * (
        -1.0 / 1680 + inv2 * (1.0 / 1188 + inv2 * (-691.0 / 360360))))))
    lo = z * (z + 1) * (z + 2) * (z + 3)
    hi = (z + 4) * (z + 5) * (z + 6) * (z + 7)
    return (w - 0.5) * np.log(w) - w + _HALF_LOG_2PI + series - np.log(lo) - np.log(hi)


def digamma_np(z) -> np.ndarray:
    """ψ(z) for z > 0 on numpy arrays (same scheme as ``digamma``)."""
    z = np.asarray(z, dtype=float)
    w = z + _SHIFT
    inv = 1.0 / w
    inv2 = inv * inv
    series = inv2 * (1.0 / 12 - inv2 * (1.0 / 120 - inv2 * (1.0 / 252 - inv2 * (
        1.0 / 240 - inv2 * (1.0 / 132)))))
    out = np.log(w) - 0.5 * inv - series
    for j in range(_SHIFT):
        out = out - 1.0 / (z + j)
    return out


#: Largest argument at which the power series is summed; beyond, it is continued.
_SERIES_END = 0.5


def _power_series(a, b, c, z, derivative: bool = False) -> np.ndarray:
    """₂F₁ (or its derivative) by its series at |z| <= 0.5, where the terms
    shrink by half in the end, however large the parameters."""
    if derivative:
        return a * b / c * _power_series(a + 1, b + 1, c + 1, z)
    total, term = np.ones_like(z), np.ones_like(z)
    idx, j = np.arange(z.size), 0
    while idx.size:
        ratio = (a[idx] + j) * (b[idx] + j) / ((c[idx] + j) * (j + 1.0)) * z[idx]
        term[idx] = t = term[idx] * ratio
        total[idx] = new = total[idx] + t
        # past its largest term a series is over when a term no longer counts
        moving = ((np.abs(t) > 1e-17 * np.abs(new)) | (np.abs(ratio) > 0.9)) & np.isfinite(new) & (t != 0)
        idx, j = idx[moving], j + 1
    return total


def _continued(a, b, c, z) -> np.ndarray:
    """₂F₁ for 0.5 < z < 1: value and slope at 0.5, carried on by Taylor steps of
    the hypergeometric equation, each of half the distance to 1.  About
    log2(1 / (1 - z)) steps of some sixty terms."""
    at = np.full_like(z, _SERIES_END)
    w, slope = _power_series(a, b, c, at), _power_series(a, b, c, at, derivative=True)
    idx = np.arange(z.size)
    while idx.size:
        x, h = at[idx], np.minimum(z[idx] - at[idx], 0.5 * (1.0 - at[idx]))
        aa, bb, cc = a[idx], b[idx], c[idx]
        # coefficients scaled by h^n, so that none overflows
        p, q = w[idx], slope[idx] * h
        value, rise, n = p + q, q.copy(), 0
        quiet = 0
        while quiet < 3 and n < 4000:
            r = -(((1 - 2 * x) * n + cc - (aa + bb + 1) * x) * (n + 1) * q * h - (n + aa) * (n + bb) * p * h * h) / (
                x * (1 - x) * (n + 2) * (n + 1))
            value = value + r
            rise = rise + (n + 2) * r
            small = np.abs(r) * (n + 2) <= 1e-17 * np.maximum(np.abs(rise), np.abs(value))
            quiet = quiet + 1 if np.all(small | ~np.isfinite(value)) else 0
            p, q, n = q, r, n + 1
        w[idx], slope[idx], at[idx] = value, rise / h, x + h
        idx = idx[(at[idx] < z[idx]) & np.isfinite(w[idx])]
    return w


def hyp2f1_numpy(a, b, c, z) -> np.ndarray:
    """₂F₁(a, b; c; z) for |z| < 1, c not a non-positive integer.

    Where it grows towards z = 1 (c < a + b), Euler's transformation
    (1 - z)^(c - a - b) ₂F₁(c - a, c - b; c; z) leaves a series that does not.
    The power series is summed up to |z| = 0.5; Pfaff's transformation brings
    z < -0.5 into that range and Taylor steps lead on to any z < 1, so the work
    is bounded by the logarithm of the distance to 1.
    """
    a, b, c, z = (np.array(v, dtype=float) for v in np.broadcast_arrays(a, b, c, z))
    shape = z.shape
    a, b, c, z = (v.ravel() for v in (a, b, c, z))
    out = np.full(z.size, np.nan)
    fine = np.isfinite(a) & np.isfinite(b) & np.isfinite(c) & (np.abs(z) < 1)
    with np.errstate(all="ignore"):
        factor = np.ones_like(z)
        left = fine & (z < -_SERIES_END)
        factor[left] = (1 - z[left]) ** -a[left]
        b = np.where(left, c - b, b)
        z = np.where(left, z / (z - 1), z)
        grows = fine & (c < a + b)
        factor = np.where(grows, factor * (1 - z) ** (c - a - b), factor)
        a, b = np.where(grows, c - a, a), np.where(grows, c - b, b)
        near = fine & (z <= _SERIES_END)
        out[near] = _power_series(a[near], b[near], c[near], z[near])
        far = fine & (z > _SERIES_END)
        out[far] = _continued(a[far], b[far], c[far], z[far])
        out = out * factor
    return np.where(np.isfinite(out), out, np.nan).reshape(shape)


def _hyp2f1_batch(a: pd.Series, b: pd.Series, c: pd.Series, z: pd.Series) -> pd.Series:
    out = hyp2f1_numpy(a.to_numpy(float), b.to_numpy(float), c.to_numpy(float),
                       z.to_numpy(float))
    mask = (a.isna() | b.isna() | c.isna() | z.isna()).to_numpy() | np.isnan(out)
    return pd.Series(out).where(~mask, None)


def hyp2f1(a: Column, b: Column, c: Column, z: Column) -> Column:
    """₂F₁ over columns; NULL where an argument is, or outside |z| < 1.  The UDF is made at each use, so it belongs to the session
    that uses it."""
    return F.pandas_udf(_hyp2f1_batch, T.DoubleType())(a, b, c, z)
