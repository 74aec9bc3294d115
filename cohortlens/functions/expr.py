"""Column-expression building blocks (all JVM-side, no UDFs).

Determinism: every random draw is a hash of ``seed|key|salt`` so that results
do not depend on partitioning or on the engine (the same text hashes to the
same value in DuckDB: ``md5`` → first 8 hex digits → integer).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 4294967296.0


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def hash_key(seed, *keys, salt=None) -> Column:
    parts = [F.lit(str(seed))] + [_s(k) for k in keys]
    if salt is not None:
        parts.append(_s(salt) if not isinstance(salt, (int, str)) else F.lit(str(salt)))
    return F.concat_ws("|", *parts)


def hash_u32(seed, *keys, salt=None) -> Column:
    """Integer in [0, 2^32) from md5(seed|keys|salt)."""
    return F.conv(F.substring(F.md5(hash_key(seed, *keys, salt=salt)), 1, 8), 16, 10).cast("bigint")


def hash_uniform(seed, *keys, salt=None) -> Column:
    """Uniform in [0, 1)."""
    return hash_u32(seed, *keys, salt=salt) / F.lit(TWO32)


def hash_normal(seed, *keys, salt="n") -> Column:
    """Standard normal by Box–Muller over two hashed uniforms."""
    u1 = (hash_u32(seed, *keys, salt=f"{salt}1") + F.lit(0.5)) / F.lit(TWO32)
    u2 = hash_uniform(seed, *keys, salt=f"{salt}2")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def sql_hash_u32(seed, keys: list[str], salt=None) -> str:
    """DuckDB text of ``hash_u32`` (for oracles)."""
    parts = [f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys]
    if salt is not None:
        parts.append(f"'{salt}'")
    return f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8)) AS BIGINT)"


def sql_hash_uniform(seed, keys: list[str], salt=None) -> str:
    return f"({sql_hash_u32(seed, keys, salt)} / {TWO32})"


def sql_hash_normal(seed, keys: list[str], salt="n") -> str:
    u1 = f"(({sql_hash_u32(seed, keys, salt + '1')} + 0.5) / {TWO32})"
    u2 = sql_hash_uniform(seed, keys, salt + "2")
    return f"(sqrt(-2.0 * ln({u1})) * cos({2 * math.pi!r} * {u2}))"


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def xlogy_ratio(p: Column, q: Column) -> Column:
    """p * ln(p / q) with 0 · ln 0 = 0 (relative-entropy term)."""
    return F.when(p > 0, p * F.log(p / q)).otherwise(F.lit(0.0))


def kolmogorov_sf(z: Column, terms: int = 100) -> Column:
    """Survival function of the Kolmogorov distribution,
    2 Σ_{k≥1} (-1)^{k-1} exp(-2 k² z²), clamped to [0, 1]; 1 for z < 0.27
    (where the alternating series converges slowly and the value is > 0.99999)."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k * k * z * z))
    v = F.lit(2.0) * series
    return F.when(z < 0.27, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), v)))


def normal_cdf(x: Column) -> Column:
    """Φ(x) via erfc rational approximation (Numerical Recipes erfcc,
    fractional error < 1.2e-7)."""
    z = F.abs(x) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    # Chebyshev-fitted polynomial (fixed published coefficients)
    coeffs = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
              0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    poly = F.lit(coeffs[-1])
    for c in reversed(coeffs[:-1]):
        poly = poly * t + F.lit(c)
    erfc = t * F.exp(-z * z + poly)
    return F.when(x >= 0, F.lit(1.0) - F.lit(0.5) * erfc).otherwise(F.lit(0.5) * erfc)


# Acklam's inverse-normal rational approximation (fixed published coefficients)
_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01]
_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00]


def _horner(coeffs, x):
    acc = F.lit(coeffs[0])
    for c in coeffs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def probit(p: Column) -> Column:
    """Φ⁻¹(p) for p in (0, 1), relative error ≈ 1e-9."""
    lo, hi = 0.02425, 1 - 0.02425
    q_low = F.sqrt(F.lit(-2.0) * F.log(p))
    low = _horner(_C, q_low) / (_horner(_D, q_low) * q_low + F.lit(1.0))
    q = p - F.lit(0.5)
    r = q * q
    mid = _horner(_A, r) * q / (_horner(_B, r) * r + F.lit(1.0))
    q_high = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    high = -_horner(_C, q_high) / (_horner(_D, q_high) * q_high + F.lit(1.0))
    return F.when(p < lo, low).when(p > hi, high).otherwise(mid)


def r6(c: Column) -> Column:
    """Round to 6 dp and turn -0.0 into 0.0 (stable cross-engine values)."""
    return F.round(c, 6) + F.lit(0.0)


def br(c: Column, dp: int) -> Column:
    """Half-even rounding (numpy/Python ``round``)."""
    return F.bround(c, dp) + F.lit(0.0)
