"""Deterministic per-row random weights for distributed resampling.

A row's weight in replicate ``r`` is a Poisson(1) draw taken from the md5 of
``seed:r:row_id``; summing independent Poisson(1) weights is the standard
distributed stand-in for drawing ``n`` rows with replacement, and a hash makes
every replicate reproducible on any engine and after task retries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = 4294967296.0  # 2**32: the first 8 hex digits of md5 form a 32-bit integer
POISSON_MAX_K = 12   # P(Poisson(1) > 12) < 1e-10, below the 2**-32 grid


def poisson1_cdf(max_k: int = POISSON_MAX_K) -> list[float]:
    """Cumulative Poisson(1) probabilities F(0..max_k), computed from the formula."""
    out, term, total = [], math.exp(-1.0), 0.0
    for k in range(max_k + 1):
        if k > 0:
            term /= k
        total += term
        out.append(total)
    return out


def hash_uniform(*parts: Column) -> Column:
    """Uniform [0, 1) from the first 32 bits of md5 over ``parts`` joined by ':'."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(UNIT)


def poisson1_weight(u: Column) -> Column:
    """Inverse-CDF Poisson(1) draw for a uniform ``u`` (int)."""
    cdf = poisson1_cdf()
    expr = None
    for k, bound in enumerate(cdf):
        cond = u < F.lit(bound)
        expr = F.when(cond, F.lit(k)) if expr is None else expr.when(cond, F.lit(k))
    return expr.otherwise(F.lit(len(cdf))).cast("int")


def poisson1_weight_sql(u_sql: str) -> str:
    """The same draw as a SQL CASE over a uniform expression (for SQL engines)."""
    cdf = poisson1_cdf()
    whens = " ".join(f"WHEN {u_sql} < {bound!r} THEN {k}" for k, bound in enumerate(cdf))
    return f"CAST(CASE {whens} ELSE {len(cdf)} END AS INTEGER)"
