"""Repeatable random numbers: a function of a row key and a seed, not of the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def portable_rand(*keys, seed: int = 0) -> Column:
    """Uniform number in [0, 1) from the md5 of the keys and the seed.

    The first 13 hex digits (52 bits) are read as an integer, so another engine can compute the same number
    and ties stay rare in tables of any size.
    """
    text = F.concat_ws(":", *[F.col(k) if isinstance(k, str) else k for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(4503599627370496.0)


def portable_normal(*keys, seed: int = 0) -> Column:
    """Standard normal number by the Box-Muller transform of two uniform ones."""
    u1 = F.greatest(portable_rand(*keys, seed=f"{seed}a"), F.lit(1e-12))
    u2 = portable_rand(*keys, seed=f"{seed}b")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)
