"""Seeded pseudo-random columns that do not depend on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def hash52(seed: str, key: Column) -> Column:
    """52 bits of an MD5 as a long: exact in a double, equal on every engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def uniform(seed: str, key: Column) -> Column:
    """Uniform in (0, 1): the midpoint of one of 2**32 equal steps."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def normal(seed: str, key: Column, mean: float, deviation: float) -> Column:
    """Box-Muller normal from two independent uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(seed + "a", key)))
    angle = F.cos(F.lit(2.0 * math.pi) * uniform(seed + "b", key))
    return F.lit(float(mean)) + F.lit(float(deviation)) * radius * angle


def lognormal(seed: str, key: Column, mean: float, deviation: float) -> Column:
    return F.exp(normal(seed, key, mean, deviation))
