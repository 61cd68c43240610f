"""Deterministic per-row pseudo-random values from an integer id and a seed.

Values depend only on the id and the seed, never on partitioning or task
order, so a generated table is identical on 1 or 10,000 executors (unlike
``rand(seed)``), and any SQL engine with ``md5`` reproduces them. The whole
64-bit id enters the digest, so rows do not repeat after 2^31 ids.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 6  # hexadecimal digits of the digest per value: 24 bits, five values a digest


def hash_bits(row_id: Column, seed: int, place: int) -> Column:
    """Integer in [0, 2^24): the ``place``-th (from 0 to 4) group of digits of md5('<seed>:<id>')."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("bigint").cast("string")).cast("binary"))
    return F.conv(F.substring(digest, place * DIGITS + 1, DIGITS), 16, 10).cast("bigint")


def hash_range(row_id: Column, seed: int, place: int, size: int) -> Column:
    """Integer in [0, size) from :func:`hash_bits` (``size`` well below 2^24)."""
    return F.pmod(hash_bits(row_id, seed, place), F.lit(size))


def hash_pick(row_id: Column, seed: int, place: int, values: list[str]) -> Column:
    """One of ``values`` chosen by :func:`hash_range`."""
    choices = F.array(*[F.lit(v) for v in values])
    return F.element_at(choices, (hash_range(row_id, seed, place, len(values)) + 1).cast("int"))
