"""Deterministic hashing shared by splits, hash buckets and crossed features.

Rule: the first 15 hex digits of MD5(UTF-8 text) read as a non-negative 60-bit
integer.  It is reproducible in plain SQL engines (DuckDB:
``('0x'||substr(md5(s),1,15))::BIGINT``), unlike xxhash64.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_int(text: str | Column) -> Column:
    """Non-negative bigint fingerprint of a string column."""
    return F.conv(F.substring(F.md5(_c(text).cast("string")), 1, 15), 16, 10).cast("long")


def fingerprint_concat(cols: Sequence[str | Column], null_text: str = "NA") -> Column:
    """CONCAT(COALESCE(CAST(c AS STRING), 'NA'), ...) over the given columns."""
    return F.concat(*[F.coalesce(_c(c).cast("string"), F.lit(null_text)) for c in cols])


def hash_bucket(col: str | Column, num_buckets: int) -> Column:
    """hash(x) mod n with the MD5 rule; null maps to the bucket of the empty string."""
    return F.pmod(md5_int(F.coalesce(_c(col).cast("string"), F.lit(""))), F.lit(num_buckets)).cast("int")


def cross_bucket(cols: Sequence[str | Column], num_buckets: int, sep: str = "_X_") -> Column:
    """Crossed feature: hash of the keys joined by ``sep``, mod ``num_buckets``."""
    joined = F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])
    return F.pmod(md5_int(joined), F.lit(num_buckets)).cast("int")


def seeded_unit(key: str | Column, seed: int, resolution: int = 1_000_000) -> Column:
    """Deterministic pseudo-random integer in [0, resolution) from (seed, key)."""
    return F.pmod(md5_int(F.concat(F.lit(f"{seed}:"), _c(key).cast("string"))), F.lit(resolution))


def uniform(key: str | Column, seed: int) -> Column:
    """Deterministic uniform deviate in (0, 1] from (seed, key): 60 bits, halfway between two of their steps."""
    h = md5_int(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 60))


def normal_deviate(key: str | Column, seed: int) -> Column:
    """Deterministic standard normal deviate from (seed, key), by Box-Muller over two uniforms: a counter-based
    generator, so that a row's noise depends on neither its task nor the rows before it."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(key, 2 * seed)))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(key, 2 * seed + 1))


def exponential_key(key: str | Column, weight: str | Column, seed: int) -> Column:
    """-ln(u) / weight: the rows with the smallest keys are a weighted sample without replacement.
    Null, so never drawn, unless the weight is above 0."""
    w = _c(weight).cast("double")
    return F.when(w > 0, -F.ln(uniform(key, seed)) / w)
