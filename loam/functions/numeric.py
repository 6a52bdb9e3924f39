"""Numeric / categorical scalar helpers."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(x: str | Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x)))


def log_feature(x: str | Column, offset: float = 0.0) -> Column:
    v = _c(x).cast("double") + F.lit(offset)
    return F.when(v > 0, F.ln(v))


def polynomial(x: str | Column, y: str | Column) -> dict[str, Column]:
    """x^2, y^2, x*y, |x-y| (= sqrt((x-y)^2)), sin(x), cos(y)."""
    x, y = _c(x).cast("double"), _c(y).cast("double")
    return {"x_sq": x * x, "y_sq": y * y, "xy": x * y, "abs_diff": F.abs(x - y),
            "sin_x": F.sin(x), "cos_y": F.cos(y)}


def periodic(t: str | Column, period: float) -> tuple[Column, Column]:
    ang = F.lit(2 * math.pi / period) * _c(t).cast("double")
    return F.sin(ang), F.cos(ang)


def recode(x: str | Column, mapping: Mapping, default: str | None = "Unknown",
           strict: bool = False) -> Column:
    """Code -> label through a literal map.  ``strict`` raises on a missing code."""
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    key = _c(x)
    looked = F.try_element_at(m, key)
    if strict:
        return F.when(looked.isNotNull(), looked).otherwise(
            F.raise_error(F.concat(F.lit("unmapped code: "), F.coalesce(key.cast("string"), F.lit("null")))))
    return F.coalesce(looked, F.lit(default))


def indicator(cond: Column, as_string: bool = False) -> Column:
    return cond.cast("string") if as_string else cond.cast("int")


def identity_category(x: str | Column, num_buckets: int, default: int = 0) -> Column:
    v = _c(x)
    return F.when(v.between(0, num_buckets - 1), v.cast("int")).otherwise(F.lit(default))


def decimal_ratio(x: float) -> tuple[int, int]:
    """Exact small integer ratio of a decimal fraction (0.7 -> (7, 10)).

    ``float.as_integer_ratio`` gives the binary value (0.7 -> slightly below 7/10),
    which moves ``floor(n * fraction)`` down by one whenever n * fraction is whole.
    """
    for den in (10, 100, 1000, 10000, 100000):
        num = round(x * den)
        if abs(num / den - x) < 1e-12:
            return num, den
    return x.as_integer_ratio()
