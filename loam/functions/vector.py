"""Array (dense vector) functions built from higher-order SQL functions: no UDF, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(arr: str | Column) -> Column:
    return F.transform(_c(arr), lambda x: x.cast("double"))


def dot(a: str | Column, b: str | Column) -> Column:
    prod = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + x)


def sum_sq(a: str | Column) -> Column:
    return F.aggregate(as_double(a), F.lit(0.0), lambda acc, x: acc + x * x)


def norm(a: str | Column) -> Column:
    return F.sqrt(sum_sq(a))


def cosine(a: str | Column, b: str | Column) -> Column:
    """SUM(a*b) / (SQRT(SUM(a^2)) * SQRT(SUM(b^2))); null when a norm is zero."""
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den)


def round_array(arr: str | Column, digits: int) -> Column:
    return F.transform(as_double(arr), lambda x: F.round(x, digits))


def mean(arr: str | Column) -> Column:
    a = as_double(arr)
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / F.size(a)


def softmax(arr: str | Column) -> Column:
    a = as_double(arr)
    m = F.array_max(a)
    ex = F.transform(a, lambda x: F.exp(x - m))
    s = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / s)


def argmax(arr: str | Column) -> Column:
    """0-based index of the first maximum."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def one_hot(index: str | Column, width: int) -> Column:
    """Indicator array of ``width``; all zeros when the index is out of range or null."""
    i = _c(index)
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)),
                       lambda k: F.coalesce((k == i).cast("int"), F.lit(0)))


def squared_error_sum(a: str | Column, b: str | Column) -> Column:
    d = F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x)
