"""Small linear algebra on array columns: no UDF, no collect; one row holds one system.

A matrix is ``array<array<double>>``.  All functions are native higher-order expressions whose cost follows
the size of the system, not the number of rows that were aggregated into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PIVOT_TOLERANCE = 1e-12     # of a column's own scale; a smaller pivot means that earlier columns span it


def matrix(rows: Sequence[Sequence[Column]]) -> Column:
    return F.array(*[F.array(*row) for row in rows])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def solve_symmetric(a: Column, b: Column) -> Column:
    """x of ``a x = b`` for a symmetric positive semidefinite ``a``, by elimination without row exchanges.

    Pivots of such a matrix are those of its Cholesky factor.  A column that the ones before it span (its
    pivot is at most ``PIVOT_TOLERANCE`` of its diagonal) gets the coefficient 0.  Null if ``a`` or ``b`` is.
    """
    augmented = F.zip_with(a, b, lambda row, y: F.concat(row, F.array(y)))
    scale = F.transform(a, lambda row, i: F.abs(F.get(row, i)))

    def eliminate(rows, j):
        pivot_row = F.get(rows, j)
        pivot = F.get(pivot_row, j)
        inverse = F.when(pivot > F.lit(PIVOT_TOLERANCE) * F.get(scale, j), F.try_divide(F.lit(1.0), pivot)).otherwise(F.lit(0.0))
        unit = F.transform(pivot_row, lambda x: x * inverse)
        return F.transform(rows, lambda row, i: F.when(i == j, unit).otherwise(
            F.zip_with(row, unit, lambda x, u: x - F.get(row, j) * u)))

    done = F.aggregate(F.sequence(F.lit(0), F.size(a) - 1), augmented, eliminate)
    return F.when(F.size(a) > 0, F.transform(done, lambda row: F.element_at(row, -1))).otherwise(F.array().cast("array<double>"))


def moments(values: Sequence[Column]) -> Column:
    """Aggregate to struct(n, mean, comoment): one pass, partially aggregated, stable (no raw squares).

    ``comoment[i][j]`` is the sum of products of deviations.  Rows with a null among ``values`` do not count.
    """
    whole = values[0].isNotNull()
    for v in values[1:]:
        whole = whole & v.isNotNull()
    xs = [F.when(whole, v.cast("double")) for v in values]
    n = F.count(xs[0])
    upper = {(i, j): F.covar_pop(xs[i], xs[j]) * n for i in range(len(xs)) for j in range(i, len(xs))}
    rows = [[upper[min(i, j), max(i, j)] for j in range(len(xs))] for i in range(len(xs))]
    return F.struct(n.alias("n"), F.array(*[F.avg(x) for x in xs]).alias("mean"), matrix(rows).alias("comoment"))


def without(total: Column, part: Column) -> Column:
    """Moments of the rows of ``total`` that are not in ``part`` (both from :func:`moments`); null if none is left."""
    n = total["n"] - part["n"]
    mean = F.zip_with(total["mean"], part["mean"], lambda t, p: F.try_divide(t * total["n"] - p * part["n"], n))
    shrink = F.try_divide(part["n"].cast("double") * n, total["n"].cast("double"))

    def deviation(i):
        return F.get(part["mean"], i) - F.get(mean, i)

    comoment = F.transform(total["comoment"], lambda row, i: F.transform(row, lambda x, j: (
        x - F.get(F.get(part["comoment"], i), j) - shrink * deviation(i) * deviation(j))))
    return F.when(part["n"] == 0, total).when(n > 0, F.struct(n.alias("n"), mean.alias("mean"), comoment.alias("comoment")))


def merged(parts: Column) -> Column:
    """Moments of all rows together, from an array of moments of disjoint parts (empty parts allowed)."""
    held = F.filter(parts, lambda p: p["n"] > 0)
    n = F.aggregate(held, F.lit(0).cast("long"), lambda s, p: s + p["n"])
    width = F.size(F.get(held, F.lit(0))["mean"])
    at = lambda f: F.transform(F.sequence(F.lit(0), width - 1), f)
    over = lambda f: F.aggregate(held, F.lit(0.0), lambda s, p: s + f(p))
    mean = at(lambda i: F.try_divide(over(lambda p: p["n"] * F.get(p["mean"], i)), n.cast("double")))
    first = F.struct(n.alias("n"), mean.alias("mean"))
    # a let-binding: the means are worked out once for all cells of the matrix
    return F.when(n > 0, F.transform(F.array(first), lambda m: F.struct(m["n"].alias("n"), m["mean"].alias("mean"), at(
        lambda i: at(lambda j: over(lambda p: F.get(F.get(p["comoment"], i), j) + p["n"]
                                    * (F.get(p["mean"], i) - F.get(m["mean"], i)) * (F.get(p["mean"], j) - F.get(m["mean"], j))))
    ).alias("comoment")))[0])


def ridge_fit(m: Column, features: Sequence[int] | Column, target: int, penalty: Column) -> Column:
    """struct(b0, b) minimising mean squared error + penalty * |b|^2 on moments ``m``; b0 is not penalised.

    ``features`` are places in the moments (a list, or an array column).  Null if ``m`` is null.
    """
    idx = features if isinstance(features, Column) else F.array(*[F.lit(int(i)) for i in features])
    n = m["n"].cast("double")
    a = F.transform(idx, lambda i: F.transform(idx, lambda j: (
        F.get(F.get(m["comoment"], i), j) / n + F.when(i == j, penalty).otherwise(0.0))))
    c = F.transform(idx, lambda i: F.get(F.get(m["comoment"], i), F.lit(target)) / n)
    b = solve_symmetric(a, c)
    b0 = lambda v: F.get(m["mean"], F.lit(target)) - dot(v, F.transform(idx, lambda i: F.get(m["mean"], i)))
    fit = F.transform(F.array(b), lambda v: F.struct(b0(v).alias("b0"), v.alias("b")))[0]
    return F.when(m.isNotNull() & (m["n"] > 0), fit)


def squared_error(m: Column, features: Sequence[int] | Column, target: int, fit: Column) -> Column:
    """Sum of squared errors of a linear ``fit`` over the rows behind moments ``m``, without reading them again."""
    idx = features if isinstance(features, Column) else F.array(*[F.lit(int(i)) for i in features])
    b = fit["b"]
    g = F.transform(idx, lambda i: F.get(F.get(m["comoment"], i), F.lit(target)))
    quadratic = F.aggregate(F.transform(idx, lambda i, p: F.get(b, p) * dot(
        F.transform(idx, lambda j: F.get(F.get(m["comoment"], i), j)), b)), F.lit(0.0), lambda s, x: s + x)
    off = F.get(m["mean"], F.lit(target)) - fit["b0"] - dot(b, F.transform(idx, lambda i: F.get(m["mean"], i)))
    return F.get(F.get(m["comoment"], F.lit(target)), F.lit(target)) - 2.0 * dot(b, g) + quadratic + m["n"] * off * off
