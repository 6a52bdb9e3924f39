"""Model search from additive moments: every fold, feature set and penalty from one scan.

The data are read once, into one row of moments per fold (counts, means and
co-moments, partially aggregated).  A fold's training set is the total minus its
own moments, its held-out error follows from its own moments, and all fits are
small systems solved in array expressions.  Folds and grid are parameters, so
what follows the scan is bounded by them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions import linalg as L


def fold_moments(df: DataFrame, features: Sequence[str], target: str, fold: str) -> DataFrame:
    """(fold, m): moments of (features..., target) of each fold; rows with a null among them do not count."""
    return df.filter(F.col(fold).isNotNull()).groupBy(F.col(fold).alias("fold")).agg(
        L.moments([F.col(c) for c in [*features, target]]).alias("m"))


def _per_fold(moments: DataFrame) -> DataFrame:
    """(fold, own, train, total); a fold without rows does not take part."""
    packed = moments.filter("m.n > 0").agg(F.collect_list(F.struct("fold", "m")).alias("folds"))     # one struct a fold
    packed = packed.withColumn("total", L.merged(F.transform("folds", lambda f: f["m"])))
    each = packed.select("total", F.explode("folds").alias("f")).select(
        "total", F.col("f.fold").alias("fold"), F.col("f.m").alias("own"))
    return each.withColumn("train", L.without(F.col("total"), F.col("own")))


def ridge_search(df: DataFrame, target: str, feature_sets: Mapping[str, Sequence[str]], penalties: Sequence[float],
                 fold: str) -> DataFrame:
    """Cross-validated linear models for every feature set and penalty.

    One row per grid point: ``features`` (the set's name), ``penalty``, ``score`` (mean R² of the held-out folds, as
    the usual search reports), ``rmse`` (mean held-out RMSE), ``fold_scores`` (by fold), ``intercept`` and
    ``coefficients`` of the fit on all rows, and ``best``: true for the highest score, of equal ones for the fewest
    features, then the largest penalty.  A fold of a constant target has no R² and is left out of the mean.
    """
    names = list(dict.fromkeys(c for cols in feature_sets.values() for c in cols))
    y = len(names)
    grid = F.array(*[F.struct(F.lit(name).alias("features"), F.array(*[F.lit(names.index(c)) for c in cols]).alias("idx"),
                              F.lit(float(p)).alias("penalty")) for name, cols in feature_sets.items() for p in penalties])
    each = _per_fold(fold_moments(df, names, target, fold)).withColumn("g", F.explode(grid)).select("*", "g.*")
    each = each.withColumn("fit", L.ridge_fit(F.col("train"), F.col("idx"), y, F.col("penalty")))
    each = each.withColumn("sse", L.squared_error(F.col("own"), F.col("idx"), y, F.col("fit")))
    spread = F.get(F.get(F.col("own.comoment"), F.lit(y)), F.lit(y))
    each = each.withColumn("r2", F.when(spread > 0, 1.0 - F.try_divide(F.col("sse"), spread)))
    each = each.withColumn("whole", L.ridge_fit(F.col("total"), F.col("idx"), y, F.col("penalty")))
    points = each.groupBy("features", "penalty").agg(
        F.avg("r2").alias("score"), F.avg(F.sqrt(F.greatest(F.col("sse"), F.lit(0.0)) / F.col("own.n"))).alias("rmse"),
        F.transform(F.sort_array(F.collect_list(F.struct("fold", "r2"))), lambda s: s["r2"]).alias("fold_scores"),
        F.first("whole").alias("whole"), F.first(F.size("idx")).alias("_width"))
    order = F.struct(F.coalesce("score", F.lit(float("-inf"))).alias("s"), (-F.col("_width")).alias("w"), F.col("penalty").alias("p"),
                     F.col("features").alias("f"))
    best = points.agg(F.max(order).alias("_top"))        # one row
    return points.crossJoin(F.broadcast(best)).select(
        "features", "penalty", "score", "rmse", "fold_scores", F.col("whole.b0").alias("intercept"),
        F.col("whole.b").alias("coefficients"), (order == F.col("_top")).alias("best"))


def best_of(points: DataFrame) -> DataFrame:
    """The best grid point: its parameters, score and the model fitted on all rows."""
    return points.filter("best").drop("best")


def fold_predictions(df: DataFrame, features: Sequence[str], target: str, fold: str, penalty: float = 0.0,
                     out: str = "prediction") -> DataFrame:
    """``df`` with each row's prediction by the model fitted on the other folds (out-of-fold predictions).

    One row of coefficients a fold is joined back; a row with a null feature or fold has a null prediction.
    """
    fits = _per_fold(fold_moments(df, features, target, fold)).select(
        F.col("fold").alias("_fold"), L.ridge_fit(F.col("train"), list(range(len(features))), len(features), F.lit(float(penalty))).alias("_fit"))
    joined = df.join(F.broadcast(fits), df[fold] == F.col("_fold"), "left")       # one row a fold
    return joined.withColumn(out, predicted(F.col("_fit"), [F.col(c) for c in features])).drop("_fold", "_fit")


def predicted(fit: Column, features: Sequence[Column]) -> Column:
    value = fit["b0"]
    for i, x in enumerate(features):
        value = value + fit["b"][i] * x.cast("double")
    return value
