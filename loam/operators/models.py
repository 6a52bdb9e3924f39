"""Spark ML models where Spark has a distributed implementation.

Thin, explicit wrappers: feature assembly -> estimator -> predictions/metrics.
Training runs in Spark ML (distributed gradient / Lloyd iterations); the recursive
AR forecast is a native aggregate over the last ``p`` values of each series.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import PCA, HashingTF, IDF, OneHotEncoder, Tokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from loam.functions import linalg as L
from loam.functions.numeric import decimal_ratio
from loam.operators.ranking import group_row_number, halo_blocks, join_side_table

# Series whose forecasts are worked out together.
FORECAST_ROWS = 2048


def assemble(df: DataFrame, inputs: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(inputs), outputCol=out, handleInvalid="keep").transform(df)


def logistic_fit_predict(train: DataFrame, test: DataFrame, label: str = "label", features: str = "features",
                         params: Mapping[str, object] | None = None, overrides: Mapping[str, object] | None = None,
                         weight: str | None = None) -> tuple[object, DataFrame]:
    """Logistic regression with a base param map and per-fit overriding params (e.g. a
    renamed probability column); returns (model, predictions)."""
    lr = LogisticRegression(labelCol=label, featuresCol=features, **(params or {}))
    if weight:
        lr = lr.setWeightCol(weight)
    pmap = {getattr(lr, k): v for k, v in (overrides or {}).items()}
    model = lr.fit(train, pmap) if pmap else lr.fit(train)
    return model, model.transform(test)


def linear_fit_predict(train: DataFrame, test: DataFrame, label: str, features: str = "features",
                       **params) -> tuple[object, DataFrame]:
    model = LinearRegression(labelCol=label, featuresCol=features, **params).fit(train)
    return model, model.transform(test)


def gbt_fit_predict(train: DataFrame, test: DataFrame, label: str, features: str = "features",
                    max_iter: int = 20, max_depth: int = 5, seed: int = 42) -> tuple[object, DataFrame]:
    """Gradient-boosted trees regressor (the tree option of the regression models)."""
    from pyspark.ml.regression import GBTRegressor
    m = GBTRegressor(labelCol=label, featuresCol=features, maxIter=max_iter, maxDepth=max_depth, seed=seed).fit(train)
    return m, m.transform(test)


def mlp_fit_predict(train: DataFrame, test: DataFrame, layers: Sequence[int], label: str = "label",
                    features: str = "features", seed: int = 42, max_iter: int = 50) -> tuple[object, DataFrame]:
    """Layered classifier (hidden_units) — Spark's multilayer perceptron (no sample weights)."""
    m = MultilayerPerceptronClassifier(layers=list(layers), labelCol=label, featuresCol=features, seed=seed,
                                       maxIter=max_iter).fit(train)
    return m, m.transform(test)


def kmeans(df: DataFrame, k: int, features: str = "features", init: str = "k-means||", seed: int = 42,
           max_iter: int = 20) -> tuple[object, DataFrame, DataFrame]:
    """Fit k-means; returns (model, assignments, centroids as a DataFrame)."""
    m = KMeans(k=k, featuresCol=features, initMode=init, seed=seed, maxIter=max_iter).fit(df)
    spark = df.sparkSession
    cents = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(m.clusterCenters())],
                                  "cluster int, centroid array<double>")
    return m, m.transform(df), cents


def pca(df: DataFrame, k: int, features: str = "features", out: str = "pca") -> tuple[object, DataFrame]:
    m = PCA(k=k, inputCol=features, outputCol=out).fit(df)
    return m, m.transform(df)


def text_grid_search(df: DataFrame, text: str, label: str, reg_params: Sequence[float],
                     num_features: Sequence[int], folds: int = 5, seed: int = 42, parallelism: int = 4):
    """Tokenize -> hashed tf -> idf -> logistic regression; k-fold CV over a param grid.

    Returns (model, rows): the model fitted on all rows with the best parameters (``bestModel``), and
    every grid point with its mean score; ``best`` marks the one of the model."""
    # tokenizer and hashing learn nothing: they run once, outside the folds, and their short vectors are kept
    # instead of the words; the folds' rows are those of the words' frame
    words = Tokenizer(inputCol=text, outputCol="_words").transform(df).select("_words", label)
    hashing = {n: HashingTF(inputCol="_words", outputCol=f"_tf{n}", numFeatures=n) for n in num_features}
    counts = words
    for tf in hashing.values():
        counts = tf.transform(counts)
    counts = counts.drop("_words").persist()
    idf = IDF(outputCol="_tfidf")          # fitted per fold: no leakage
    lr = LogisticRegression(labelCol=label, featuresCol="_tfidf", maxIter=20)
    points = ParamGridBuilder().addGrid(lr.regParam, list(reg_params)).addGrid(
        idf.inputCol, [tf.getOutputCol() for tf in hashing.values()]).build()
    cv = CrossValidator(estimator=Pipeline(stages=[idf, lr]), estimatorParamMaps=points, numFolds=folds, seed=seed, parallelism=parallelism,
                        evaluator=BinaryClassificationEvaluator(labelCol=label))
    model = cv.fit(counts)
    counts.unpersist()
    width = {tf.getOutputCol(): n for n, tf in hashing.items()}
    top = max(range(len(points)), key=lambda i: model.avgMetrics[i])
    rows = [{"regParam": pm[lr.regParam], "numFeatures": width[pm[idf.inputCol]], "auc": float(metric), "best": i == top}
            for i, (pm, metric) in enumerate(zip(points, model.avgMetrics))]
    # the model reads words, so its hashing goes before what was fitted
    model.bestModel = PipelineModel([hashing[rows[top]["numFeatures"]], *model.bestModel.stages])
    return model, rows


def ar_forecast(series: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column], value: str,
                p: int, horizon: int) -> DataFrame:
    """Fit AR(p) on all series by least squares and forecast ``horizon`` steps of each: (keys..., h, forecast).

    One ranking serves the lags and the tails.  The recursion runs over an array of the
    last p values, as a native aggregate.  A series shorter than p has no forecast and is
    left out; a null among its last p values makes its forecasts null.
    """
    keys = list(keys)
    ranked = group_row_number(series, keys, order_cols, out="t", size_col="_n")
    lags = [f"{value}_lag{k}" for k in range(1, p + 1)]
    h = halo_blocks(ranked, "t", before=p, after=0)
    w = Window.partitionBy(*keys, "_lm_blk").orderBy("t")
    h = h.select("*", *[F.lag(value, k).over(w).alias(c) for k, c in enumerate(lags, 1)]).filter("_lm_own")
    model = LinearRegression(labelCol=value, featuresCol="features", regParam=0.0, solver="normal").fit(
        assemble(h.dropna(subset=[value, *lags]), lags))
    coef, b0 = [float(c) for c in model.coefficients], float(model.intercept)

    # the last p values, newest first
    tail = ranked.filter((F.col("_n") >= p) & (F.col("t") > F.col("_n") - p)).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("t", F.col(value).cast("double").alias("v"))), asc=False).alias("_tail"))

    last = F.transform("_tail", lambda s: s["v"])
    out = with_forecasts(tail.select(*keys, last.alias("_last"), F.lit(b0).alias("_b0"), F.array(*[F.lit(c) for c in coef]).alias("_b")), horizon)
    return out.select(*keys, F.posexplode("_f").alias("_h", "forecast")).select(
        *keys, (F.col("_h") + 1).alias("h"), "forecast")


def with_forecasts(df: DataFrame, horizon: int, out: str = "_f", steps: str | None = None) -> DataFrame:
    """``df`` without ``_last`` (p values, newest first), ``_b0`` and ``_b``, and with ``out``: ``horizon`` forecasts of an AR(p) model.

    The recursion runs over all series of a batch at once, one step after the other, so its cost grows with the
    horizon, not with its square.  A null among the last values makes all forecasts null.  With the column ``steps``
    (dropped) a row gets so many forecasts only, ``horizon`` at most.
    """
    keep = [c for c in df.columns if c not in ("_last", "_b0", "_b", steps)]
    schema = StructType([*(df.schema[c] for c in keep), StructField(out, ArrayType(DoubleType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, FORECAST_ROWS):
                part = whole.slice(start, FORECAST_ROWS)
                n = part.num_rows
                col = lambda c: part.column(part.schema.get_field_index(c))
                flat = lambda c: np.asarray(col(c).flatten().to_numpy(zero_copy_only=False), float).reshape(n, -1).T
                last, b, b0 = flat("_last"), flat("_b"), col("_b0").to_numpy(zero_copy_only=False)
                known = col("_last").flatten().is_valid().to_numpy(zero_copy_only=False).reshape(n, -1).all(axis=1)
                wanted = np.clip(col(steps).to_numpy(), 0, horizon) if steps else np.full(n, horizon)
                longest = wanted.max(initial=0)
                values = np.empty((longest, n))
                with np.errstate(over="ignore", invalid="ignore"):      # a model may diverge
                    for h in range(longest):
                        total = np.zeros(n)
                        for k in range(len(b)):
                            total = b[k] * last[k] + total
                        values[h] = b0 + total
                        last = np.concatenate([values[h:h + 1], last[:-1]])
                flat_values = pa.array(values.T[np.arange(longest) < wanted[:, None]], mask=np.repeat(~known, wanted))
                f = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(wanted)]), pa.int32()), flat_values)
                yield pa.RecordBatch.from_arrays([*(col(c) for c in keep), f], names=[*keep, out])

    return df.mapInArrow(run, schema)


def _lagged(ranked: DataFrame, keys: Sequence[str], value: str, p: int) -> tuple[DataFrame, list[str]]:
    """``ranked`` (numbered by ``t``) with the ``p`` values before each, over halo blocks."""
    lags = [f"_lag{k}" for k in range(1, p + 1)]
    h = halo_blocks(ranked, "t", before=p, after=0)
    w = Window.partitionBy(*keys, "_lm_blk").orderBy("t")
    return h.select("*", *[F.lag(value, k).over(w).alias(c) for k, c in enumerate(lags, 1)]).filter("_lm_own").drop("_lm_own", "_lm_blk"), lags


def ar_fit_by_series(ranked: DataFrame, keys: Sequence[str], value: str, p: int, penalty: float = 0.0) -> DataFrame:
    """(keys..., n, b0, b): an AR(p) model of every series, by its own normal equations.

    ``ranked`` has positions ``t`` from 1.  A series is reduced to one vector of moments, summed map-side, so a
    series with a third of the rows is no group in memory; the systems are solved in array expressions.
    ``penalty`` is a ridge on the lag coefficients (of the mean squared error).  Rows with a null among value and
    lags do not count; a series without a whole row has no model.  A lag that the others span has coefficient 0.
    """
    keys = list(keys)
    h, lags = _lagged(ranked, keys, value, p)
    m = h.groupBy(*keys).agg(L.moments([F.col(c) for c in [*lags, value]]).alias("m")).filter("m.n > 0")
    fit = m.select(*keys, F.col("m.n").alias("n"), L.ridge_fit(F.col("m"), list(range(p)), p, F.lit(float(penalty))).alias("fit"))
    return fit.select(*keys, "n", "fit.b0", "fit.b")


def ar_forecast_by_series(series: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column], value: str,
                          p: int, horizon: int, penalty: float = 0.0, train_fraction: float | None = None,
                          with_model: bool = False, held_out_only: bool = False) -> DataFrame:
    """One AR(p) model a series and its forecasts: (keys..., h, forecast), and ``actual`` with ``train_fraction``.

    With ``train_fraction`` the models see the first floor(fraction * n) values of each series only, forecasts start
    behind them, and ``actual`` is the value at that place (null behind the end, and where a key is null).  The last p
    values and the ``horizon`` values behind them come from one grouping of the series.  ``with_model`` adds the lag
    coefficients ``b``; ``held_out_only`` stops each series at its end, so there are no more rows than values.
    Series with fewer than p values to start from, or without a model, are left out.
    """
    keys = list(keys)
    ranked = group_row_number(series, keys, order_cols, out="t", size_col="_n")
    if train_fraction is not None:
        num, den = decimal_ratio(float(train_fraction))
        ranked = ranked.withColumn("_cut", F.floor(F.col("_n") * num / den))
    else:
        ranked = ranked.withColumn("_cut", F.col("_n"))
    models = ar_fit_by_series(ranked.filter(F.col("t") <= F.col("_cut")).select(*keys, "t", value), keys, value, p, penalty)
    near = ranked.filter((F.col("t") > F.col("_cut") - p) & (F.col("t") <= F.col("_cut") + horizon))      # p + horizon values a series
    entry = F.struct("t", F.col(value).cast("double").alias("v"))
    tail = near.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("t") <= F.col("_cut"), entry)), asc=False).alias("_tail"),           # newest first
        F.sort_array(F.collect_list(F.when(F.col("t") > F.col("_cut"), entry))).alias("_truth")).filter(F.size("_tail") == p)
    carried = [*keys, *(["b"] if with_model else []), *(["_truth"] if train_fraction is not None else [])]
    j = join_side_table(tail, models, keys).withColumns({
        "_last": F.transform("_tail", lambda s: s["v"]), "_b0": F.col("b0"), "_b": F.col("b"), "_truth": F.transform("_truth", lambda s: s["v"])})
    steps = "_steps" if held_out_only and train_fraction is not None else None
    f = with_forecasts(j.select(*carried, "_last", "_b0", "_b", *([F.size("_truth").alias(steps)] if steps else [])), horizon, steps=steps)
    out = f.select(*carried, F.posexplode("_f").alias("_h", "forecast"))
    named = None
    for k in keys:
        named = F.col(k).isNotNull() if named is None else named & F.col(k).isNotNull()
    actual = [F.when(named, F.get("_truth", F.col("_h"))).alias("actual")] if train_fraction is not None else []
    return out.select(*keys, (F.col("_h") + 1).alias("h"), "forecast", *(["b"] if with_model else []), *actual)


def regression_rmse(pred: DataFrame, label: str, prediction: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse").evaluate(pred)


__all__ = ["assemble", "array_to_vector", "vector_to_array", "OneHotEncoder"]
