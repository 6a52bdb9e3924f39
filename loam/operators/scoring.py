"""Batch scoring and tagging of predictions.

Two paths:
* models expressible as Spark expressions (fixed linear coefficients, Spark ML
  ``PipelineModel``) are applied inside the plan — codegen, no Python;
* foreign models go through ``mapInPandas`` with the model loaded once per
  Python worker (module-level cache), scoring whole Arrow batches.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LinearModel:
    """y = intercept + sum(coef * feature); ``latency_ms`` is the declared per-row cost."""

    name: str
    intercept: float
    coefficients: Mapping[str, float] = field(default_factory=dict)
    latency_ms: float = 0.0

    def predict(self) -> Column:
        out = F.lit(float(self.intercept))
        for f, w in self.coefficients.items():
            out = out + F.lit(float(w)) * F.col(f).cast("double")
        return out


def score_and_tag(df: DataFrame, models: Sequence[LinearModel], target: str,
                  keep: Sequence[str | Column] = (), testdata: Column | str | None = None) -> DataFrame:
    """One scan, every model: (keep..., model, testdata, weight_true, weight_predicted,
    weight_residual, time_inference).  Models are stacked with ``inline`` (no union of scans)."""
    rows = [F.struct(F.lit(m.name).alias("model"), m.predict().alias("weight_predicted"),
                     F.lit(float(m.latency_ms)).alias("time_inference")) for m in models]
    td = F.lit(testdata) if isinstance(testdata, str) else testdata
    cols = list(keep) + [F.col(target).cast("double").alias("weight_true")]
    if td is not None:
        cols.append(td.alias("testdata"))
    out = df.select(*cols, F.inline(F.array(*rows)))
    return out.withColumn("weight_residual", F.col("weight_true") - F.col("weight_predicted"))


def year_range_label(ts: str | Column, ranges: Sequence[tuple[int, int]]) -> Column:
    """'from-to' label of the year range containing ``ts`` (null outside all ranges)."""
    y = F.year(F.col(ts) if isinstance(ts, str) else ts)
    out = None
    for lo, hi in ranges:
        cond = y.between(lo, hi)
        out = F.when(cond, F.lit(f"{lo}-{hi}")) if out is None else out.when(cond, F.lit(f"{lo}-{hi}"))
    return out


_MODEL_CACHE: dict[str, object] = {}


def score_with_loader(df: DataFrame, loader: Callable[[], Callable[[pd.DataFrame], pd.Series]],
                      cache_key: str, features: Sequence[str], out_schema: str,
                      model_name: str) -> DataFrame:
    """Score a foreign (non-Spark) model with ``mapInPandas``.

    ``loader`` returns a batch predictor; it runs once per Python worker.  Adds
    ``weight_predicted`` and per-row ``time_inference`` (batch time / rows, msec).
    """
    feats = list(features)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _MODEL_CACHE.get(cache_key)
        if model is None:
            model = loader()
            _MODEL_CACHE[cache_key] = model
        for pdf in batches:
            t0 = time.perf_counter()
            pred = model(pdf[feats])
            dt = time.perf_counter() - t0
            pdf = pdf.assign(model=model_name, weight_predicted=pd.Series(pred, index=pdf.index).astype("float64"),
                             time_inference=1000.0 * dt / max(len(pdf), 1))
            yield pdf

    return df.mapInPandas(run, schema=out_schema)
