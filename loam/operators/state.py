"""Mergeable analyzer state: what a fit knows of its rows, kept so that later rows can be added.

The state of a numeric feature is one row: count, mean, sum of squared deviations, minimum, maximum and a KLL
sketch of its values.  The state of a vocabulary is its values' counts, whole: a top-k cut is made when the state
is finished, never in between.  States of disjoint rows merge to the state of all of them without reading any row
again, so an artefact can be refitted day by day.  Everything is one partially aggregated pass; a merge is two
small aggregations over states.

Nulls don't count.  A feature without values has count 0, null statistics and no boundaries.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.operators import transform as TR
from loam.operators.analyze import vocabulary

SKETCH_K = 1024      # rank error of a merged sketch: about 0.25 % (the error falls with about 1 / k)
NUMERIC = "feature string, n long, mean double, m2 double, min double, max double, sketch binary"
_FIELDS = ("n", "mean", "m2", "min", "max", "sketch")


def numeric_state(df: DataFrame, features: Sequence[str], by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(by..., feature, n, mean, m2, min, max, sketch): every feature's state from one aggregation."""
    features = list(dict.fromkeys(features))
    if not features:
        return df.select(*by).limit(0).select(*by, *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in NUMERIC.split(", ")])
    aggs = []
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        n = F.count(x)
        aggs.append(F.struct(F.lit(f).alias("feature"), n.alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * n).alias("m2"),
                             F.min(x).alias("min"), F.max(x).alias("max"), F.kll_sketch_agg_double(x, k).alias("sketch")).alias(f"s{i}"))
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return wide.select(*by, F.inline(F.array(*[f"s{i}" for i in range(len(features))])))


def merge_numeric(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of disjoint rows merged by feature (and ``by``); squared deviations are taken from the merged mean."""
    keys = [*by, "feature"]
    n = F.col("n").cast("double")
    whole = states.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.try_divide(F.sum(n * F.coalesce("mean", F.lit(0.0))), F.sum(n)).alias("mean"), F.min("min").alias("min"),
        F.max("max").alias("max"), F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch"))).alias("sketch"))
    means = whole.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("mean").alias("_mean"))
    same = None
    for c in keys:
        same = F.col(c).eqNullSafe(F.col(f"_{c}")) if same is None else same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    off = F.col("mean") - F.col("_mean")
    spread = states.join(means, same).groupBy(*keys).agg(F.sum(F.col("m2") + n * off * off).alias("m2"))
    spread = spread.select(*[F.col(c).alias(f"_{c}") for c in keys], "m2")
    return whole.join(spread, same).select(*keys, *_FIELDS)


def std_of(ddof: int = 0) -> Column:
    """Standard deviation of a state row; null where there are too few values."""
    return F.sqrt(F.try_divide(F.greatest(F.col("m2"), F.lit(0.0)), F.when(F.col("n") > ddof, F.col("n") - ddof)))


def quantiles_of(probs: Sequence[float]) -> Column:
    """Quantiles of a state row from its sketch, an array in the order of ``probs``; null without values."""
    return F.when(F.col("n") > 0, F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs]))


def boundaries(states: DataFrame, num_buckets: int, by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, i, boundary): the num_buckets - 1 cuts of each feature, i from 1."""
    probs = [i / num_buckets for i in range(1, num_buckets)]
    return states.select(*by, "feature", F.posexplode(quantiles_of(probs)).alias("i", "boundary")).withColumn("i", F.col("i") + 1)


def count_state(df: DataFrame, col: str) -> DataFrame:
    """(value, frequency) of a column, nulls left out."""
    return df.select(F.col(col).cast("string").alias("value")).filter("value IS NOT NULL").groupBy("value").agg(
        F.count(F.lit(1)).alias("frequency"))


def merge_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("value").agg(F.sum("frequency").alias("frequency"))


# --------------------------------------------------------------------------- state of a pipeline

def _numeric_columns(steps: Sequence[TR.Step]) -> list[str]:
    return list(dict.fromkeys(s.col for s in steps if isinstance(s, (TR.ZScore, TR.MinMax, TR.QuantileBucketize))))


@dataclass
class FitState:
    """The unfinished fit of a :class:`~loam.operators.transform.FeaturePipeline`."""

    pipeline: TR.FeaturePipeline
    numeric: DataFrame
    counts: dict[str, DataFrame]

    @staticmethod
    def of(pipeline: TR.FeaturePipeline, train: DataFrame) -> FitState:
        if pipeline.process_features:
            train = pipeline.process_features(train)
        return FitState(pipeline, numeric_state(train, _numeric_columns(pipeline.steps)),
                        {s.out: count_state(train, s.col) for s in pipeline.steps if isinstance(s, TR.Vocabulary)})

    def merge(self, other: FitState) -> FitState:
        """The state of both parts' rows; the pipelines must have the same steps."""
        if _meta(self.pipeline) != _meta(other.pipeline):
            raise ValueError(f"states of different steps: {_meta(self.pipeline)} and {_meta(other.pipeline)}")
        return FitState(self.pipeline, merge_numeric(self.numeric.unionByName(other.numeric)),
                        {c: merge_counts(v, other.counts[c]) for c, v in self.counts.items()})

    def save(self, path: str) -> None:
        """To a new folder: states as Parquet, the steps as JSON, written last."""
        spark = self.numeric.sparkSession
        self.numeric.write.parquet(f"{path}/numeric")
        for name, v in self.counts.items():
            v.write.parquet(f"{path}/counts/{name}")
        spark.range(1).select(F.lit(json.dumps(_meta(self.pipeline))).alias("value")).coalesce(1).write.text(f"{path}/steps")

    @staticmethod
    def load(spark: SparkSession, path: str, pipeline: TR.FeaturePipeline) -> FitState:
        saved, now = json.loads(spark.read.text(f"{path}/steps").first()[0]), json.loads(json.dumps(_meta(pipeline)))
        if saved != now:
            raise ValueError(f"saved steps {saved} do not match {now}")
        return FitState(pipeline, spark.read.parquet(f"{path}/numeric"), {
            s.out: spark.read.parquet(f"{path}/counts/{s.out}") for s in pipeline.steps if isinstance(s, TR.Vocabulary)})

    def finish(self) -> TR.FittedTransform:
        """The fitted transform.  One row a feature comes to the driver; boundaries are those of the sketches."""
        steps = self.pipeline.steps
        quantiles = [s for s in steps if isinstance(s, TR.QuantileBucketize)]
        cuts = {n: [i / n for i in range(1, n)] for n in sorted({s.num_buckets for s in quantiles})}
        rows = {r["feature"]: r for r in self.numeric.select(
            "feature", "n", "mean", "min", "max", std_of(0).alias("std0"), std_of(1).alias("std1"),
            *[quantiles_of(p).alias(f"cuts{n}") for n, p in cuts.items() if p]).collect()}
        stats: dict[str, float | None] = {}
        for s in steps:
            if isinstance(s, TR.ZScore):
                stats |= {f"{s.out}.mean": rows[s.col]["mean"], f"{s.out}.std": rows[s.col][f"std{s.ddof}"]}
            elif isinstance(s, TR.MinMax):
                stats |= {f"{s.out}.min": rows[s.col]["min"], f"{s.out}.max": rows[s.col]["max"]}
        bounds = {s.out: list(rows[s.col][f"cuts{s.num_buckets}"] or []) if s.num_buckets > 1 else [] for s in quantiles}
        vocabs = {s.out: vocabulary(self.counts[s.out], "value", top_k=s.top_k, count_col="frequency").select("value", "frequency", "id")
                  for s in steps if isinstance(s, TR.Vocabulary)}
        return TR.FittedTransform(list(steps), list(self.pipeline.keep), stats, bounds, vocabs,
                                  {name: v.count() for name, v in vocabs.items()}, self.pipeline.process_features)


def _meta(pipeline: TR.FeaturePipeline) -> dict:
    return {"keep": list(pipeline.keep), "steps": [TR._step_meta(s) for s in pipeline.steps]}
