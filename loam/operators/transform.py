"""Fit-on-train / apply-anywhere feature transforms.

``FeaturePipeline(steps).fit(train)`` runs:
* ONE ``agg`` holding every scalar analyzer of every step (means, stds, mins, maxes);
* ONE distributed quantile job for all quantile-bucketized features;
* one ``groupBy(value).count`` job per learned vocabulary.

The result is an immutable :class:`FittedTransform`; ``transform(df)`` is a
single ``select`` of literal-parameterized expressions plus vocabulary lookups
(no hints: Spark broadcasts by size).  Eval data only ever
sees train statistics.  ``save``/``load`` write the artefacts through Spark
(JSON metadata + one Parquet table per vocabulary), so any shared filesystem works.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.functions.hashing import cross_bucket, hash_bucket
from loam.functions.numeric import identity_category
from loam.operators.analyze import bucket_boundaries, vocabulary


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------------- spec

@dataclass(frozen=True)
class FeatureSpec:
    """Column roles.  Unused columns = header - key - features - target - weight."""

    key: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    target: str | None = None
    weight: str | None = None

    @property
    def columns(self) -> list[str]:
        cols = list(self.key) + list(self.numeric) + list(self.categorical)
        cols += [c for c in (self.target, self.weight) if c]
        return cols

    def unused(self, header: Sequence[str]) -> list[str]:
        used = set(self.columns)
        return [h for h in header if h not in used]

    def project(self, df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
        """Keep only role columns (numeric as double, categorical as string), optionally renamed."""
        rename = rename or {}
        out = [F.col(k).alias(rename.get(k, k)) for k in self.key]
        out += [F.col(c).cast("double").alias(rename.get(c, c)) for c in self.numeric]
        out += [F.col(c).cast("string").alias(rename.get(c, c)) for c in self.categorical]
        for c in (self.target, self.weight):
            if c:
                out.append(F.col(c).alias(rename.get(c, c)))
        return df.select(*out)


# ----------------------------------------------------------------------------- steps

class Step:
    out: str

    def analyzers(self) -> dict[str, Column]:
        return {}

    def apply(self, fitted: "FittedTransform") -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class ZScore(Step):
    """(x - mean) / std with population std (x - mean when std == 0)."""
    col: str
    out: str
    ddof: int = 0

    def analyzers(self):
        c = F.col(self.col).cast("double")
        std = F.stddev_pop(c) if self.ddof == 0 else F.stddev_samp(c)
        return {f"{self.out}.mean": F.avg(c), f"{self.out}.std": std}

    def apply(self, ft):
        mu, sd = ft.stats[f"{self.out}.mean"], ft.stats[f"{self.out}.std"]
        x = F.col(self.col).cast("double") - F.lit(mu)
        return x / F.lit(sd) if sd else x


@dataclass(frozen=True)
class MinMax(Step):
    """(x - min) / (max - min); a constant column maps to 0.0."""
    col: str
    out: str

    def analyzers(self):
        c = F.col(self.col).cast("double")
        return {f"{self.out}.min": F.min(c), f"{self.out}.max": F.max(c)}

    def apply(self, ft):
        lo, hi = ft.stats[f"{self.out}.min"], ft.stats[f"{self.out}.max"]
        x = F.col(self.col).cast("double")
        if lo is None or hi is None or hi == lo:
            return F.when(x.isNotNull(), F.lit(0.0))
        return (x - F.lit(lo)) / F.lit(hi - lo)


def bucket_of(x: Column, boundaries: Sequence[float]) -> Column:
    """Number of boundaries <= x (left-closed buckets, len+1 of them); null stays null."""
    if not boundaries:
        return F.when(x.isNotNull(), F.lit(0))
    values = [float(b) for b in boundaries]

    def search(lo: int, hi: int) -> Column:           # a balanced tree of comparisons
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x >= F.lit(values[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))

    return F.when(x.isNotNull(), search(0, len(values)))


@dataclass(frozen=True)
class QuantileBucketize(Step):
    """Bucket id from train quantile boundaries (num_buckets - 1 of them)."""
    col: str
    out: str
    num_buckets: int
    exact: bool = True
    epsilon: float = 0.01

    def apply(self, ft):
        return bucket_of(F.col(self.col).cast("double"), ft.boundaries[self.out])


@dataclass(frozen=True)
class FixedBucketize(Step):
    col: str
    out: str
    boundaries: tuple[float, ...]

    def apply(self, ft):
        return bucket_of(F.col(self.col).cast("double"), self.boundaries)


@dataclass(frozen=True)
class Vocabulary(Step):
    """Integerize by a learned vocabulary (frequency desc, value desc); OOV -> ``oov``."""
    col: str
    out: str
    top_k: int | None = None
    oov: int = -1

    def apply(self, ft):
        return F.coalesce(F.col(f"_lm_vid_{self.out}"), F.lit(self.oov))


@dataclass(frozen=True)
class FixedVocabulary(Step):
    """Index in a fixed list (position), OOV -> ``oov``."""
    col: str
    out: str
    values: tuple[str, ...]
    oov: int = -1

    def apply(self, ft):
        pos = F.array_position(F.array(*[F.lit(v) for v in self.values]), F.col(self.col).cast("string"))
        return F.when(pos > 0, (pos - 1).cast("int")).otherwise(F.lit(self.oov))


@dataclass(frozen=True)
class HashBucket(Step):
    col: str
    out: str
    num_buckets: int

    def apply(self, ft):
        return hash_bucket(self.col, self.num_buckets)


@dataclass(frozen=True)
class Cross(Step):
    cols: tuple[str, ...]
    out: str
    num_buckets: int

    def apply(self, ft):
        return cross_bucket(list(self.cols), self.num_buckets)


@dataclass(frozen=True)
class Identity(Step):
    col: str
    out: str
    num_buckets: int
    default: int = 0

    def apply(self, ft):
        return identity_category(self.col, self.num_buckets, self.default)


@dataclass(frozen=True)
class Log(Step):
    col: str
    out: str
    offset: float = 0.0

    def apply(self, ft):
        v = F.col(self.col).cast("double") + F.lit(self.offset)
        return F.when(v > 0, F.ln(v))


@dataclass(frozen=True)
class Expr(Step):
    """Stateless user expression (the ``process_features`` hook for one column)."""
    out: str
    fn: Callable[[], Column] = field(compare=False)

    def apply(self, ft):
        return self.fn()


# ----------------------------------------------------------------------------- fit / apply

@dataclass
class FittedTransform:
    steps: list[Step]
    keep: list[str]
    stats: dict[str, float | None]
    boundaries: dict[str, list[float]]
    vocabs: dict[str, DataFrame]
    vocab_sizes: dict[str, int]
    process_features: Callable[[DataFrame], DataFrame] | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        cur = self.process_features(df) if self.process_features else df
        for s in self.steps:
            if isinstance(s, Vocabulary):
                v = self.vocabs[s.out].select(F.col("value").alias(f"_lm_vk_{s.out}"),
                                              F.col("id").alias(f"_lm_vid_{s.out}"))
                cur = cur.join(v, F.col(s.col).cast("string") == F.col(f"_lm_vk_{s.out}"), "left")
        out = [F.col(k) for k in self.keep] + [s.apply(self).alias(s.out) for s in self.steps]
        return cur.select(*out)

    # -- persistence -----------------------------------------------------------------
    def save(self, path: str) -> None:
        spark = next(iter(self.vocabs.values())).sparkSession if self.vocabs else SparkSession.getActiveSession()
        meta = {"stats": self.stats, "boundaries": self.boundaries, "vocab_sizes": self.vocab_sizes,
                "keep": self.keep, "steps": [_step_meta(s) for s in self.steps]}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
            .write.mode("overwrite").text(f"{path}/metadata")
        for name, v in self.vocabs.items():
            v.write.mode("overwrite").parquet(f"{path}/vocab/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str, steps: list[Step] | None = None,
             process_features: Callable[[DataFrame], DataFrame] | None = None) -> "FittedTransform":
        """Reload a fitted transform from its folder alone, or check ``steps`` (the code) against it.

        Given steps must match what was saved, parameters included.  Steps that hold code of
        the user's (``Expr``) cannot be saved, so transforms with them need their steps.
        """
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        if steps is None:
            steps = [_step_of(m) for m in meta["steps"]]
        now = json.loads(json.dumps([_step_meta(s) for s in steps]))
        if meta["steps"] != now:
            raise ValueError(f"saved steps {meta['steps']} do not match {now}")
        vocabs = {name: spark.read.parquet(f"{path}/vocab/{name}") for name in meta["vocab_sizes"]}
        return FittedTransform(steps, meta["keep"], meta["stats"], meta["boundaries"], vocabs,
                               meta["vocab_sizes"], process_features)


def _step_meta(s: Step) -> dict:
    d = {"type": type(s).__name__}
    for f in fields(s):
        v = getattr(s, f.name)
        if not callable(v):
            d[f.name] = list(v) if isinstance(v, tuple) else v
    return d


def _step_of(meta: dict) -> Step:
    kinds = {c.__name__: c for c in Step.__subclasses__()}
    kind = kinds.get(meta["type"])
    if kind is None or kind is Expr:
        raise ValueError(f"step {meta} holds code: pass the steps")
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in meta.items() if k != "type"})


@dataclass
class FeaturePipeline:
    steps: list[Step]
    keep: list[str] = field(default_factory=list)
    process_features: Callable[[DataFrame], DataFrame] | None = None

    def fit(self, train: DataFrame, max_concurrent_jobs: int = 4) -> FittedTransform:
        """Fit every analyzer; independent Spark jobs (the scalar agg, each quantile
        group, each vocabulary) are submitted concurrently from driver threads."""
        if self.process_features:
            train = self.process_features(train)
        aggs: dict[str, Column] = {}
        for s in self.steps:
            aggs.update(s.analyzers())

        def fit_scalars() -> dict:
            if not aggs:
                return {}
            row = train.agg(*[c.alias(k) for k, c in aggs.items()]).first()
            return {k: (float(row[k]) if row[k] is not None else None) for k in aggs}

        by_cfg: dict[tuple[int, float, bool], list[QuantileBucketize]] = {}
        for s in self.steps:
            if isinstance(s, QuantileBucketize):
                by_cfg.setdefault((s.num_buckets, s.epsilon, s.exact), []).append(s)

        def fit_quantiles(cfg, ss) -> dict:
            n, eps, exact = cfg
            src = train.select(*[F.col(s.col).cast("double").alias(s.out) for s in ss])
            return bucket_boundaries(src, [s.out for s in ss], n, exact=exact, epsilon=eps)

        def fit_vocab(s: Vocabulary):
            vals = train.select(F.col(s.col).cast("string").alias("value"))
            v = vocabulary(vals, "value", top_k=s.top_k).select("value", "frequency", "id")
            return s.out, v, v.count()

        with ThreadPoolExecutor(max_workers=max_concurrent_jobs) as pool:
            f_stats = pool.submit(fit_scalars)
            f_q = [pool.submit(fit_quantiles, cfg, ss) for cfg, ss in by_cfg.items()]
            f_v = [pool.submit(fit_vocab, s) for s in self.steps if isinstance(s, Vocabulary)]
            stats = f_stats.result()
            boundaries: dict[str, list[float]] = {}
            for f in f_q:
                boundaries.update(f.result())
            vocabs: dict[str, DataFrame] = {}
            sizes: dict[str, int] = {}
            for f in f_v:
                name, v, n = f.result()
                vocabs[name], sizes[name] = v, n
        return FittedTransform(list(self.steps), list(self.keep), stats, boundaries, vocabs, sizes,
                               self.process_features)

    def fit_transform(self, train: DataFrame) -> tuple[DataFrame, FittedTransform]:
        ft = self.fit(train)
        return ft.transform(train), ft
