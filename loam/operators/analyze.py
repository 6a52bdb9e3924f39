"""Analyzers: whole-column reductions (statistics, quantiles, vocabularies, idf).

Design rule: every scalar analyzer of a fit goes into ONE ``agg`` (one pass,
partial aggregation on the map side).  Exact quantiles use the distributed
ranking in :mod:`loam.operators.ranking` (a range-partitioned sort), never an
aggregate that holds a whole group in one task; ``percentile_approx`` is the
mergeable-sketch alternative for very large inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.arrays import explode_rows
from loam.operators.ranking import (global_row_number, join_side_table, limit_ordered,
                                   prefix_sums)

# Fixed value: the padding word placed at id 0 of a word-set vocabulary.
PAD_WORD = "#=KS=#"


def _struct_rows(structs: list[Column]) -> Column:
    return F.inline(F.array(*structs))


# --------------------------------------------------------------------------- stats

def column_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long table (feature, mean, stdv, max, min); stdv is the sample std (ddof=1)."""
    aggs = []
    for f in features:
        c = F.col(f).cast("double")
        aggs += [F.avg(c).alias(f"{f}__mean"), F.stddev_samp(c).alias(f"{f}__stdv"),
                 F.max(c).alias(f"{f}__max"), F.min(c).alias(f"{f}__min")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f"{f}__mean").alias("mean"),
                     F.col(f"{f}__stdv").alias("stdv"), F.col(f"{f}__max").alias("max"),
                     F.col(f"{f}__min").alias("min")) for f in features]
    return wide.select(_struct_rows(rows))


def moments(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: min/max/mean/population variance of every feature, in a single pass."""
    aggs = []
    for f in features:
        c = F.col(f).cast("double")
        aggs += [F.min(c).alias(f"{f}_min"), F.max(c).alias(f"{f}_max"),
                 F.avg(c).alias(f"{f}_mean"), F.var_pop(c).alias(f"{f}_var")]
    return df.agg(*aggs)


def to_long(df: DataFrame, features: Sequence[str], keys: Sequence[str] = (),
            name: str = "feature", value: str = "value") -> DataFrame:
    """Unpivot numeric features to (keys..., feature, value) as double."""
    rows = [F.struct(F.lit(f).alias(name), F.col(f).cast("double").alias(value)) for f in features]
    return df.select(*keys, F.inline(F.array(*rows)))


# --------------------------------------------------------------------------- quantiles

def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (like ``quantile_cont``) per group.

    Distributed and skew-safe: values are first compressed to (group, value,
    count) with a map-side partial aggregation (a column with few distinct
    values shrinks to a handful of rows), then a distributed prefix sum over
    the sorted distinct values gives each value its rank range; only the values
    covering the 1-2 ranks around each quantile position are kept.
    """
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    keys = list(keys)
    gkeys = keys or ["_lm_all"]
    base = df.select(*[F.col(k) for k in keys], F.col(value).cast("double").alias("_v"))
    if not keys:
        base = base.withColumn("_lm_all", F.lit(0))
    vc = base.filter(F.col("_v").isNotNull()).groupBy(*gkeys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ps = prefix_sums(vc, [F.col(k) for k in gkeys] + [F.col("_v")], ["_c"], inclusive=False, suffix="_before")
    grp = ps.groupBy(*gkeys).agg(F.min("_c_before").alias("_g0"), F.sum("_c").alias("_n"))
    r = join_side_table(ps, grp, gkeys).withColumn("_lo_rank", F.col("_c_before") - F.col("_g0"))
    covers = lambda rank: (F.col("_lo_rank") < rank) & (rank <= F.col("_lo_rank") + F.col("_c"))
    n1 = F.col("_n") - 1
    conds, aggs = [], []
    for p, nm in zip(probs, names):
        pos = n1 * F.lit(float(p))
        lo = F.floor(pos) + 1
        hi = F.ceil(pos) + 1
        conds += [covers(lo), covers(hi)]
        lo_v = F.max(F.when(covers(lo), F.col("_v")))
        hi_v = F.max(F.when(covers(hi), F.col("_v")))
        d = F.max(pos - F.floor(pos))
        aggs.append((lo_v + (hi_v - lo_v) * d).alias(nm))
    keep = conds[0]
    for c in conds[1:]:
        keep = keep | c
    out = r.filter(keep).groupBy(*gkeys).agg(*aggs)
    return out.drop("_lm_all") if not keys else out


def approx_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (),
                     epsilon: float = 0.01, names: Sequence[str] | None = None) -> DataFrame:
    """Mergeable-sketch quantiles (``percentile_approx``, accuracy = 1/epsilon)."""
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    acc = max(1, int(round(1.0 / epsilon)))
    arr = F.percentile_approx(F.col(value).cast("double"), list(probs), acc)
    g = df.groupBy(*keys) if keys else df
    res = g.agg(arr.alias("_qs"))
    return res.select(*keys, *[F.col("_qs")[i].alias(nm) for i, nm in enumerate(names)])


def bucket_boundaries(df: DataFrame, features: Sequence[str], num_buckets: int,
                      exact: bool = True, epsilon: float = 0.01) -> dict[str, list[float]]:
    """Quantile boundaries (num_buckets - 1 per feature) for all features in one job.

    Returns a small dict (num_buckets x features values): collected to the driver
    because it parameterizes the transform, bounded by construction.
    """
    probs = [i / num_buckets for i in range(1, num_buckets)]
    names = [f"b{i}" for i in range(1, num_buckets)]
    long = to_long(df, features)
    if exact:
        q = exact_quantiles(long, "value", probs, keys=["feature"], names=names)
    else:
        q = approx_quantiles(long, "value", probs, keys=["feature"], epsilon=epsilon, names=names)
    out = {f: [] for f in features}
    for row in q.collect():
        out[row["feature"]] = [row[n] for n in names]
    return out


def describe(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max per feature (long format, exact)."""
    long = to_long(df, features)
    basic = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], keys=["feature"],
                        names=["p25", "p50", "p75"])
    return basic.join(q, "feature", "left")


def five_number_summary(df: DataFrame, value: str, by: str) -> DataFrame:
    """Box-plot numbers per category: min, q1, median, q3, max (exact)."""
    return exact_quantiles(df, value, [0.0, 0.25, 0.5, 0.75, 1.0], keys=[by],
                           names=["min", "q1", "median", "q3", "max"])


def histogram(df: DataFrame, value: str, bins: int, log: bool = False) -> DataFrame:
    """Equal-width histogram between min and max (max falls in the last bin)."""
    x = F.col(value).cast("double")
    if log:
        x = F.when(x > 0, F.ln(x))
    base = df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
    rng = base.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    b = F.when(width > 0, F.least(F.floor((F.col("_x") - F.col("_lo")) / width), F.lit(bins - 1))) \
         .otherwise(F.lit(0)).cast("int")
    # rng is one row: broadcast with a proven size bound.
    j = base.crossJoin(F.broadcast(rng)).withColumn("bin", b)
    return (j.groupBy("bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("count"))
            .select("bin", (F.col("_lo") + F.col("bin") * width).alias("lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("hi"), "count"))


# --------------------------------------------------------------------------- counts

def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), F.col(col))


def class_share(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """Count and percent share of each class; the total is a one-row broadcast."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .select(col, "count", F.round(F.lit(100.0) * F.col("count") / F.col("_total"), digits)
                    .alias("percent")))


def baseline_accuracy(df: DataFrame, label: str) -> DataFrame:
    """Accuracy of always predicting the majority class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    return counts.agg((F.max("_c") / F.sum("_c")).alias("baseline_accuracy"),
                      F.max_by(F.col(label), F.struct(F.col("_c"), F.col(label))).alias("majority_class"))


# --------------------------------------------------------------------------- vocabularies

def vocabulary(tokens: DataFrame, token: str, top_k: int | None = None,
               min_frequency: int | None = None, count_col: str | None = None) -> DataFrame:
    """(token, frequency, id) ordered by frequency desc, then token desc; id is 0-based.

    ``count_col`` lets callers pass pre-aggregated counts.  Ids come from the
    distributed global row number (no single-partition window).
    """
    cnt = F.sum(count_col) if count_col else F.count(F.lit(1))
    counts = tokens.filter(F.col(token).isNotNull()).groupBy(token).agg(cnt.cast("long").alias("frequency"))
    if min_frequency:
        counts = counts.filter(F.col("frequency") >= min_frequency)
    order = [F.desc("frequency"), F.desc(token)]
    if top_k is not None:
        ranked = limit_ordered(counts, order, top_k, rank_col="_rn")
    else:
        ranked = global_row_number(counts, order, out="_rn")
    return ranked.select(token, "frequency", (F.col("_rn") - 1).cast("int").alias("id"))


def word_set_vocabulary(docs: DataFrame, text: str, pad_word: str = PAD_WORD) -> DataFrame:
    """Distinct space-separated words, ids 1..n in byte order, pad word at id 0."""
    words = (explode_rows(docs, [], F.split(F.col(text), " "), "word")
             .filter(F.col("word") != "").distinct())
    ranked = global_row_number(words, [F.col("word")], out="_rn")
    vocab = ranked.select("word", F.col("_rn").cast("int").alias("id"))
    pad = docs.sparkSession.range(1).select(F.lit(pad_word).alias("word"), F.lit(0).alias("id"))
    return pad.unionByName(vocab)


def doc_frequency(docs: DataFrame, doc_id: str, tokens: str | Column) -> DataFrame:
    """(token, df, idf) with idf = 1 + ln((N + 1) / (df + 1)), N = number of documents."""
    tok = tokens if isinstance(tokens, Column) else F.col(tokens)
    pairs = explode_rows(docs, [F.col(doc_id)], F.array_distinct(tok), "token")
    dfreq = pairs.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    n = docs.agg(F.count(F.lit(1)).alias("_n"))
    return (dfreq.crossJoin(F.broadcast(n))
            .select("token", "df", (F.lit(1.0) + F.ln((F.col("_n") + 1) / (F.col("df") + 1))).alias("idf")))


def idf_value(n_docs: Column, dfreq: Column) -> Column:
    return F.lit(1.0) + F.ln((n_docs + 1) / (dfreq + 1))

