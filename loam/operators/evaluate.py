"""Evaluation metrics as Spark aggregations (map-side partial aggregation, no collect)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.operators.ranking import prefix_sums


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rmse(residual: Column) -> Column:
    """SQRT(SUM(POW(r,2)) / COUNT(*))."""
    return F.sqrt(F.sum(residual * residual) / F.count(F.lit(1)))


def regression_metrics(df: DataFrame, y: str, yhat: str | Column, by: Sequence[str] = (),
                       extra: Mapping[str, Column] | None = None) -> DataFrame:
    """RMSE, MAE (plain mean absolute error), count per group, plus user metrics."""
    r = F.col(y).cast("double") - _c(yhat).cast("double")
    aggs = [rmse(r).alias("rmse"), F.avg(F.abs(r)).alias("mae"), F.count(F.lit(1)).alias("n")]
    for name, expr in (extra or {}).items():
        aggs.append(expr.alias(name))
    g = df.groupBy(*by) if by else df
    return g.agg(*aggs)


def accuracy_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and mean per-class accuracy (= mean recall over the true classes)."""
    keys = list(by)
    per = (df.groupBy(*keys, label)
           .agg(F.count(F.lit(1)).alias("_n"),
                F.sum((F.col(label) == F.col(pred)).cast("long")).alias("_ok")))
    g = per.groupBy(*keys) if keys else per
    return g.agg((F.sum("_ok") / F.sum("_n")).alias("accuracy"),
                 F.avg(F.col("_ok") / F.col("_n")).alias("mean_per_class_accuracy"),
                 F.sum("_n").alias("n"))


def macro_precision_recall(df: DataFrame, label: str, pred: str, by: str | None = None) -> DataFrame:
    """Macro-averaged precision and recall over the union of true and predicted classes (of each ``by``).

    One pass: every row is emitted once under its true class and once under its
    predicted class, and a single groupBy(class) yields support, tp and predicted.
    """
    hit = (F.col(label) == F.col(pred)).cast("long")
    keys = [by] if by else []
    tagged = df.select(*keys, F.inline(F.array(
        F.struct(F.col(label).alias("cls"), F.lit(1).alias("t"), hit.alias("tp"), F.lit(0).alias("p")),
        F.struct(F.col(pred).alias("cls"), F.lit(0).alias("t"), F.lit(0).cast("long").alias("tp"),
                 F.lit(1).alias("p")))))
    j = tagged.groupBy(*keys, "cls").agg(F.sum("t").alias("support"), F.sum("tp").alias("tp"),
                                  F.sum("p").alias("predicted"))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    return j.groupBy(*keys).agg(F.avg(prec).alias("macro_precision"), F.avg(rec).alias("macro_recall"),
                 F.count(F.lit(1)).alias("n_classes"))


def auroc_exact(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact ROC AUC by the rank-sum (Mann-Whitney) statistic with average ranks for ties.

    Rows are first collapsed per distinct score (partial aggregation), then the
    number of rows below each score comes from a distributed prefix sum.
    """
    per = (df.groupBy(F.col(score).cast("double").alias("_s"))
           .agg(F.sum(F.col(label).cast("long")).alias("_pos"),
                F.count(F.lit(1)).alias("_cnt")))
    cum = prefix_sums(per, [F.col("_s")], ["_cnt"], inclusive=False, suffix="_below")
    avg_rank = F.col("_cnt_below") + (F.col("_cnt") + 1) / 2.0
    tot = cum.agg(F.sum(F.col("_pos") * avg_rank).alias("_rsum"),
                  F.sum("_pos").alias("n_pos"),
                  (F.sum("_cnt") - F.sum("_pos")).alias("n_neg"))
    auc = (F.col("_rsum") - F.col("n_pos") * (F.col("n_pos") + 1) / 2.0) / (F.col("n_pos") * F.col("n_neg"))
    return tot.select(F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), auc).alias("auc"),
                      "n_pos", "n_neg")


def log_loss(df: DataFrame, label: str, prob: str, weight: str | Column | None = None,
             eps: float = 1e-15) -> DataFrame:
    """Binary cross-entropy -sum(w * ln p_true) / sum(w)."""
    p = F.greatest(F.least(F.col(prob).cast("double"), F.lit(1 - eps)), F.lit(eps))
    ll = -(F.col(label) * F.ln(p) + (1 - F.col(label)) * F.ln(1 - p))
    w = F.lit(1.0) if weight is None else _c(weight).cast("double")
    return df.agg((F.sum(w * ll) / F.sum(w)).alias("log_loss"), F.sum(w).alias("weight_sum"))


def sliced_metrics(df: DataFrame, slice_cols: Sequence[str], metrics: Mapping[str, Column]) -> DataFrame:
    """Overall metrics plus one row per value of each slice column, in ONE aggregation.

    Each row is emitted once per slice (``inline``), then a single groupBy
    (slice_col, slice_value) computes everything; the overall slice is ('', '').
    """
    tags = [F.struct(F.lit("Overall").alias("slice_col"), F.lit("").alias("slice_value"))]
    tags += [F.struct(F.lit(c).alias("slice_col"), F.col(c).cast("string").alias("slice_value"))
             for c in slice_cols]
    tagged = df.select("*", F.inline(F.array(*tags)))
    return tagged.groupBy("slice_col", "slice_value").agg(
        *[expr.alias(name) for name, expr in metrics.items()])


# Rows of a score range that are ranked together.
AUC_ROWS = 200_000


def sliced_auroc(df: DataFrame, label: str, score: str, slice_cols: Sequence[str]) -> DataFrame:
    """Exact ROC AUC overall and for every value of each slice column: (slice_col, slice_value, auc, n_pos, n_neg).

    Rows collapse to one per score and slice values, are dealt by ranges of the score, and each range is ranked within
    its task: a slice's rank sum over a range is that of its own rows plus the number of its rows in the ranges below.
    Rows are never copied per slice; what leaves a range is one row per slice.  Ties have average ranks; a slice of one
    class has a null AUC; rows with a null label or score do not count, a null slice value is a slice of its own.
    """
    held = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    named = [F.col(c).cast("string").alias(f"_v{i}") for i, c in enumerate(slice_cols)]
    values = [f"_v{i}" for i in range(len(slice_cols))]
    per = held.select(F.col(label).cast("long").alias("_y"), F.col(score).cast("double").alias("_s"), *named).groupBy("_s", *values).agg(
        F.sum("_y").alias("_pos"), F.count(F.lit(1)).alias("_cnt"))
    ranged = per.repartitionByRange("_s").sortWithinPartitions("_s").withColumn("_pid", F.spark_partition_id())

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Pieces of about ``AUC_ROWS`` sorted rows; equal scores stay together."""
        held = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < AUC_ROWS:
                continue
            t = pa.Table.from_batches(held)
            s = t.column("_s").to_numpy()
            n = int(np.searchsorted(s, s[-1]))        # the last score may go on
            if n:
                yield t.slice(0, n)
                held = t.slice(n).combine_chunks().to_batches()
        if any(x.num_rows for x in held):
            yield pa.Table.from_batches(held)

    def ranked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, t in enumerate(cut(batches)):
            yield from ranked_piece(place, t)

    def ranked_piece(place: int, t: pa.Table) -> Iterator[pa.RecordBatch]:
        s, pos, cnt = (t.column(c).to_numpy() for c in ("_s", "_pos", "_cnt"))
        pid = t.column("_pid")[0].as_py()
        tie = np.unique(s, return_inverse=True)[1].ravel()
        for i, name in enumerate(["Overall", *slice_cols]):
            codes = [""], np.zeros(s.size, np.int64)
            if i:
                d = t.column(f"_v{i - 1}").combine_chunks().dictionary_encode(null_encoding="encode")
                codes = d.dictionary.to_pylist(), d.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.lexsort((tie, codes[1]))
            c, k = codes[1][order], tie[order]
            first = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (k[1:] != k[:-1])])      # of each slice and score
            g, p, n = c[first], np.add.reduceat(pos[order], first), np.add.reduceat(cnt[order], first)
            head = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            below = np.cumsum(n) - n
            below -= np.repeat(below[head], np.diff(np.r_[head, g.size]))
            sums = [np.add.reduceat(x, head) for x in (p * (2 * below + n + 1), p, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([pid] * head.size, pa.int32()), pa.array([place] * head.size, pa.int32()), pa.array([name] * head.size), pa.array([codes[0][x] for x in g[head]], pa.string()),
                 *(pa.array(x, pa.int64()) for x in sums)], names=["_pid", "_place", "slice_col", "slice_value", "_r2", "_pos", "_cnt"])

    parts = ranged.mapInArrow(ranked, "_pid int, _place int, slice_col string, slice_value string, _r2 long, _pos long, _cnt long")
    # one row per slice and piece of a range: a slice's window has as many rows as there are pieces
    w = Window.partitionBy("slice_col", "slice_value").orderBy("_pid", "_place").rowsBetween(Window.unboundedPreceding, -1)
    cum = parts.withColumn("_below", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    # twice the average rank is a whole number, so sums are exact and do not depend on their order
    wide = "decimal(38,0)"
    twice = F.col("_r2").cast(wide) + (F.lit(2).cast("decimal(1,0)") * F.col("_below").cast("decimal(18,0)") * F.col("_pos").cast("decimal(18,0)")).cast(wide)
    tot = cum.groupBy("slice_col", "slice_value").agg(
        F.sum(twice.cast(wide)).alias("_r2"), F.sum("_pos").alias("n_pos"), (F.sum("_cnt") - F.sum("_pos")).alias("n_neg"))
    pos, neg = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    auc = (F.col("_r2").cast("double") - pos * (pos + 1)) / (2.0 * pos * neg)
    return tot.select("slice_col", "slice_value", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), auc).alias("auc"), "n_pos", "n_neg")


def error_by_horizon(df: DataFrame, h: str, y: str, yhat: str) -> DataFrame:
    """(h, rmse, mae, n): errors over the first h steps of all forecasts, for every h; unknown values do not count."""
    r = F.col(y).cast("double") - F.col(yhat).cast("double")
    g = df.filter(r.isNotNull()).groupBy(h).agg(F.sum(r * r).alias("_sse"), F.sum(F.abs(r)).alias("_sae"), F.count(F.lit(1)).alias("_n"))
    c = prefix_sums(g, [F.col(h)], ["_sse", "_sae", "_n"], inclusive=True)
    return c.select(h, F.sqrt(F.col("_sse_cum") / F.col("_n_cum")).alias("rmse"), (F.col("_sae_cum") / F.col("_n_cum")).alias("mae"),
                    F.col("_n_cum").cast("long").alias("n"))


def metrics_by_split_column(df: DataFrame, split: str, y: str, yhat: str | Column) -> DataFrame:
    """Train/valid/test metric table from ONE scan carrying a split column."""
    return regression_metrics(df, y, yhat, by=[split])


def metrics_by_split(parts: Mapping[str, DataFrame], y: str, yhat: str | Column) -> DataFrame:
    """Train/valid/test metric table from separate frames: union the labelled parts, one groupBy.
    Prefer :func:`metrics_by_split_column` when the parts come from one table."""
    frames = [p.select(F.lit(name).alias("split"), F.col(y).cast("double").alias("_y"),
                       _c(yhat).cast("double").alias("_p")) for name, p in parts.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return regression_metrics(u, "_y", "_p", by=["split"])


def reconstruction_error(a: str | Column, b: str | Column) -> Column:
    """Per-row RMSE between an input vector and its reconstruction."""
    from loam.functions.vector import as_double, squared_error_sum
    return F.sqrt(squared_error_sum(a, b) / F.size(as_double(a)))
