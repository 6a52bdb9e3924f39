"""Series operators: ordered splits, tails, lags, sliding windows, ordered arrays.

All per-series positions come from the skew-safe group row number; windows
that look back/ahead a few rows are computed over halo blocks, so no window
partition grows with the length of a series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.functions.hashing import normal_deviate
from loam.functions.numeric import decimal_ratio
from loam.operators.ranking import group_row_number, halo_blocks


def series_index(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column],
                 out: str = "t", size_col: str | None = None) -> DataFrame:
    """1-based position of each row within its series."""
    return group_row_number(df, keys, order_cols, out=out, size_col=size_col)


def time_split(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column],
               train_fraction: float | None = 0.7, train_count: int | None = None) -> DataFrame:
    """'train' for the first rows of each series (count or floor(fraction*n)), else 'test'."""
    r = group_row_number(df, keys, order_cols, out="_t", size_col="_n")
    if train_count is not None:
        lim = F.lit(train_count)
    else:
        num, den = decimal_ratio(float(train_fraction))
        lim = F.floor(F.col("_n") * num / den)
    return r.withColumn("split", F.when(F.col("_t") <= lim, "train").otherwise("test")).drop("_t", "_n")


def series_tail(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column], n: int) -> DataFrame:
    """Last ``n`` rows of every series."""
    r = group_row_number(df, keys, order_cols, out="_t", size_col="_n")
    return r.filter(F.col("_t") > F.col("_n") - n).drop("_t", "_n")


def lag_features(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column], value: str,
                 lags: Sequence[int], period: float | None = None, block: int = 4096) -> DataFrame:
    """``value_lag{k}`` for each k (null before the series start) and optional sin/cos of
    2*pi*t/period where t is the 1-based position in the series."""
    keys = list(keys)
    r = group_row_number(df, keys, order_cols, out="t")
    p = max(lags)
    h = halo_blocks(r, "t", before=p, after=0, block=block)
    w = Window.partitionBy(*keys, "_lm_blk").orderBy("t")
    for k in lags:
        h = h.withColumn(f"{value}_lag{k}", F.lag(value, k).over(w))
    h = h.filter("_lm_own").drop("_lm_own", "_lm_blk")
    if period:
        ang = F.lit(2 * math.pi / period) * F.col("t").cast("double")
        h = h.withColumn("t_sin", F.sin(ang)).withColumn("t_cos", F.cos(ang))
    return h


def sliding_windows(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column], value: str,
                    n_in: int, n_out: int, step: int = 1, block: int = 4096) -> DataFrame:
    """Every full window of ``n_in + n_out`` consecutive values of each series.

    Output: keys..., ``start`` (1-based position of the first value), ``x`` (first
    n_in values) and ``y`` (next n_out values).  Windows start every ``step`` rows.
    """
    keys = list(keys)
    size = n_in + n_out
    r = group_row_number(df, keys, order_cols, out="t")
    h = halo_blocks(r.select(*keys, "t", value), "t", before=0, after=size - 1, block=block)
    w = Window.partitionBy(*keys, "_lm_blk").orderBy("t").rowsBetween(0, size - 1)
    win = (h.withColumn("_w", F.collect_list(F.struct(value)).over(w))
           .filter(F.col("_lm_own") & (F.size("_w") == size) & (F.pmod(F.col("t") - 1, F.lit(step)) == 0)))
    values = F.transform("_w", lambda s: s[value])        # structs, as a list of values would skip nulls
    return win.select(*keys, F.col("t").alias("start"), F.slice(values, 1, n_in).alias("x"),
                      F.slice(values, n_in + 1, n_out).alias("y"))


def series_chunks(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column], value: str,
                  chunk: int = 10_000) -> DataFrame:
    """Whole-series ordered read as consecutive arrays of at most ``chunk`` values.

    (keys..., chunk_id, first_t, values): concatenating chunks by chunk_id gives
    the full ordered series; no array ever holds more than ``chunk`` values.
    """
    keys = list(keys)
    r = group_row_number(df, keys, order_cols, out="t")
    c = r.withColumn("chunk_id", F.floor((F.col("t") - 1) / chunk).cast("long"))
    g = c.groupBy(*keys, "chunk_id").agg(F.sort_array(F.collect_list(F.struct("t", value))).alias("_s"))
    return g.select(*keys, "chunk_id", F.col("_s")[0]["t"].alias("first_t"),
                    F.transform("_s", lambda s: s[value]).alias("values"))


def sequence_in_out(arr: Column, n_in: int, n_out: int) -> list[Column]:
    """Split a fixed-length sequence into input (first n_in) and target (next n_out) parts."""
    return [F.slice(arr, 1, n_in).alias("seq_in"), F.slice(arr, n_in + 1, n_out).alias("seq_out")]


def falling(t: Column) -> Column:
    """-t (noise-free)."""
    return -t.cast("double")


def alternating(t: Column) -> Column:
    """2t at even and -2t at odd places (noise-free)."""
    x = F.lit(2.0) * t.cast("double")
    return F.when(F.pmod(t, F.lit(2)) == 0, x).otherwise(-x)


def signal(t: Column, period: float, trend: float) -> Column:
    """sin(pi * t / period) + t / trend (noise-free signal generator)."""
    x = t.cast("double")
    return F.sin(F.lit(math.pi) * x / F.lit(float(period))) + x / F.lit(float(trend))


def noisy(series: Column, key: Column, scale: float, seed: int = 0) -> Column:
    """A generated series with normal noise of standard deviation ``scale``, the row's own by its ``key``."""
    return series + F.lit(float(scale)) * normal_deviate(key, seed)
