"""Deterministic splitting and sampling.

Everything is a pure function of the row's key (MD5 fingerprint rule), so a
split is reproducible, needs one scan, and train/eval never overlap.  Exact
per-class fractions use the skew-safe group row number (a hot class is spread
over many tasks by the range sort).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.hashing import exponential_key, fingerprint_concat, md5_int, seeded_unit
from loam.functions.numeric import decimal_ratio
from loam.operators.ranking import global_row_number, group_row_number, limit_ordered


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_split(df: DataFrame, cols: Sequence[str | Column], train_pct: int = 70,
               out: str = "split", labels: tuple[str, str] = ("train", "eval")) -> DataFrame:
    """MOD(fingerprint(concat of all columns, null -> 'NA'), 100) < train_pct -> train.

    The fingerprint is non-negative, so the modulo is never negative (a signed
    fingerprint would send every negative key to train).
    """
    b = F.pmod(md5_int(fingerprint_concat(cols)), F.lit(100))
    return df.withColumn(out, F.when(b < train_pct, labels[0]).otherwise(labels[1]))


def threshold_split(df: DataFrame, col: str | Column, max_train_bucket: int = 75,
                    out: str = "split", labels: tuple[str, str] = ("train", "eval")) -> DataFrame:
    """ABS(fingerprint) MOD 100 <= max_train_bucket -> train (76/24 for 75)."""
    b = F.pmod(F.abs(md5_int(_c(col))), F.lit(100))
    return df.withColumn(out, F.when(b <= max_train_bucket, labels[0]).otherwise(labels[1]))


def random_fraction(df: DataFrame, key: str | Column, fraction: float, seed: int = 42,
                    resolution: int = 1 << 60) -> DataFrame:
    """Seeded Bernoulli-like sample by hash threshold: reproducible, one scan, no shuffle."""
    return df.filter(seeded_unit(key, seed, resolution) < F.lit(int(round(fraction * resolution))))


def random_rest(df: DataFrame, key: str | Column, fraction: float, seed: int = 42,
                resolution: int = 1 << 60) -> DataFrame:
    """The rows that :func:`random_fraction` leaves, by the same threshold: no join."""
    return df.filter(seeded_unit(key, seed, resolution) >= F.lit(int(round(fraction * resolution))))


def complement(df: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``sample`` (left anti join)."""
    return df.join(sample.select(key), key, "left_anti")


def stratified_split(df: DataFrame, label: str, key: str, fractions: Sequence[tuple[str, float]],
                     seed: int = 42, out: str = "split") -> DataFrame:
    """Exact per-class split: rows of each class in seeded-hash order, the first
    floor(f1*n) get the first name, the next up to floor((f1+f2)*n) the second, ...;
    the last name takes the rest.  Nested splits are successive cumulative cuts."""
    order = [seeded_unit(key, seed, 1 << 60), F.col(key)]
    r = group_row_number(df, [label], order, out="_rn", size_col="_n")
    cum = 0
    expr = None
    for name, frac in fractions[:-1]:
        cum += frac
        num, den = _ratio(cum)
        cond = F.col("_rn") <= F.floor(F.col("_n") * num / den)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = fractions[-1][0]
    expr = F.lit(last) if expr is None else expr.otherwise(F.lit(last))
    return r.withColumn(out, expr).drop("_rn", "_n")


def _ratio(x: float) -> tuple[int, int]:
    return decimal_ratio(x)


def modulo_holdout(df: DataFrame, order_cols: Sequence[str | Column], k: int = 6,
                   out: str = "split") -> DataFrame:
    """Position-in-order holdout: 0-based index % k == 0 -> test (distributed row index)."""
    r = global_row_number(df, order_cols, out="_rn")
    return r.withColumn(out, F.when(F.pmod(F.col("_rn") - 1, F.lit(k)) == 0, "test").otherwise("train")).drop("_rn")


def deterministic_shuffle(df: DataFrame, key: str, seed: int = 7, out: str = "pos") -> DataFrame:
    """Reproducible shuffle: order by a seeded hash of the key; ``pos`` is the 0-based rank."""
    r = global_row_number(df, [seeded_unit(key, seed, 1 << 60), F.col(key)], out="_rn")
    return r.withColumn(out, F.col("_rn") - 1).drop("_rn")


def kfold_assign(df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold id in [0, k) from a seeded hash of the key."""
    return df.withColumn(out, F.pmod(seeded_unit(key, seed, 1 << 60), F.lit(k)).cast("int"))


def weighted_sample(df: DataFrame, key: str, weight: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows drawn without replacement, each draw in proportion to ``weight`` among the rows left.

    Rows with a weight of 0 or less, or null, are never drawn; fewer than ``n`` rows come back if there are no more.
    The draw depends on (seed, key) only; rows of one key and weight are drawn one after the other.
    """
    drawn = df.withColumn("_draw", exponential_key(key, weight, seed)).filter("_draw IS NOT NULL")
    return limit_ordered(drawn, [F.col("_draw"), F.col(key)], n).drop("_draw")
