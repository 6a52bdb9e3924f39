"""Vector operators over ``array<float|double>`` columns.

Per-row vector math uses higher-order functions (``zip_with``/``aggregate``)
inside whole-stage codegen — no explode, no shuffle.  Group pooling explodes
with positions and aggregates per (group, position) with map-side partial
aggregation, so a hot group is still combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions import vector as V
from loam.functions.arrays import explode_rows, let, posexplode_rows

_STATS = {"min": F.min, "max": F.max, "mean": F.avg}


def single_row(df: DataFrame, order_cols: Sequence[str | Column]) -> DataFrame:
    """Deterministic one-row probe (first row of a total order); size bound = 1."""
    return df.orderBy(*order_cols).limit(1)


def _one_probe(probe: DataFrame, key: str, vec: str) -> DataFrame:
    """The probe's only row as (k1, _v1); several rows are an error, none gives none."""
    p = probe.agg(F.count(F.lit(1)).alias("_n"), F.first(key).alias("k1"), F.first(vec).alias("_v1")).filter("_n > 0")
    one = F.when(F.col("_n") == 1, F.col("_v1")).otherwise(
        F.raise_error(F.lit("the probe has more than one row")).cast(probe.schema[vec].dataType))
    return p.select("k1", one.alias("_v1"))


def similar_by_vector(df: DataFrame, key: str, vec: str, probe: DataFrame,
                      top_k: int | None = None) -> DataFrame:
    """Cosine similarity of one probe vector against every row: (k1, k2, similarity).

    The probe side is exactly one row, so the cross join is a broadcast nested
    loop join streaming the big side once; the dot product is fused per row.
    """
    p = _one_probe(probe, key, vec)
    j = df.select(F.col(key).alias("k2"), F.col(vec).alias("_v2")).crossJoin(F.broadcast(p))
    # the row's vector may be an expression: it is worked out once for dot product and norm
    out = j.select("k1", "k2", let(F.col("_v2"), lambda v: V.cosine("_v1", v)).alias("similarity"))
    if top_k is not None:
        out = out.orderBy(F.desc_nulls_last("similarity"), F.col("k2")).limit(top_k)
    return out


def similar_by_unnest(df: DataFrame, key: str, vec: str, probe: DataFrame) -> DataFrame:
    """Relational form: unnest both arrays by offset, pair them, group per (k1, k2).

    ``arrays_zip`` pairs elements by offset without a join; the group-by is the
    reference's "sum of products" collapse (partial aggregation before shuffle).
    """
    p = _one_probe(probe, key, vec)
    j = df.select(F.col(key).alias("k2"), F.col(vec).alias("_v2")).crossJoin(F.broadcast(p))
    z = explode_rows(j, ["k1", "k2"], F.arrays_zip(V.as_double("_v1").alias("a"),
                                                    V.as_double("_v2").alias("b")), "z")
    a, b = F.col("z.a"), F.col("z.b")
    return z.groupBy("k1", "k2").agg(
        F.sum(a * b).alias("dot"), F.sqrt(F.sum(a * a)).alias("norm1"), F.sqrt(F.sum(b * b)).alias("norm2"))


def exploded(df: DataFrame, vec: str, keys: Sequence[str]) -> DataFrame:
    """(keys..., pos, x) with pos 0-based and x as double."""
    return posexplode_rows(df, list(keys), V.as_double(vec), "pos", "x")


def _field(name: str):
    return lambda s: s[name]


def pool_vectors(df: DataFrame, group: str, vec: str, how: str | Sequence[str] = ("min", "max")) -> DataFrame:
    """Element-wise pooling of the vectors of each group: columns ``vec_<stat>`` (arrays).

    ``how=("min", "max")`` also adds ``vec_min_max`` (the concatenation).
    """
    hows = [how] if isinstance(how, str) else list(how)
    e = exploded(df, vec, [group])
    per = e.groupBy(group, "pos").agg(*[_STATS[h]("x").alias(h) for h in hows])
    # second stage holds one value per dimension per group: bounded by the vector width
    arr = per.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("pos", *hows))).alias("_s"))
    out = arr.select(group, *[F.transform("_s", _field(h)).alias(f"vec_{h}") for h in hows])
    if "min" in hows and "max" in hows:
        out = out.withColumn("vec_min_max", F.concat("vec_min", "vec_max"))
    return out


def pooled_long(df: DataFrame, group: str, vec: str, how: Sequence[str]) -> DataFrame:
    """Long form (group, pos, stat...) of :func:`pool_vectors`, before re-assembly."""
    e = exploded(df, vec, [group])
    return e.groupBy(group, "pos").agg(*[_STATS[h]("x").alias(f"v{h}") for h in how])


# Centroids in one broadcast row; larger sets are folded pack by pack on the same rows.
CENTROID_CHUNK = 4096


def _fold_pack(df: DataFrame, vec: str, cents: DataFrame, cid: str, cvec: str) -> DataFrame:
    """``_best`` (d, id) of every row, improved by one pack of centroids; null distances never win."""
    packed = cents.agg(F.sort_array(F.collect_list(
        F.struct(F.col(cid).alias("id"), V.as_double(cvec).alias("c")))).alias("_cents"))
    v = V.as_double(vec)

    def step(acc, c):
        d = V.squared_error_sum(v, c["c"])
        better = d.isNotNull() & (acc["d"].isNull() | (d < acc["d"]) | ((d == acc["d"]) & (c["id"] < acc["id"])))
        return F.when(better, F.struct(d.alias("d"), c["id"].alias("id"))).otherwise(acc)

    return df.crossJoin(F.broadcast(packed)).withColumn("_best", F.aggregate("_cents", F.col("_best"), step)).drop("_cents")


def nearest_centroid(df: DataFrame, vec: str, centroids: DataFrame, cid: str, cvec: str,
                     out: str = "centroid") -> DataFrame:
    """Assign every row to its nearest centroid (squared Euclidean; ties -> smallest id).

    One path for any number of centroids: packs of at most ``CENTROID_CHUNK`` go one
    after the other through a running (distance, id) on the same row, so there is no
    shuffle of the rows, no key and no join.  Null centroids are skipped; a null vector
    gets a null centroid.
    """
    from loam.operators.ranking import global_row_number
    id_type = centroids.schema[cid].dataType
    ranked = global_row_number(centroids.select(cid, cvec), [F.col(cid)], out="_crn")
    packs = -(-max(1, ranked.count()) // CENTROID_CHUNK)
    res = df.withColumn("_best", F.struct(F.lit(None).cast("double").alias("d"), F.lit(None).cast(id_type).alias("id")))
    for k in range(packs):
        res = _fold_pack(res, vec, ranked.filter(F.floor((F.col("_crn") - 1) / CENTROID_CHUNK) == k), cid, cvec)
    return res.withColumn(out, F.col("_best.id")).withColumn(f"{out}_sqdist", F.col("_best.d")).drop("_best")


def with_vectorized(df: DataFrame, fn, input_col: str, output: str, return_type: str) -> DataFrame:
    """Apply a batch function through an Arrow ``pandas_udf`` (the vectorized UDF hook)."""
    udf = F.pandas_udf(fn, return_type)
    return df.withColumn(output, udf(F.col(input_col)))


def standardize_vectors(df: DataFrame, vec: str, out: str) -> DataFrame:
    """Per-vector standardization (x - mean) / max(std_pop, 1/sqrt(n)), in three projections."""
    a = V.as_double(vec)
    n = F.size(a)
    s1 = df.withColumn("_lm_mu", F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / n)
    var = F.aggregate(V.as_double(vec), F.lit(0.0),
                      lambda acc, x: acc + (x - F.col("_lm_mu")) * (x - F.col("_lm_mu"))) / F.size(vec)
    s2 = s1.withColumn("_lm_den", F.greatest(F.sqrt(var), F.lit(1.0) / F.sqrt(F.size(vec).cast("double"))))
    return (s2.withColumn(out, F.transform(V.as_double(vec), lambda x: (x - F.col("_lm_mu")) / F.col("_lm_den")))
            .drop("_lm_mu", "_lm_den"))


def dense_from_long(df: DataFrame, key: str, index: str, value: str, dims: int, out: str = "vec") -> DataFrame:
    """(key, index, value) rows -> (key, dense array of ``dims``) with zeros for missing slots.

    The per-key collect holds at most ``dims`` entries (bounded by the vector width).
    """
    g = df.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.col(index).cast("int"),
                                                                        F.col(value).cast("double")))).alias("_m"))
    return g.select(key, F.transform(F.sequence(F.lit(0), F.lit(dims - 1)),
                                     lambda i: F.coalesce(F.element_at("_m", i), F.lit(0.0))).alias(out))
