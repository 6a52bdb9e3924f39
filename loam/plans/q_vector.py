"""Vector / similarity queries (TV1, JN1, JN2, AG15-17, SL2, SF1, SF16-18, WN11, ML4, UD4)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from loam.functions import vector as V
from loam.operators import vector as VO
from loam.plans.common import r6
from loam.plans.registry import register, t

# Probe rule: the vector with the smallest id in class 3.
PROBE_LABEL = 3
SQL_PROBE = f"(SELECT vec_id AS k1, embedding::DOUBLE[] AS v1 FROM embeddings WHERE label = {PROBE_LABEL} ORDER BY vec_id LIMIT 1)"
# Class names of the sequence classifier.
SEQ_LABELS = ["P01", "P02", "P03", "P04"]


def _probe(emb):
    return VO.single_row(emb.filter(F.col("label") == PROBE_LABEL), ["vec_id"])


@register("similar_by_vector", f"""
SELECT p.k1, e.vec_id AS k2,
       round(list_dot_product(p.v1, e.embedding::DOUBLE[]) /
             (sqrt(list_dot_product(p.v1, p.v1)) * sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[]))), 6) AS similarity
FROM embeddings e CROSS JOIN {SQL_PROBE} p
""", ids=("TV1", "JN1", "AG15"))
def similar_by_vector(spark, sf):
    emb = t(spark, sf, "embeddings")
    s = VO.similar_by_vector(emb, "vec_id", "embedding", _probe(emb))
    return s.select("k1", "k2", r6("similarity").alias("similarity"))


@register("similar_top_k", f"""
SELECT k1, k2, similarity FROM (
  SELECT p.k1, e.vec_id AS k2,
         round(list_dot_product(p.v1, e.embedding::DOUBLE[]) /
               (sqrt(list_dot_product(p.v1, p.v1)) * sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[]))), 6) AS similarity,
         list_dot_product(p.v1, e.embedding::DOUBLE[]) /
               (sqrt(list_dot_product(p.v1, p.v1)) * sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[]))) AS s_raw
  FROM embeddings e CROSS JOIN {SQL_PROBE} p)
ORDER BY s_raw DESC, k2 LIMIT 10
""", ids=("SL2", "TV1"))
def similar_top_k(spark, sf):
    emb = t(spark, sf, "embeddings")
    s = VO.similar_by_vector(emb, "vec_id", "embedding", _probe(emb), top_k=10)
    return s.select("k1", "k2", r6("similarity").alias("similarity"))


@register("unnest_offset_join", f"""
WITH a AS (SELECT p.k1, unnest(p.v1) AS vv1, unnest(range(0, len(p.v1))) AS ind1 FROM {SQL_PROBE} p),
b AS (SELECT vec_id AS k2, unnest(embedding)::DOUBLE AS vv2, unnest(range(0, len(embedding))) AS ind2 FROM embeddings)
SELECT k1, k2, round(sum(vv1 * vv2), 6) AS dot, round(sqrt(sum(vv1 * vv1)), 6) AS norm1,
       round(sqrt(sum(vv2 * vv2)), 6) AS norm2
FROM a CROSS JOIN b WHERE ind1 = ind2 GROUP BY k1, k2
""", ids=("JN2",))
def unnest_offset_join(spark, sf):
    emb = t(spark, sf, "embeddings")
    s = VO.similar_by_unnest(emb, "vec_id", "embedding", _probe(emb))
    return s.select("k1", "k2", r6("dot").alias("dot"), r6("norm1").alias("norm1"), r6("norm2").alias("norm2"))


_SQL_EXPL = "(SELECT vec_id, label, unnest(range(0, len(embedding))) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)"


@register("pool_vectors", f"""
SELECT label, pos, min(x) AS vmin, max(x) AS vmax FROM {_SQL_EXPL} e GROUP BY label, pos
""", ids=("AG16",))
def pool_vectors(spark, sf):
    emb = t(spark, sf, "embeddings")
    return VO.pooled_long(emb, "label", "embedding", ["min", "max"]).select(
        "label", F.col("pos").cast("bigint").alias("pos"), "vmin", "vmax")


@register("mean_pool_vectors", f"""
SELECT label, pos, round(avg(x), 6) AS vmean FROM {_SQL_EXPL} e GROUP BY label, pos
""", ids=("AG17",))
def mean_pool_vectors(spark, sf):
    emb = t(spark, sf, "embeddings")
    p = VO.pool_vectors(emb, "label", "embedding", how="mean")
    return p.select("label", F.posexplode_outer("vec_mean").alias("pos", "vmean")).filter(F.col("pos").isNotNull()).select(
        "label", F.col("pos").cast("bigint").alias("pos"), r6("vmean").alias("vmean"))


@register("round_array", """
SELECT vec_id, pos, round(x, 3) + 0.0 AS v FROM (SELECT vec_id, unnest(range(0, len(embedding))) AS pos,
       unnest(embedding)::DOUBLE AS x FROM embeddings)
""", ids=("SF1", "TV4"))
def round_array(spark, sf):
    emb = t(spark, sf, "embeddings")
    r = emb.select("vec_id", V.round_array("embedding", 3).alias("r"))
    return r.select("vec_id", F.posexplode_outer("r").alias("pos", "v")).filter(F.col("pos").isNotNull()).select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), "v")


@register("standardize_vector", """
WITH e AS (SELECT vec_id, unnest(range(0, len(embedding))) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
s AS (SELECT vec_id, avg(x) AS mu, count(*) AS n FROM e GROUP BY vec_id),
v AS (SELECT e.vec_id, sum((x - mu) * (x - mu)) / n AS var, mu, n FROM e JOIN s USING (vec_id) GROUP BY e.vec_id, mu, n)
SELECT e.vec_id, e.pos, round((x - mu) / greatest(sqrt(var), 1.0 / sqrt(n)), 6) + 0.0 AS z
FROM e JOIN v USING (vec_id)
""", ids=("SF16",))
def standardize_vector(spark, sf):
    emb = t(spark, sf, "embeddings")
    z = VO.standardize_vectors(emb, "embedding", "z").select("vec_id", "z")
    # posexplode_outer: no inferred size()>0 filter re-evaluating the inlined lambdas
    return z.select("vec_id", F.posexplode_outer("z").alias("pos", "z")).filter(F.col("pos").isNotNull()).select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), r6("z").alias("z"))


_SQL_LABELS = "[" + ", ".join(f"'{x}'" for x in SEQ_LABELS) + "]"


@register("argmax_label", f"""
WITH l AS (SELECT vec_id, embedding[1:4]::DOUBLE[] AS z FROM embeddings),
m AS (SELECT vec_id, z, list_max(z) AS zm FROM l),
e AS (SELECT vec_id, z, list_transform(z, lambda x: exp(x - zm)) AS ex FROM m)
SELECT vec_id, {_SQL_LABELS}[list_position(z, list_max(z))] AS pred_label,
       round(list_max(ex) / list_sum(ex), 6) AS p_max FROM e
""", ids=("SF17",))
def argmax_label(spark, sf):
    emb = t(spark, sf, "embeddings")
    logits = F.slice(V.as_double("embedding"), 1, len(SEQ_LABELS))
    s = emb.select("vec_id", logits.alias("z"))
    labels = F.array(*[F.lit(x) for x in SEQ_LABELS])
    return s.select("vec_id", F.element_at(labels, V.argmax("z") + 1).alias("pred_label"),
                    r6(F.array_max(V.softmax("z"))).alias("p_max"))


@register("one_hot_label", """
SELECT vec_id, pos, CAST(pos = label AS INTEGER) AS v FROM (SELECT vec_id, label, unnest(range(0, 10)) AS pos FROM embeddings)
""", ids=("SF18",))
def one_hot_label(spark, sf):
    emb = t(spark, sf, "embeddings")
    o = emb.select("vec_id", V.one_hot("label", 10).alias("oh"))
    return o.select("vec_id", F.posexplode_outer("oh").alias("pos", "v")).filter(F.col("pos").isNotNull()).select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), "v")


@register("sequence_in_out", """
SELECT vec_id, CASE WHEN pos < 48 THEN 'in' ELSE 'out' END AS part,
       CASE WHEN pos < 48 THEN pos ELSE pos - 48 END AS pos, x AS value
FROM (SELECT vec_id, unnest(range(0, len(embedding))) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)
""", ids=("WN11",))
def sequence_in_out(spark, sf):
    from loam.operators.series import sequence_in_out as sio
    emb = t(spark, sf, "embeddings")
    s = emb.select("vec_id", *sio(V.as_double("embedding"), 48, 16))
    parts = s.select("vec_id", F.inline(F.array(
        F.struct(F.lit("in").alias("part"), F.col("seq_in").alias("a")),
        F.struct(F.lit("out").alias("part"), F.col("seq_out").alias("a")))))
    return parts.select("vec_id", "part", F.posexplode_outer("a").alias("pos", "value")).filter(F.col("pos").isNotNull()).select(
        "vec_id", "part", F.col("pos").cast("bigint").alias("pos"), "value")


@register("nearest_centroid", """
WITH e AS (SELECT vec_id, label, unnest(range(0, len(embedding))) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
c AS (SELECT label AS cid, list(avg_x ORDER BY pos) AS cv FROM (SELECT label, pos, avg(x) AS avg_x FROM e GROUP BY label, pos) GROUP BY label),
d AS (SELECT v.vec_id, c.cid, list_sum(list_transform(list_zip(v.embedding::DOUBLE[], c.cv), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist
      FROM embeddings v CROSS JOIN c)
SELECT vec_id, arg_min(cid, dist) AS centroid FROM d GROUP BY vec_id
""", ids=("ML4",))
def nearest_centroid(spark, sf):
    emb = t(spark, sf, "embeddings")
    cents = VO.pool_vectors(emb, "label", "embedding", how="mean").select(
        F.col("label").alias("cid"), F.col("vec_mean").alias("cv"))
    a = VO.nearest_centroid(emb, "embedding", cents, "cid", "cv")
    return a.select("vec_id", "centroid")


def _np_norm(s: pd.Series) -> pd.Series:
    """Norms of a whole batch at once: one flat array and the places where its vectors start."""
    sizes = s.map(len).to_numpy()
    flat = np.concatenate([*s.to_numpy(), np.zeros(1)]).astype(np.float64)
    sums = np.add.reduceat(flat * flat, np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int))
    return pd.Series(np.sqrt(np.where(sizes > 0, sums, 0.0)))


@register("vectorized_udf", """
SELECT vec_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm FROM embeddings
""", ids=("UD4",))
def vectorized_udf(spark, sf):
    emb = t(spark, sf, "embeddings")
    out = VO.with_vectorized(emb, _np_norm, "embedding", "norm_raw", "double")
    return out.select("vec_id", r6("norm_raw").alias("norm"))
