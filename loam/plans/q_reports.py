"""Small reports over whole tables: previews, cross-validated metrics, sketch errors, generators, multi-hot, titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.functions import vector as V
from loam.functions.arrays import let
from loam.functions.hashing import md5_int
from loam.functions.text import first_line
from loam.operators import evaluate as ev
from loam.operators import series as S
from loam.operators import split as SP
from loam.operators import vector as VO
from loam.plans.common import SQL_LINEITEM_KEY, lineitem_key, r6, sql_md5_int, sql_split2, split2
from loam.plans.q_eval import _SQL_DOC_PREDS, _doc_preds
from loam.plans.q_split import SQL_EVENTS_RN, sql_seeded
from loam.plans.registry import register, t


@register("embeddings_preview", """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS width, round(CAST(embedding[1] AS DOUBLE), 6) AS first
FROM embeddings ORDER BY vec_id LIMIT 10
""", ids=("TV4", "SL3"))
def embeddings_preview(spark, sf):
    e = t(spark, sf, "embeddings").orderBy("vec_id").limit(10)       # the preview's size is the feature
    return e.select("vec_id", "label", F.size("embedding").alias("width"),
                    r6(F.col("embedding")[0].cast("double")).alias("first"))


@register("argmax_slot", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS slot FROM embeddings
""", ids=("SF17",))
def argmax_slot(spark, sf):
    return t(spark, sf, "embeddings").select("vec_id", V.argmax("embedding").alias("slot"))


@register("macro_precision_recall_cv", f"""
WITH s AS (SELECT *, CAST({sql_seeded('doc_id', 42, 1 << 60)} % 5 AS INTEGER) AS fold FROM {_SQL_DOC_PREDS} x),
c AS (SELECT fold, unnest([quality, pred]) AS cls, unnest([1, 0]) AS t, unnest([CAST(quality = pred AS INTEGER), 0]) AS tp,
             unnest([0, 1]) AS p FROM s),
j AS (SELECT fold, cls, sum(t) AS support, sum(tp) AS tp, sum(p) AS predicted FROM c GROUP BY fold, cls),
f AS (SELECT fold, avg(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END) AS mp,
             avg(CASE WHEN support > 0 THEN tp / support ELSE 0.0 END) AS mr FROM j GROUP BY fold)
SELECT round(avg(mp), 6) AS macro_precision, round(avg(mr), 6) AS macro_recall, count(*) AS folds FROM f
""", ids=("ML7",))
def macro_precision_recall_cv(spark, sf):
    s = SP.kfold_assign(_doc_preds(spark, sf), "doc_id", 5, seed=42)
    m = ev.macro_precision_recall(s, "quality", "pred", by="fold")
    return m.agg(r6(F.avg("macro_precision")).alias("macro_precision"), r6(F.avg("macro_recall")).alias("macro_recall"),
                 F.count(F.lit(1)).alias("folds"))


SKETCH_EPSILON = 0.01


@register("quantile_sketch_error", """
SELECT k AS boundary, TRUE AS within_epsilon FROM (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS k)
""", ids=("AG8", "FT4"))
def quantile_sketch_error(spark, sf):
    """Boundaries of 8 buckets by the sketch: each one's rank is within epsilon of the exact share."""
    li = t(spark, sf, "lineitem").select(F.col("l_extendedprice").cast("double").alias("x"))
    shares = [k / 8 for k in range(1, 8)]
    cuts = li.agg(F.percentile_approx("x", shares, int(1 / SKETCH_EPSILON)).alias("cuts"), F.count("x").alias("n"))
    # one row of seven cuts against every row, then one aggregation
    rank = li.crossJoin(F.broadcast(cuts)).agg(
        *[F.sum((F.col("x") < F.col("cuts")[k]).cast("long")).alias(f"b{k}") for k in range(7)],
        *[F.sum((F.col("x") <= F.col("cuts")[k]).cast("long")).alias(f"a{k}") for k in range(7)], F.first("n").alias("n"))
    n = F.col("n").cast("double")
    checks = [F.struct(F.lit(k + 1).alias("boundary"),
                       ((F.col(f"b{k}") <= (shares[k] + SKETCH_EPSILON) * n)
                        & (F.col(f"a{k}") >= (shares[k] - SKETCH_EPSILON) * n)).alias("within_epsilon")) for k in range(7)]
    return rank.select(F.inline(F.array(*checks)))


@register("generate_trends", f"""
SELECT user_id, event_id, CAST(rn AS BIGINT) AS t, CAST(-rn AS DOUBLE) AS falling,
       CAST(CASE WHEN rn % 2 = 0 THEN 2 * rn ELSE -2 * rn END AS DOUBLE) AS alternating FROM {SQL_EVENTS_RN} r
""", ids=("SF19",))
def generate_trends(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "ts")
    r = S.series_index(e, ["user_id"], ["ts", "event_id"], out="t")
    return r.select("user_id", "event_id", "t", S.falling(F.col("t")).alias("falling"),
                    S.alternating(F.col("t")).alias("alternating"))


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@register("multi_hot_priorities", f"""
SELECT o_custkey, pos, CAST(max(CAST(o_orderpriority = p AS INTEGER)) AS INTEGER) AS v
FROM orders CROSS JOIN (SELECT unnest([{', '.join(f"'{p}'" for p in PRIORITIES)}]) AS p, unnest(range(0, 5)) AS pos)
GROUP BY o_custkey, pos
""", ids=("FT12",))
def multi_hot_priorities(spark, sf):
    o = t(spark, sf, "orders")
    hot = o.groupBy("o_custkey").agg(*[F.max((F.col("o_orderpriority") == p).cast("int")).alias(f"_{k}")
                                       for k, p in enumerate(PRIORITIES)])
    return hot.select("o_custkey", F.posexplode(F.array(*[F.col(f"_{k}") for k in range(5)])).alias("pos", "v")).select(
        "o_custkey", F.col("pos").cast("bigint").alias("pos"), "v")


@register("reshuffle_train_test", f"""
WITH s AS (SELECT l_orderkey, l_linenumber, {sql_split2(SQL_LINEITEM_KEY)} AS old_split, {SQL_LINEITEM_KEY} AS k FROM lineitem)
SELECT l_orderkey, l_linenumber, old_split,
       CASE WHEN {sql_seeded('k', 7, 1 << 60)} < {round(0.8 * (1 << 60))} THEN 'train' ELSE 'test' END AS split FROM s
""", ids=("WN6", "SO1"))
def reshuffle_train_test(spark, sf):
    """Train and test put together again and dealt anew by another seed."""
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", lineitem_key().alias("k"),
                                         split2(lineitem_key()).alias("old_split"))
    both = li.filter("old_split = 'train'").unionByName(li.filter("old_split <> 'train'"))
    first = SP.random_fraction(both, "k", 0.8, seed=7).withColumn("split", F.lit("train"))
    return first.unionByName(SP.random_rest(both, "k", 0.8, seed=7).withColumn("split", F.lit("test"))).drop("k")


TITLE_DIMS = 64


@register("title_similarity", f"""
WITH w AS (SELECT doc_id, unnest(string_split(split_part(text, chr(10), 1), ' ')) AS w FROM documents),
s AS (SELECT doc_id, {sql_md5_int('w')} % {TITLE_DIMS} AS slot, CAST(count(*) AS DOUBLE) AS c FROM w WHERE w <> '' GROUP BY 1, 2),
n AS (SELECT doc_id, sqrt(sum(c * c)) AS n FROM s GROUP BY doc_id),
p AS (SELECT min(doc_id) AS doc_id FROM n),
d AS (SELECT s.doc_id, sum(s.c * q.c) AS dot FROM s JOIN s q ON q.slot = s.slot JOIN p ON q.doc_id = p.doc_id GROUP BY s.doc_id)
SELECT p.doc_id AS k1, n.doc_id AS k2, round(coalesce(dot, 0) / (n.n * m.n), 6) AS similarity
FROM n CROSS JOIN p JOIN n m ON m.doc_id = p.doc_id LEFT JOIN d ON d.doc_id = n.doc_id
""", ids=("TV1", "TV2"))
def title_similarity(spark, sf):
    """Titles (first lines) as hashed word counts, by cosine to the first document's."""
    def words(line):
        return F.filter(F.split(line, " "), lambda w: w != "")

    def counts(slots):
        return F.transform(F.sequence(F.lit(0), F.lit(TITLE_DIMS - 1)), lambda i: F.size(F.filter(slots, lambda x: x == i)).cast("double"))

    # a title with a word; its words are hashed once, not once a slot
    d = t(spark, sf, "documents").select("doc_id", first_line("text").alias("title")).filter(F.length(F.translate("title", " ", "")) > 0)
    slots = F.transform(words(F.col("title")), lambda w: F.pmod(md5_int(w), F.lit(TITLE_DIMS)).cast("int"))
    vec = let(slots, counts).alias("title_vec")
    probe = VO.single_row(d, ["doc_id"]).select("doc_id", vec)
    out = VO.similar_by_vector(d.select("doc_id", vec), "doc_id", "title_vec", probe)
    return out.select("k1", "k2", r6("similarity").alias("similarity"))
