"""Scoring and evaluation queries (AG11, AG12, SF15/ML10, EV1-EV8, ML7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.functions.vector import as_double
from loam.operators import evaluate as ev
from loam.operators.ranking import group_row_number, join_side_table, prefix_sums
from loam.operators.scoring import score_and_tag, year_range_label
from loam.plans.common import (LINEITEM_MODELS, SQL_DOC_PROB, SQL_LINEITEM_KEY, doc_quality_prob,
                               lineitem_key, r6, split2, split3, sql_predict, sql_split2,
                               sql_split3, sql_year_label)
from loam.plans.registry import register, t
from loam.session import scratch_path

M0 = LINEITEM_MODELS[0]


def _scored(spark, sf):
    li = t(spark, sf, "lineitem")
    return score_and_tag(li, LINEITEM_MODELS, "l_extendedprice",
                         keep=["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"],
                         testdata=year_range_label("l_shipdate", [(1995, 1996), (1997, 1998), (1999, 2001)]))


def _sql_scored() -> str:
    sel = []
    for m in LINEITEM_MODELS:
        sel.append(f"""SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
            {sql_year_label('l_shipdate')} AS testdata, '{m.name}' AS model,
            CAST(l_extendedprice AS DOUBLE) AS weight_true, {sql_predict(m)} AS weight_predicted,
            CAST({float(m.latency_ms)!r} AS DOUBLE) AS time_inference FROM lineitem""")
    return "(SELECT *, weight_true - weight_predicted AS weight_residual FROM (" + " UNION ALL ".join(sel) + "))"


@register("rmse_by_model", f"""
SELECT model, testdata, round(sqrt(sum(weight_residual * weight_residual) / count(*)), 6) AS rmse,
       round(avg(time_inference), 6) AS mean_latency_ms, count(*) AS n
FROM {_sql_scored()} s GROUP BY model, testdata
""", ids=("AG11",))
def rmse_by_model(spark, sf):
    s = _scored(spark, sf)
    return (s.groupBy("model", "testdata")
            .agg(r6(ev.rmse(F.col("weight_residual"))).alias("rmse"),
                 r6(F.avg("time_inference")).alias("mean_latency_ms"),
                 F.count(F.lit(1)).alias("n")))


@register("score_and_tag", f"""
SELECT l_orderkey, l_linenumber, model, testdata, weight_true, round(weight_predicted, 6) AS weight_predicted,
       round(weight_residual, 6) AS weight_residual, time_inference
FROM {_sql_scored()} s
""", ids=("SF15", "ML10"))
def score_and_tag_q(spark, sf):
    s = _scored(spark, sf)
    return s.select("l_orderkey", "l_linenumber", "model", "testdata", "weight_true",
                    r6("weight_predicted").alias("weight_predicted"),
                    r6("weight_residual").alias("weight_residual"), "time_inference")


@register("rmse_mae", f"""
SELECT model, round(sqrt(sum(weight_residual * weight_residual) / count(*)), 6) AS rmse,
       round(avg(abs(weight_residual)), 6) AS mae, count(*) AS n
FROM {_sql_scored()} s GROUP BY model
""", ids=("EV1",))
def rmse_mae(spark, sf):
    s = _scored(spark, sf)
    m = ev.regression_metrics(s, "weight_true", "weight_predicted", by=["model"])
    return m.select("model", r6("rmse").alias("rmse"), r6("mae").alias("mae"), "n")


@register("sliced_metrics", f"""
WITH s AS (SELECT * FROM {_sql_scored()} x WHERE model = '{M0.name}'),
t AS (
  SELECT 'Overall' AS slice_col, '' AS slice_value, weight_residual FROM s
  UNION ALL SELECT 'l_returnflag', CAST(l_returnflag AS VARCHAR), weight_residual FROM s
  UNION ALL SELECT 'l_linestatus', CAST(l_linestatus AS VARCHAR), weight_residual FROM s
  UNION ALL SELECT 'testdata', CAST(testdata AS VARCHAR), weight_residual FROM s)
SELECT slice_col, slice_value, round(sqrt(sum(weight_residual * weight_residual) / count(*)), 6) AS rmse,
       round(avg(abs(weight_residual)), 6) AS mae, count(*) AS n
FROM t GROUP BY slice_col, slice_value
""", ids=("EV5", "UD7"))
def sliced_metrics(spark, sf):
    s = _scored(spark, sf).filter(F.col("model") == M0.name)
    r = F.col("weight_residual")
    return ev.sliced_metrics(s, ["l_returnflag", "l_linestatus", "testdata"], {
        "rmse": F.round(ev.rmse(r), 6), "mae": F.round(F.avg(F.abs(r)), 6),
        "n": F.count(F.lit(1))})


@register("metrics_by_split", f"""
WITH s AS (SELECT {sql_split3(SQL_LINEITEM_KEY)} AS split, CAST(l_extendedprice AS DOUBLE) AS y,
                  {sql_predict(M0)} AS p FROM lineitem)
SELECT split, round(sqrt(sum((y - p) * (y - p)) / count(*)), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
       count(*) AS n
FROM s GROUP BY split
""", ids=("EV7",))
def metrics_by_split(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("split", split3(lineitem_key()))
    m = ev.metrics_by_split_column(li, "split", "l_extendedprice", M0.predict())
    return m.select("split", r6("rmse").alias("rmse"), r6("mae").alias("mae"), "n")


@register("mean_predictor_rmse", f"""
WITH s AS (SELECT {sql_split2(SQL_LINEITEM_KEY)} AS split, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem),
m AS (SELECT avg(y) AS mu FROM s WHERE split = 'train')
SELECT split, round(sqrt(sum((y - mu) * (y - mu)) / count(*)), 6) AS rmse, count(*) AS n
FROM s CROSS JOIN m GROUP BY split
""", ids=("AG12",))
def mean_predictor_rmse(spark, sf):
    li = t(spark, sf, "lineitem").select(split2(lineitem_key()).alias("split"),
                                         F.col("l_extendedprice").cast("double").alias("y"))
    mu = li.filter(F.col("split") == "train").agg(F.avg("y").alias("mu"))
    j = li.crossJoin(F.broadcast(mu))  # one-row side: proven bound
    r = F.col("y") - F.col("mu")
    return j.groupBy("split").agg(r6(ev.rmse(r)).alias("rmse"), F.count(F.lit(1)).alias("n"))


def _doc_preds(spark, sf):
    lab = t(spark, sf, "labels")
    docs = t(spark, sf, "documents").select("doc_id", "n_chars")
    j = lab.join(docs, "doc_id")
    p = doc_quality_prob(F.col("n_chars"))
    return j.select("doc_id", "quality", "toxic", p.alias("p"), (p >= 0.5).cast("int").alias("pred"))


_SQL_DOC_PREDS = f"""(SELECT l.doc_id, l.quality, l.toxic, {SQL_DOC_PROB} AS p,
    CAST({SQL_DOC_PROB} >= 0.5 AS INTEGER) AS pred FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


@register("accuracy_mean_class", f"""
WITH per AS (SELECT quality, count(*) AS n, sum(CAST(quality = pred AS BIGINT)) AS ok FROM {_SQL_DOC_PREDS} s GROUP BY quality)
SELECT round(sum(ok) / sum(n), 6) AS accuracy, round(avg(ok / n), 6) AS mean_per_class_accuracy,
       CAST(sum(n) AS BIGINT) AS n FROM per
""", ids=("EV2",))
def accuracy_mean_class(spark, sf):
    m = ev.accuracy_metrics(_doc_preds(spark, sf), "quality", "pred")
    return m.select(r6("accuracy").alias("accuracy"),
                    r6("mean_per_class_accuracy").alias("mean_per_class_accuracy"),
                    F.col("n").cast("long").alias("n"))


@register("macro_precision_recall", f"""
WITH s AS {_SQL_DOC_PREDS},
tp AS (SELECT quality AS cls, count(*) AS support, sum(CAST(quality = pred AS BIGINT)) AS tp FROM s GROUP BY quality),
pp AS (SELECT pred AS cls, count(*) AS predicted FROM s GROUP BY pred),
j AS (SELECT coalesce(tp.support, 0) AS support, coalesce(tp.tp, 0) AS tp, coalesce(pp.predicted, 0) AS predicted
      FROM tp FULL OUTER JOIN pp ON tp.cls = pp.cls)
SELECT round(avg(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END), 6) AS macro_precision,
       round(avg(CASE WHEN support > 0 THEN tp / support ELSE 0.0 END), 6) AS macro_recall,
       count(*) AS n_classes FROM j
""", ids=("ML7",))
def macro_precision_recall(spark, sf):
    m = ev.macro_precision_recall(_doc_preds(spark, sf), "quality", "pred")
    return m.select(r6("macro_precision").alias("macro_precision"),
                    r6("macro_recall").alias("macro_recall"), "n_classes")


@register("auroc_exact", f"""
WITH s AS {_SQL_DOC_PREDS},
f AS (SELECT quality AS lab, p AS score FROM s UNION ALL SELECT 1 - quality, 1.0 - p FROM s),
g AS (SELECT score, sum(lab) AS pos, count(*) AS cnt FROM f GROUP BY score),
c AS (SELECT *, coalesce(sum(cnt) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT round((sum(pos * (below + (cnt + 1) / 2.0)) - sum(pos) * (sum(pos) + 1) / 2.0)
             / (sum(pos) * (sum(cnt) - sum(pos))), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(cnt) - sum(pos) AS BIGINT) AS n_neg FROM c
""", ids=("EV3",))
def auroc_exact(spark, sf):
    s = _doc_preds(spark, sf)
    # one-hot labels flattened with the class probabilities: (y, p) and (1-y, 1-p)
    flat = s.select(F.inline(F.array(
        F.struct(F.col("quality").alias("lab"), F.col("p").alias("score")),
        F.struct((F.lit(1) - F.col("quality")).alias("lab"), (F.lit(1.0) - F.col("p")).alias("score")))))
    a = ev.auroc_exact(flat, "lab", "score")
    return a.select(r6("auc").alias("auc"), F.col("n_pos").cast("long"), F.col("n_neg").cast("long"))


@register("log_loss_weighted", f"""
WITH s AS {_SQL_DOC_PREDS},
w AS (SELECT quality, greatest(least(p, 1 - 1e-15), 1e-15) AS pc,
             CASE WHEN toxic = 1 THEN 6.6 ELSE 1.0 END::DOUBLE AS w FROM s)
SELECT round(sum(w * (-(quality * ln(pc) + (1 - quality) * ln(1 - pc)))) / sum(w), 6) AS log_loss,
       round(sum(w), 6) AS weight_sum FROM w
""", ids=("EV4", "PF9", "FT17"))
def log_loss_weighted(spark, sf):
    s = _doc_preds(spark, sf)
    w = F.when(F.col("toxic") == 1, F.lit(6.6)).otherwise(F.lit(1.0))
    m = ev.log_loss(s, "quality", "p", weight=w)
    return m.select(r6("log_loss").alias("log_loss"), r6("weight_sum").alias("weight_sum"))


@register("metrics_by_horizon", """
WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
                  count(*) OVER (PARTITION BY user_id) AS n FROM events),
tr AS (SELECT user_id, avg(value) AS mu FROM r WHERE rn <= floor(n * 7 / 10) GROUP BY user_id),
te AS (SELECT r.user_id, rn - CAST(floor(n * 7 / 10) AS BIGINT) AS h, (value - mu) * (value - mu) AS se
       FROM r JOIN tr ON r.user_id = tr.user_id WHERE rn > floor(n * 7 / 10)),
g AS (SELECT h, sum(se) AS sse, count(*) AS cnt FROM te GROUP BY h)
SELECT h, round(sqrt(sum(sse) OVER (ORDER BY h) / sum(cnt) OVER (ORDER BY h)), 6) AS rmse,
       CAST(sum(cnt) OVER (ORDER BY h) AS BIGINT) AS n FROM g
""", ids=("EV6",))
def metrics_by_horizon(spark, sf):
    ev_ = t(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    r = group_row_number(ev_, ["user_id"], ["ts", "event_id"], out="rn", size_col="n")
    ntr = F.floor(F.col("n") * 7 / 10)
    tr = r.filter(F.col("rn") <= ntr).groupBy("user_id").agg(F.avg("value").alias("mu"))
    te = r.filter(F.col("rn") > ntr).withColumn("h", (F.col("rn") - ntr).cast("long"))
    te = join_side_table(te, tr, ["user_id"])
    g = te.groupBy("h").agg(F.sum((F.col("value") - F.col("mu")) ** 2).alias("sse"),
                            F.count(F.lit(1)).alias("cnt"))
    c = prefix_sums(g, [F.col("h")], ["sse", "cnt"], inclusive=True)
    return c.select("h", r6(F.sqrt(F.col("sse_cum") / F.col("cnt_cum"))).alias("rmse"),
                    F.col("cnt_cum").cast("long").alias("n"))


@register("reconstruction_rmse", """
WITH e AS (SELECT vec_id, label, unnest(range(0, len(embedding))) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
c AS (SELECT label, pos, avg(x) AS cx FROM e GROUP BY label, pos)
SELECT e.vec_id, round(sqrt(avg((x - cx) * (x - cx))), 6) AS rmse
FROM e JOIN c ON e.label = c.label AND e.pos = c.pos GROUP BY e.vec_id
""", ids=("EV8",))
def reconstruction_rmse(spark, sf):
    emb = t(spark, sf, "embeddings")
    from loam.operators.vector import pool_vectors
    cent = pool_vectors(emb, "label", "embedding", how="mean").withColumnRenamed("vec_mean", "recon")
    j = join_side_table(emb, cent, ["label"])
    return j.select("vec_id", r6(ev.reconstruction_error(as_double("embedding"), "recon")).alias("rmse"))


# ----------------------------------------------------------------------------- foreign-model batch scoring

def _write_linear_artefact(spark, m) -> str:
    """Persist a (non-Spark) linear model as a JSON artefact through Spark's filesystem layer."""
    import json
    path = scratch_path(spark, "foreign-model")
    spark.createDataFrame([(json.dumps({"intercept": m.intercept, "coef": dict(m.coefficients)}),)],
                          "model string").coalesce(1).write.text(path)
    return path


def _numpy_loader(model_json: str):
    """Build a batch predictor from the artefact text (runs once per Python worker)."""
    import json

    import numpy as np
    spec = json.loads(model_json)
    names, w = list(spec["coef"]), np.array(list(spec["coef"].values()), dtype="float64")

    def predict(pdf):
        x = pdf[names].to_numpy(dtype="float64")
        out = np.full(len(pdf), float(spec["intercept"]))
        for j in range(len(names)):          # same accumulation order as the SQL expression
            out = out + w[j] * x[:, j]
        return out
    return predict


@register("batch_score_foreign", f"""
SELECT l_orderkey, l_linenumber, '{LINEITEM_MODELS[1].name}' AS model,
       round({sql_predict(LINEITEM_MODELS[1])}, 6) AS weight_predicted FROM lineitem
""", ids=("ML10", "UD1"))
def batch_score_foreign(spark, sf):
    from loam.operators.scoring import score_with_loader
    m = LINEITEM_MODELS[1]
    path = _write_linear_artefact(spark, m)
    model_json = spark.read.text(path).first()[0]      # one small artefact, shipped with the closure
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *m.coefficients)
    schema = ("l_orderkey bigint, l_linenumber int, l_quantity double, l_discount double, model string, "
              "weight_predicted double, time_inference double")
    out = score_with_loader(li, lambda: _numpy_loader(model_json), f"linear:{path}", list(m.coefficients),
                            schema, m.name)
    return out.select("l_orderkey", "l_linenumber", "model", r6("weight_predicted").alias("weight_predicted"))


@register("pipeline_model_score", None, ids=("ML10", "ML2"))
def pipeline_model_score(spark, sf):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    li = t(spark, sf, "lineitem").withColumn("split", split2(lineitem_key()))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features"),
                            LinearRegression(labelCol="l_extendedprice", featuresCol="features")])
    path = scratch_path(spark, "pipeline-model")
    pipe.fit(li.filter(F.col("split") == "train")).write().overwrite().save(path)
    scored = PipelineModel.load(path).transform(li.filter(F.col("split") == "eval"))
    return scored.select("l_orderkey", "l_linenumber", F.lit(path).alias("model"),
                         F.col("l_extendedprice").alias("weight_true"), F.col("prediction").alias("weight_predicted"))
