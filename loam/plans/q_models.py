"""Model queries (ML1-ML9, FT13, ST1): Spark ML fits — checked on row counts (no SQL oracle)."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from loam.functions.hashing import hash_bucket
from loam.operators import models as M
from loam.operators.transform import FeaturePipeline, FixedVocabulary, ZScore
from loam.plans.common import SQL_LINEITEM_KEY, lineitem_key, r6, split2, sql_md5_int, sql_split2
from loam.plans.q_features import SQL_FIT_APPLY, lineitem_pipeline, round_lineitem_features
from loam.plans.registry import register, t
from loam.session import scratch_path


def _doc_features(spark, sf):
    lab = t(spark, sf, "labels")
    docs = t(spark, sf, "documents")
    j = lab.join(docs, "doc_id")
    f = j.select("doc_id", "text", F.col("quality").cast("double").alias("label"),
                 F.col("toxic").cast("double").alias("toxic"),
                 F.ln(F.col("n_chars").cast("double")).alias("log_chars"),
                 (F.col("lang") == "en").cast("double").alias("is_en"),
                 F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
                 split2(F.col("doc_id").cast("string")).alias("split"))
    return M.assemble(f, ["log_chars", "is_en", "n_lines"])


@register("logreg_predict", None, ids=("ML1",))
def logreg_predict(spark, sf):
    f = _doc_features(spark, sf)
    train, test = f.filter(F.col("split") == "train"), f.filter(F.col("split") == "eval")
    _, pred = M.logistic_fit_predict(train, test, params={"maxIter": 10, "regParam": 0.01},
                                     overrides={"maxIter": 20, "regParam": 0.1, "probabilityCol": "myProbability"})
    return pred.select("doc_id", "label", "prediction", vector_to_array("myProbability")[1].alias("p1"))


def sql_least_squares(y: str, xs: tuple[str, str, str], rows: str) -> str:
    """One row b0, b1, b2, b3: least squares of ``y`` on three columns of ``rows``, by Cramer's rule on covariances."""
    x1, x2, x3 = xs
    cov = {(i, j): f"c{i}{j}" for i in range(1, 4) for j in range(1, 4)}
    names = {1: x1, 2: x2, 3: x3}
    cols = ", ".join(f"covar_pop({names[i]}, {names[j]}) AS {c}" for (i, j), c in cov.items())
    cols += ", " + ", ".join(f"covar_pop({y}, {names[i]}) AS y{i}, avg({names[i]}) AS m{i}" for i in names)

    def det(m):
        (a, b, c), (d, e, f), (g, h, i) = m
        return f"({a}*({e}*{i}-{f}*{h})-{b}*({d}*{i}-{f}*{g})+{c}*({d}*{h}-{e}*{g}))"

    full = [[cov[i, j] for j in range(1, 4)] for i in range(1, 4)]
    betas = []
    for k in range(3):
        m = [[f"y{i + 1}" if j == k else full[i][j] for j in range(3)] for i in range(3)]
        betas.append(f"{det(m)} / {det(full)} AS b{k + 1}")
    return (f"(SELECT my - b1*m1 - b2*m2 - b3*m3 AS b0, b1, b2, b3 FROM (SELECT *, {', '.join(betas)} "
            f"FROM (SELECT {cols}, avg({y}) AS my FROM {rows})))")


@register("linear_regression", f"""
WITH s AS (SELECT *, {sql_split2(SQL_LINEITEM_KEY)} AS split FROM lineitem), tr AS (SELECT * FROM s WHERE split = 'train'),
b AS {sql_least_squares('l_extendedprice', ('l_quantity', 'l_discount', 'l_tax'), 'tr')}
SELECT l_orderkey, l_linenumber, l_extendedprice,
       round(b0 + b1 * l_quantity + b2 * l_discount + b3 * l_tax, 2) AS prediction
FROM s CROSS JOIN b WHERE split = 'eval'
""", ids=("ML2",))
def linear_regression(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("split", split2(lineitem_key()))
    data = M.assemble(li, ["l_quantity", "l_discount", "l_tax"])
    _, pred = M.linear_fit_predict(data.filter(F.col("split") == "train"), data.filter(F.col("split") == "eval"),
                                   "l_extendedprice", regParam=0.0, solver="normal")
    return pred.select("l_orderkey", "l_linenumber", "l_extendedprice", F.round("prediction", 2).alias("prediction"))


@register("weighted_classifier", None, ids=("ML3", "FT17"))
def weighted_classifier(spark, sf):
    emb = t(spark, sf, "embeddings")
    d = emb.select("vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
                   F.col("label").cast("double").alias("label"),
                   F.when(F.col("label") == 0, F.lit(3.0)).otherwise(F.lit(1.0)).alias("w"))
    _, p1 = M.logistic_fit_predict(d, d, params={"maxIter": 30, "family": "multinomial"}, weight="w")
    _, p2 = M.mlp_fit_predict(d, d, layers=[64, 16, 10])
    return p1.select("vec_id", F.col("prediction").alias("pred_logreg")).join(
        p2.select("vec_id", F.col("prediction").alias("pred_mlp")), "vec_id")


@register("kmeans_assign", None, ids=("ML4",))
def kmeans_assign(spark, sf):
    emb = t(spark, sf, "embeddings")
    d = emb.select("vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    _, assigned, _ = M.kmeans(d, k=10, init="k-means||", seed=42)
    return assigned.select("vec_id", F.col("prediction").alias("cluster"))


@register("kmeans_random_init", None, ids=("ML4",))
def kmeans_random_init(spark, sf):
    emb = t(spark, sf, "embeddings")
    d = emb.select("vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    model, assigned, cents = M.kmeans(d, k=10, init="random", seed=7)
    return assigned.select("vec_id", F.col("prediction").alias("cluster"))


@register("gbt_regression", None, ids=("ML2",))
def gbt_regression(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("split", split2(lineitem_key()))
    data = M.assemble(li, ["l_quantity", "l_discount", "l_tax"])
    _, pred = M.gbt_fit_predict(data.filter(F.col("split") == "train"), data.filter(F.col("split") == "eval"),
                                "l_extendedprice", max_iter=10, max_depth=4)
    return pred.select("l_orderkey", "l_linenumber", "l_extendedprice", "prediction")


@register("pca_project", None, ids=("ML5",))
def pca_project(spark, sf):
    emb = t(spark, sf, "embeddings")
    d = emb.select("vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    model, out = M.pca(d, 3)
    ev = [float(x) for x in model.explainedVariance]
    a = vector_to_array("pca")
    return out.select("vec_id", a[0].alias("pc1"), a[1].alias("pc2"), a[2].alias("pc3"),
                      F.lit(sum(ev)).alias("explained_variance"))


@register("grid_search_cv", None, ids=("ML6",))
def grid_search_cv(spark, sf):
    f = _doc_features(spark, sf)
    _, rows = M.text_grid_search(f, "text", "label", reg_params=[0.01, 0.1], num_features=[256, 1024], folds=5)
    # one row per grid point: bounded by the grid size
    return spark.createDataFrame(rows, "regParam double, numFeatures int, auc double, best boolean")


# A parameter sweep file: group__name columns; a blank keeps the default.
SWEEP_CSV = ["optimizer__regParam,optimizer__maxIter,model__elasticNetParam",
             "0.01,10,", "0.1,,0.5", ",50,1.0"]
SWEEP_DEFAULTS = {"regParam": 0.0, "maxIter": 100, "elasticNetParam": 0.0}


@register("param_sweep", None, ids=("ML8",))
def param_sweep(spark, sf):
    path = scratch_path(spark, "sweep")
    spark.createDataFrame([(line,) for line in SWEEP_CSV], "value string").coalesce(1).write.text(path)
    settings = (spark.read.option("header", True)
                .schema("optimizer__regParam double, optimizer__maxIter int, model__elasticNetParam double").csv(path))
    f = _doc_features(spark, sf)
    train, test = f.filter(F.col("split") == "train"), f.filter(F.col("split") == "eval")
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(labelCol="label")
    out = []
    # a sweep is a handful of settings: the driver loops over them, each fit is distributed
    for i, row in enumerate(settings.collect()):
        params = dict(SWEEP_DEFAULTS)
        for col, v in row.asDict().items():
            if v is not None:
                params[col.split("__", 1)[1]] = v
        _, pred = M.logistic_fit_predict(train, test, params=params)
        out.append((i, float(params["regParam"]), int(params["maxIter"]), float(params["elasticNetParam"]),
                    float(ev.evaluate(pred))))
    return spark.createDataFrame(out, "setting int, regParam double, maxIter int, elasticNetParam double, auc double")


def _sql_ar_forecast(horizon: int) -> str:
    return f"""
WITH RECURSIVE d AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER w AS t, count(*) OVER (PARTITION BY user_id) AS m,
             lag(n, 1) OVER w AS x1, lag(n, 2) OVER w AS x2, lag(n, 3) OVER w AS x3
      FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day)),
tr AS (SELECT * FROM r WHERE x3 IS NOT NULL),
b AS {sql_least_squares('n', ('x1', 'x2', 'x3'), 'tr')},
f AS (SELECT user_id, 0 AS h, n AS y1, x1 AS y2, x2 AS y3 FROM r WHERE t = m AND m >= 3
      UNION ALL SELECT user_id, h + 1, b0 + b1 * y1 + b2 * y2 + b3 * y3, y1, y2 FROM f CROSS JOIN b WHERE h < {horizon})
SELECT user_id, h, round(y1, 5) AS forecast FROM f WHERE h > 0
"""


def _daily_forecast(spark, sf, horizon: int):
    e = t(spark, sf, "events")
    daily = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    f = M.ar_forecast(daily, ["user_id"], ["day"], "n", p=3, horizon=horizon)
    return f.select("user_id", "h", F.round("forecast", 5).alias("forecast"))


@register("ar_forecast_long", _sql_ar_forecast(300), ids=("ML9",))
def ar_forecast_long(spark, sf):
    return _daily_forecast(spark, sf, 300)


@register("ar_forecast", _sql_ar_forecast(7), ids=("ML9",))
def ar_forecast(spark, sf):
    return _daily_forecast(spark, sf, 7)


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@register("assemble_wide_deep", f"""
WITH x AS (SELECT c_custkey, c_acctbal, c_nationkey, {sql_md5_int("coalesce(c_name, '')")} % 50 AS hash,
                  coalesce(nullif(list_position([{', '.join(f"'{s}'" for s in SEGMENTS)}], c_mktsegment), 0) - 1, 5) AS seg
           FROM customer),
s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd, max(hash) + 1 AS width FROM x),
v AS (SELECT c_custkey, 'wide' AS part, hash AS slot, 1.0::DOUBLE AS value FROM x
      UNION ALL SELECT c_custkey, 'wide', width + seg, 1.0 FROM x CROSS JOIN s
      UNION ALL SELECT c_custkey, 'deep', 0, round((c_acctbal - m) / sd, 6) + 0.0 FROM x CROSS JOIN s
      UNION ALL SELECT c_custkey, 'deep', 1 + c_nationkey, 1.0 FROM x)
SELECT c_custkey, part, CAST(slot AS BIGINT) AS slot, value FROM v WHERE value <> 0
""", ids=("FT13",))
def assemble_wide_deep(spark, sf):
    c = t(spark, sf, "customer")
    ft = FeaturePipeline([ZScore("c_acctbal", "acctbal_z"),
                          FixedVocabulary("c_mktsegment", "segment_idx",
                                          SEGMENTS)],
                         keep=["c_custkey", "c_name", "c_nationkey"]).fit(c)
    x = ft.transform(c).withColumn("name_hash", hash_bucket("c_name", 50))
    x = x.withColumn("segment_idx", F.when(F.col("segment_idx") >= 0, F.col("segment_idx")).otherwise(5))
    enc = OneHotEncoder(inputCols=["name_hash", "segment_idx", "c_nationkey"],
                        outputCols=["name_oh", "segment_oh", "nation_oh"], dropLast=False).fit(x)
    y = enc.transform(x)
    y = M.assemble(y, ["name_oh", "segment_oh"], "wide")
    y = M.assemble(y, ["acctbal_z", "nation_oh"], "deep")
    parts = y.select("c_custkey", F.inline(F.array(
        F.struct(F.lit("wide").alias("part"), vector_to_array("wide").alias("a")),
        F.struct(F.lit("deep").alias("part"), vector_to_array("deep").alias("a")))))
    return parts.select("c_custkey", "part", F.posexplode("a").alias("slot", "value")).select(
        "c_custkey", "part", F.col("slot").cast("bigint").alias("slot"), r6("value").alias("value")).filter("value <> 0")


@register("transform_stream", SQL_FIT_APPLY, ids=("ST1",))
def transform_stream(spark, sf):
    from loam.streaming.transform_stream import transform_stream as ts
    li = t(spark, sf, "lineitem").withColumn("split", split2(lineitem_key()))
    pipe = lineitem_pipeline()
    ft = pipe.fit(li.filter(F.col("split") == "train"))
    src = scratch_path(spark, "stream-src")
    li.filter(F.col("split") == "eval").drop("split").repartition(4).write.parquet(src)
    sink, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = ts(spark, src, t(spark, sf, "lineitem").schema, ft, sink, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    return round_lineitem_features(spark.read.parquet(sink).drop("batch"))
