"""Feature-transform and statistics queries (FT1-FT12, FT16, FT19, AG2-AG7, AG13, AG14, IO11, IO12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.functions.hashing import md5_int
from loam.functions.vector import one_hot
from loam.operators import analyze as A
from loam.operators import transform as TR
from loam.plans.common import SQL_LINEITEM_KEY, lineitem_key, r6, split2, sql_md5_int, sql_split2
from loam.plans.registry import register, t
from loam.session import scratch_path

LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _sql_hash(col_sql: str, n: int) -> str:
    return f"CAST({sql_md5_int(f'coalesce(CAST({col_sql} AS VARCHAR), {chr(39)}{chr(39)})')} % {n} AS INTEGER)"


def _sql_cross(cols: list[str], n: int) -> str:
    inner = " || '_X_' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"CAST({sql_md5_int(inner)} % {n} AS INTEGER)"


def _sql_bucket(x: str, arr: str, k: int) -> str:
    return "CAST(" + " + ".join(f"CAST({x} >= {arr}[{i}] AS INTEGER)" for i in range(1, k + 1)) + " AS INTEGER)"


# ----------------------------------------------------------------------------- flagship pipeline

def lineitem_pipeline() -> TR.FeaturePipeline:
    return TR.FeaturePipeline(steps=[
        TR.ZScore("l_quantity", "qty_z"),
        TR.MinMax("l_extendedprice", "price_01"),
        TR.QuantileBucketize("l_discount", "disc_bucket", 4),
        TR.Vocabulary("l_returnflag", "flag_id"),
        TR.Log("l_extendedprice", "price_log"),
        TR.HashBucket("l_suppkey", "supp_hash", 50),
        TR.Cross(("l_returnflag", "l_linestatus"), "flag_x_status", 20),
        TR.Identity("l_linenumber", "line_id", 5),
    ], keep=LI_KEYS)


def round_lineitem_features(df):
    return df.select(*LI_KEYS, r6("qty_z").alias("qty_z"), r6("price_01").alias("price_01"), "disc_bucket",
                     "flag_id", r6("price_log").alias("price_log"), "supp_hash", "flag_x_status", "line_id")


SQL_FIT_APPLY = f"""
WITH s AS (SELECT *, {sql_split2(SQL_LINEITEM_KEY)} AS split FROM lineitem),
tr AS (SELECT * FROM s WHERE split = 'train'),
st AS (SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, min(l_extendedprice) AS pmin,
              max(l_extendedprice) AS pmax, quantile_cont(l_discount, [0.25, 0.5, 0.75]) AS db FROM tr),
v AS (SELECT l_returnflag AS value, row_number() OVER (ORDER BY count(*) DESC, l_returnflag DESC) - 1 AS id
      FROM tr GROUP BY l_returnflag)
SELECT e.l_orderkey, e.l_linenumber,
  round((l_quantity - qm) / qs, 6) + 0.0 AS qty_z,
  round((l_extendedprice - pmin) / (pmax - pmin), 6) AS price_01,
  {_sql_bucket('l_discount', 'db', 3)} AS disc_bucket,
  CAST(coalesce(v.id, -1) AS INTEGER) AS flag_id,
  round(ln(l_extendedprice), 6) AS price_log,
  {_sql_hash('l_suppkey', 50)} AS supp_hash,
  {_sql_cross(['l_returnflag', 'l_linestatus'], 20)} AS flag_x_status,
  CASE WHEN l_linenumber BETWEEN 0 AND 4 THEN l_linenumber ELSE 0 END AS line_id
FROM s e CROSS JOIN st LEFT JOIN v ON e.l_returnflag = v.value WHERE e.split = 'eval'
"""


@register("fit_train_apply_eval", SQL_FIT_APPLY, ids=("FT16", "JN6", "UD5"))
def fit_train_apply_eval(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("split", split2(lineitem_key()))
    ft = lineitem_pipeline().fit(li.filter(F.col("split") == "train"))
    return round_lineitem_features(ft.transform(li.filter(F.col("split") == "eval")))


@register("artefact_roundtrip", SQL_FIT_APPLY, ids=("IO11",))
def artefact_roundtrip(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("split", split2(lineitem_key()))
    pipe = lineitem_pipeline()
    ft = pipe.fit(li.filter(F.col("split") == "train"))
    path = scratch_path(spark, "transform")
    ft.save(path)
    loaded = TR.FittedTransform.load(spark, path, pipe.steps)
    return round_lineitem_features(loaded.transform(li.filter(F.col("split") == "eval")))


@register("artefact_from_folder", SQL_FIT_APPLY, ids=("IO11",))
def artefact_from_folder(spark, sf):
    """As ``artefact_roundtrip``, but nothing but the folder says what the steps were."""
    li = t(spark, sf, "lineitem").withColumn("split", split2(lineitem_key()))
    path = scratch_path(spark, "transform")
    lineitem_pipeline().fit(li.filter(F.col("split") == "train")).save(path)
    loaded = TR.FittedTransform.load(spark, path)
    return round_lineitem_features(loaded.transform(li.filter(F.col("split") == "eval")))


@register("scale_z_score", f"""
WITH s AS (SELECT *, {sql_split2(SQL_LINEITEM_KEY)} AS split FROM lineitem),
st AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS sd FROM s WHERE split = 'train')
SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / sd, 6) + 0.0 AS price_z FROM s CROSS JOIN st
""", ids=("FT1",))
def scale_z_score(spark, sf):
    li = t(spark, sf, "lineitem")
    train = li.filter(split2(lineitem_key()) == "train")
    ft = TR.FeaturePipeline([TR.ZScore("l_extendedprice", "price_z")], keep=LI_KEYS).fit(train)
    return ft.transform(li).select(*LI_KEYS, r6("price_z").alias("price_z"))


@register("scale_standard_saved", """
WITH st AS (SELECT avg(l_quantity) AS qm, stddev_samp(l_quantity) AS qs,
                   avg(l_extendedprice) AS pm, stddev_samp(l_extendedprice) AS ps FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - qm) / qs, 6) + 0.0 AS qty_std,
       round((l_extendedprice - pm) / ps, 6) + 0.0 AS price_std FROM lineitem CROSS JOIN st
""", ids=("FT2",))
def scale_standard_saved(spark, sf):
    li = t(spark, sf, "lineitem")
    path = scratch_path(spark, "stats")
    A.column_stats(li, ["l_quantity", "l_extendedprice"]).write.mode("overwrite").parquet(path)
    stats = spark.read.parquet(path)
    # stats are joined by feature NAME (never by position); one row per feature, broadcast
    wide = stats.groupBy().pivot("feature", ["l_quantity", "l_extendedprice"]).agg(
        F.first(F.struct("mean", "stdv"))).withColumnsRenamed({"l_quantity": "st_q", "l_extendedprice": "st_p"})
    j = li.crossJoin(F.broadcast(wide))
    return j.select(*LI_KEYS,
                    r6((F.col("l_quantity") - F.col("st_q.mean")) / F.col("st_q.stdv")).alias("qty_std"),
                    r6((F.col("l_extendedprice") - F.col("st_p.mean")) / F.col("st_p.stdv")).alias("price_std"))


@register("scale_0_1", """
WITH st AS (SELECT min(p_retailprice) AS a, max(p_retailprice) AS b, min(p_size) AS c, max(p_size) AS d FROM part)
SELECT p_partkey, round((p_retailprice - a) / (b - a), 6) AS price_01, round((p_size - c) / (d - c), 6) AS size_01
FROM part CROSS JOIN st
""", ids=("FT3",))
def scale_0_1(spark, sf):
    p = t(spark, sf, "part")
    ft = TR.FeaturePipeline([TR.MinMax("p_retailprice", "price_01"), TR.MinMax("p_size", "size_01")],
                            keep=["p_partkey"]).fit(p)
    return ft.transform(p).select("p_partkey", r6("price_01").alias("price_01"), r6("size_01").alias("size_01"))


@register("bucketize_quantiles", f"""
WITH q AS (SELECT quantile_cont(l_extendedprice, [0.2, 0.4, 0.6, 0.8]) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, {_sql_bucket('l_extendedprice', 'b', 4)} AS price_bucket FROM lineitem CROSS JOIN q
""", ids=("FT4",))
def bucketize_quantiles(spark, sf):
    li = t(spark, sf, "lineitem")
    ft = TR.FeaturePipeline([TR.QuantileBucketize("l_extendedprice", "price_bucket", 5)], keep=LI_KEYS).fit(li)
    return ft.transform(li)


QTY_BOUNDS = (10.0, 20.0, 30.0, 40.0)
DISC_BOUNDS = (0.02, 0.04, 0.06, 0.08)


@register("bucketize_fixed", f"""
SELECT l_orderkey, l_linenumber,
  CAST({' + '.join(f'CAST(l_quantity >= {b} AS INTEGER)' for b in QTY_BOUNDS)} AS INTEGER) AS qty_bucket,
  CAST({' + '.join(f'CAST(l_discount >= CAST({b} AS DOUBLE) AS INTEGER)' for b in DISC_BOUNDS)} AS INTEGER) AS disc_bucket
FROM lineitem
""", ids=("FT5",))
def bucketize_fixed(spark, sf):
    li = t(spark, sf, "lineitem")
    ft = TR.FeaturePipeline([TR.FixedBucketize("l_quantity", "qty_bucket", QTY_BOUNDS),
                             TR.FixedBucketize("l_discount", "disc_bucket", DISC_BOUNDS)], keep=LI_KEYS).fit(li)
    return ft.transform(li)


SQL_ORDERS_SPLIT = sql_split2("CAST(o_orderkey AS VARCHAR)")


@register("integerize_vocab", f"""
WITH s AS (SELECT *, {SQL_ORDERS_SPLIT} AS split FROM orders),
v AS (SELECT o_orderpriority AS value, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority DESC) - 1 AS id
      FROM s WHERE split = 'train' GROUP BY o_orderpriority QUALIFY id < 3)
SELECT o_orderkey, CAST(coalesce(v.id, -1) AS INTEGER) AS priority_id FROM s LEFT JOIN v ON s.o_orderpriority = v.value
""", ids=("FT6",))
def integerize_vocab(spark, sf):
    o = t(spark, sf, "orders")
    train = o.filter(split2(F.col("o_orderkey").cast("string")) == "train")
    ft = TR.FeaturePipeline([TR.Vocabulary("o_orderpriority", "priority_id", top_k=3)], keep=["o_orderkey"]).fit(train)
    return ft.transform(o)


PRIORITY_LIST = ("1-URGENT", "2-HIGH", "3-MEDIUM")


@register("vocab_fixed_list", """
SELECT o_orderkey, CAST(coalesce(list_position(['1-URGENT', '2-HIGH', '3-MEDIUM'], o_orderpriority) - 1, -1) AS INTEGER) AS priority_idx
FROM orders
""", ids=("FT7",))
def vocab_fixed_list(spark, sf):
    o = t(spark, sf, "orders")
    ft = TR.FeaturePipeline([TR.FixedVocabulary("o_orderpriority", "priority_idx", PRIORITY_LIST)],
                            keep=["o_orderkey"]).fit(o)
    return ft.transform(o)


@register("hash_bucket", f"""
SELECT c_custkey, {_sql_hash('c_name', 50)} AS name_bucket, {_sql_hash('c_mktsegment', 100)} AS segment_bucket FROM customer
""", ids=("FT9",))
def hash_bucket(spark, sf):
    c = t(spark, sf, "customer")
    ft = TR.FeaturePipeline([TR.HashBucket("c_name", "name_bucket", 50),
                             TR.HashBucket("c_mktsegment", "segment_bucket", 100)], keep=["c_custkey"]).fit(c)
    return ft.transform(c)


@register("crossed_feature", f"""
WITH q AS (SELECT quantile_cont(c_acctbal, [0.25, 0.5, 0.75]) AS b FROM customer),
c AS (SELECT *, {_sql_bucket('c_acctbal', 'b', 3)} AS bal_bucket FROM customer CROSS JOIN q)
SELECT c_custkey, {_sql_cross(['c_nationkey', 'c_mktsegment'], 100)} AS nation_x_segment,
       {_sql_cross(['bal_bucket', 'c_mktsegment'], 100)} AS bal_x_segment FROM c
""", ids=("FT10",))
def crossed_feature(spark, sf):
    c = t(spark, sf, "customer")
    f1 = TR.FeaturePipeline([TR.QuantileBucketize("c_acctbal", "bal_bucket", 4)],
                            keep=["c_custkey", "c_nationkey", "c_mktsegment"]).fit(c)
    b = f1.transform(c)
    f2 = TR.FeaturePipeline([TR.Cross(("c_nationkey", "c_mktsegment"), "nation_x_segment", 100),
                             TR.Cross(("bal_bucket", "c_mktsegment"), "bal_x_segment", 100)],
                            keep=["c_custkey"]).fit(b)
    return f2.transform(b)


@register("identity_category", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber BETWEEN 0 AND 4 THEN l_linenumber ELSE 0 END AS line_id
FROM lineitem
""", ids=("FT11",))
def identity_category(spark, sf):
    li = t(spark, sf, "lineitem")
    ft = TR.FeaturePipeline([TR.Identity("l_linenumber", "line_id", 5)], keep=LI_KEYS).fit(li)
    return ft.transform(li)


@register("indicator_column", f"""
WITH s AS (SELECT *, {SQL_ORDERS_SPLIT} AS split FROM orders),
v AS (SELECT o_orderpriority AS value, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority DESC) - 1 AS id
      FROM s WHERE split = 'train' GROUP BY o_orderpriority QUALIFY id < 4),
x AS (SELECT o_orderkey, coalesce(v.id, -1) AS id FROM s LEFT JOIN v ON s.o_orderpriority = v.value)
SELECT o_orderkey, slot, CAST(slot = id AS INTEGER) AS v FROM (SELECT o_orderkey, id, unnest(range(0, 4)) AS slot FROM x)
""", ids=("FT12",))
def indicator_column(spark, sf):
    o = t(spark, sf, "orders")
    train = o.filter(split2(F.col("o_orderkey").cast("string")) == "train")
    ft = TR.FeaturePipeline([TR.Vocabulary("o_orderpriority", "pid", top_k=4)], keep=["o_orderkey"]).fit(train)
    x = ft.transform(o).select("o_orderkey", one_hot("pid", 4).alias("oh"))
    return x.select("o_orderkey", F.posexplode_outer("oh").alias("slot", "v")).filter(F.col("slot").isNotNull()).select(
        "o_orderkey", F.col("slot").cast("bigint").alias("slot"), "v")


@register("scale_all_numeric", f"""
WITH st AS (SELECT {', '.join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s, quantile_cont({c}, [0.25, 0.5, 0.75]) AS {c}_b" for c in LI_NUMERIC)} FROM lineitem)
SELECT l_orderkey, l_linenumber,
  {', '.join(f"round(({c} - {c}_m) / {c}_s, 6) + 0.0 AS {c}_z, {_sql_bucket(c, c + '_b', 3)} AS {c}_bucket" for c in LI_NUMERIC)}
FROM lineitem CROSS JOIN st
""", ids=("FT19",))
def scale_all_numeric(spark, sf):
    li = t(spark, sf, "lineitem")
    steps = []
    for c in LI_NUMERIC:
        steps += [TR.ZScore(c, f"{c}_z"), TR.QuantileBucketize(c, f"{c}_bucket", 4)]
    ft = TR.FeaturePipeline(steps, keep=LI_KEYS).fit(li)
    out = ft.transform(li)
    return out.select(*LI_KEYS, *[x for c in LI_NUMERIC for x in (r6(f"{c}_z").alias(f"{c}_z"), F.col(f"{c}_bucket"))])


# ----------------------------------------------------------------------------- statistics

def _sql_col_stats(cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stdv, "
        f"CAST(max({c}) AS DOUBLE) AS max, CAST(min({c}) AS DOUBLE) AS min FROM lineitem" for c in cols)


def _r_stats(df):
    return df.select("feature", r6("mean").alias("mean"), r6("stdv").alias("stdv"), "max", "min")


@register("column_stats", _sql_col_stats(LI_NUMERIC), ids=("AG4",))
def column_stats(spark, sf):
    return _r_stats(A.column_stats(t(spark, sf, "lineitem"), LI_NUMERIC))


@register("stats_roundtrip", _sql_col_stats(LI_NUMERIC), ids=("IO12",))
def stats_roundtrip(spark, sf):
    path = scratch_path(spark, "stats")
    A.column_stats(t(spark, sf, "lineitem"), LI_NUMERIC).write.mode("overwrite").parquet(path)
    return _r_stats(spark.read.parquet(path))


@register("analyze_moments", "SELECT " + ", ".join(
    f"min({c}) AS {c}_min, max({c}) AS {c}_max, round(avg({c}), 6) AS {c}_mean, round(var_pop({c}), 6) AS {c}_var"
    for c in LI_NUMERIC) + " FROM lineitem", ids=("AG6",))
def analyze_moments(spark, sf):
    m = A.moments(t(spark, sf, "lineitem"), LI_NUMERIC)
    return m.select(*[F.col(c) if c.endswith(("_min", "_max")) else r6(c).alias(c) for c in m.columns])


@register("analyze_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, " + ", ".join(f"round(quantile_cont({c}, {i / 5}), 6) AS b{i}" for i in range(1, 5))
    + " FROM lineitem" for c in LI_NUMERIC), ids=("AG7",))
def analyze_quantiles(spark, sf):
    li = t(spark, sf, "lineitem")
    probs = [i / 5 for i in range(1, 5)]
    q = A.exact_quantiles(A.to_long(li, LI_NUMERIC), "value", probs, keys=["feature"],
                          names=[f"b{i}" for i in range(1, 5)])
    return q.select("feature", *[r6(f"b{i}").alias(f"b{i}") for i in range(1, 5)])


@register("describe_numeric", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    f"round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM part"
    for c in ["p_size", "p_retailprice"]), ids=("AG5",))
def describe_numeric(spark, sf):
    d = A.describe(t(spark, sf, "part"), ["p_size", "p_retailprice"])
    return d.select("feature", "count", r6("mean").alias("mean"), r6("std").alias("std"), "min",
                    r6("p25").alias("p25"), r6("p50").alias("p50"), r6("p75").alias("p75"), "max")


@register("boxplot_stats", """
SELECT c_mktsegment, CAST(min(c_acctbal) AS DOUBLE) AS min, round(quantile_cont(c_acctbal, 0.25), 6) AS q1,
       round(quantile_cont(c_acctbal, 0.5), 6) AS median, round(quantile_cont(c_acctbal, 0.75), 6) AS q3,
       CAST(max(c_acctbal) AS DOUBLE) AS max
FROM customer GROUP BY c_mktsegment
""", ids=("AG14",))
def boxplot_stats(spark, sf):
    b = A.five_number_summary(t(spark, sf, "customer"), "c_acctbal", "c_mktsegment")
    return b.select("c_mktsegment", "min", r6("q1").alias("q1"), r6("median").alias("median"),
                    r6("q3").alias("q3"), "max")


@register("histogram_bins", """
WITH r AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part),
b AS (SELECT CAST(least(floor((p_retailprice - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, lo, hi FROM part CROSS JOIN r)
SELECT bin, round(lo + bin * ((hi - lo) / 10), 6) AS lo, round(lo + (bin + 1) * ((hi - lo) / 10), 6) AS hi, count(*) AS count
FROM b GROUP BY bin, lo, hi
""", ids=("AG13",))
def histogram_bins(spark, sf):
    h = A.histogram(t(spark, sf, "part"), "p_retailprice", 10)
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "count")


@register("value_counts", """
SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority ORDER BY count DESC, o_orderpriority
""", ids=("AG1",))
def value_counts(spark, sf):
    return A.value_counts(t(spark, sf, "orders"), "o_orderpriority")


@register("class_share", """
SELECT event_type, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent
FROM events GROUP BY event_type
""", ids=("AG2",))
def class_share(spark, sf):
    return A.class_share(t(spark, sf, "events"), "event_type")


@register("baseline_accuracy", """
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
SELECT round(max(n) / sum(n), 6) AS baseline_accuracy, arg_max(quality, n) AS majority_class FROM c
""", ids=("AG3",))
def baseline_accuracy(spark, sf):
    b = A.baseline_accuracy(t(spark, sf, "labels"), "quality")
    return b.select(r6("baseline_accuracy").alias("baseline_accuracy"), "majority_class")


_ = md5_int  # re-exported for users composing their own crossed features


def _revenue(df):
    """User hook (process_features): derive revenue before any analyzer runs."""
    return df.withColumn("revenue", F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")))


@register("process_features_hook", f"""
WITH s AS (SELECT *, l_extendedprice * (1.0 - l_discount) AS revenue, {sql_split2(SQL_LINEITEM_KEY)} AS split FROM lineitem),
st AS (SELECT min(revenue) AS lo, max(revenue) AS hi FROM s WHERE split = 'train')
SELECT l_orderkey, l_linenumber, (revenue - lo) / (hi - lo) AS revenue_01, revenue / l_quantity AS unit_revenue
FROM s CROSS JOIN st WHERE split = 'eval'
""", ids=("UD6", "FT16"))
def process_features_hook(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("split", split2(lineitem_key()))
    pipe = TR.FeaturePipeline([TR.MinMax("revenue", "revenue_01"),
                               TR.Expr("unit_revenue", lambda: F.col("revenue") / F.col("l_quantity"))],
                              keep=LI_KEYS, process_features=_revenue)
    ft = pipe.fit(li.filter(F.col("split") == "train"))
    out = ft.transform(li.filter(F.col("split") == "eval"))
    # no rounding: same IEEE operations in the same order on both sides (no summation order involved)
    return out.select(*LI_KEYS, "revenue_01", "unit_revenue")
