"""Projection, filter, recode, scalar-function, union and preview queries (PF, SF12-14, SO1, SL3, JN7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.functions import numeric as N
from loam.operators.ranking import limit_ordered
from loam.operators.transform import FeatureSpec
from loam.plans.common import SQL_DOC_PROB, doc_quality_prob, r6
from loam.plans.registry import register, t

# Numeric race codes and their labels (unmapped -> 'Unknown').
RACE_CODES = {1: "White", 2: "Black", 3: "American Indian", 4: "Chinese", 5: "Japanese", 6: "Hawaiian",
              7: "Filipino", 18: "Asian Indian", 28: "Korean", 39: "Samaon", 48: "Vietnamese"}
ORDER_STATUS = {"F": "Finished", "O": "Open", "P": "Partial"}


def _sql_case(col: str, mapping: dict, default: str | None) -> str:
    parts = " ".join(f"WHEN {col} = {k!r} THEN '{v}'" for k, v in mapping.items())
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {parts}{tail} END"


@register("filter_positive_range", """
SELECT count(*) AS n FROM lineitem
WHERE year(l_shipdate) >= 1995 AND year(l_shipdate) <= 1998 AND l_quantity > 0 AND l_discount > 0 AND l_tax > 0
""", ids=("PF1",))
def filter_positive_range(spark, sf):
    li = t(spark, sf, "lineitem")
    y = F.year("l_shipdate")
    f = li.filter(y.between(1995, 1998) & (F.col("l_quantity") > 0) & (F.col("l_discount") > 0)
                  & (F.col("l_tax") > 0))
    return f.agg(F.count(F.lit(1)).alias("n"))


@register("filter_in", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""", ids=("PF3",))
def filter_in(spark, sf):
    o = t(spark, sf, "orders")
    return o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


CUSTOMER_SPEC = FeatureSpec(key=("c_custkey",), numeric=("c_acctbal",), categorical=("c_mktsegment", "c_nationkey"))


@register("project_roles", """
SELECT c_custkey AS key, CAST(c_acctbal AS DOUBLE) AS acctbal, c_mktsegment AS segment,
       CAST(c_nationkey AS VARCHAR) AS nation FROM customer
""", ids=("PF4", "SO2"))
def project_roles(spark, sf):
    c = t(spark, sf, "customer")
    assert CUSTOMER_SPEC.unused(c.columns) == ["c_name"]
    return CUSTOMER_SPEC.project(c, rename={"c_custkey": "key", "c_acctbal": "acctbal",
                                            "c_mktsegment": "segment", "c_nationkey": "nation"})


@register("recode_with_unknown", f"""
SELECT l_orderkey, l_linenumber, {_sql_case('l_linenumber', RACE_CODES, 'Unknown')} AS race FROM lineitem
""", ids=("PF5",))
def recode_with_unknown(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", N.recode("l_linenumber", RACE_CODES, "Unknown").alias("race"))


@register("recode_strict", f"""
SELECT o_orderkey, {_sql_case('o_orderstatus', ORDER_STATUS, None)} AS status_label FROM orders
""", ids=("PF6",))
def recode_strict(spark, sf):
    o = t(spark, sf, "orders")
    return o.select("o_orderkey", N.recode("o_orderstatus", ORDER_STATUS, strict=True).alias("status_label"))


PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@register("stringify_lower", "SELECT " + ", ".join(f"lower(CAST({c} AS VARCHAR)) AS {c}" for c in PART_COLS)
          + " FROM part", ids=("PF7",))
def stringify_lower(spark, sf):
    p = t(spark, sf, "part")
    return p.select(*[F.lower(F.col(c).cast("string")).alias(c) for c in PART_COLS])


@register("indicator_feature", """
SELECT l_orderkey, l_linenumber, CAST(l_tax > l_discount AS INTEGER) AS tax_gt_disc,
       CAST(l_quantity > 1 AS VARCHAR) AS is_multiple FROM lineitem
""", ids=("PF8",))
def indicator_feature(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     N.indicator(F.col("l_tax") > F.col("l_discount")).alias("tax_gt_disc"),
                     N.indicator(F.col("l_quantity") > 1, as_string=True).alias("is_multiple"))


@register("class_weight_const", """
SELECT doc_id, CAST(CASE WHEN toxic = 1 THEN 6.6 ELSE 1.0 END AS DOUBLE) AS weight FROM labels
""", ids=("PF9",))
def class_weight_const(spark, sf):
    lab = t(spark, sf, "labels")
    return lab.select("doc_id", F.when(F.col("toxic") == 1, F.lit(6.6)).otherwise(F.lit(1.0)).alias("weight"))


@register("polynomial_features", """
SELECT l_orderkey, l_linenumber, round(l_quantity * l_quantity, 6) AS x_sq, round(l_discount * l_discount, 6) AS y_sq,
       round(l_quantity * l_discount, 6) AS xy, round(abs(l_quantity - l_discount), 6) AS abs_diff,
       round(sin(l_quantity), 6) + 0.0 AS sin_x, round(cos(l_discount), 6) AS cos_y FROM lineitem
""", ids=("SF12",))
def polynomial_features(spark, sf):
    li = t(spark, sf, "lineitem")
    p = N.polynomial("l_quantity", "l_discount")
    return li.select("l_orderkey", "l_linenumber", *[r6(c).alias(k) for k, c in p.items()])


@register("clip_value", """
SELECT l_orderkey, l_linenumber, greatest(5.0, least(45.0, l_quantity)) AS qty_clip,
       greatest(CAST(0.01 AS DOUBLE), least(CAST(0.09 AS DOUBLE), l_discount)) AS disc_clip FROM lineitem
""", ids=("SF13",))
def clip_value(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", N.clip("l_quantity", 5.0, 45.0).alias("qty_clip"),
                     N.clip("l_discount", 0.01, 0.09).alias("disc_clip"))


@register("log_feature", """
SELECT p_partkey, round(ln(p_retailprice), 6) AS price_log, round(ln(p_size + 0.01), 6) + 0.0 AS size_log FROM part
""", ids=("SF14",))
def log_feature(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", r6(N.log_feature("p_retailprice")).alias("price_log"),
                    r6(N.log_feature("p_size", 0.01)).alias("size_log"))


@register("union_all", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier
""", ids=("SO1",))
def union_all(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                                        F.lit("customer").alias("kind"))
    s = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
                                        F.lit("supplier").alias("kind"))
    return c.unionByName(s)


@register("preview", "SELECT r_regionkey, r_name FROM region ORDER BY r_regionkey LIMIT 3", ids=("SL3", "TV4"))
def preview(spark, sf):
    return t(spark, sf, "region").orderBy("r_regionkey").limit(3)


@register("align_predictions", f"""
SELECT l.doc_id, l.quality, CAST({SQL_DOC_PROB} >= 0.5 AS INTEGER) AS pred
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
""", ids=("JN7",))
def align_predictions(spark, sf):
    lab = t(spark, sf, "labels").select("doc_id", "quality")
    preds = t(spark, sf, "documents").select("doc_id", (doc_quality_prob(F.col("n_chars")) >= 0.5).cast("int")
                                             .alias("pred"))
    return lab.join(preds, "doc_id")
