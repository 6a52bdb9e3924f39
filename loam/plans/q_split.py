"""Ranking, sampling and split queries (WN1-WN8, WN13, JN4, ML6 folds, SF19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.functions.text import first_line
from loam.operators import series as S
from loam.operators import split as SP
from loam.plans.common import r6, sql_md5_int
from loam.plans.registry import register, t

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
SQL_LINEITEM_FP = " || ".join(f"COALESCE(CAST({c} AS VARCHAR), 'NA')" for c in LINEITEM_COLS)


def sql_seeded(key_sql: str, seed: int, resolution: int) -> str:
    inner = f"'{seed}:' || CAST({key_sql} AS VARCHAR)"
    return f"({sql_md5_int(inner)} % {resolution})"


SQL_EVENTS_RN = """(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
                   count(*) OVER (PARTITION BY user_id) AS n FROM events)"""


@register("top1_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) = 1
""", ids=("WN1",))
def top1_per_group(spark, sf):
    o = t(spark, sf, "orders")
    # max over a (price, key) struct: partial aggregation, a hot customer is combined map-side
    g = o.groupBy("o_custkey").agg(F.max(F.struct("o_totalprice", "o_orderkey")).alias("_b"))
    return g.select("o_custkey", F.col("_b.o_orderkey").alias("o_orderkey"),
                    F.col("_b.o_totalprice").alias("o_totalprice"))


@register("hash_split_70_30", f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN {sql_md5_int(SQL_LINEITEM_FP)} % 100 < 70 THEN 'train' ELSE 'eval' END AS split
FROM lineitem
""", ids=("WN2", "SF2"))
def hash_split_70_30(spark, sf):
    li = t(spark, sf, "lineitem")
    return SP.hash_split(li, LINEITEM_COLS, 70).select("l_orderkey", "l_linenumber", "split")


@register("hash_split_76_24", f"""
SELECT doc_id, CASE WHEN abs({sql_md5_int("split_part(text, chr(10), 1)")}) % 100 <= 75 THEN 'train' ELSE 'eval' END AS split
FROM documents
""", ids=("WN3",))
def hash_split_76_24(spark, sf):
    d = t(spark, sf, "documents")
    return SP.threshold_split(d, first_line("text"), 75).select("doc_id", "split")


@register("stratified_split", f"""
WITH r AS (SELECT event_id, event_type,
                  row_number() OVER (PARTITION BY event_type ORDER BY {sql_seeded('event_id', 42, 1 << 60)}, event_id) AS rn,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_id, CASE WHEN rn <= floor(n * 6 / 10) THEN 'train' WHEN rn <= floor(n * 8 / 10) THEN 'valid'
                      ELSE 'test' END AS split FROM r
""", ids=("WN4",))
def stratified_split(spark, sf):
    e = t(spark, sf, "events").select("event_id", "event_type")
    s = SP.stratified_split(e, "event_type", "event_id", [("train", 0.6), ("valid", 0.2), ("test", 0.2)], seed=42)
    return s.select("event_id", "split")


@register("random_fraction", f"""
SELECT o_orderkey FROM orders WHERE {sql_seeded("o_orderkey", 42, 1 << 60)} < {round(0.3 * (1 << 60))}
""", ids=("WN5",))
def random_fraction(spark, sf):
    o = t(spark, sf, "orders")
    return SP.random_fraction(o, "o_orderkey", 0.3, seed=42).select("o_orderkey")


@register("split_complement_anti", f"""
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN
  (SELECT o_orderkey FROM orders WHERE {sql_seeded("o_orderkey", 42, 1 << 60)} < {round(0.3 * (1 << 60))})
""", ids=("JN4",))
def split_complement_anti(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    sample = SP.random_fraction(o, "o_orderkey", 0.3, seed=42)
    return SP.complement(o, sample, "o_orderkey")


@register("modulo_holdout", """
SELECT o_orderkey, CASE WHEN (row_number() OVER (ORDER BY o_orderkey) - 1) % 6 = 0 THEN 'test' ELSE 'train' END AS split
FROM orders
""", ids=("WN6",))
def modulo_holdout(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey")
    return SP.modulo_holdout(o, ["o_orderkey"], 6)


@register("time_split", f"""
SELECT event_id, CASE WHEN rn <= floor(n * 7 / 10) THEN 'train' ELSE 'test' END AS split FROM {SQL_EVENTS_RN} r
""", ids=("WN7",))
def time_split(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "ts")
    return S.time_split(e, ["user_id"], ["ts", "event_id"], train_fraction=0.7).select("event_id", "split")


@register("series_tail", f"""
SELECT user_id, event_id, value FROM {SQL_EVENTS_RN} r WHERE rn > n - 20
""", ids=("WN8",))
def series_tail(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return S.series_tail(e, ["user_id"], ["ts", "event_id"], 20).select("user_id", "event_id", "value")


@register("deterministic_shuffle", f"""
SELECT n_nationkey, row_number() OVER (ORDER BY {sql_seeded('n_nationkey', 7, 1 << 60)}, n_nationkey) - 1 AS pos
FROM nation
""", ids=("WN13",))
def deterministic_shuffle(spark, sf):
    n = t(spark, sf, "nation").select("n_nationkey")
    return SP.deterministic_shuffle(n, "n_nationkey", seed=7)


@register("kfold_assign", f"""
SELECT doc_id, CAST({sql_seeded('doc_id', 42, 1 << 60)} % 5 AS INTEGER) AS fold FROM labels
""", ids=("ML6",))
def kfold_assign(spark, sf):
    lab = t(spark, sf, "labels").select("doc_id")
    return SP.kfold_assign(lab, "doc_id", 5, seed=42)


@register("generate_series", f"""
SELECT user_id, event_id, rn AS t,
       round(sin(pi() * rn / 12.0) + rn / 50.0, 6) AS signal FROM {SQL_EVENTS_RN} r
""", ids=("SF19",))
def generate_series(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "ts")
    r = S.series_index(e, ["user_id"], ["ts", "event_id"], out="t")
    return r.select("user_id", "event_id", "t", r6(S.signal(F.col("t"), 12.0, 50.0)).alias("signal"))
