"""Source/sink queries (IO1-IO6, IO8-IO10, IO13): write to a fresh scratch folder, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.functions.arrays import explode_rows
from loam.operators.transform import FeatureSpec
from loam.plans.registry import register, t
from loam.session import scratch_path
from loam.sources import readers as R
from loam.sources import sinks as K

ORDERS_DDL = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING"


@register("io_csv_defaults", """
SELECT o_orderkey, o_custkey, coalesce(nullif(o_orderstatus, 'P'), 'NA') AS o_orderstatus,
       CASE WHEN o_orderpriority = '5-LOW' THEN 0.0 ELSE o_totalprice END::DOUBLE AS o_totalprice, o_orderpriority
FROM orders
""", ids=("IO1",))
def io_csv_defaults(spark, sf):
    o = t(spark, sf, "orders")
    blanks = o.select("o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
                      F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
                      "o_orderpriority")
    path = scratch_path(spark, "csv")
    K.write_delimited(blanks, path, sep=";")
    return R.read_delimited(spark, f"{path}/*.csv", ORDERS_DDL, sep=";",
                            defaults={"o_orderstatus": "NA", "o_totalprice": 0.0})


@register("io_skip_empty", """
SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE length(line) > 0 GROUP BY line
""", ids=("IO2",))
def io_skip_empty(spark, sf):
    d = t(spark, sf, "documents")
    path = scratch_path(spark, "lines")
    explode_rows(d, [], F.split("text", "\n"), "line").write.mode("overwrite").text(path)
    lines = R.read_text_lines(spark, path, drop_empty=True)
    return lines.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@register("parse_csv_column", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""", ids=("IO3",))
def parse_csv_column(spark, sf):
    c = t(spark, sf, "customer")
    rows = c.select(F.concat_ws(",", *[F.col(x).cast("string") for x in
                                       ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]]).alias("csv"))
    ddl = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    return rows.select(R.parse_csv_column("csv", ddl).alias("r")).select("r.*")


@register("parse_json_column", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""", ids=("IO4",))
def parse_json_column(spark, sf):
    e = t(spark, sf, "events")
    return e.select("event_id", R.parse_json_column("props", "k INT").alias("p")).select("event_id", "p.k")


@register("sql_named_params", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE year(l_shipdate) BETWEEN 1996 AND 1998 AND l_quantity > 0 AND l_extendedprice > 0 AND l_discount > 0
""", ids=("IO5",))
def sql_named_params(spark, sf):
    li = t(spark, sf, "lineitem")
    q = """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM {li}
           WHERE year(l_shipdate) BETWEEN :year_from AND :year_to
             AND l_quantity > 0 AND l_extendedprice > 0 AND l_discount > 0"""
    return R.sql_source(spark, q, {"year_from": 1996, "year_to": 1998}, li=li)


@register("io_whole_files", """
SELECT source AS label, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars FROM documents GROUP BY source
""", ids=("IO6", "IO7"))
def io_whole_files(spark, sf):
    d = t(spark, sf, "documents")
    path = scratch_path(spark, "files")
    d.select("source", "text").write.mode("overwrite").partitionBy("source").text(path)
    files = R.read_whole_files(spark, f"{path}/*/*.txt")
    lab = F.regexp_replace(R.label_from_path("path"), "^source=", "")
    return files.groupBy(lab.alias("label")).agg(F.sum(F.length("content")).cast("bigint").alias("n_chars"))


@register("sink_tsv", "SELECT n_nationkey, n_name, n_regionkey FROM nation", ids=("IO8", "IO13"))
def sink_tsv(spark, sf):
    n = t(spark, sf, "nation")
    path, dbg = scratch_path(spark, "tsv"), scratch_path(spark, "debug")
    K.write_delimited(n, path, sep="\t", num_shards=2, debug_path=dbg)
    return R.read_delimited(spark, path, "n_nationkey INT, n_name STRING, n_regionkey INT", sep="\t")


LI_SPEC = FeatureSpec(key=("l_orderkey", "l_linenumber"), numeric=("l_quantity", "l_extendedprice", "l_discount"),
                      categorical=("l_returnflag", "l_linestatus"), target="l_tax")


@register("sink_feature_shards", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
       CAST(l_discount AS DOUBLE) AS l_discount, l_returnflag, l_linestatus, l_tax FROM lineitem
""", ids=("IO9", "PF4", "SO2"))
def sink_feature_shards(spark, sf):
    li = t(spark, sf, "lineitem")
    path = scratch_path(spark, "shards")
    K.write_feature_shards(li, LI_SPEC, path, num_shards=4)
    return spark.read.parquet(path)


@register("sink_append_overwrite", """
SELECT * FROM customer UNION ALL SELECT * FROM customer
""", ids=("IO10",))
def sink_append_overwrite(spark, sf):
    c = t(spark, sf, "customer")
    path = scratch_path(spark, "table")
    K.write_table(c, path, mode="append")     # create
    K.write_table(c, path, mode="overwrite")  # truncate + write: still one copy
    K.write_table(c, path, mode="append")     # two copies
    return spark.read.parquet(path)
