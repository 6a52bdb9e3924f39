"""A training corpus from ``documents``, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor; all but
the last return the columns of ``documents``.  Every stage calls one operator of
:mod:`loam.llm` with its production parameters:

1. ``quality_rules``: documents that the line-first rules reject go; the others lose their
   failing lines;
2. ``simhash_dedup``: of each component of near-duplicates the document with the smallest
   doc_id stays;
3. ``substring_dedup``: repeated 13-word passages go, wherever a document before has them;
4. ``pii_surrogates``: personal data are replaced by keyed surrogates;
5. ``mixture_packing``: the rest is packed into windows of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm.fm_index import keep_unrepeated_words
from loam.llm.line_quality import line_quality
from loam.llm.mixture_packing import pack
from loam.llm.pii_surrogates import replace_entities
from loam.llm.queries import SURROGATE_KEY, table, tokenizer_path
from loam.llm.shipping import ship_package
from loam.llm.simhash_pivot import fingerprints, simhash_members
from loam.session import materialize, scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Kept documents, their failing lines removed."""
    judged = line_quality(docs).filter("kept")
    return _documents(judged.withColumn("text", F.col("clean_text")))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component; of rows that repeat its doc_id in it, one.

    Rows of one doc_id may be in several components: each is judged by its own.
    """
    ship_package(spark)
    groups = simhash_members(docs.select("doc_id", "text"))
    mixed = materialize(groups.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("doc_id"))
    rest = [c for c in COLUMNS if c != "doc_id"]
    # a document that stays is its component's; rows without an id stay, as nothing tells which is first
    gone = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    again = groups.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    several = not mixed.isEmpty()
    if several:
        # their rows' components by their texts: text's hash -> fingerprint -> component
        rows = docs.join(mixed, "doc_id", "left_semi").withColumn("_text", F.xxhash64("text"))
        prints = fingerprints(rows.select(F.col("_text").alias("doc_id"), "text")).distinct().withColumnRenamed("doc_id", "_text")
        own = groups.join(mixed, "doc_id", "left_semi").select("fingerprint", "component_id", "root").distinct()
        first = rows.join(prints, "_text").join(own, "fingerprint").filter("doc_id = component_id").groupBy("doc_id", "root").agg(
            F.min(F.struct(*rest)).alias("row")).select("doc_id", "row.*")
        docs = docs.join(mixed, "doc_id", "left_anti")
    left = docs.join(gone, "doc_id", "left_anti")
    once = left.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min(F.struct(*rest)).alias("row")).select("doc_id", "row.*")
    out = left.join(again, "doc_id", "left_anti").select(*COLUMNS).union(once.select(*COLUMNS))
    return _documents(out.union(first.select(*COLUMNS)) if several else out)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of repeated passages; texts that lose none stay as they are."""
    ship_package(spark)
    return _documents(keep_unrepeated_words(docs))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their entities replaced."""
    ship_package(spark)
    return _documents(replace_entities(docs.select(*COLUMNS), SURROGATE_KEY))


def mixture_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    ship_package(spark)
    return pack(docs, tokenizer_path("word_bpe_49k.json"), with_ids=False).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("pii_surrogates", pii_surrogates),
    ("mixture_packing", mixture_packing),
]

# Tokenizer ids and surrogates cannot be stated in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
