"""Filter interaction audit: what every filter removes at every place of every order.

A document's failures are a bit mask, and all that an audit needs of the corpus
is how many documents have each mask: the *mask cells* of a part, at most 2**k
for k filters.  A recursive CTE starts from the empty prefix of every part and
extends prefixes by each unused letter; a level joins the part's cells, carries
the applied bits, and its row holds that step's metrics.  A prefix is worked out
once for all orders that begin with it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.session import materialize

LETTERS = "ABCDE"
MAX_LETTERS = 8         # 8! orders of 8 steps are 322,560 rows, the most that is broadcast

MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITALS_PERCENT = 5


def text_failures(text: Column) -> Column:
    """Bits 1 to 8: too few words (A), too few distinct words (B), too many capitals (C), a symbol (D)."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    bit = lambda condition, value: F.when(condition, value).otherwise(0)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return (bit(n < MIN_WORDS, 1)
            + bit(100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n, 2)
            + bit(100 * capitals.cast("long") > MAX_CAPITALS_PERCENT * F.length(text).cast("long"), 4)
            + bit(text.rlike(r"[#$%&*|]"), 8)).cast("int")


def failure_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) for every row of ``docs`` (doc_id, source, text; other columns are ignored).

    Bit 16 (E) is a text that a smaller doc_id has too, anywhere in the table; texts are compared by their
    SHA-256.  Null texts are empty, a null source is the part ''.  A row without a doc_id follows no other,
    so it never fails E, nor do rows that share the smallest doc_id of their text.  Copies are counted by
    partial aggregation and met by doc_id, so a text that a third of the rows have is no hot key.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("part"),
                       text_failures(text).alias("low"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = materialize(rows)            # a hundred bytes a document, read twice
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("leads", F.lit(True))
    joined = rows.join(first, ["doc_id", "digest"], "left")
    late = F.col("leads").isNull() & F.col("doc_id").isNotNull()
    return joined.select("doc_id", "part", (F.col("low") + F.when(late, 16).otherwise(0)).alias("mask"))


def mask_cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cells): the part's masks with their documents, good and toxic ones.

    ``labels`` has doc_id, quality and toxic; a doc_id with several labels is good or toxic if one of them says so.
    """
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("long"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("long"), F.lit(0))).alias("toxic"))
    counted = masks.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    return counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))


# One row per part and prefix; the cells of a part are one row of at most 2**k structs.
_STEPS = """
WITH RECURSIVE steps(part, prefix, letter, applied, step, kept, removed, redundant, good_lost, toxic_lost) AS (
  SELECT part, '', '', 0, 0, aggregate(cells, 0L, (a, c) -> a + c.n), 0L, 0L, 0L, 0L FROM {cells}
  UNION ALL
  SELECT part, concat(prefix, l.letter), l.letter, applied | l.bit, step + 1,
         kept - aggregate(cells, 0L, (a, c) -> a + if((c.mask & l.bit) <> 0 AND (c.mask & applied) = 0, c.n, 0L)),
         aggregate(cells, 0L, (a, c) -> a + if((c.mask & l.bit) <> 0 AND (c.mask & applied) = 0, c.n, 0L)),
         aggregate(cells, 0L, (a, c) -> a + if((c.mask & l.bit) <> 0 AND (c.mask & applied) <> 0, c.n, 0L)),
         aggregate(cells, 0L, (a, c) -> a + if((c.mask & l.bit) <> 0 AND (c.mask & applied) = 0, c.good, 0L)),
         aggregate(cells, 0L, (a, c) -> a + if((c.mask & l.bit) <> 0 AND (c.mask & applied) = 0, c.toxic, 0L))
  FROM (SELECT s.*, m.cells, explode(filter({letters}, l -> (l.bit & s.applied) = 0)) AS l
        FROM steps s JOIN {cells} m ON s.part = m.part))
SELECT * FROM steps WHERE step > 0 LIMIT ALL"""

_ORDERS = """
WITH RECURSIVE spelt(prefix, applied, step) AS (
  SELECT '', 0, 0
  UNION ALL
  SELECT concat(prefix, l.letter), applied | l.bit, step + 1
  FROM (SELECT s.*, explode(filter({letters}, l -> (l.bit & s.applied) = 0)) AS l FROM spelt s))
SELECT prefix AS filter_order, explode(sequence(1, {n})) AS step FROM spelt WHERE step = {n} LIMIT ALL"""


def audit_orders(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, filter_order and step with the step's metrics.

    ``cells`` comes from :func:`mask_cells` (or has its columns); bit 2**i of a mask is ``letters[i]``.
    Columns: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.  No parts give no rows.
    """
    if not 1 <= len(letters) <= MAX_LETTERS or len(set(letters)) != len(letters):
        raise ValueError(f"1 to {MAX_LETTERS} different letters, not {letters!r}")
    spark = cells.sparkSession
    cells = materialize(cells)
    listed = "array(" + ", ".join(f"named_struct('letter', '{c}', 'bit', {1 << i})" for i, c in enumerate(letters)) + ")"
    steps = materialize(spark.sql(_STEPS.replace("{letters}", listed), cells=cells))
    orders = spark.sql(_ORDERS.replace("{letters}", listed).replace("{n}", str(len(letters)))).withColumn(
        "prefix", F.expr("left(filter_order, step)")).drop("step")
    # a prefix begins (k - its length)! orders
    begins = F.element_at(F.array(*[F.lit(math.factorial(len(letters) - i)) for i in range(1, len(letters) + 1)]), F.col("step"))
    shapley = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * begins).alias("shapley"))
    alone = cells.select("part", F.explode(F.expr(
        f"transform({listed}, l -> named_struct('letter', l.letter, 'unique_fails', "
        "aggregate(cells, 0L, (a, c) -> a + if(c.mask = l.bit, c.n, 0L))))")).alias("u")).select("part", "u.*")
    totals = shapley.join(alone, ["part", "letter"])
    out = steps.join(totals, ["part", "letter"]).join(F.broadcast(orders), "prefix")
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                      "good_lost", "toxic_lost", "shapley")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five text filters A to E over ``docs``; see :func:`failure_masks` for awkward rows."""
    return audit_orders(mask_cells(failure_masks(docs), labels))
