"""Quality rules, line first: clean each line, then judge what is left of the document.

Every rule is a DataFrame expression over the arrays of a document's lines and
words; there is no Python on the path and no shuffle, since a document is judged
by itself.

Lines fail by three rules:

* *navigation*: at least ``nav_separators`` stand-alone separators, and at most
  ``nav_words`` words for each of them;
* *punctuation*: for more than ``symbol_words`` of its words there is a run of symbols
  or of exclamation or question marks;
* *boilerplate*: it matches one of the licence, rights or consent notices and is
  short.

Failing lines are removed; a document is rejected if it loses more than
``max_lost`` of its word characters, or if it fails the base rules on the whole
text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE_CLASS = r"[\x20\x09-\x0D]+"

# Notices that are not prose, in lower case.
NOTICES = (
    "all rights reserved", "licensed under", "released under the", "copyright (c)", "copyright ©",
    "terms of use", "terms of service", "privacy policy", "accept cookies", "accept all cookies",
    "enable javascript", "subscribe to our newsletter", "skip to content", "skip to main content",
)
SYMBOL_RUN = r"[#*$%&<>]{2,}|[!?]{2,}"


@dataclass(frozen=True)
class LineRules:
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    nav_separators: int = 3
    nav_words: int = 4
    symbol_words: float = 0.3
    notice_words: int = 30
    max_lost: float = 0.3


def words_of(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def repeated_window_words(words: Column, width: int) -> Column:
    """How many words lie in windows of ``width`` words that occur twice or more in the array.

    A text whose window hashes are all distinct has none.  In others the hashes
    are sorted with their places, so equal windows are neighbours; the places of
    repeated ones, sorted again, add up to the words covered.
    """
    n = F.size(words)
    def windows(g: Column) -> Column:
        return F.transform(F.slice(g, 1, n - (width - 1)),
                           lambda x, i: F.xxhash64(x, *(F.get(g, i + k) for k in range(1, width))))

    hashes = F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), windows)[0]

    def places(o: Column) -> Column:
        at = F.transform(o, lambda x, k: F.when(
            F.get(o, k - 1)["h"].eqNullSafe(x["h"]) | F.get(o, k + 1)["h"].eqNullSafe(x["h"]), x["i"]))
        return F.sort_array(F.filter(at, lambda p: p.isNotNull()))

    def covered(p: Column) -> Column:
        return F.aggregate(
            p, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-width).alias("last")),
            lambda acc, x: F.struct((acc["sum"] + F.least(F.lit(width), x - acc["last"])).alias("sum"), x.alias("last")),
            lambda acc: acc["sum"])

    def repeats(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        # one-element arrays bind a value, so that it is not computed anew for each element
        heavy = F.transform(F.array(ordered), lambda o: F.transform(F.array(places(o)), covered)[0])[0]
        return F.when(F.size(F.array_distinct(h)) < F.size(h), heavy).otherwise(F.lit(0).cast("long"))

    return F.when(n >= width, F.transform(F.array(hashes), repeats)[0]).otherwise(F.lit(0).cast("long"))


def has_notice(lower: Column) -> Column:
    return reduce(or_, (lower.contains(x) for x in NOTICES))


def line_fails(line: Column, any_notice: Column, rules: LineRules) -> Column:
    """Whether a line fails a rule; ``any_notice``: whether the whole text has a notice, so its lines are looked at."""
    # a conjunction stops at its first false part: most lines have no separator, symbol run or notice
    n = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
    separators = F.regexp_count(line, F.lit(r"(?<![^\x20\x09-\x0D])[|»›•·](?![^\x20\x09-\x0D])"))
    some = reduce(or_, (line.contains(x) for x in "|»›•·"))
    nav = some & (separators >= rules.nav_separators) & (n - separators <= rules.nav_words * (separators + 1))
    runs = F.regexp_count(line, F.lit(SYMBOL_RUN))
    noisy = line.rlike(SYMBOL_RUN) & (runs > F.lit(rules.symbol_words) * n)
    notice = any_notice & (n <= rules.notice_words) & F.transform(F.array(F.lower(line)), has_notice)[0]
    return nav | noisy | notice


def line_quality(docs: DataFrame, text: str = "text", rules: LineRules | None = None) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``clean_text``, ``lost_share`` and ``kept`` added.

    Null or empty texts have no words and fail the base rules.  Rows are judged
    one by one, so repeated rows get equal verdicts, an empty table gives an
    empty one, and other columns pass through; columns that bear an added name
    are replaced.
    """
    rules = rules or LineRules()
    body = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumn("_lq_words", words_of(body)).withColumn(
        "_lq_lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    step = step.withColumn("n_words", F.size("_lq_words").cast("long"))
    step = step.withColumn("word_chars", F.length(F.array_join("_lq_words", "")).cast("long"))
    step = step.withColumn("n_symbols", F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long"))
    step = step.withColumn("n_dup_lines", (F.size("_lq_lines") - F.size(F.array_distinct("_lq_lines"))).cast("long"))
    step = step.withColumn("n_repeat_words", repeated_window_words(F.col("_lq_words"), rules.window))
    step = step.withColumn("base_failed", (F.col("n_words") < rules.min_words)
                           | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    noticed = F.transform(F.array(F.lower(body)), has_notice)       # bound once a document, outside the lines' lambda
    step = step.withColumn("_lq_marked", F.transform(noticed, lambda any_notice: F.transform(
        F.split(body, "\n"), lambda x: F.struct(x.alias("line"), line_fails(x, any_notice, rules).alias("bad"))))[0])
    step = step.withColumn("clean_text", F.array_join(
        F.filter("_lq_marked", lambda x: ~x["bad"])["line"], "\n"))
    lost = F.array_join(F.filter("_lq_marked", lambda x: x["bad"])["line"], "\n")
    step = step.withColumn("lost_share", F.when(
        F.col("word_chars") > 0, F.length(F.regexp_replace(lost, SPACE_CLASS, "")) / F.col("word_chars"))
        .otherwise(F.lit(0.0)))
    step = step.withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= rules.max_lost))
    return step.drop("_lq_words", "_lq_lines", "_lq_marked")
