"""Text operators: token counts, vocabulary lookup, tf-idf, n-grams, hashed doc vectors.

Scale notes:
* tokens are counted within the document's row; a token that is hot across the
  corpus is combined map-side before any shuffle;
* vocabularies are ordered/numbered with the distributed global row number;
* a vocabulary side table is broadcast only when its size is proven (``top_k``)
  or checked by ``count()``; otherwise it is a shuffle join.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.arrays import count_distinct_values, let, sum_by_value
from loam.functions.hashing import md5_int
from loam.operators.ranking import global_row_number, join_side_table, limit_ordered
from loam.session import cached, materialize


def explode_tokens(df: DataFrame, keep: list[str | Column], tokens: Column, out: str = "token") -> DataFrame:
    """One row per token.  ``explode_outer`` + null filter: plain ``explode`` makes the
    optimizer add a ``size(tokens) > 0`` filter that evaluates the tokenizer twice."""
    from loam.functions.arrays import explode_rows
    return explode_rows(df, keep, tokens, out)


def split_repeated(docs: DataFrame, doc_id: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose ``doc_id`` no other row has, and the rest (None if there is none); null counts as an id.

    Reads the ids only.  Documents that are one row each need no shuffle to be counted.
    """
    repeated = materialize(docs.groupBy(F.col(doc_id).alias("_lm_id")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_lm_id"))
    if repeated.isEmpty():
        return docs, None
    same = docs[doc_id].eqNullSafe(repeated["_lm_id"])
    return docs.join(repeated, same, "left_anti"), docs.join(repeated, same, "left_semi")


def token_counts(docs: DataFrame, doc_id: str, tokens: Column, with_length: bool = False) -> DataFrame:
    """(doc_id, [_len,] token, cnt): per-document term counts.

    Counted within the row, so only rows that repeat an id are shuffled, to be added up.
    ``with_length`` carries the document's token count (rows of one id and other lengths stay apart).
    """
    keys = [doc_id, "_len"] if with_length else [doc_id]

    def counted(part: DataFrame) -> DataFrame:
        tk = part.select(F.col(doc_id), tokens.alias("_tk"))
        keep = [F.col(doc_id)] + ([F.size("_tk").alias("_len")] if with_length else [])
        return explode_tokens(tk, keep, count_distinct_values(F.col("_tk")), "_t").select(*keys, "_t.token", "_t.cnt")

    once, again = split_repeated(docs, doc_id)
    if again is None:
        return counted(once)
    return counted(once).unionByName(counted(again).groupBy(*keys, "token").agg(F.sum("cnt").alias("cnt")))


def batch_token_counts(docs: DataFrame, tokens: Column) -> DataFrame:
    """(token, df, cnt) of every batch of ``docs``, whose rows are one document each; a token comes once a batch.

    A task holds one batch's tokens at a time.  A partial aggregation in its place holds all different tokens of
    the task's input, which for n-grams are nearly as many as there are words, and spills.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            words = lists.flatten().dictionary_encode(null_encoding="encode")
            at, n = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(words.dictionary)
            pairs = np.sort(at * batch.num_rows + pc.list_parent_indices(lists).to_numpy(zero_copy_only=False))
            pairs = pairs[np.diff(pairs, prepend=-1) > 0] // max(batch.num_rows, 1)         # each (token, row) once
            yield pa.RecordBatch.from_arrays([words.dictionary, pa.array(np.bincount(pairs, minlength=n), pa.int64()),
                                              pa.array(np.bincount(at, minlength=n), pa.int64())], names=["token", "df", "cnt"])

    return docs.select(tokens.alias("_tk")).mapInArrow(run, "token string, df long, cnt long")


# A vocabulary of at most so many rows (its top_k) is sent to all tasks.
BROADCAST_ROWS = 200_000


def _join_vocab(left: DataFrame, vocab: DataFrame, top_k: int | None) -> DataFrame:
    v = vocab.select("token", "id")
    small = top_k is not None and top_k <= BROADCAST_ROWS
    return left.join(F.broadcast(v) if small else v, "token", "left")


def lookup_ids(tc: DataFrame, vocab: DataFrame, oov_id: int | Column, top_k: int | None) -> DataFrame:
    """Map token -> id with a default id for tokens missing from the vocabulary."""
    j = _join_vocab(tc, vocab, top_k)
    oov = oov_id if isinstance(oov_id, Column) else F.lit(oov_id)
    return j.withColumn("id", F.coalesce(F.col("id"), oov))


def _idf(n: str, df: str) -> Column:
    return F.lit(1.0) + F.ln((F.col(n) + 1) / (F.col(df) + 1))


def tfidf(docs: DataFrame, doc_id: str, tokens: Column, top_k: int | None = None,
          vocab: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Bag-of-words tf-idf.

    tf = count(term in doc) / number of tokens in doc; idf = 1 + ln((N+1)/(df+1)).
    With ``top_k`` the vocabulary keeps the most frequent tokens (ties: token
    desc) and every other token falls into the single out-of-vocabulary slot
    ``top_k``.  Returns (weights(doc_id, term_id, tf, df, idf, tf_idf), vocab).
    """
    tc = token_counts(docs, doc_id, tokens, with_length=True)
    n = docs.agg(F.count(F.lit(1)).alias("_n"))
    small = top_k is not None and top_k <= BROADCAST_ROWS
    if vocab is None:
        # a token has an id of its own or none: frequency and df come from one aggregation by token
        counts = tc.filter(F.col("token").isNotNull()).groupBy("token").agg(
            F.sum("cnt").cast("long").alias("frequency"), F.count(F.lit(1)).alias("df"))
        order = [F.desc("frequency"), F.desc("token")]
        ranked = limit_ordered(counts, order, top_k, rank_col="_rn") if top_k is not None else global_row_number(counts, order, out="_rn")
        ranked = ranked.withColumn("id", (F.col("_rn") - 1).cast("int"))
        vocab = ranked.select("token", "frequency", "id")
        side = ranked.crossJoin(F.broadcast(n)).select("token", "id", "df", _idf("_n", "df").alias("idf"))
        if top_k is None:
            j = tc.join(side.hint("shuffle_hash"), "token")         # the (doc, token) rows are dealt once, by token
        else:
            side = F.broadcast(side) if small else side
            # only what is added up is dealt, one row a document; kept, as its df and its weights both read it
            rest = cached(tc.join(side, tc["token"] == side["token"], "left_anti").groupBy(doc_id, "_len").agg(F.sum("cnt").alias("cnt")))
            rest_df = rest.agg(F.count(F.lit(1)).alias("df"))
            oov = rest.crossJoin(F.broadcast(rest_df)).crossJoin(F.broadcast(n)).withColumns(
                {"id": F.lit(top_k), "idf": _idf("_n", "df")})
            cols = [doc_id, "_len", "cnt", "id", "df", "idf"]
            j = tc.join(side, "token").select(*cols).unionByName(oov.select(*cols))
    else:
        m = lookup_ids(tc, vocab, top_k if top_k is not None else F.lit(None).cast("int"), top_k)
        if top_k is None:
            m = m.filter(F.col("id").isNotNull())
        # ids and numbers only; kept, as the document frequencies and the weights both read it
        per = cached(m.groupBy(doc_id, "_len", "id").agg(F.sum("cnt").alias("cnt")))
        dfreq = per.groupBy("id").agg(F.count(F.lit(1)).alias("df"))
        idf = dfreq.crossJoin(F.broadcast(n)).select("id", "df", _idf("_n", "df").alias("idf"))
        j = join_side_table(per, F.broadcast(idf) if small else idf, ["id"])
    w = j.select(F.col(doc_id), F.col("id").alias("term_id"), (F.col("cnt") / F.col("_len")).alias("tf"),
                 "df", "idf")
    return w.withColumn("tf_idf", F.col("tf") * F.col("idf")), vocab


def sparse_bow(weights: DataFrame, doc_id: str, size: int | Column, index: str = "term_id",
               value: str = "tf_idf") -> DataFrame:
    """Per-document sparse vector as struct(size, indices, values), indices sorted.

    A document's entries are bounded by its token count (the unit of work).
    """
    g = weights.groupBy(doc_id).agg(F.sort_array(F.collect_list(F.struct(index, value))).alias("_e"))
    sz = size if isinstance(size, Column) else F.lit(size)
    return g.select(doc_id, F.struct(sz.cast("int").alias("size"),
                                     F.transform("_e", lambda e: e[index].cast("int")).alias("indices"),
                                     F.transform("_e", lambda e: e[value].cast("double")).alias("values"))
                    .alias("bow"))


def ngram_counts(docs: DataFrame, doc_id: str, tokens: Column, n_values: tuple[int, ...] = (1, 2),
                 max_df: float = 1.0) -> DataFrame:
    """(ngram, df, cnt) over the n-gram vocabulary kept by df <= max_df * N.

    N-grams are counted batch by batch and dealt by n-gram before anything else adds them up, so no task holds
    more than a batch or its own share of them.
    """
    from loam.functions.text import ngrams
    # project the tokens once; the n-gram lambdas then index a column, not a regex
    tk = docs.select(F.col(doc_id), tokens.alias("_tk"))
    grams = F.flatten(F.array(*[ngrams(F.col("_tk"), n) for n in n_values]))
    once, again = split_repeated(tk, doc_id)
    counts = batch_token_counts(once, grams)
    if again is not None:
        tc = explode_tokens(again, [F.col(doc_id)], count_distinct_values(grams), "_t").select(doc_id, "_t.token", "_t.cnt")
        tc = tc.groupBy(doc_id, "token").agg(F.sum("cnt").alias("cnt"))
        counts = counts.unionByName(tc.select("token", F.lit(1).cast("long").alias("df"), "cnt"))
    stats = counts.withColumnRenamed("token", "ngram").repartition("ngram").groupBy("ngram").agg(
        F.sum("df").alias("df"), F.sum("cnt").alias("cnt"))
    n = docs.agg(F.count(F.lit(1)).alias("_n"))
    kept = stats.crossJoin(F.broadcast(n)).filter(F.col("df") <= F.lit(float(max_df)) * F.col("_n"))
    return kept.select("ngram", "df", "cnt")


def hashed_doc_vector(docs: DataFrame, doc_id: str, text: str, dims: int = 64) -> DataFrame:
    """Document vector = mean over sentences of hashed tf-idf sentence vectors.

    Sentence s of doc d: weight of token w = count(w in s)/len(s) * idf(w) placed
    at slot md5(w) mod dims; idf from document frequencies.  Long output
    (doc_id, slot, value) for non-zero slots.  A token's idf is the same in all
    sentences, so each row sums count/len over its sentences first; the
    (doc, token) rows are dealt by token once, then added up by slot.  The number
    of non-empty sentences travels with each row.
    """
    from loam.functions.text import sentence_split, word_tokens

    def weighed(part: DataFrame) -> DataFrame:
        st = part.select(F.col(doc_id), F.filter(F.transform(F.split(sentence_split(text), "\n"), lambda x: word_tokens(x)),
                                                 lambda t: F.size(t) > 0).alias("_st"))
        each = F.flatten(F.transform("_st", lambda t: let(F.lit(1.0) / F.size(t), lambda x: F.transform(
            t, lambda w: F.struct(w.alias("token"), x.alias("x"))))))
        return explode_tokens(st, [F.col(doc_id), F.size("_st").alias("_ns")], sum_by_value(each), "_t").select(
            doc_id, "_ns", "_t.token", "_t.x")

    once, again = split_repeated(docs, doc_id)
    tc = weighed(docs)
    seen = tc.select("token") if again is None else weighed(once).select("token").unionByName(
        weighed(again).select(doc_id, "token").distinct().select("token"))
    dfreq = seen.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    n = docs.agg(F.count(F.lit(1)).alias("_n"))
    idf = dfreq.crossJoin(F.broadcast(n)).select("token", F.pmod(md5_int(F.col("token")), F.lit(dims)).cast("int").alias("slot"),
                                                 _idf("_n", "df").alias("idf"))
    w = tc.join(idf.hint("shuffle_hash"), "token").select(doc_id, "_ns", "slot", (F.col("x") * F.col("idf")).alias("w"))
    # mean over sentences of per-sentence slot sums = (sum of all weights per slot) / #sentences
    per_doc = w.groupBy(doc_id, "_ns", "slot").agg(F.sum("w").alias("w"))
    return per_doc.select(doc_id, "slot", (F.col("w") / F.col("_ns")).alias("value"))


# Markup patterns of the page extractor.
TITLE_RE = "<title>(.*?)</title>"
PARAGRAPH_RE = "<p>(.*?)</p>"
LINK_TEXT_RE = "<a href=\"[^\"]*\">([^<]*)</a>"


def extract_page_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """title, body (paragraphs joined by newline) and topics (link texts, comma-joined)."""
    h = F.col(html)
    return pages.select(
        "*",
        F.regexp_extract(h, TITLE_RE, 1).alias("title"),
        F.array_join(F.regexp_extract_all(h, F.lit(PARAGRAPH_RE), F.lit(1)), "\n").alias("body"),
        F.array_join(F.regexp_extract_all(h, F.lit(LINK_TEXT_RE), F.lit(1)), ",").alias("topics"))


def drop_incomplete(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows where any listed field is null, an empty string or an empty array."""
    cond = None
    for c in cols:
        dt = df.schema[c].dataType.simpleString()
        ok = F.col(c).isNotNull()
        if dt == "string":
            ok = ok & (F.col(c) != "")
        elif dt.startswith("array"):
            ok = ok & (F.size(c) > 0)
        cond = ok if cond is None else cond & ok
    return df.filter(cond)
