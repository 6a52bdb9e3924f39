"""Text queries (SF3-SF11, PF2, JN3, JN5, SL1, AG8-AG10, FT8, FT14, FT15, FT18, TV2, TV3, PF10, IO7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.functions import text as T
from loam.functions.arrays import explode_rows, posexplode_rows
from loam.operators import text as TO
from loam.operators.analyze import PAD_WORD, doc_frequency, vocabulary, word_set_vocabulary
from loam.operators.split import threshold_split
from loam.plans.common import r6, sql_md5_int
from loam.plans.registry import register, t
from loam.session import cached, scratch_path

VOCAB_TOP_K = 20_000
SQL_FIRST_LINE = "split_part(text, chr(10), 1)"
SQL_DELIM_TOKENS = "list_filter(regexp_split_to_array(lower(text), '[.,!?() ]'), lambda x: x <> '')"
SQL_WORD_RE = "'[\\p{L}\\p{N}_]{2,}'"
SQL_CLEAN_SMS = "regexp_replace(lower(translate(text, chr(9) || '\"', '')), '^\\s+|\\s+$', '', 'g')"
SQL_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in T.STOP_WORDS_EN) + "]"
SQL_PAGE_FIELDS = """(SELECT page_id, url,
    regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
    array_to_string(regexp_extract_all(html, '<p>(.*?)</p>', 1), chr(10)) AS body,
    array_to_string(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1), ',') AS topics FROM pages)"""


def _docs(spark, sf):
    return t(spark, sf, "documents")


def _delim_tokens():
    return T.tokenize(F.lower(F.col("text")))


@register("clean_title_regex", f"""
SELECT doc_id, regexp_replace({SQL_FIRST_LINE}, '[^a-zA-Z0-9 $.-]', ' ', 'g') AS clean_title FROM documents
""", ids=("SF3",))
def clean_title_regex(spark, sf):
    return _docs(spark, sf).select("doc_id", T.clean_title(T.first_line("text")).alias("clean_title"))


@register("tokenize_delims", """
SELECT doc_id, len(tk) AS n_tokens, array_to_string(tk, ' ') AS tokens_text
FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[.,!?() ]'), lambda x: x <> '') AS tk FROM documents)
""", ids=("SF7",))
def tokenize_delims(spark, sf):
    d = _docs(spark, sf).select("doc_id", T.tokenize("text").alias("tk"))
    return d.select("doc_id", F.size("tk").cast("bigint").alias("n_tokens"),
                    F.array_join("tk", " ").alias("tokens_text"))


@register("clean_sms", f"""
SELECT doc_id, {SQL_CLEAN_SMS} AS clean_text FROM documents
""", ids=("SF6",))
def clean_sms(spark, sf):
    return _docs(spark, sf).select("doc_id", T.clean_sms("text").alias("clean_text"))


@register("clean_text_stopwords", f"""
SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(lower(text), '\\s+'),
         lambda w: regexp_replace(w, '[^\\p{{L}}\\p{{N}}]', '', 'g')),
         lambda w: w <> '' AND NOT list_contains({SQL_STOP}, w)), ' ') AS clean_text
FROM documents
""", ids=("SF8",))
def clean_text_stopwords(spark, sf):
    return _docs(spark, sf).select("doc_id", T.clean_text_stopwords("text").alias("clean_text"))


@register("sentence_split", """
SELECT doc_id, len(string_split(c, chr(10))) AS n_sentences, c AS content
FROM (SELECT doc_id, regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g') AS c FROM documents)
""", ids=("SF9",))
def sentence_split(spark, sf):
    d = _docs(spark, sf).select("doc_id", T.sentence_split("text").alias("content"))
    return d.select("doc_id", F.size(F.split("content", "\n")).cast("bigint").alias("n_sentences"), "content")


@register("ascii_clean", """
SELECT doc_id, regexp_replace(replace(replace(text, chr(10) || ' Reuter' || chr(10) || chr(3), ''), chr(10), ' '),
                              '[^\\x00-\\x7F]', '', 'g') AS content FROM documents
""", ids=("SF10",))
def ascii_clean(spark, sf):
    return _docs(spark, sf).select("doc_id", T.ascii_clean("text").alias("content"))


@register("url_source", """
SELECT page_id, string_split(regexp_extract(url, '.*://(.[^/]+)/', 1), '.')[-2] AS source FROM pages
""", ids=("SF4",))
def url_source(spark, sf):
    return t(spark, sf, "pages").select("page_id", T.url_source("url").alias("source"))


@register("hn_title_source", f"""
SELECT page_id, string_split(regexp_extract(url, '.*://(.[^/]+)/', 1), '.')[-2] AS source, title
FROM {SQL_PAGE_FIELDS} p
WHERE regexp_matches(regexp_extract(url, '.*://(.[^/]+)/', 1), '\\.com$') AND length(title) > 10
""", ids=("SF5",))
def hn_title_source(spark, sf):
    p = TO.extract_page_fields(t(spark, sf, "pages"))
    f = p.filter(T.is_dot_com(T.url_host("url")) & (F.length("title") > 10))
    return f.select("page_id", T.url_source("url").alias("source"), "title")


@register("label_from_path", """
SELECT page_id, string_split(url, '/')[-2] AS label FROM pages
""", ids=("IO7",))
def label_from_path(spark, sf):
    p = t(spark, sf, "pages")
    return p.select("page_id", F.try_element_at(F.split("url", "/"), F.lit(-2)).alias("label"))


@register("longest_titles", f"""
SELECT doc_id, length({SQL_FIRST_LINE}) AS title_len FROM documents WHERE text LIKE '%the%'
ORDER BY title_len DESC, doc_id LIMIT 5
""", ids=("SL1",))
def longest_titles(spark, sf):
    d = _docs(spark, sf).filter(F.col("text").like("%the%"))
    d = d.select("doc_id", F.length(T.first_line("text")).cast("bigint").alias("title_len"))
    return d.orderBy(F.desc("title_len"), "doc_id").limit(5)


@register("filter_like", """
SELECT doc_id, source FROM documents WHERE lower(text) LIKE '%license%'
""", ids=("PF2",))
def filter_like(spark, sf):
    return _docs(spark, sf).filter(F.lower("text").like("%license%")).select("doc_id", "source")


@register("topic_distribution", f"""
SELECT topic, count(title) AS title_count
FROM (SELECT {SQL_FIRST_LINE} AS title, unnest(string_split(lang || ',' || source, ',')) AS topic FROM documents)
GROUP BY topic ORDER BY title_count DESC
""", ids=("JN3", "AG1"))
def topic_distribution(spark, sf):
    d = explode_rows(_docs(spark, sf), [T.first_line("text").alias("title")],
                     F.split(F.concat_ws(",", "lang", "source"), ","), "topic")
    return d.groupBy("topic").agg(F.count("title").alias("title_count")).orderBy(F.desc("title_count"), "topic")


@register("vocabulary_topk", f"""
WITH c AS (SELECT token, count(*) AS frequency FROM (SELECT unnest({SQL_DELIM_TOKENS}) AS token FROM documents) GROUP BY token)
SELECT token, frequency, CAST(row_number() OVER (ORDER BY frequency DESC, token DESC) - 1 AS INTEGER) AS id
FROM c QUALIFY id < {VOCAB_TOP_K}
""", ids=("AG8", "FT6"))
def vocabulary_topk(spark, sf):
    tk = explode_rows(_docs(spark, sf), [], _delim_tokens(), "token")
    return vocabulary(tk, "token", top_k=VOCAB_TOP_K)


@register("word_set_vocab", f"""
WITH w AS (SELECT DISTINCT unnest(string_split({SQL_CLEAN_SMS}, ' ')) AS word FROM documents)
SELECT '{PAD_WORD}' AS word, 0 AS id
UNION ALL SELECT word, CAST(row_number() OVER (ORDER BY word) AS INTEGER) AS id FROM w WHERE word <> ''
""", ids=("AG9",))
def word_set_vocab(spark, sf):
    d = _docs(spark, sf).select(T.clean_sms("text").alias("clean"))
    return word_set_vocabulary(d, "clean")


@register("doc_frequency_idf", f"""
WITH p AS (SELECT DISTINCT doc_id, unnest({SQL_DELIM_TOKENS}) AS token FROM documents),
n AS (SELECT count(*) AS n FROM documents)
SELECT token, count(*) AS df, round(1 + ln((n.n + 1) / (count(*) + 1)), 6) AS idf FROM p CROSS JOIN n GROUP BY token, n.n
""", ids=("AG10",))
def doc_frequency_idf(spark, sf):
    d = doc_frequency(_docs(spark, sf), "doc_id", _delim_tokens())
    return d.select("token", "df", r6("idf").alias("idf"))


def _sql_tfidf(top_k: int | None) -> str:
    vfilter = f"QUALIFY id < {top_k}" if top_k is not None else ""
    oov = str(top_k) if top_k is not None else "NULL"
    return f"""
WITH d AS (SELECT doc_id, {SQL_DELIM_TOKENS} AS toks FROM documents),
l AS (SELECT doc_id, len(toks) AS dl FROM d),
tc AS (SELECT doc_id, token, count(*) AS cnt FROM (SELECT doc_id, unnest(toks) AS token FROM d) GROUP BY doc_id, token),
v AS (SELECT token, row_number() OVER (ORDER BY sum(cnt) DESC, token DESC) - 1 AS id FROM tc GROUP BY token {vfilter}),
m AS (SELECT tc.doc_id, coalesce(v.id, {oov}) AS id, sum(cnt) AS cnt FROM tc LEFT JOIN v ON tc.token = v.token
      GROUP BY tc.doc_id, coalesce(v.id, {oov})),
df AS (SELECT id, count(*) AS df FROM m GROUP BY id),
n AS (SELECT count(*) AS n FROM documents)"""


@register("tfidf_weights", _sql_tfidf(VOCAB_TOP_K) + """
SELECT m.doc_id, CAST(m.id AS INTEGER) AS term_id, round(m.cnt / l.dl * (1 + ln((n.n + 1) / (df.df + 1))), 6) AS tf_idf
FROM m JOIN l ON m.doc_id = l.doc_id JOIN df ON m.id = df.id CROSS JOIN n
""", ids=("FT14",))
def tfidf_weights(spark, sf):
    w, _ = TO.tfidf(_docs(spark, sf), "doc_id", _delim_tokens(), top_k=VOCAB_TOP_K)
    return w.select("doc_id", F.col("term_id").cast("int").alias("term_id"), r6("tf_idf").alias("tf_idf"))


@register("weighted_bow", _sql_tfidf(None) + """,
vs AS (SELECT count(*) AS vsize FROM v)
SELECT m.doc_id, CAST(vs.vsize AS INTEGER) AS size, CAST(m.id AS INTEGER) AS idx,
       round(m.cnt / l.dl * (1 + ln((n.n + 1) / (df.df + 1))), 6) AS weight
FROM m JOIN l ON m.doc_id = l.doc_id JOIN df ON m.id = df.id CROSS JOIN n CROSS JOIN vs WHERE m.id IS NOT NULL
""", ids=("FT15",))
def weighted_bow(spark, sf):
    docs = _docs(spark, sf)
    w, vocab = TO.tfidf(docs, "doc_id", _delim_tokens(), top_k=None)
    vsize = vocab.agg(F.count(F.lit(1)).alias("_v"))
    # size is a per-corpus constant: attach it after building the vectors (one-row broadcast)
    bow = TO.sparse_bow(w, "doc_id", 0).crossJoin(F.broadcast(vsize)).withColumn(
        "bow", F.struct(F.col("_v").cast("int").alias("size"), F.col("bow.indices").alias("indices"),
                        F.col("bow.values").alias("values")))
    flat = bow.select("doc_id", F.col("bow.size").alias("size"),
                      F.inline(F.arrays_zip(F.col("bow.indices").alias("idx"), F.col("bow.values").alias("weight"))))
    return flat.select("doc_id", "size", "idx", r6("weight").alias("weight"))


@register("ngram_counts_maxdf", f"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), {SQL_WORD_RE}) AS tk FROM documents),
g AS (SELECT doc_id, unnest(tk) AS ngram FROM t
      UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(tk)), lambda i: tk[i] || ' ' || tk[i + 1])) FROM t),
c AS (SELECT doc_id, ngram, count(*) AS cnt FROM g GROUP BY doc_id, ngram),
n AS (SELECT count(*) AS n FROM documents)
SELECT ngram, count(*) AS df, CAST(sum(cnt) AS BIGINT) AS cnt FROM c CROSS JOIN n GROUP BY ngram, n.n
HAVING count(*) <= 0.5 * n.n
""", ids=("FT18",))
def ngram_counts_maxdf(spark, sf):
    docs = _docs(spark, sf)
    return TO.ngram_counts(docs, "doc_id", T.word_tokens("text"), (1, 2), max_df=0.5)


# ---------------------------------------------------------------- vocabulary from file + OOV

SQL_TRAIN_VOCAB = f"""
tr AS (SELECT * FROM documents WHERE abs({sql_md5_int(SQL_FIRST_LINE)}) % 100 <= 75),
w AS (SELECT DISTINCT unnest(string_split({SQL_CLEAN_SMS}, ' ')) AS word FROM tr),
v AS (SELECT '{PAD_WORD}' AS word, 0 AS id UNION ALL SELECT word, row_number() OVER (ORDER BY word) FROM w WHERE word <> ''),
vs AS (SELECT count(*) AS vsize FROM v)"""


def _file_vocab(spark, sf):
    """Word-set vocabulary fitted on the train split, written to CSV and read back."""
    docs = _docs(spark, sf)
    train = threshold_split(docs, T.first_line("text"), 75).filter(F.col("split") == "train")
    vocab = word_set_vocabulary(train.select(T.clean_sms("text").alias("clean")), "clean")
    path = scratch_path(spark, "vocab")
    # JSON lines: words may contain newlines/commas; the format stays splittable
    vocab.write.mode("overwrite").json(path)
    return spark.read.schema("word string, id int").json(path)


def _doc_words(docs):
    return docs.select("doc_id", F.filter(F.split(T.clean_sms("text"), " "), lambda w: w != "").alias("toks"))


@register("vocab_lookup_oov", f"""
WITH {SQL_TRAIN_VOCAB},
tk AS (SELECT doc_id, unnest(string_split({SQL_CLEAN_SMS}, ' ')) AS word FROM documents)
SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (WHERE v.id IS NULL) AS n_oov,
       CAST(sum(coalesce(v.id, vs.vsize)) AS BIGINT) AS id_sum
FROM tk LEFT JOIN v ON tk.word = v.word CROSS JOIN vs WHERE tk.word <> '' GROUP BY doc_id
""", ids=("JN5", "FT8", "IO11"))
def vocab_lookup_oov(spark, sf):
    vocab = _file_vocab(spark, sf).withColumnRenamed("word", "token")
    vsize = vocab.agg(F.count(F.lit(1)).alias("_oov"))
    words = explode_rows(_doc_words(_docs(spark, sf)), ["doc_id"], "toks", "token")
    m = TO.lookup_ids(words.crossJoin(F.broadcast(vsize)), vocab, F.col("_oov"), top_k=None)
    return m.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.count(F.when(F.col("id") == F.col("_oov"), 1)).alias("n_oov"),
        F.sum(F.col("id").cast("long")).alias("id_sum"))


@register("pad_token_ids", f"""
WITH {SQL_TRAIN_VOCAB},
tk AS (SELECT doc_id, list_filter(string_split({SQL_CLEAN_SMS}, ' '), lambda x: x <> '') AS toks FROM documents),
p AS (SELECT doc_id, unnest(range(0, 100)) AS pos, toks FROM tk)
SELECT p.doc_id, p.pos, CAST(CASE WHEN p.pos < len(p.toks) THEN coalesce(v.id, vs.vsize) ELSE 0 END AS INTEGER) AS id
FROM p CROSS JOIN vs LEFT JOIN v ON v.word = p.toks[p.pos + 1]
""", ids=("SF11",))
def pad_token_ids(spark, sf):
    vocab = _file_vocab(spark, sf).withColumnRenamed("word", "token")
    vsize = vocab.agg(F.count(F.lit(1)).cast("int").alias("_oov"))
    words = _doc_words(_docs(spark, sf))
    ex = posexplode_rows(words, ["doc_id"], F.slice("toks", 1, 100), "pos", "token")
    m = TO.lookup_ids(ex.crossJoin(F.broadcast(vsize)), vocab, F.col("_oov"), top_k=None)
    # per document at most 100 ids: bounded collect, then pad/cut to 100
    ids = m.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("_s"))
    ids = words.select("doc_id").join(ids, "doc_id", "left").select(
        "doc_id", T.pad_or_cut(F.coalesce(F.transform("_s", lambda s: s["id"]), F.array().cast("array<int>")),
                               100, 0).alias("ids"))
    return posexplode_rows(ids, ["doc_id"], "ids", "pos", "id").select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), F.col("id").cast("int").alias("id"))


@register("hashed_doc_vector", f"""
WITH sp AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)) AS l FROM documents),
s AS (SELECT doc_id, unnest(l) AS sent, unnest(range(0, len(l))) AS s FROM sp),
st AS (SELECT doc_id, s, regexp_extract_all(lower(sent), {SQL_WORD_RE}) AS tk FROM s),
st2 AS (SELECT * FROM st WHERE len(tk) > 0),
ns AS (SELECT doc_id, count(*) AS ns FROM st2 GROUP BY doc_id),
ex AS (SELECT doc_id, s, len(tk) AS sl, unnest(tk) AS token FROM st2),
stc AS (SELECT doc_id, s, sl, token, count(*) AS cnt FROM ex GROUP BY doc_id, s, sl, token),
df AS (SELECT token, count(DISTINCT doc_id) AS df FROM stc GROUP BY token),
n AS (SELECT count(*) AS n FROM documents),
w AS (SELECT doc_id, s, CAST({sql_md5_int('stc.token')} % 64 AS INTEGER) AS slot,
             cnt / sl * (1 + ln((n.n + 1) / (df.df + 1))) AS w FROM stc JOIN df ON stc.token = df.token CROSS JOIN n),
ps AS (SELECT doc_id, s, slot, sum(w) AS w FROM w GROUP BY doc_id, s, slot),
pd AS (SELECT doc_id, slot, sum(w) AS w FROM ps GROUP BY doc_id, slot)
SELECT pd.doc_id, slot, round(w / ns, 6) AS value FROM pd JOIN ns ON pd.doc_id = ns.doc_id
""", ids=("TV3",))
def hashed_doc_vector(spark, sf):
    v = TO.hashed_doc_vector(_docs(spark, sf), "doc_id", "text", dims=64)
    return v.select("doc_id", "slot", r6("value").alias("value"))


@register("extract_page_fields", f"""
SELECT page_id, title, body, topics FROM {SQL_PAGE_FIELDS} p
""", ids=("TV2", "UD2"))
def extract_page_fields(spark, sf):
    return TO.extract_page_fields(t(spark, sf, "pages")).select("page_id", "title", "body", "topics")


@register("drop_incomplete", f"""
SELECT page_id FROM {SQL_PAGE_FIELDS} p WHERE title <> '' AND body <> '' AND topics <> ''
""", ids=("PF10", "UD3"))
def drop_incomplete(spark, sf):
    p = TO.extract_page_fields(t(spark, sf, "pages"))
    return TO.drop_incomplete(p, ["title", "body", "topics"]).select("page_id")


# ----------------------------------------------------------------------------- end-to-end similarity

def _sql_hashed_vectors(src: str, id_col: str, text_col: str) -> str:
    """CTEs computing hashed sentence-mean tf-idf vectors (long form) for ``src``."""
    return f"""
sp AS (SELECT {id_col} AS doc_id, string_split(regexp_replace({text_col}, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)) AS l FROM {src}),
s AS (SELECT doc_id, unnest(l) AS sent, unnest(range(0, len(l))) AS s FROM sp),
st AS (SELECT doc_id, s, regexp_extract_all(lower(sent), {SQL_WORD_RE}) AS tk FROM s),
st2 AS (SELECT * FROM st WHERE len(tk) > 0),
ns AS (SELECT doc_id, count(*) AS ns FROM st2 GROUP BY doc_id),
ex AS (SELECT doc_id, s, len(tk) AS sl, unnest(tk) AS token FROM st2),
stc AS (SELECT doc_id, s, sl, token, count(*) AS cnt FROM ex GROUP BY doc_id, s, sl, token),
df AS (SELECT token, count(DISTINCT doc_id) AS df FROM stc GROUP BY token),
n AS (SELECT count(*) AS n FROM {src}),
w AS (SELECT doc_id, s, CAST({sql_md5_int('stc.token')} % 64 AS INTEGER) AS slot,
             cnt / sl * (1 + ln((n.n + 1) / (df.df + 1))) AS w FROM stc JOIN df ON stc.token = df.token CROSS JOIN n),
ps AS (SELECT doc_id, s, slot, sum(w) AS w FROM w GROUP BY doc_id, s, slot),
pd AS (SELECT doc_id, slot, sum(w) AS w FROM ps GROUP BY doc_id, slot),
hv AS (SELECT pd.doc_id, slot, w / ns AS value FROM pd JOIN ns ON pd.doc_id = ns.doc_id)"""


@register("page_similarity", f"""
WITH pf AS {SQL_PAGE_FIELDS},
{_sql_hashed_vectors('pf', 'page_id', 'body')},
probe AS (SELECT min(page_id) AS k1 FROM pf WHERE body LIKE '%the%'),
pv AS (SELECT hv.slot, hv.value FROM hv JOIN probe ON hv.doc_id = probe.k1),
dots AS (SELECT hv.doc_id AS k2, sum(hv.value * pv.value) AS dot FROM hv JOIN pv ON hv.slot = pv.slot GROUP BY hv.doc_id),
norms AS (SELECT doc_id, sqrt(sum(value * value)) AS nrm FROM hv GROUP BY doc_id),
pn AS (SELECT sqrt(sum(value * value)) AS pnrm FROM pv)
SELECT probe.k1, norms.doc_id AS k2, round(coalesce(dots.dot, 0.0) / (norms.nrm * pn.pnrm), 6) AS similarity
FROM norms CROSS JOIN probe CROSS JOIN pn LEFT JOIN dots ON dots.k2 = norms.doc_id
""", ids=("TV1", "TV2", "TV3", "JN1", "SL2"))
def page_similarity(spark, sf):
    """Pages -> title/body -> hashed tf-idf body vectors -> cosine of one probe page vs all."""
    from loam.operators.vector import dense_from_long, similar_by_vector, single_row
    pages = TO.extract_page_fields(t(spark, sf, "pages")).select("page_id", "body")
    # one short vector a page, kept: the probe and the comparison read the same ones
    vecs = cached(dense_from_long(TO.hashed_doc_vector(pages, "page_id", "body", dims=64), "page_id", "slot", "value", 64))
    probe_id = single_row(pages.filter(F.col("body").like("%the%")).select("page_id"), ["page_id"])
    probe = vecs.join(F.broadcast(probe_id), "page_id")          # one row
    s = similar_by_vector(vecs, "page_id", "vec", probe)
    return s.select("k1", "k2", r6("similarity").alias("similarity"))
