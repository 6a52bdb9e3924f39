"""Work and traffic that must not grow faster than the tables; rows built here, repeated and null ids among them."""

import re
from collections import Counter, defaultdict
from math import log

from pyspark.sql import functions as F

from loam.functions.arrays import let


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def dealt(df) -> int:
    """Exchanges by key in the plan, reused ones not counted."""
    return len(re.findall(r"\bExchange (hash|range)partitioning", plan(df)))


def test_title_words_are_hashed_once_not_once_a_slot(spark, tmp_path):
    from __spark_entry__ import queries
    rows = [(1, "alpha beta  beta\nmore"), (2, "beta\talpha alpha"), (3, "  \nonly spaces"), (4, None), (5, "gamma"), (6, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries()["title_similarity"](spark, str(tmp_path))
    assert not re.search(r"sequence\(0, 63[^)]*\), lambdafunction\([^\n]{0,200}md5", plan(out))
    got = {(r.k1, r.k2): r.similarity for r in out.collect()}
    assert set(got) == {(1, 1), (1, 2), (1, 5)} and got[1, 1] == 1.0


def test_let_works_its_value_out_once(spark):
    r = spark.range(5).select(let(F.rand(), lambda v: F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: v)).alias("v")).collect()
    assert all(len(set(x.v)) == 1 for x in r)


TEXTS = [(1, "a b a. c"), (2, "b b c"), (2, "b b c"), (2, "a c"), (None, "c a"), (None, "a, b"), (3, ""), (4, None)]


def words(text):
    return [w for w in re.split("[., ]", text or "") if w]


def texts(spark, rows=TEXTS):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_weighted_bow_is_dealt_by_token_once(spark):
    from loam.functions.text import tokenize
    from loam.operators.text import sparse_bow, tfidf
    once = texts(spark, [(i, t) for i, (_, t) in enumerate(TEXTS)])
    w, _ = tfidf(once, "doc_id", tokenize(F.col("text")))
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*doc_id", plan(w))) == 0        # before: (doc, token) and (doc, id)
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*doc_id", plan(sparse_bow(w, "doc_id", 0)))) == 1
    # rows of one id and length count as one document, as before
    w, vocab = tfidf(texts(spark), "doc_id", tokenize(F.col("text")))
    ids = {r.token: r.id for r in vocab.collect()}
    cnt = Counter((d, len(words(t)), x) for d, t in TEXTS for x in words(t))
    df = Counter(x for _, _, x in cnt)
    want = {(d, n, ids[x], round(c / n * (1 + log((len(TEXTS) + 1) / (df[x] + 1))), 9)) for (d, n, x), c in cnt.items()}
    got = [(r.doc_id, r.term_id, round(r.tf_idf, 9)) for r in w.collect()]
    assert Counter(got) == Counter((d, i, v) for d, _, i, v in want)


def test_ngrams_are_dealt_by_ngram_only(spark):
    from loam.functions.text import word_tokens
    from loam.operators.text import ngram_counts
    rows = [(1, "ab cd ab cd"), (2, "cd ef"), (2, "cd ef"), (None, "ab cd"), (None, "ab"), (3, None), (4, "x")]
    assert "doc_id" not in " ".join(re.findall(r"Exchange hashpartitioning\([^)]*\)", plan(
        ngram_counts(texts(spark, [(i, t) for i, (_, t) in enumerate(rows)]), "doc_id", word_tokens("text")))))
    grams = Counter()
    for d, t in rows:
        w = re.findall(r"\w{2,}", t or "")
        grams.update((d, g) for g in w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    df, cnt = Counter(g for _, g in grams), defaultdict(int)
    for (_, g), c in grams.items():
        cnt[g] += c
    got = {(r.ngram, r.df, r.cnt) for r in ngram_counts(texts(spark, rows), "doc_id", word_tokens("text")).collect()}
    assert got == {(g, df[g], cnt[g]) for g in df}


def test_ngrams_are_counted_by_batch_not_by_task(spark):
    from loam.functions.text import word_tokens
    from loam.operators.text import batch_token_counts, ngram_counts
    once = texts(spark, [(i, t) for i, (_, t) in enumerate(TEXTS)])
    above = plan(ngram_counts(once, "doc_id", word_tokens("text"))).split("Exchange hashpartitioning(ngram")[1].splitlines()[1]
    assert "Aggregate" not in above                          # before: a map of all different n-grams of a task, spilled
    rows = [(["a", "b", "a", None],), (["b"],), ([],), (None,), (["c", None, None],), (["a"],)]
    df = spark.createDataFrame(rows, "tk array<string>").coalesce(1)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for n in ("2", "100"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
        try:
            got = batch_token_counts(df, F.col("tk")).groupBy("token").agg(F.sum("df"), F.sum("cnt"), F.count(F.lit(1))).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        assert {r[0]: (r[1], r[2]) for r in got} == {"a": (2, 3), "b": (2, 2), "c": (1, 1), None: (2, 3)}
        assert n == "2" or all(r[3] == 1 for r in got)       # once a batch


def test_hashed_vectors_sum_sentences_within_the_row(spark):
    from loam.operators.text import hashed_doc_vector
    rows = [(1, "aa bb. aa cc! dd"), (2, "bb bb. cc"), (2, "bb bb. cc"), (2, "dd"), (None, "aa. aa"), (None, "cc"), (3, None), (4, ".")]
    p = plan(hashed_doc_vector(texts(spark, [(i, t) for i, (_, t) in enumerate(rows)]), "doc_id", "text", 8))
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*doc_id", p)) == 1 and not re.search(r"hashpartitioning\([^)]*\bs#", p)
    df = Counter(x for _, x in {(d, x) for d, t in rows for x in re.findall(r"\w{2,}", t or "")})
    slot = {r.w: r.s for r in spark.createDataFrame([(x,) for x in df], "w string").selectExpr(
        "w", "cast(pmod(cast(conv(substring(md5(w), 1, 15), 16, 10) as bigint), 8) as int) as s").collect()}
    want = defaultdict(float)
    for d, t in rows:
        sents = [s for s in (re.findall(r"\w{2,}", x) for x in re.split(r"[.!?]\s+", t or "")) if s]
        for s in sents:
            for x in s:
                want[d, len(sents), slot[x]] += (1 + log((len(rows) + 1) / (df[x] + 1))) / len(s) / len(sents)
    got = sorted((str(r.doc_id), r.slot, round(r.value, 9)) for r in hashed_doc_vector(texts(spark, rows), "doc_id", "text", 8).collect())
    assert got == sorted((str(d), s, round(v, 9)) for (d, _, s), v in want.items())


def test_top_k_tfidf_broadcasts_its_vocabulary(spark):
    from loam.functions.text import tokenize
    from loam.operators.text import tfidf
    once, _ = tfidf(texts(spark, [(i, t) for i, (_, t) in enumerate(TEXTS)]), "doc_id", tokenize(F.col("text")), top_k=2)
    p = plan(once)
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p and not re.search(r"Exchange hashpartitioning\([^)]*token", p)
    w, _ = tfidf(texts(spark), "doc_id", tokenize(F.col("text")), top_k=2)
    ids = {x: i for i, (x, _) in enumerate(sorted(Counter(x for _, t in TEXTS for x in words(t)).items(), key=lambda e: (e[1], e[0]), reverse=True)[:2])}
    cnt = Counter((d, len(words(t)), ids.get(x, 2)) for d, t in TEXTS for x in words(t))
    df = Counter(i for _, _, i in cnt)
    want = Counter((d, i, round(c / n * (1 + log((len(TEXTS) + 1) / (df[i] + 1))), 9)) for (d, n, i), c in cnt.items())
    assert Counter((r.doc_id, r.term_id, round(r.tf_idf, 9)) for r in w.collect()) == want


def test_top_k_tfidf_deals_only_the_rest_of_a_document(spark):
    from loam.functions.text import tokenize
    from loam.operators.text import tfidf
    rows = [(i, t) for i, (_, t) in enumerate(TEXTS)] + [(8, "z y, z z"), (9, "a")]
    for k in (2, 50):                                        # 50: nothing is out of the vocabulary
        w, vocab = tfidf(texts(spark, rows), "doc_id", tokenize(F.col("text")), top_k=k)
        assert not re.search(r"Exchange hashpartitioning\([^)]*\bid#", plan(w))          # before: every (doc, id) row
        freq = sorted(Counter(x for _, t in rows for x in words(t)).items(), key=lambda e: (e[1], e[0]), reverse=True)[:k]
        assert {(r.token, r.frequency, r.id) for r in vocab.collect()} == {(x, f, i) for i, (x, f) in enumerate(freq)}
        ids = {x: i for i, (x, _) in enumerate(freq)}
        cnt = Counter((d, len(words(t)), ids.get(x, k)) for d, t in rows for x in words(t))
        df = Counter(i for _, _, i in cnt)
        want = Counter((d, i, df[i], round(c / n * (1 + log((len(rows) + 1) / (df[i] + 1))), 9)) for (d, n, i), c in cnt.items())
        assert Counter((r.doc_id, r.term_id, r.df, round(r.tf_idf, 9)) for r in w.collect()) == want


def test_grid_search_hashes_once_and_its_model_reads_words(spark, monkeypatch):
    from pyspark.ml.feature import HashingTF

    from loam.operators import models as M
    calls = []
    transform = HashingTF.transform
    monkeypatch.setattr(HashingTF, "transform", lambda self, *a: calls.append(self.getNumFeatures()) or transform(self, *a))
    df = spark.createDataFrame([(f"{'good fine' if i % 2 else 'bad poor'} w{i % 7} v{i % 5}", float(i % 2)) for i in range(60)], "text string, label double")
    model, rows = M.text_grid_search(df, "text", "label", [0.01, 0.1], [16, 64], folds=2)
    assert sorted(calls) == [16, 64]                                     # before: for every fold and grid point
    assert {(r["regParam"], r["numFeatures"]) for r in rows} == {(a, b) for a in (0.01, 0.1) for b in (16, 64)} and sum(r["best"] for r in rows) == 1
    out = model.bestModel.transform(df.selectExpr("split(lower(text), ' ') as _words", "label"))
    assert out.filter("label = prediction").count() == 60


def test_sliced_auc_ranks_ranges_without_copies_per_slice(spark, monkeypatch):
    from loam.operators import evaluate as ev
    monkeypatch.setattr(ev, "AUC_ROWS", 7, raising=False)
    rows = [(i % 3 == 0, float(i * 7 % 23), "p" if i % 5 else None, i % 4) for i in range(400)]
    rows += [(True, None, "p", 1), (None, 1.0, "p", 1), (True, float("nan"), "q", 1), (False, -0.0, "q", 1)]
    df = spark.createDataFrame([(None if y is None else int(y), s, a, b) for y, s, a, b in rows], "y long, s double, a string, b int").repartition(6)
    out = ev.sliced_auroc(df, "y", "s", ["a", "b"])
    assert "Generate" not in plan(out)                                   # before: every row once a slice
    got = {(r.slice_col, r.slice_value): (r.auc, r.n_pos, r.n_neg) for r in out.collect()}
    held = [(y, (1, 0) if s != s else (0, s), a, b) for y, s, a, b in rows if y is not None and s is not None]
    slices = {("Overall", ""): held, **{("a", v): [h for h in held if h[2] == v] for v in ("p", "q", None)},
              **{("b", str(v)): [h for h in held if h[3] == v] for v in range(4)}}
    for k, part in slices.items():
        pos, neg = [h[1] for h in part if h[0]], [h[1] for h in part if not h[0]]
        auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
        assert got[k][1:] == (len(pos), len(neg)) and abs(got[k][0] - auc) < 1e-12, k
    assert set(got) == set(slices)


def _series(spark):
    rows = [(u, t, float((t * 7 + u) % 5 + t % 3)) for u in (1, 2) for t in range(40)] + [(3, t, 1.0) for t in range(2)]
    rows += [(None, t, float(t % 4)) for t in range(20)] + [(4, t, None if t == 19 else float(t % 6)) for t in range(20)]
    return spark.createDataFrame(rows, "u int, t int, n double"), rows


def test_forecasts_follow_their_model_step_by_step(spark):
    from loam.operators import models as M
    df, rows = _series(spark)
    out = M.ar_forecast_by_series(df, ["u"], ["t"], "n", p=3, horizon=30, penalty=0.05, with_model=True)
    assert "MapInArrow" in plan(out)                         # before: an aggregate that copied its arrays at every step
    got = defaultdict(list)
    for r in out.orderBy("u", "h").collect():
        got[r.u].append((r.forecast, r.b))
    assert set(got) == {None, 1, 2, 4} and all(v is None for v, _ in got[4])
    for u in (None, 1, 2):
        last = [n for x, _, n in rows if x == u][:-4:-1]
        level = got[u][0][0] - sum(b * x for b, x in zip(got[u][0][1], last))
        for v, b in got[u]:
            y = level + sum(c * x for c, x in zip(b, last))
            assert abs(v - y) < 1e-9
            last = [y, *last[:-1]]


def test_held_out_values_come_with_the_tails(spark):
    from loam.operators import models as M
    df, rows = _series(spark)
    out = M.ar_forecast_by_series(df, ["u"], ["t"], "n", p=3, horizon=15, train_fraction=0.7)
    assert not re.search(r"Exchange hashpartitioning\([^)]*\bh#", plan(out))         # before: a join of all (series, step)
    got = {(r.u, r.h): r.actual for r in out.collect()}
    value = {(u, t): n for u, t, n in rows}
    cut = {1: 28, 2: 28, 4: 14}
    assert got == {(u, h): value.get((u, c + h - 1)) for u, c in cut.items() for h in range(1, 16)} | {(None, h): None for h in range(1, 16)}


def test_only_held_out_steps_are_forecast(spark, tmp_path, monkeypatch):
    from __spark_entry__ import queries
    from loam.operators import evaluate as ev
    from loam.operators import models as M
    df, rows = _series(spark)
    both = [{(r.u, r.h): (r.forecast, r.actual) for r in M.ar_forecast_by_series(
        df, ["u"], ["t"], "n", p=3, horizon=8, train_fraction=0.7, **more).collect()} for more in ({}, {"held_out_only": True})]
    behind = Counter(u for u, _, _ in rows)
    behind = {u: n - int(n * 7 // 10) for u, n in behind.items()}
    assert both[1] == {(u, h): v for (u, h), v in both[0].items() if h <= behind[u]} and len(both[1]) < len(both[0])
    seen = []
    monkeypatch.setattr(ev, "error_by_horizon", lambda d, *a, real=ev.error_by_horizon: seen.append(d.count()) or real(d, *a))
    spark.range(200).selectExpr("id % 4 as user_id", "timestamp'2024-01-01 00:00:00' + make_dt_interval(int(id div 4) div 2) as ts").write.parquet(f"{tmp_path}/events.parquet")
    out = queries()["forecast_rmse_by_horizon"](spark, str(tmp_path)).collect()
    assert seen == [4 * 8] and sorted((r.h, r.n) for r in out) == [(h, 4 * h) for h in range(1, 9)]      # before: 300 steps a user


def test_shards_grow_with_the_table(spark, tmp_path, monkeypatch):
    import glob

    from loam.operators.transform import FeatureSpec
    from loam.sources import sinks
    monkeypatch.setattr(sinks, "SHARD_ROWS", 100, raising=False)
    spec = FeatureSpec(key=("id",), numeric=("x",), categorical=(), target="y")
    for n, files in ((350, 4), (1001, 11)):
        df = spark.range(n).selectExpr("id", "id as x", "id as y")
        sinks.write_feature_shards(df, spec, f"{tmp_path}/f{n}", num_shards=4)
        sinks.write_delimited(df, f"{tmp_path}/d{n}", num_shards=4)
        assert len(glob.glob(f"{tmp_path}/f{n}/part-*")) == len(glob.glob(f"{tmp_path}/d{n}/part-*")) == files
        assert spark.read.parquet(f"{tmp_path}/f{n}").count() == n
