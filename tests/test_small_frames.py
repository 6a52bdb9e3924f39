"""Hand-made edge cases: nulls/empties, constant columns, unseen categories, ties, one row, empty input."""

from pyspark.sql import functions as F

from loam.functions.text import clean_sms, tokenize
from loam.operators.analyze import describe, exact_quantiles, vocabulary
from loam.operators.evaluate import auroc_exact
from loam.operators.text import drop_incomplete
from loam.operators.transform import (FeaturePipeline, MinMax, QuantileBucketize, Vocabulary, ZScore,
                                      bucket_of)
from loam.sources.readers import apply_defaults


def test_nulls_and_empty_strings(spark):
    df = spark.createDataFrame([(1, None, ""), (2, "a", "b"), (3, "", None)], "k int, a string, b string")
    assert [r.k for r in drop_incomplete(df, ["a", "b"]).collect()] == [2]
    filled = apply_defaults(df, {"a": "NA"})
    assert {r.k: r.a for r in filled.collect()} == {1: "NA", 2: "a", 3: ""}
    t = spark.createDataFrame([("  ..a,,b  ",), ("",)], "s string").select(tokenize("s").alias("t")).collect()
    assert t[0].t == ["a", "b"] and t[1].t == []
    assert spark.createDataFrame([('\t"Hi"\n ',)], "s string").select(clean_sms("s")).first()[0] == "hi"


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    out = FeaturePipeline([MinMax("x", "m"), ZScore("x", "z")]).fit(df).transform(df).collect()
    assert all(r.m == 0.0 and r.z == 0.0 for r in out)


def test_unseen_category_and_ties(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    voc = {r.value: r.id for r in vocabulary(train.withColumnRenamed("v", "value"), "value").collect()}
    assert voc == {"c": 0, "b": 1, "a": 2}           # frequency desc, ties by value desc
    ft = FeaturePipeline([Vocabulary("v", "vid")], keep=["v"]).fit(train)
    test = spark.createDataFrame([("a",), ("zzz",), (None,)], "v string")
    got = {r.v: r.vid for r in ft.transform(test).collect()}
    assert got == {"a": 2, "zzz": -1, None: -1}


def test_one_row_table(spark):
    df = spark.createDataFrame([(3.5,)], "x double")
    q = exact_quantiles(df, "x", [0.0, 0.5, 1.0]).first()
    assert (q.q00, q.q50, q.q100) == (3.5, 3.5, 3.5)
    ft = FeaturePipeline([QuantileBucketize("x", "b", 4)]).fit(df)
    assert ft.transform(df).first().b == 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, k string")
    assert exact_quantiles(df, "x", [0.5]).count() == 0
    assert describe(df, ["x"]).count() == 0 or describe(df, ["x"]).first()["count"] == 0
    ft = FeaturePipeline([ZScore("x", "z"), MinMax("x", "m")]).fit(df)
    assert ft.transform(df).count() == 0


def test_bucket_of_left_closed(spark):
    df = spark.createDataFrame([(0.9,), (1.0,), (2.5,), (None,)], "x double")
    got = [r.b for r in df.select(bucket_of(F.col("x"), [1.0, 2.0]).alias("b")).collect()]
    assert got == [0, 1, 2, None]


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    assert auroc_exact(df, "y", "s").first().auc == 0.875


def test_nearest_centroid_chunked_matches_single_pack(spark, monkeypatch):
    import random

    from loam.operators import vector as VO
    rnd = random.Random(3)
    pts = spark.createDataFrame([(i, [rnd.uniform(-1, 1) for _ in range(4)]) for i in range(200)],
                                "k long, v array<double>")
    cents = spark.createDataFrame([(j, [rnd.uniform(-1, 1) for _ in range(4)]) for j in range(37)],
                                  "cid int, c array<double>")
    one = {r.k: r.centroid for r in VO.nearest_centroid(pts, "v", cents, "cid", "c").collect()}
    monkeypatch.setattr(VO, "CENTROID_CHUNK", 8)
    more = cents.union(spark.createDataFrame([(-1, None)], cents.schema))
    packs = {r.k: r.centroid for r in VO.nearest_centroid(pts, "v", more, "cid", "c").collect()}
    assert one == packs and -1 not in packs.values()


def test_a_probe_of_several_rows_is_refused(spark):
    import pytest

    from loam.operators import vector as VO
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "k long, v array<double>")
    assert VO.similar_by_vector(df, "k", "v", df.filter("k = 1")).count() == 2
    with pytest.raises(Exception, match="more than one row"):
        VO.similar_by_vector(df, "k", "v", df).collect()


def test_forecast_of_short_series(spark):
    from loam.operators.models import ar_forecast
    rows = [("a", i, float(i % 5)) for i in range(40)] + [("b", 0, 500.0)]
    got = ar_forecast(spark.createDataFrame(rows, "g string, t int, v double"), ["g"], ["t"], "v", 3, 4).collect()
    assert {r.g for r in got} == {"a"} and sorted(r.h for r in got) == [1, 2, 3, 4]


def test_changed_step_parameters_are_refused(spark, tmp_path):
    import pytest

    from loam.operators.transform import FeaturePipeline, FittedTransform, FixedBucketize
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    FeaturePipeline([FixedBucketize("x", "b", (2.0,))]).fit(df).save(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="do not match"):
        FittedTransform.load(spark, str(tmp_path / "t"), [FixedBucketize("x", "b", (7.0,))])


def test_skipped_lines_and_blank_lines(spark, tmp_path):
    from loam.sources.readers import read_delimited
    (tmp_path / "f.csv").write_text("junk\n\n1,a\n\n2,\n")
    for n in (1, 2):
        got = read_delimited(spark, str(tmp_path / "f.csv"), "k int, s string", skip_lines=n, defaults={"s": "none"}).collect()
        assert sorted(tuple(r) for r in got) == [(1, "a"), (2, "none")]


def test_small_fractions_sample(spark):
    from loam.operators.split import random_fraction
    df = spark.range(200_000)
    assert 0 < random_fraction(df, "id", 1e-4).count() < 60
    assert random_fraction(df, "id", 4e-7).count() <= 3


def test_approx_quantile_buckets_close_to_exact(spark):
    df = spark.range(10000).selectExpr("cast(id as double) as x")
    exact = FeaturePipeline([QuantileBucketize("x", "b", 4)]).fit(df).boundaries["b"]
    approx = FeaturePipeline([QuantileBucketize("x", "b", 4, exact=False, epsilon=0.01)]).fit(df).boundaries["b"]
    assert all(abs(a - e) <= 0.01 * 10000 + 1 for a, e in zip(approx, exact))


def test_read_delimited_skips_n_lines_per_file(spark, tmp_path):
    from loam.sources.readers import read_delimited
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text("# generated\n# a;b\n" + "".join(f"{i}{j};x{j}\n" for j in range(5)))
    df = read_delimited(spark, str(tmp_path / "*.csv"), "a INT, b STRING", sep=";", skip_lines=2)
    got = sorted((r.a, r.b) for r in df.collect())
    assert got == sorted((int(f"{i}{j}"), f"x{j}") for i in range(3) for j in range(5))
    one = read_delimited(spark, str(tmp_path / "part0.csv"), "a STRING, b STRING", sep=";", skip_lines=1)
    assert one.count() == 6


def test_fraction_cut_uses_decimal_ratio(spark):
    from loam.operators.series import time_split
    df = spark.range(670).selectExpr("id", "0 as g")
    n_train = time_split(df, ["g"], ["id"], train_fraction=0.7).filter("split = 'train'").count()
    assert n_train == 469          # floor(670 * 7 / 10), not floor(670 * 0.69999999999999996)


def test_release_cached(spark):
    from pyspark.sql import functions as F

    from loam.functions.text import tokenize
    from loam.operators.text import tfidf
    from loam.session import release_cached
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c")], "doc_id long, text string")
    w, _ = tfidf(docs, "doc_id", tokenize(F.col("text")), top_k=2)
    rows = w.collect()
    assert len(rows) > 0
    assert release_cached() >= 1
    assert release_cached() == 0
