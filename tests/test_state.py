"""Mergeable states, noise and weighted draws on awkward small frames, and the sketch's rank error as DuckDB counts it."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from loam.functions.hashing import normal_deviate
from loam.operators import split as SP
from loam.operators import state as ST
from loam.operators import transform as TR
from loam.plans.q_state import STATE_FEATURES, daily_states
from loam.session import scratch_path
from tests.conftest import SF_SMALL

SCHEMA = "k int, x double, c string, feature string"
ROWS = [(i, float(i * i % 37), "abc"[i % 3], "clash") for i in range(60)] + [(60, None, None, None), (61, 1e9 + 0.25, "a", "z")]
STEPS = [TR.ZScore("x", "z"), TR.ZScore("x", "z1", ddof=1), TR.MinMax("x", "m"), TR.QuantileBucketize("x", "q", 2), TR.Vocabulary("c", "v", top_k=2)]


def transformed(ft, df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in ft.transform(df).collect()), key=repr)


@pytest.mark.parametrize("cut", [0, 1, 30, 62])
def test_merged_state_is_the_state_of_all(spark, cut):
    df = spark.createDataFrame(ROWS, SCHEMA)
    pipe = TR.FeaturePipeline(STEPS, keep=["k", "feature"])
    a, b = ST.FitState.of(pipe, df.filter(F.col("k") < cut)), ST.FitState.of(pipe, df.filter(F.col("k") >= cut))
    path = scratch_path(spark, "state-test")
    a.save(path)
    both = ST.FitState.load(spark, path, pipe).merge(b).finish()
    once, fit = ST.FitState.of(pipe, df).finish(), pipe.fit(df)
    assert transformed(both, df) == transformed(once, df)
    for key, v in fit.stats.items():
        assert math.isclose(both.stats[key], v, rel_tol=1e-12)
    assert both.vocab_sizes == fit.vocab_sizes
    assert sorted(map(tuple, both.vocabs["v"].collect())) == sorted(map(tuple, fit.vocabs["v"].collect()))


def test_state_of_nothing(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).filter("k < 0")
    pipe = TR.FeaturePipeline(STEPS, keep=["k"])
    empty = ST.FitState.of(pipe, df)
    merged = empty.merge(ST.FitState.of(pipe, df))
    row = merged.numeric.first()
    assert (row["feature"], row["n"], row["mean"], row["min"], row["max"]) == ("x", 0, None, None, None)
    ft = merged.finish()
    assert ft.boundaries == {"q": []} and ft.vocab_sizes == {"v": 0} and ft.transform(df).count() == 0
    assert ST.boundaries(merged.numeric, 4).count() == 0
    assert ST.numeric_state(df, []).count() == 0


def test_states_by_null_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None)], "g string, x double")
    s = ST.numeric_state(df, ["x"], by=["g"])
    m = {r["g"]: r for r in ST.merge_numeric(s.unionByName(s), by=["g"]).collect()}
    assert m[None]["n"] == 4 and m[None]["mean"] == 2.0 and m[None]["m2"] == 4.0 and m["a"]["n"] == 2


def test_wrong_steps_are_refused(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    a = ST.FitState.of(TR.FeaturePipeline(STEPS), df)
    with pytest.raises(ValueError):
        a.merge(ST.FitState.of(TR.FeaturePipeline(STEPS[:1]), df))


def test_sketch_rank_error(spark):
    """Cuts of merged daily sketches, their exact ranks counted by DuckDB: within 1 % for every feature."""
    probs = [i / 10 for i in range(1, 10)]
    cuts = ST.boundaries(ST.merge_numeric(daily_states(spark, SF_SMALL).drop("day")), 10).collect()
    con = duckdb.connect()
    assert len(cuts) == 9 * len(STATE_FEATURES)
    for r in cuts:
        below, upto = con.execute(f"SELECT avg(CAST(CAST({r['feature']} AS DOUBLE) < ? AS INTEGER)), avg(CAST(CAST({r['feature']} AS DOUBLE) <= ? AS INTEGER)) "
                                  f"FROM read_parquet('{SF_SMALL}/lineitem.parquet')", [r["boundary"]] * 2).fetchone()
        assert below - 0.01 <= probs[r["i"] - 1] <= upto + 0.01


def test_normal_deviates(spark):
    m = spark.range(50_000).select(normal_deviate("id", 7).alias("z"), normal_deviate("id", 8).alias("w")).agg(
        F.avg("z"), F.stddev("z"), F.kurtosis("z"), F.corr("z", "w")).first()
    assert abs(m[0]) < 0.02 and abs(m[1] - 1) < 0.02 and abs(m[2]) < 0.1 and abs(m[3]) < 0.02


def test_weighted_sample(spark):
    df = spark.createDataFrame([(i, float(w)) for i, w in enumerate([0, -1, 5, 5, 1e9])] + [(9, None)], "k int, w double")
    assert sorted(r["k"] for r in SP.weighted_sample(df, "k", "w", 10).collect()) == [2, 3, 4]
    assert [r["k"] for r in SP.weighted_sample(df, "k", "w", 1).collect()] == [4]
    assert SP.weighted_sample(df.limit(0), "k", "w", 3).count() == 0
    heavy = spark.range(2000).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, 9.0).otherwise(1.0).alias("w"))
    even = sum(r["k"] % 2 == 0 for r in SP.weighted_sample(heavy, "k", "w", 200).collect())
    assert 165 <= even <= 195
