"""Mergeable fits, noise and weighted draws (IO11, FT16, AG4, AG7, FT4, SF19, WN5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.operators import series as S
from loam.operators import split as SP
from loam.operators import state as ST
from loam.plans.common import lineitem_key, r6, split2, sql_md5_int
from loam.plans.q_features import SQL_FIT_APPLY, lineitem_pipeline, round_lineitem_features
from loam.plans.q_split import SQL_EVENTS_RN
from loam.plans.registry import register, t
from loam.session import scratch_path

# ----------------------------------------------------------------------------- refit


@register("incremental_refit", SQL_FIT_APPLY, ids=("IO11", "FT16", "FT4"))
def incremental_refit(spark, sf):
    """A state of the older train rows is saved; the newer rows' state is merged into it, and the older are not read again."""
    li = t(spark, sf, "lineitem").withColumn("split", split2(lineitem_key()))
    train, old = li.filter("split = 'train'"), F.year("l_shipdate") < 1997
    path = scratch_path(spark, "state")
    ST.FitState.of(lineitem_pipeline(), train.filter(old)).save(path)
    merged = ST.FitState.load(spark, path, lineitem_pipeline()).merge(ST.FitState.of(lineitem_pipeline(), train.filter(~old)))
    return round_lineitem_features(merged.finish().transform(li.filter("split = 'eval'")))


STATE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def daily_states(spark, sf):
    """One state row a day and feature, as a daily job would keep them."""
    li = t(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"), *STATE_FEATURES)
    path = scratch_path(spark, "daily-states")
    ST.numeric_state(li, STATE_FEATURES, by=["day"]).write.parquet(path)
    return spark.read.parquet(path)


@register("merged_state_stats", f"""
WITH l AS (SELECT year(l_shipdate) AS year, unnest({STATE_FEATURES}) AS feature,
                  unnest([{', '.join(f'CAST({f} AS DOUBLE)' for f in STATE_FEATURES)}]) AS x FROM lineitem)
SELECT CAST(year AS INTEGER) AS year, feature, count(x) AS n, round(avg(x), 6) AS mean, round(stddev_samp(x), 5) AS std, min(x) AS min, max(x) AS max
FROM l GROUP BY 1, 2
""", ids=("AG4", "AG6", "IO12"))
def merged_state_stats(spark, sf):
    """Yearly statistics from daily states: no row of the table is read again."""
    m = ST.merge_numeric(daily_states(spark, sf).withColumn("year", F.year("day")).drop("day"), by=["year"])
    return m.select("year", "feature", "n", r6("mean").alias("mean"), F.round(ST.std_of(1), 5).alias("std"), "min", "max")


@register("merged_sketch_boundaries", """
WITH l AS (SELECT unnest(['l_discount', 'l_tax']) AS feature, unnest([CAST(l_discount AS DOUBLE), CAST(l_tax AS DOUBLE)]) AS x FROM lineitem),
q AS (SELECT feature, quantile_disc(x, [0.25, 0.5, 0.75]) AS b FROM l GROUP BY feature)
SELECT feature, unnest([1, 2, 3]) AS i, unnest(b) AS boundary FROM q
""", ids=("AG7", "FT4"))
def merged_sketch_boundaries(spark, sf):
    """Quartile boundaries from merged daily sketches, of features whose values are far apart in rank: the sketch's
    cuts are then the exact ones.  Features with close values are held to the rank error in the tests."""
    states = daily_states(spark, sf).filter(F.col("feature").isin("l_discount", "l_tax")).drop("day")
    return ST.boundaries(ST.merge_numeric(states), 4)


# ----------------------------------------------------------------------------- noise, draws


def _sql_uniform(key: str, seed: int) -> str:
    inner = f"'{seed}:' || CAST({key} AS VARCHAR)"
    return f"((CAST({sql_md5_int(inner)} AS DOUBLE) + 0.5) / CAST({1 << 60} AS DOUBLE))"


def _sql_normal(key: str, seed: int) -> str:
    return f"(sqrt(-2.0 * ln({_sql_uniform(key, 2 * seed)})) * cos(2.0 * pi() * {_sql_uniform(key, 2 * seed + 1)}))"


@register("generate_noisy_series", f"""
SELECT user_id, event_id, CAST(rn AS BIGINT) AS t, round(sin(pi() * rn / 12.0) + rn / 50.0 + 0.1 * {_sql_normal('event_id', 1)}, 6) AS signal,
       round(-rn + 1.0 * {_sql_normal('event_id', 2)}, 6) AS falling,
       round(CASE WHEN rn % 2 = 0 THEN 2 * rn ELSE -2 * rn END + 0.5 * {_sql_normal('event_id', 3)}, 6) AS alternating FROM {SQL_EVENTS_RN} r
""", ids=("SF19",))
def generate_noisy_series(spark, sf):
    """All three generators with their noise."""
    e = t(spark, sf, "events").select("event_id", "user_id", "ts")
    r, at, key = S.series_index(e, ["user_id"], ["ts", "event_id"], out="t"), F.col("t"), F.col("event_id")
    return r.select("user_id", "event_id", "t", r6(S.noisy(S.signal(at, 12.0, 50.0), key, 0.1, seed=1)).alias("signal"),
                    r6(S.noisy(S.falling(at), key, 1.0, seed=2)).alias("falling"),
                    r6(S.noisy(S.alternating(at), key, 0.5, seed=3)).alias("alternating"))


@register("weighted_sample", f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0
ORDER BY -ln({_sql_uniform('o_orderkey', 42)}) / CAST(o_totalprice AS DOUBLE), o_orderkey LIMIT 100
""", ids=("WN5",))
def weighted_sample(spark, sf):
    """A hundred orders, drawn by their price."""
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return SP.weighted_sample(o, "o_orderkey", "o_totalprice", 100)
