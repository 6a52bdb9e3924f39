"""Series-window queries (WN9, WN10, WN12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.operators import series as S
from loam.plans.common import r6
from loam.plans.registry import register, t
from loam.plans.q_split import SQL_EVENTS_RN

N_IN, N_OUT = 40, 10


@register("lag_features", f"""
SELECT event_id, rn AS t,
       lag(value, 1) OVER w AS value_lag1, lag(value, 2) OVER w AS value_lag2, lag(value, 3) OVER w AS value_lag3,
       round(sin(2 * pi() / 24.0 * rn), 6) + 0.0 AS t_sin, round(cos(2 * pi() / 24.0 * rn), 6) + 0.0 AS t_cos
FROM {SQL_EVENTS_RN} r WINDOW w AS (PARTITION BY user_id ORDER BY rn)
""", ids=("WN12",))
def lag_features(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    lf = S.lag_features(e, ["user_id"], ["ts", "event_id"], "value", [1, 2, 3], period=24.0)
    return lf.select("event_id", "t", "value_lag1", "value_lag2", "value_lag3",
                     r6("t_sin").alias("t_sin"), r6("t_cos").alias("t_cos"))


@register("sliding_windows", f"""
WITH r AS {SQL_EVENTS_RN}
SELECT a.user_id, a.rn AS start, CASE WHEN b.rn - a.rn < {N_IN} THEN 'x' ELSE 'y' END AS part,
       CASE WHEN b.rn - a.rn < {N_IN} THEN b.rn - a.rn ELSE b.rn - a.rn - {N_IN} END AS pos, b.value
FROM r a JOIN r b ON a.user_id = b.user_id AND b.rn BETWEEN a.rn AND a.rn + {N_IN + N_OUT - 1}
WHERE a.rn + {N_IN + N_OUT - 1} <= a.n
""", ids=("WN9",))
def sliding_windows(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    w = S.sliding_windows(e, ["user_id"], ["ts", "event_id"], "value", N_IN, N_OUT)
    parts = w.select("user_id", "start", F.inline(F.array(
        F.struct(F.lit("x").alias("part"), F.col("x").alias("a")),
        F.struct(F.lit("y").alias("part"), F.col("y").alias("a")))))
    return parts.select("user_id", "start", "part", F.posexplode_outer("a").alias("pos", "value")) \
        .select("user_id", "start", "part", F.col("pos").cast("bigint").alias("pos"), "value")


@register("series_as_array", f"""
SELECT user_id, CAST((rn - 1) // 16 AS BIGINT) AS chunk_id, min(rn) AS first_t, count(*) AS n_values,
       string_agg(CAST(value AS VARCHAR), ',' ORDER BY rn) AS values_text
FROM {SQL_EVENTS_RN} r GROUP BY user_id, (rn - 1) // 16
""", ids=("WN10",))
def series_as_array(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    c = S.series_chunks(e, ["user_id"], ["ts", "event_id"], "value", chunk=16)
    return c.select("user_id", "chunk_id", "first_t", F.size("values").cast("bigint").alias("n_values"),
                    F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("values_text"))
