"""Model search, models per series and metrics of fitted models (ML6, ML7, ML9, EV3, EV5, EV6), with normal equations as oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.operators import evaluate as ev
from loam.operators import models as M
from loam.operators import search as SE
from loam.operators import split as SP
from loam.plans.common import LINEITEM_MODELS, SQL_LINEITEM_KEY, lineitem_key, r6, sql_predict
from loam.plans.q_split import sql_seeded
from loam.plans.registry import register, t

# ----------------------------------------------------------------------------- normal equations in SQL


def _det(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    terms = [f"{'-' if j % 2 else '+'} {m[0][j]} * ({_det([row[:j] + row[j + 1:] for row in m[1:]])})" for j in range(len(m))]
    return f"({' '.join(terms)})"


def sql_moments(y: str, xs: list[str]) -> str:
    """Means and population covariances of y and xs, as a select list."""
    out = [f"count(*) AS n, avg({y}) AS my, var_pop({y}) AS vy"]
    for i, x in enumerate(xs):
        out.append(f"avg({x}) AS m{i}, covar_pop({y}, {x}) AS y{i}")
        out += [f"covar_pop({x}, {xs[j]}) AS c{i}{j}" for j in range(len(xs))]
    return ", ".join(out)


def sql_ridge(places: list[int], penalty: float) -> tuple[str, list[str]]:
    """(b0, [b...]) over columns of :func:`sql_moments`, by Cramer's rule."""
    a = [[f"(c{i}{j} + {float(penalty) if i == j else 0.0!r})" for j in places] for i in places]
    full = _det(a)
    bs = [f"({_det([[f'y{i}' if q == k else a[r][q] for q in range(len(places))] for r, i in enumerate(places)])} / {full})"
          for k in range(len(places))]
    return "my" + "".join(f" - {b} * m{i}" for b, i in zip(bs, places, strict=True)), bs


# ----------------------------------------------------------------------------- ML6

SEARCH_FEATURES = ["l_quantity", "l_discount", "l_tax"]
SEARCH_SETS = {"quantity": ["l_quantity"], "discount-tax": ["l_discount", "l_tax"], "all": SEARCH_FEATURES}
SEARCH_PENALTIES = [0.0, 0.01, 1.0, 100.0]
_SQL_LI_FOLD = f"CAST({sql_seeded(SQL_LINEITEM_KEY, 42, 1 << 60)} % 5 AS INTEGER)"


def _sql_search() -> str:
    """The three coefficients are q0, q1, q2 and the intercept b0."""
    fits = []
    for name, cols in SEARCH_SETS.items():
        places = [SEARCH_FEATURES.index(c) for c in cols]
        for p in SEARCH_PENALTIES:
            b0, bs = sql_ridge(places, p)
            q = [bs[places.index(i)] if i in places else "0.0" for i in range(3)]
            fits.append(f"SELECT held, '{name}' AS features, {p!r}::DOUBLE AS penalty, {len(cols)} AS width, {b0} AS b0, "
                        + ", ".join(f"{x} AS q{i}" for i, x in enumerate(q)) + " FROM tr")
    m = sql_moments("y", ["x0", "x1", "x2"])
    return f"""
WITH s AS (SELECT l_extendedprice AS y, l_quantity AS x0, l_discount AS x1, l_tax AS x2, {_SQL_LI_FOLD} AS fold FROM lineitem),
tr AS (SELECT f.fold AS held, {m} FROM (SELECT DISTINCT fold FROM s) f JOIN s ON s.fold <> f.fold GROUP BY f.fold
       UNION ALL SELECT -1, {m} FROM s),
fits AS ({' UNION ALL '.join(fits)}),
te AS (SELECT features, penalty, any_value(width) AS width, fold, sum((y - b0 - q0 * x0 - q1 * x1 - q2 * x2) ** 2) AS sse,
              var_pop(y) * count(*) AS sst, count(*) AS n
       FROM s JOIN fits ON fits.held = s.fold GROUP BY features, penalty, fold),
sc AS (SELECT features, penalty, any_value(width) AS width, avg(1 - sse / sst) AS score, avg(sqrt(sse / n)) AS rmse
       FROM te GROUP BY features, penalty)
SELECT sc.features, sc.penalty, round(score, 6) AS score, round(rmse, 3) AS rmse, round(w.b0, 2) AS intercept,
       round(w.q0, 3) + 0.0 AS coef_quantity, round(w.q1, 2) + 0.0 AS coef_discount, round(w.q2, 2) + 0.0 AS coef_tax,
       row_number() OVER (ORDER BY score DESC, sc.width, sc.penalty DESC, sc.features DESC) = 1 AS best
FROM sc JOIN fits w ON w.held = -1 AND w.features = sc.features AND w.penalty = sc.penalty
"""


def search_points(spark, sf):
    li = t(spark, sf, "lineitem").select(*SEARCH_FEATURES, "l_extendedprice", lineitem_key().alias("k"))
    return SE.ridge_search(SP.kfold_assign(li, "k", 5, seed=42), "l_extendedprice", SEARCH_SETS, SEARCH_PENALTIES, "fold")


@register("ridge_search_best", _sql_search(), ids=("ML6",))
def ridge_search_best(spark, sf):
    """Every grid point's cross-validated score, the model on all rows, and which point is best."""
    p = search_points(spark, sf)

    def coef(name, digits):
        at = [F.when(F.col("features") == s, F.get("coefficients", F.lit(cols.index(name)))) for s, cols in SEARCH_SETS.items() if name in cols]
        return (F.round(F.coalesce(*at, F.lit(0.0)), digits) + 0.0)

    return p.select("features", "penalty", r6("score").alias("score"), F.round("rmse", 3).alias("rmse"), F.round("intercept", 2).alias("intercept"),
                    coef("l_quantity", 3).alias("coef_quantity"), coef("l_discount", 2).alias("coef_discount"),
                    coef("l_tax", 2).alias("coef_tax"), "best")


# ----------------------------------------------------------------------------- ML7

_SQL_DOC_FOLDS = f"""(SELECT l.doc_id, CAST(quality AS DOUBLE) AS y, ln(CAST(n_chars AS DOUBLE)) AS x0, CAST(lang = 'en' AS INTEGER)::DOUBLE AS x1,
  CAST(len(string_split(text, chr(10))) AS DOUBLE) AS x2, CAST({sql_seeded('l.doc_id', 42, 1 << 60)} % 5 AS INTEGER) AS fold
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
_B0, _BS = sql_ridge([0, 1, 2], 0.01)


@register("macro_precision_recall_fitted", f"""
WITH s AS (SELECT * FROM {_SQL_DOC_FOLDS}),
tr AS (SELECT f.fold AS held, {sql_moments('y', ['x0', 'x1', 'x2'])} FROM (SELECT DISTINCT fold FROM s) f JOIN s ON s.fold <> f.fold GROUP BY f.fold),
b AS (SELECT held, {_B0} AS b0, {', '.join(f'{x} AS q{i}' for i, x in enumerate(_BS))} FROM tr),
p AS (SELECT s.fold, CAST(y AS INTEGER) AS quality, CAST(b0 + q0 * x0 + q1 * x1 + q2 * x2 >= 0.75 AS INTEGER) AS pred FROM s JOIN b ON b.held = s.fold),
c AS (SELECT fold, unnest([quality, pred]) AS cls, unnest([1, 0]) AS t, unnest([CAST(quality = pred AS INTEGER), 0]) AS tp, unnest([0, 1]) AS p FROM p),
j AS (SELECT fold, cls, sum(t) AS support, sum(tp) AS tp, sum(p) AS predicted FROM c GROUP BY fold, cls)
SELECT fold, round(avg(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END), 6) AS macro_precision,
       round(avg(CASE WHEN support > 0 THEN tp / support ELSE 0.0 END), 6) AS macro_recall FROM j GROUP BY fold
""", ids=("ML7",))
def macro_precision_recall_fitted(spark, sf):
    """A model fitted for every fold on the others, its macro precision and recall on the fold."""
    docs = t(spark, sf, "documents").select("doc_id", F.ln(F.col("n_chars").cast("double")).alias("log_chars"),
                                            (F.col("lang") == "en").cast("double").alias("is_en"),
                                            F.size(F.split("text", "\n")).cast("double").alias("n_lines"))
    d = SP.kfold_assign(t(spark, sf, "labels").select("doc_id", "quality").join(docs, "doc_id"), "doc_id", 5, seed=42)
    p = SE.fold_predictions(d, ["log_chars", "is_en", "n_lines"], "quality", "fold", penalty=0.01)
    m = ev.macro_precision_recall(p.withColumn("pred", (F.col("prediction") >= 0.75).cast("int")), "quality", "pred", by="fold")
    return m.select("fold", r6("macro_precision").alias("macro_precision"), r6("macro_recall").alias("macro_recall"))


# ----------------------------------------------------------------------------- ML9, EV6

AR_PENALTY = 0.05
_AR_B0, _AR_BS = sql_ridge([0, 1, 2], AR_PENALTY)
HORIZONS = (10, 20, 50, 100, 200, 300)


def _sql_ar_by_user(horizon: int, cut: str) -> str:
    """Tables r (daily counts with lags), models b and forecasts f by user; models see the days up to ``cut``."""
    return f"""
WITH RECURSIVE d AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(count(*) AS DOUBLE) AS y FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER w AS t, count(*) OVER (PARTITION BY user_id) AS m,
             lag(y, 1) OVER w AS x0, lag(y, 2) OVER w AS x1, lag(y, 3) OVER w AS x2
      FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day)),
c AS (SELECT user_id, any_value({cut}) AS cut FROM r GROUP BY user_id),
b AS (SELECT user_id, n, {_AR_B0} AS b0, {', '.join(f'{x} AS q{i}' for i, x in enumerate(_AR_BS))}
      FROM (SELECT r.user_id, {sql_moments('y', ['x0', 'x1', 'x2'])} FROM r JOIN c USING (user_id) WHERE x2 IS NOT NULL AND t <= cut GROUP BY r.user_id)),
f AS (SELECT r.user_id, 0 AS h, y AS y1, x0 AS y2, x1 AS y3 FROM r JOIN c USING (user_id) WHERE t = cut AND cut >= 3
      UNION ALL SELECT f.user_id, h + 1, b0 + q0 * y1 + q1 * y2 + q2 * y3, y1, y2 FROM f JOIN b USING (user_id) WHERE h < {horizon})"""


def _daily_counts(spark, sf):
    return t(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("n"))


@register("ar_forecast_by_user", _sql_ar_by_user(max(HORIZONS), "m") + f"""
SELECT f.user_id, h, round(y1, 5) AS forecast, round(q0, 6) AS lag1, round(q1, 6) AS lag2, round(q2, 6) AS lag3
FROM f JOIN b USING (user_id) WHERE h IN {HORIZONS}
""", ids=("ML9",))
def ar_forecast_by_user(spark, sf):
    """One AR(3) model of every user's daily counts, its coefficients and its forecasts at horizons 10 to 300."""
    f = M.ar_forecast_by_series(_daily_counts(spark, sf), ["user_id"], ["day"], "n", p=3, horizon=max(HORIZONS), penalty=AR_PENALTY,
                                with_model=True)
    return f.filter(F.col("h").isin(*HORIZONS) & F.col("user_id").isNotNull()).select(
        "user_id", "h", F.round("forecast", 5).alias("forecast"), *[r6(F.col("b")[i]).alias(f"lag{i + 1}") for i in range(3)])


@register("forecast_rmse_by_horizon", _sql_ar_by_user(max(HORIZONS), "CAST(floor(m * 7 / 10) AS BIGINT)") + """,
e AS (SELECT h, sum((r.y - y1) ** 2) AS sse, sum(abs(r.y - y1)) AS sae, count(*) AS k
      FROM f JOIN c USING (user_id) JOIN r ON r.user_id = f.user_id AND r.t = c.cut + f.h WHERE h > 0 GROUP BY h)
SELECT h, round(sqrt(sum(sse) OVER o / sum(k) OVER o), 6) AS rmse, round(sum(sae) OVER o / sum(k) OVER o, 6) AS mae,
       CAST(sum(k) OVER o AS BIGINT) AS n FROM e WINDOW o AS (ORDER BY h)
""", ids=("EV6", "ML9"))
def forecast_rmse_by_horizon(spark, sf):
    """Error of the users' forecasts over their first h steps, for every h: models see 70 % of each series."""
    f = M.ar_forecast_by_series(_daily_counts(spark, sf), ["user_id"], ["day"], "n", p=3, horizon=max(HORIZONS),
                                penalty=AR_PENALTY, train_fraction=0.7, held_out_only=True)
    m = ev.error_by_horizon(f, "h", "actual", "forecast")
    return m.select("h", r6("rmse").alias("rmse"), r6("mae").alias("mae"), "n")


# ----------------------------------------------------------------------------- EV3 in EV5

_M0 = LINEITEM_MODELS[0]
AUC_SLICES = ["l_linestatus", "year", "l_linenumber"]


@register("sliced_auc", f"""
WITH s AS (SELECT CAST(l_returnflag = 'R' AS BIGINT) AS y, l_extendedprice - {sql_predict(_M0)} AS s, l_linestatus, year(l_shipdate) AS year, l_linenumber FROM lineitem),
t AS (SELECT 'Overall' AS slice_col, '' AS slice_value, y, s FROM s
      {' '.join(f"UNION ALL SELECT '{c}', CAST({c} AS VARCHAR), y, s FROM s" for c in AUC_SLICES)}),
g AS (SELECT slice_col, slice_value, s, sum(y) AS pos, count(*) AS cnt FROM t GROUP BY ALL),
c AS (SELECT *, coalesce(sum(cnt) OVER (PARTITION BY slice_col, slice_value ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT slice_col, slice_value, CASE WHEN sum(pos) > 0 AND sum(cnt) > sum(pos) THEN
         round((sum(pos * (below + (cnt + 1) / 2.0)) - sum(pos) * (sum(pos) + 1) / 2.0) / (sum(pos) * (sum(cnt) - sum(pos))), 6) END AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(cnt) - sum(pos) AS BIGINT) AS n_neg
FROM c GROUP BY slice_col, slice_value
""", ids=("EV3", "EV5"))
def sliced_auc(spark, sf):
    """AUC of a residual as a sign of returned items, overall and by slice."""
    li = t(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("long").alias("y"), (F.col("l_extendedprice") - _M0.predict()).alias("s"),
        "l_linestatus", F.year("l_shipdate").alias("year"), "l_linenumber")
    a = ev.sliced_auroc(li, "y", "s", AUC_SLICES)
    return a.select("slice_col", "slice_value", r6("auc").alias("auc"), "n_pos", "n_neg")
