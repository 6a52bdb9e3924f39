"""Shared fixtures of the registered queries: fixed models, keys, SQL snippets.

Every value here is a parameter of a query, mirrored in Spark and SQL from the
same Python object so the two sides cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loam.functions.hashing import md5_int
from loam.operators.scoring import LinearModel

# Fixed linear models scored against lineitem (target l_extendedprice).
LINEITEM_MODELS = [
    LinearModel("linear-qty", 0.0, {"l_quantity": 1400.0}),
    LinearModel("linear-qty-disc", 2000.0, {"l_quantity": 1350.0, "l_discount": -5000.0}),
]
YEAR_RANGES = [(1995, 1996), (1997, 1998), (1999, 2001)]


def sql_predict(m: LinearModel) -> str:
    expr = f"CAST({float(m.intercept)!r} AS DOUBLE)"
    for f, w in m.coefficients.items():
        expr = f"({expr} + CAST({float(w)!r} AS DOUBLE) * CAST({f} AS DOUBLE))"
    return expr


def sql_year_label(col: str) -> str:
    parts = " ".join(f"WHEN year({col}) BETWEEN {lo} AND {hi} THEN '{lo}-{hi}'" for lo, hi in YEAR_RANGES)
    return f"CASE {parts} END"


def sql_md5_int(expr: str) -> str:
    return f"CAST(('0x' || substr(md5({expr}), 1, 15)) AS BIGINT)"


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def lineitem_key() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


SQL_LINEITEM_KEY = "(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR))"


def split3(key: Column) -> Column:
    """60/20/20 train/valid/test by key fingerprint."""
    b = F.pmod(md5_int(key), F.lit(100))
    return F.when(b < 60, "train").when(b < 80, "valid").otherwise("test")


def sql_split3(key_sql: str) -> str:
    b = f"({sql_md5_int(key_sql)} % 100)"
    return f"CASE WHEN {b} < 60 THEN 'train' WHEN {b} < 80 THEN 'valid' ELSE 'test' END"


def split2(key: Column, train_pct: int = 70) -> Column:
    b = F.pmod(md5_int(key), F.lit(100))
    return F.when(b < train_pct, "train").otherwise("eval")


def sql_split2(key_sql: str, train_pct: int = 70) -> str:
    return f"CASE WHEN ({sql_md5_int(key_sql)} % 100) < {train_pct} THEN 'train' ELSE 'eval' END"


def doc_quality_prob(n_chars: Column) -> Column:
    """Fixed scoring rule for documents: logistic of ln(n_chars) centred at 7."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.ln(n_chars.cast("double")) - F.lit(7.0))))


SQL_DOC_PROB = "(1.0 / (1.0 + exp(-(ln(CAST(n_chars AS DOUBLE)) - 7.0))))"
