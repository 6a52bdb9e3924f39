"""Array -> rows helpers.

``explode``/``posexplode`` make the optimizer infer ``size(arr) > 0 AND
isnotnull(arr)`` and push it below the projection, where the (possibly
expensive) array expression is inlined and evaluated a second time.  The
``_outer`` generators infer nothing; dropping the null rows they add for empty
arrays restores the plain semantics with a single evaluation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, keep: list, arr: Column | str, out: str = "value") -> DataFrame:
    """Rows of ``keep`` + one row per array element, null elements included; empty/null arrays give no rows."""
    a = F.col(arr) if isinstance(arr, str) else arr
    rows = df.select(*keep, F.posexplode_outer(a).alias("_lm_pos", out))
    return rows.filter(F.col("_lm_pos").isNotNull()).drop("_lm_pos")


def posexplode_rows(df: DataFrame, keep: list, arr: Column | str, pos: str = "pos", out: str = "value",
                    pos_type: str | None = None) -> DataFrame:
    """Rows of ``keep`` + (position, element) per element; empty/null arrays give no rows."""
    a = F.col(arr) if isinstance(arr, str) else arr
    res = df.select(*keep, F.posexplode_outer(a).alias(pos, out)).filter(F.col(pos).isNotNull())
    return res.withColumn(pos, F.col(pos).cast(pos_type)) if pos_type else res


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` (and the lambdas in it) reads it.

    A column read inside a lambda is otherwise inlined and evaluated again for every element.
    """
    return F.transform(F.array(value), use)[0]


def _run_starts(entries: Column, same) -> Column:
    """Places (0-based) of the sorted, non-empty ``entries`` that differ from the one before."""
    return F.filter(F.sequence(F.lit(0), F.size(entries) - 1), lambda i: (i == 0) | ~same(F.get(entries, i), F.get(entries, i - 1)))


def count_distinct_values(arr: Column) -> Column:
    """array<struct(token, cnt)>: the array's different values and how often each occurs; null for an empty or null one.

    Sorted within the row, so nothing is shuffled.
    """
    def runs(s):
        return F.when(F.size(s) > 0, let(_run_starts(s, lambda a, b: a.eqNullSafe(b)), lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(s, i).alias("token"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).cast("long").alias("cnt")))))
    return let(F.sort_array(arr), runs)


def sum_by_value(entries: Column) -> Column:
    """array<struct(token, x)>: the sum of ``x`` for each ``token`` of an array of such structs; null for an empty or null one."""
    def runs(s):
        def total(at, i, k):
            run = F.slice(s, i + 1, F.coalesce(F.get(at, k + 1), F.size(s)) - i)
            return F.aggregate(run, F.lit(0.0), lambda acc, e: acc + e["x"])
        return F.when(F.size(s) > 0, let(_run_starts(s, lambda a, b: a["token"].eqNullSafe(b["token"])), lambda at: F.transform(
            at, lambda i, k: F.struct(F.get(s, i)["token"].alias("token"), total(at, i, k).alias("x")))))
    return let(F.sort_array(entries), runs)
