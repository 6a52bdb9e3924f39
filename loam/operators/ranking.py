"""Skew-safe ranking primitives: global/grouped row numbers, prefix sums, halo blocks.

Spark's ``row_number() over (partition by g order by t)`` sends every row of a
group to one task, and ``over (order by t)`` sends the whole table to one task.
Both break when one key holds a large share of the rows.  These helpers instead:

1. range-partition + sort on the full ordering key (Spark samples the composite
   key, so a hot group is split over many partitions),
2. tag each row with ``spark_partition_id`` and ``monotonically_increasing_id``
   and checkpoint (both branches below must see the same physical rows),
3. compute per-partition row counts (one row per partition: a proven size bound,
   broadcast) and their running offsets,
4. add the offset to the in-partition position.

Grouped numbering subtracts each group's first global number; per-group starts
are joined back without a hint, so that AQE picks broadcast or shuffle by size.  Windows that must look a few rows
back or ahead (lags, sliding windows) use *halo blocks*: rows are cut into blocks
of at most ``block`` rows per group and the few neighbouring rows are duplicated,
so every window partition is bounded regardless of group size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.session import materialize

PID = "_lm_pid"
MID = "_lm_mid"


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def indexed_sort(df: DataFrame, order_cols: Sequence[str | Column]) -> DataFrame:
    """Globally sorted copy of ``df`` with partition id and in-partition ids, checkpointed."""
    s = (df.orderBy(*_cols(order_cols))
         .withColumn(PID, F.spark_partition_id())
         .withColumn(MID, F.monotonically_increasing_id()))
    return materialize(s)


def _partition_offsets(s: DataFrame, sums: dict[str, Column] | None = None) -> DataFrame:
    """One row per partition: first MID, exclusive running row count (and sums)."""
    aggs = [F.count(F.lit(1)).alias("_lm_n"), F.min(MID).alias("_lm_m0")]
    for name, expr in (sums or {}).items():
        aggs.append(F.sum(expr).alias(f"_lm_s_{name}"))
    parts = s.groupBy(PID).agg(*aggs)
    # Window over at most numPartitions rows: bounded by construction.
    w = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    out = [F.col(PID), F.col("_lm_m0"),
           F.coalesce(F.sum("_lm_n").over(w), F.lit(0)).alias("_lm_off")]
    for name in (sums or {}):
        out.append(F.coalesce(F.sum(f"_lm_s_{name}").over(w), F.lit(0)).alias(f"_lm_soff_{name}"))
    return parts.select(*out)


def global_row_number(df: DataFrame, order_cols: Sequence[str | Column], out: str = "rn") -> DataFrame:
    """1-based row number over a total order, without a single-partition window.

    ``order_cols`` should form a total order (append a unique key) for
    deterministic numbering; inputs of every size take the same path.
    """
    s = indexed_sort(df, order_cols)
    offs = _partition_offsets(s)
    res = s.join(F.broadcast(offs), PID)
    return (res.withColumn(out, (F.col("_lm_off") + F.col(MID) - F.col("_lm_m0") + 1).cast("long"))
            .drop(PID, MID, "_lm_off", "_lm_m0"))


def join_side_table(big: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe equi-join of a big table with a per-key side table.

    No hint: Spark broadcasts the side if its size in bytes, known at run time, allows
    it, and otherwise shuffles (AQE's skew join splits hot keys).
    """
    ren = {k: f"_lm_k_{k}" for k in keys}
    side = small.select(*[F.col(c).alias(ren.get(c, c)) for c in small.columns])
    cond = None
    for k in keys:
        c = big[k].eqNullSafe(side[ren[k]])
        cond = c if cond is None else cond & c
    return big.join(side, cond, "inner").drop(*ren.values())


def group_row_number(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column],
                     out: str = "rn", size_col: str | None = None) -> DataFrame:
    """1-based row number within each group of ``keys`` (skew-safe).

    One sort (checkpointed), ONE aggregation pass per (partition, group) that
    yields both the per-partition offsets and each group's first global rank,
    then the final pass.  Optionally adds ``size_col`` with the group's row count.
    """
    keys = list(keys)
    s = indexed_sort(df, [F.col(k) for k in keys] + list(_cols(order_cols)))
    # <= (#groups + #partitions) rows: every group piece inside one range partition
    pk = s.groupBy(PID, *keys).agg(F.min(MID).alias("_lm_km0"), F.count(F.lit(1)).alias("_lm_kn"))
    parts = pk.groupBy(PID).agg(F.sum("_lm_kn").alias("_lm_n"), F.min("_lm_km0").alias("_lm_m0"))
    w = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)   # <= numPartitions rows
    offs = parts.select(PID, "_lm_m0", F.coalesce(F.sum("_lm_n").over(w), F.lit(0)).alias("_lm_off"))
    first = (pk.join(F.broadcast(offs), PID)
             .select(*keys, (F.col("_lm_off") + F.col("_lm_km0") - F.col("_lm_m0") + 1).alias("_f"), "_lm_kn"))
    aggs = [F.min("_f").alias("_lm_g0")]
    if size_col:
        aggs.append(F.sum("_lm_kn").alias(size_col))
    starts = first.groupBy(*keys).agg(*aggs)
    g = s.join(F.broadcast(offs), PID).withColumn(
        "_lm_grn", F.col("_lm_off") + F.col(MID) - F.col("_lm_m0") + 1)
    res = join_side_table(g, starts, keys)
    return (res.withColumn(out, (F.col("_lm_grn") - F.col("_lm_g0") + 1).cast("long"))
            .drop(PID, MID, "_lm_off", "_lm_m0", "_lm_grn", "_lm_g0"))


def prefix_sums(df: DataFrame, order_cols: Sequence[str | Column], values: Sequence[str],
                inclusive: bool = True, suffix: str = "_cum") -> DataFrame:
    """Running sums of ``values`` over a global order, distributed.

    Per-partition totals (one row per partition) give offsets; the in-partition
    running sum is a window partitioned by the partition id, whose size is the
    range partition size (bounded).
    """
    s = indexed_sort(df, order_cols)
    offs = _partition_offsets(s, {v: F.col(v) for v in values})
    res = s.join(F.broadcast(offs), PID)
    hi = 0 if inclusive else -1
    w = Window.partitionBy(PID).orderBy(MID).rowsBetween(Window.unboundedPreceding, hi)
    for v in values:
        res = res.withColumn(v + suffix, F.col(f"_lm_soff_{v}") + F.coalesce(F.sum(v).over(w), F.lit(0)))
    drop = [PID, MID, "_lm_off", "_lm_m0"] + [f"_lm_soff_{v}" for v in values]
    return res.drop(*drop)


def group_prefix_sums(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column], values: Sequence[str],
                      inclusive: bool = True, suffix: str = "_cum", totals: bool = False) -> DataFrame:
    """Running sums of ``values`` within each group of ``keys``, restarting at the groups' borders (skew-safe).

    One global sort deals a large group over many partitions.  Each (partition, group) piece gets the sums of the
    group's pieces before it, from a window over at most as many rows as partitions the group spans, and within
    the piece a running sum over a part of one range partition.  With ``totals``, ``<value>_total`` is the group's sum.
    """
    keys = list(keys)
    s = indexed_sort(df, [F.col(k) for k in keys] + list(_cols(order_cols)))
    pieces = s.groupBy(PID, *keys).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(f"_lm_p_{v}") for v in values])
    before = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum(f"_lm_p_{v}").over(before), F.lit(0)).alias(f"_lm_o_{v}") for v in values]
    if totals:
        cols += [F.sum(f"_lm_p_{v}").over(Window.partitionBy(*keys)).alias(f"{v}_total") for v in values]
    res = join_side_table(s, pieces.select(PID, *keys, *cols), [PID, *keys])
    w = Window.partitionBy(PID, *keys).orderBy(MID).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    for v in values:
        res = res.withColumn(v + suffix, F.col(f"_lm_o_{v}") + F.coalesce(F.sum(v).over(w), F.lit(0)))
    return res.drop(PID, MID, *[f"_lm_o_{v}" for v in values])


def halo_blocks(df: DataFrame, rn: str, before: int, after: int, block: int = 4096) -> DataFrame:
    """Cut each group's rows (numbered by ``rn``, 1-based) into blocks of ``block`` rows.

    Adds ``_lm_blk`` and ``_lm_own``.  Block b receives its own rows plus copies
    of the last ``before`` rows of block b-1 and the first ``after`` rows of
    block b+1 (``_lm_own`` = false for the copies).
    A window partitioned by (group keys, ``_lm_blk``) then sees at most
    ``block + before + after`` rows, and frames reaching up to ``before`` rows
    back / ``after`` rows ahead are exact for own rows.
    """
    block = max(block, before + after)
    pos = F.col(rn) - 1
    own_blk = F.floor(pos / block).cast("long")
    off = F.pmod(pos, F.lit(block))
    base = df.withColumn("_lm_blk", own_blk).withColumn("_lm_own", F.lit(True))
    parts = [base]
    if before > 0:
        nxt = (df.filter(off >= block - before)
               .withColumn("_lm_blk", own_blk + 1).withColumn("_lm_own", F.lit(False)))
        parts.append(nxt)
    if after > 0:
        prv = (df.filter((off < after) & (own_blk > 0))
               .withColumn("_lm_blk", own_blk - 1).withColumn("_lm_own", F.lit(False)))
        parts.append(prv)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def limit_ordered(df: DataFrame, order_cols: Sequence[str | Column], n: int, rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows of a total order, by the distributed row number: no task receives n rows from every partition."""
    r = global_row_number(df, order_cols, out="_lm_lrn").filter(F.col("_lm_lrn") <= n)
    return r.withColumnRenamed("_lm_lrn", rank_col) if rank_col else r.drop("_lm_lrn")
