"""Sinks: delimited shards, feature shards, append/overwrite tables, debug copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.operators.transform import FeatureSpec


# Most rows of a shard: a table with more than ``num_shards`` times as many is written in more shards.
SHARD_ROWS = 2_000_000


def _sharded(df: DataFrame, num_shards: int | None) -> DataFrame:
    """``df`` dealt to ``num_shards`` shards, or to more if a shard, which one task writes, would exceed ``SHARD_ROWS``."""
    return df.repartition(max(num_shards, -(-df.count() // SHARD_ROWS))) if num_shards else df


def write_delimited(df: DataFrame, path: str, sep: str = "\t", num_shards: int | None = None,
                    header: bool = False, mode: str = "overwrite", debug_path: str | None = None) -> None:
    """Write rows as delimited text shards (``num_shards`` files when given, more for very large tables).

    ``debug_path`` writes a second, human-readable copy (the debug sink flag).
    """
    out = _sharded(df, num_shards)
    out.write.mode(mode).option("sep", sep).option("header", header).csv(path)
    if debug_path:
        df.write.mode("overwrite").json(debug_path)


def write_feature_shards(df: DataFrame, spec: FeatureSpec, path: str, num_shards: int | None = None) -> None:
    """Columnar export of feature rows: numeric -> double, categorical -> string, unused dropped.

    ``num_shards`` files, more if one would hold over ``SHARD_ROWS`` rows.
    """
    out = _sharded(spec.project(df), num_shards)
    out.write.mode("overwrite").parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Create-if-needed table sink at a path: ``append`` adds rows, ``overwrite`` truncates first."""
    if mode not in ("append", "overwrite"):
        raise ValueError(mode)
    df.write.mode(mode).format(fmt).save(path)


def deterministic_shard_order(df: DataFrame, key: str, seed: int = 7) -> DataFrame:
    """Shuffle rows reproducibly before a sharded export (hash of key with a seed)."""
    from loam.functions.hashing import seeded_unit
    return df.orderBy(seeded_unit(key, seed, 1 << 60), F.col(key))
