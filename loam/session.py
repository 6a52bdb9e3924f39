"""Session-level helpers: checkpoint/scratch folders and lineage cuts.

The library reads ``spark.checkpoint.dir`` from the caller's session.  Only when
it is unset *and* the master is local (tests, laptops) does it fall back to a
fresh private temp folder; on a cluster an unset value is an error, because a
machine-local folder is not visible to other executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FALLBACK: dict[int, str] = {}


def checkpoint_base(spark: SparkSession) -> str:
    """Shared base folder for checkpoints and scratch output."""
    sc = spark.sparkContext
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    conf = conf or sc.getCheckpointDir()         # set by the caller on the context
    if conf:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf)
        return conf.rstrip("/")
    key = id(sc)
    if key not in _LOCAL_FALLBACK:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset: set it to a folder shared by all executors")
        _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="loam-ckpt-")
    base = _LOCAL_FALLBACK[key]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint base."""
    return f"{checkpoint_base(spark)}/loam-scratch/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where two branches of a plan must see the *same* physical rows (e.g.
    partition ids assigned after a range sort); it also survives executor loss.
    """
    checkpoint_base(df.sparkSession)
    return df.checkpoint(eager=True)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# DataFrames the library persisted for reuse inside a plan (token indexes, counted side tables).
_CACHED: list[DataFrame] = []


def cached(df: DataFrame, level=None) -> DataFrame:
    """Persist ``df`` (memory, spilling to disk) and remember it for :func:`release_cached`."""
    from pyspark import StorageLevel
    p = df.persist(level or StorageLevel.MEMORY_AND_DISK)
    _CACHED.append(p)
    return p


def release_cached() -> int:
    """Unpersist every intermediate the library cached; returns how many were released.

    Call it once the results built from them have been written or collected.
    """
    n = len(_CACHED)
    while _CACHED:
        _CACHED.pop().unpersist()
    return n
