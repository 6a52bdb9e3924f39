"""Query registry: each named query = Spark builder + equivalent DuckDB SQL (oracle).

A query builder takes (spark, sf_dir) and returns a DataFrame over the full
tables under ``sf_dir``.  ``oracle`` is ANSI SQL over views with the same table
names; ``None`` marks queries checked on row counts only (iterative / model
fitting / streaming).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from loam.session import load_table

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    ids: tuple[str, ...] = field(default_factory=tuple)
    tables: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None, ids: tuple[str, ...] = (), tables: tuple[str, ...] = ()):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, ids, tables)
        return fn
    return deco


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, name)
