"""Readers: declared-schema delimited text, text lines, whole files, SQL sources.

Library code never infers schemas: callers declare a ``StructType``/DDL and
per-column defaults (the typed-default convention), applied with ``coalesce``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_delimited(spark: SparkSession, path: str | list[str], schema: StructType | str, sep: str = ",",
                   header: bool = False, defaults: Mapping[str, object] | None = None,
                   drop_columns: list[str] | None = None, skip_lines: int = 0) -> DataFrame:
    """Delimited files with a declared schema -> typed DataFrame with defaults.

    ``path`` may be a glob or a list of globs; an empty field becomes the
    column's default (or stays null without one).  ``header`` skips one line per
    file; ``skip_lines`` skips the first N lines of every file,
    blank ones included; blank lines are no records.
    """
    if skip_lines:
        df = _read_skipping(spark, path, schema, sep, skip_lines + (1 if header else 0))
    else:
        df = (spark.read.schema(schema).option("sep", sep).option("header", header)
              .option("mode", "PERMISSIVE").csv(path))
    return apply_defaults(df, defaults or {}, drop_columns)


def _read_skipping(spark: SparkSession, path, schema, sep: str, n: int) -> DataFrame:
    """Drop the first ``n`` lines of every file, then parse the rest as CSV records.

    Lines are read with their file path and block start; the in-partition id of
    each file's first line (from its first block) is one row per file — a
    table bounded by the number of files, broadcast back.  Rows in a text scan
    keep file order inside a partition, so position = id - first id.
    """
    ddl = schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1].replace(":", " ")
    lines = (spark.read.text(path)
             .select("value", F.col("_metadata.file_path").alias("_f"),
                     F.col("_metadata.file_block_start").alias("_b"),
                     F.monotonically_increasing_id().alias("_i")))
    first = lines.filter(F.col("_b") == 0).groupBy("_f").agg(F.min("_i").alias("_i0"))
    # one row per file: less than the file listing that the scan's plan holds on the driver anyway
    body = (lines.join(F.broadcast(first), "_f")
            .filter((F.col("_b") > 0) | (F.col("_i") - F.col("_i0") >= n)))
    body = body.filter(F.length(F.trim("value")) > 0)       # as the CSV reader: blank lines are no records
    parsed = body.select(F.from_csv("value", ddl, {"sep": sep, "mode": "PERMISSIVE"}).alias("r"))
    return parsed.select("r.*")


def apply_defaults(df: DataFrame, defaults: Mapping[str, object], drop_columns: list[str] | None = None) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if drop_columns and f.name in drop_columns:
            continue
        c = F.col(f.name)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def read_text_lines(spark: SparkSession, path: str, drop_empty: bool = True) -> DataFrame:
    """One row per line (column ``value``); empty lines removed before any decoding."""
    df = spark.read.text(path)
    return df.filter(F.length("value") > 0) if drop_empty else df


def parse_csv_column(col: str | Column, ddl: str, sep: str = ",") -> Column:
    """Parse a CSV record held in a string column into a struct (``from_csv``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_csv(c, ddl, {"sep": sep})


def parse_json_column(col: str | Column, ddl: str) -> Column:
    """Parse a one-object JSON record held in a string column into a struct."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, ddl)


def read_whole_files(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, content): every matching file read whole (one row per file)."""
    # text()'s own wholetext=False argument would override a reader option
    df = spark.read.text(pattern, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def label_from_path(path: str | Column, level: int = -2) -> Column:
    """Directory name at ``level`` of a '/'-separated path (-2 = parent directory)."""
    c = F.col(path) if isinstance(path, str) else path
    return F.try_element_at(F.split(c, "/"), F.lit(level))


def sql_source(spark: SparkSession, query: str, args: Mapping[str, object] | None = None,
               **frames: DataFrame) -> DataFrame:
    """A SQL text as a source: ``{name}`` placeholders bind DataFrames, ``:param`` binds values.

    Values are bound as typed parameters (never string-formatted into the SQL).
    """
    return spark.sql(query, args=dict(args or {}), **frames)
