"""Apply a fitted transform (and optionally a scoring function) to a stream.

Stateless: ``readStream`` -> ``FittedTransform.transform`` -> ``foreachBatch``
sink (idempotent per batch id: each micro-batch overwrites its own folder).
Vocabulary lookups are stream-static broadcast joins.  The checkpoint location
must be a shared folder (use :func:`loam.session.scratch_path` for tests).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from loam.operators.transform import FittedTransform


def transform_stream(spark: SparkSession, source_path: str, schema: StructType, fitted: FittedTransform,
                     sink_path: str, checkpoint: str, fmt: str = "parquet",
                     score: Callable[[DataFrame], DataFrame] | None = None,
                     available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_path)
    out = fitted.transform(stream)
    if score is not None:
        out = score(out)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")

    w = out.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
