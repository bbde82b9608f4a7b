"""Score files as they arrive with a fitted pipeline.

A fitted ``PipelineModel`` is a chain of narrow row maps (assembler, scaler,
forest, rounding), so it applies unchanged to a streaming DataFrame. The
file source tracks which files were processed in the checkpoint, so a
restart after a driver or executor failure neither skips nor repeats files
(the Parquet file sink commits each batch exactly once).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def score_stream(spark: SparkSession, model: PipelineModel, source: str, schema: T.StructType,
                 sink: str, *, checkpoint: str, fmt: str = "parquet",
                 available_now: bool = True, max_files_per_trigger: int | None = None,
                 options: dict | None = None) -> StreamingQuery:
    """Start a query reading ``source`` (a folder of ``fmt`` files with
    ``schema``), scoring every row, and appending to Parquet at ``sink``.
    ``available_now`` processes what is there and stops; otherwise it keeps
    running. ``checkpoint`` belongs to the sink: the same folder on every
    start for it, in storage that all nodes share. A new checkpoint for a sink
    that another has written to would meet the sink's log and lose batches."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    scored = model.transform(reader.load(source))
    plain = scored.select(*[
        vector_to_array(scored[f"`{f.name}`"]).alias(f.name) if isinstance(f.dataType, VectorUDT)
        else scored[f"`{f.name}`"] for f in scored.schema.fields])
    writer = (plain.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(sink)
