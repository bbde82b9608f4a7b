"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - binds pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabml.session import scratch_path


def id_text(df: DataFrame, id_col: str, text_col: str, with_row: bool = False) -> DataFrame:
    """The id (long) and the whole text (null: empty) under fixed names; or the id and the whole row as a struct."""
    key = df[id_col].cast("long").alias("doc_id")
    if with_row:
        return df.select(key, F.struct(*df.columns).alias("row"))
    return df.select(key, F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))


def texts_of(batch: pa.RecordBatch, text_col: str = "text") -> pa.Array:
    """The texts of a batch of :func:`id_text`; those of whole rows come from the row (null: empty)."""
    if "text" in batch.schema.names:
        return batch.column("text")
    return pa.compute.struct_field(batch.column("row"), text_col).cast(pa.string()).fill_null("")


def schema_of(ddl: str, rows: DataFrame) -> StructType:
    """The schema ``ddl`` describes, with the struct ``row`` of ``rows`` behind it if it has one."""
    out = StructType.fromDDL(ddl)
    return out.add(rows.schema["row"]) if "row" in rows.columns else out


def with_row_of(batch: pa.RecordBatch, columns: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    """The columns as a batch, with the struct ``row`` of ``batch`` behind them if it has one."""
    at = batch.schema.get_field_index("row")
    more = ([batch.column(at)], ["row"]) if at >= 0 else ([], [])
    return pa.RecordBatch.from_arrays(columns + more[0], names + more[1])


def stored(df: DataFrame, name: str, compression: str | None = None, rows_per_file: int = 0) -> DataFrame:
    """``df`` written to the shared scratch folder and read again.

    Cuts the lineage like ``checkpoint()``, survives lost executors, and the
    planner knows the size of what it reads. ``compression``: default the session's.
    ``rows_per_file`` (default: any number) is for rows of megabytes, as Parquet's
    writer and reader hold some 100 and 4096 rows of a file at once, whatever their size.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions the session is set to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(batches: Iterator[pa.RecordBatch], text_col: str = "text", limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches re-cut so that their texts hold about ``limit`` bytes each.

    A single longer text is a batch of its own; nothing is cut inside one.
    """
    for batch in batches:
        col = batch.column(text_col) if text_col in batch.schema.names else texts_of(batch, text_col)
        if col.nbytes <= limit or batch.num_rows < 2:
            yield batch
            continue
        start, held = 0, 0
        for i, n in enumerate(pa.compute.binary_length(col).to_pylist()):
            held += n or 0
            if held >= limit:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers, once per context.

    Nothing to do where PYTHONPATH has it (executors inherit it or have the
    package installed); else Spark distributes a zip of the sources.
    """
    import os
    import tempfile
    import zipfile
    from pathlib import Path

    package = Path(__file__).resolve().parents[1]
    sc = spark.sparkContext
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or "tabml.zip" in map(os.path.basename, sc._python_includes):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tabml-zip-"), "tabml.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(path)
