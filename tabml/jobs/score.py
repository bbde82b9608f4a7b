"""Batch scoring with a saved pipeline, a metrics report, and an optional
prediction sink.

    python -m tabml.jobs.score --model_path DIR --new_data PATH [--output DIR]

The pipeline's own assembler decides which columns it reads, so extra
columns in the new data are ignored (nothing is dropped by name). When the
label column is present, weighted F1 and accuracy are printed in percent,
computed from one confusion table. The model runs once: with ``--output`` the
predictions are written and the metrics read back only the label and
prediction columns, else those columns are kept for the metrics.
"""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.jobs.common import emit, read_input
from tabml.operators import metrics
from tabml.operators.columns import persisted, qcol
from tabml.plans.models import ORDINAL
from tabml.sources.models import load_pipeline


def parse_args(argv=None):
    p = argparse.ArgumentParser(description="Score new data with a saved pipeline")
    p.add_argument("--model_path", required=True)
    p.add_argument("--new_data", required=True)
    p.add_argument("--output", help="write scored rows here as Parquet")
    p.add_argument("--label", default="quality")
    p.add_argument("--format", default="auto", choices=["auto", "csv", "parquet"])
    p.add_argument("--sep", default=";")
    return p.parse_args(argv)


def label_index(model: PipelineModel, label: str) -> StringIndexerModel | None:
    """The pipeline's own index of the label column, if it has one."""
    return next((s for s in model.stages if isinstance(s, StringIndexerModel) and s.getInputCol() == label), None)


def label_column(model: PipelineModel, label: str) -> str:
    """What predictions compare with: the output of that index, else the label itself."""
    index = label_index(model, label)
    return index.getOutputCol() if index is not None else label


def plain(df: DataFrame) -> DataFrame:
    """Vectors as arrays, so any table sink (and SQL) can read the output."""
    return df.select(*[
        vector_to_array(qcol(f.name)).alias(f.name) if isinstance(f.dataType, VectorUDT)
        else qcol(f.name) for f in df.schema.fields])


def run(spark: SparkSession, args) -> dict:
    model = load_pipeline(args.model_path)
    data = read_input(spark, args.new_data, args.format, args.sep)
    scored = model.transform(data)
    pred = ORDINAL if ORDINAL in scored.columns else "prediction"
    label = label_column(model, args.label)
    out = {}
    if args.output:
        # score once: the metrics read two columns of the written predictions
        plain(scored).write.mode("overwrite").parquet(args.output)
        emit(step="written", path=args.output)
        scored = spark.read.parquet(args.output)
    if label in scored.columns:
        index = label_index(model, args.label)
        # the model runs once for the test of the labels and for the metrics
        with persisted(scored.select(*[qcol(c) for c in dict.fromkeys([args.label, label, pred])])) as judged:
            if index is not None:
                known = judged.select(F.count_if(qcol(args.label).isNotNull()).alias("given"),
                                      F.count_if(qcol(label) < len(index.labels)).alias("known")).first()
                if known["given"] and not known["known"]:
                    raise ValueError(f"no value of {args.label!r} is among the labels of the pipeline: {index.labels[:10]}")
            out = metrics.metric_values(judged, label, pred)
        emit(step="score", **{f"{k}_pct": None if out[k] is None else round(out[k] * 100, 1) for k in ("f1", "accuracy")})
    return out


def main(argv=None):
    args = parse_args(argv)
    spark = SparkSession.builder.appName("tabml-score").getOrCreate()
    run(spark, args)


if __name__ == "__main__":
    main()
