"""Evaluation metrics on scored DataFrames.

All class metrics come from ONE confusion table ``groupBy(label,
prediction).count()``: the data is scanned once, and the table has at most
(#labels x #predicted classes) rows, so everything after it is tiny.
Weighted F1 is ``sum_l n_l * 2 tp_l / (n_l + p_l) / N`` (equal to
``MulticlassClassificationEvaluator(metricName="f1")``).

One rule for missing values: a metric runs over the rows that have a label and
a prediction (both not null; for RMSE, the raw prediction). The confusion
table itself counts all rows, nulls in cells of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.expressions import DIGITS

from tabml.operators.columns import qcol


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     raw: str | None = None) -> DataFrame:
    """``(label, prediction, count)`` with both keys as double. With ``raw``
    (e.g. a regressor's unrounded output) each cell also carries ``sse``, the
    sum of squared errors ``(label - raw)^2``, and ``n_raw``, the rows that
    have it, so RMSE comes from the same pass as the class metrics."""
    y = qcol(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("count")]
    if raw is not None:
        err = y - qcol(raw).cast("double")
        # a cell without any raw prediction has no squared error
        aggs += [F.coalesce(F.sum(err * err), F.lit(0.0)).alias("sse"), F.count(err).alias("n_raw")]
    return df.groupBy(y.alias("label"), qcol(prediction).cast("double").alias("prediction")).agg(*aggs)


def _class_metrics(conf: DataFrame) -> DataFrame:
    """Per class: true count, predicted count and hits (and the squared error
    of its true rows when ``conf`` has ``sse``). Each confusion cell
    contributes one row to its true class and one to its predicted class, so
    a single aggregate (no self-join, one evaluation of ``conf``) suffices."""
    zero, none = F.lit(0).cast("long"), F.lit(0.0)
    sse = "sse" in conf.columns
    cell = F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("count").alias("n_true"),
                 zero.alias("n_pred"),
                 F.when(F.col("label") == F.col("prediction"), F.col("count"))
                 .otherwise(zero).alias("tp"),
                 (F.col("sse") if sse else none).alias("sse"),
                 (F.col("n_raw") if sse else zero).alias("n_raw")),
        F.struct(F.col("prediction").alias("cls"), zero.alias("n_true"),
                 F.col("count").alias("n_pred"), zero.alias("tp"), none.alias("sse"),
                 zero.alias("n_raw")),
    )).alias("c")
    return (conf.select(cell).select("c.*").groupBy("cls")
            .agg(F.sum("n_true").alias("n_true"), F.sum("n_pred").alias("n_pred"),
                 F.sum("tp").alias("tp"), F.sum("sse").alias("sse"), F.sum("n_raw").alias("n_raw")))


def metrics_from_confusion(conf: DataFrame, digits: int | None = DIGITS) -> DataFrame:
    """One row ``(weighted_f1, accuracy)`` from a confusion table, plus
    ``rmse`` when the table carries ``sse``."""
    per = _class_metrics(conf.where("label IS NOT NULL AND prediction IS NOT NULL"))
    f1 = F.col("n_true") * F.lit(2.0) * F.col("tp") / (F.col("n_true") + F.col("n_pred"))
    # classes that are only predicted have n_true = 0: weight 0, no division
    f1 = F.when(F.col("n_true") > 0, f1).otherwise(F.lit(0.0))
    aggs = [(F.sum(f1) / F.sum("n_true")).alias("weighted_f1"),
            (F.sum("tp") / F.sum("n_true")).alias("accuracy")]
    if "sse" in conf.columns:
        aggs.append(F.sqrt(F.sum("sse") / F.sum("n_raw")).alias("rmse"))
    out = per.agg(*aggs)
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) for c in out.columns])
    return out


def weighted_f1(df: DataFrame, label: str = "label", prediction: str = "prediction",
                digits: int | None = DIGITS) -> DataFrame:
    return metrics_from_confusion(confusion_counts(df, label, prediction), digits).select("weighted_f1")


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction",
             digits: int | None = DIGITS) -> DataFrame:
    x = F.avg((qcol(label).cast("double") == qcol(prediction).cast("double")).cast("double"))
    out = df.agg(x.alias("accuracy"))
    return out.select(F.round("accuracy", digits).alias("accuracy")) if digits is not None else out


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction",
         digits: int | None = DIGITS) -> DataFrame:
    err = qcol(label).cast("double") - qcol(prediction).cast("double")
    out = df.agg(F.sqrt(F.avg(err * err)).alias("rmse"))
    return out.select(F.round("rmse", digits).alias("rmse")) if digits is not None else out


def metrics_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   raw: str | None = None) -> DataFrame:
    """``(metric, value, pct)`` rows for weighted F1 and accuracy (and RMSE of
    ``raw`` when given), percent with one decimal, from a single confusion
    table (one scan of ``df``)."""
    m = metrics_from_confusion(confusion_counts(df, label, prediction, raw), digits=None)
    rows = [F.struct(F.lit("f1").alias("metric"), F.col("weighted_f1").alias("value")),
            F.struct(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))]
    if raw is not None:
        rows.append(F.struct(F.lit("rmse").alias("metric"), F.col("rmse").alias("value")))
    rows = m.select(F.inline(F.array(*rows)))
    return rows.select("metric", F.round("value", DIGITS).alias("value"),
                       F.round(F.col("value") * 100, 1).alias("pct"))


def metric_values(df: DataFrame, label: str = "label", prediction: str = "prediction",
                  raw: str | None = None) -> dict:
    """The report as a small dict (bounded: two or three numbers) for jobs
    and logs."""
    return {r["metric"]: r["value"] for r in metrics_report(df, label, prediction, raw).collect()}
