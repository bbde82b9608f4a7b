"""Model pipelines.

Each builder returns an unfitted ``Pipeline``: assembler, optional scaler,
optional label index, model, and for ordinal regression a ``SQLTransformer``
that rounds the regression output to the nearest class. Putting the rounding
inside the pipeline means cross validation, saving and batch scoring all see
the same ordinal prediction, while the raw ``prediction`` stays for RMSE.

Training is Spark ML's own distributed code: logistic regression runs
``treeAggregate`` gradient passes over a persisted instance RDD; random
forests aggregate split statistics per tree level. Neither collects rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession

from tabml.functions.expressions import is_missing
from tabml.operators.columns import fixed_layout, persisted, qcol
from tabml.operators.transform import (
    ASSEMBLED,
    NORMALIZED,
    STANDARDIZED,
    assembler,
    label_indexer,
    minmax_scaler,
    standard_scaler,
)
from tabml.plans import cells

ORDINAL = "ordinal_prediction"

#: Depth beyond which a forest's fit keeps the node that each row has reached: below it a walk from the root is cheaper.
DEEP = 10


def feature_stages(features: Sequence[str], scale: str | None = None,
                   handle_invalid: str = "error") -> tuple[list, str]:
    """Assembler plus an optional scaler; returns the stages and the name of
    the column the model should read."""
    stages = [assembler(features, ASSEMBLED, handle_invalid)]
    if scale is None:
        return stages, ASSEMBLED
    if scale == "minmax":
        stages.append(minmax_scaler(ASSEMBLED, NORMALIZED))
        return stages, NORMALIZED
    if scale == "standard":
        stages.append(standard_scaler(ASSEMBLED, STANDARDIZED))
        return stages, STANDARDIZED
    raise ValueError(f"unknown scaler {scale!r}")


def rounding_stage(prediction: str = "prediction", output: str = ORDINAL,
                   lower: float | None = None, upper: float | None = None) -> SQLTransformer:
    """Round half up to the nearest whole class as double; clamping to
    ``[lower, upper]`` is optional (off by default)."""
    expr = f"ROUND({prediction}, 0)"
    if lower is not None:
        expr = f"GREATEST({expr}, {float(lower)!r})"
    if upper is not None:
        expr = f"LEAST({expr}, {float(upper)!r})"
    return SQLTransformer(statement=f"SELECT *, CAST({expr} AS DOUBLE) AS {output} FROM __THIS__")


def logistic_regression(features: Sequence[str], label: str, *, max_iter: int = 100,
                        reg: float = 0.0, elastic_net: float = 0.0, scale: str | None = None,
                        index_label: bool = True, label_index: str = "label",
                        handle_invalid: str = "error") -> Pipeline:
    """Multinomial logistic regression. ``elastic_net``: 0 = L2, 1 = L1 (only
    matters with ``reg > 0``). With ``index_label`` the label is indexed by
    frequency inside the pipeline (as ``label_index``) and predictions are
    indices. ``handle_invalid``: the assembler's answer to missing features."""
    stages, fcol = feature_stages(features, scale, handle_invalid)
    label_col = label
    if index_label:
        stages.append(label_indexer(label, label_index))
        label_col = label_index
    stages.append(LogisticRegression(featuresCol=fcol, labelCol=label_col, maxIter=max_iter,
                                     regParam=reg, elasticNetParam=elastic_net))
    return Pipeline(stages=stages)


def forest_classifier(features: Sequence[str], label: str, *, num_trees: int = 20,
                      max_depth: int = 5, seed: int | None = 42, scale: str | None = None,
                      index_label: bool = False, max_bins: int = 32,
                      max_memory_mb: int = 512, label_index: str = "label",
                      handle_invalid: str = "error") -> Pipeline:
    """Random forest classifier; ``probability`` holds the class probabilities."""
    stages, fcol = feature_stages(features, scale, handle_invalid)
    label_col = label
    if index_label:
        stages.append(label_indexer(label, label_index))
        label_col = label_index
    rf = RandomForestClassifier(featuresCol=fcol, labelCol=label_col, numTrees=num_trees,
                                maxDepth=max_depth, maxBins=max_bins, probabilityCol="probability",
                                maxMemoryInMB=max_memory_mb, cacheNodeIds=max_depth > DEEP)
    if seed is not None:
        rf.setSeed(seed)
    stages.append(rf)
    return Pipeline(stages=stages)


def forest_regressor(features: Sequence[str], label: str, *, num_trees: int = 20,
                     max_depth: int = 5, seed: int | None = 42, scale: str | None = "minmax",
                     ordinal: bool = True, max_bins: int = 32, max_memory_mb: int = 512,
                     clamp: tuple[float, float] | None = None, handle_invalid: str = "error") -> Pipeline:
    """Random forest regressor; with ``ordinal`` a rounding stage adds
    ``ordinal_prediction``. Deep trees cache node ids (checkpointed to the
    session's checkpoint folder every 10 iterations)."""
    stages, fcol = feature_stages(features, scale, handle_invalid)
    rf = RandomForestRegressor(featuresCol=fcol, labelCol=label, numTrees=num_trees,
                               maxDepth=max_depth, maxBins=max_bins, maxMemoryInMB=max_memory_mb,
                               cacheNodeIds=max_depth > DEEP)
    if seed is not None:
        rf.setSeed(seed)
    stages.append(rf)
    if ordinal:
        lo, hi = clamp if clamp else (None, None)
        stages.append(rounding_stage(lower=lo, upper=hi))
    return Pipeline(stages=stages)


def label_input(pipeline: Pipeline) -> str:
    """The input column that holds the label: what the label index reads, else
    the model's own label column."""
    label = model_stage_spec(pipeline).getLabelCol()
    for s in pipeline.getStages():
        if isinstance(s, StringIndexer) and s.getOutputCol() == label:
            return s.getInputCol()
    return label


def input_columns(pipeline: Pipeline) -> list[str]:
    """The input columns that a fit of a pipeline built here reads: the features and the label."""
    features = [c for s in pipeline.getStages() if isinstance(s, VectorAssembler) for c in s.getInputCols()]
    return list(dict.fromkeys([*features, label_input(pipeline)]))


def trainable(pipeline: Pipeline, df: DataFrame) -> DataFrame:
    """The rows that have a label: a null (or NaN) label is no class."""
    return df.where(~is_missing(df, label_input(pipeline)))


def scorable(model: PipelineModel) -> PipelineModel:
    """Lets a fitted label index keep labels that it has not seen (or null):
    they get the index after all classes, which no prediction equals."""
    for s in model.stages:
        if isinstance(s, StringIndexerModel):
            s.setHandleInvalid("keep")
    return model


def storage_memory(spark: SparkSession) -> int:
    """Bytes in which the executors can keep blocks just now; of a local session, the driver's."""
    held = sorted(e.totalOnHeapStorageMemory() for e in spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos())
    # Spark lists the driver too, mostly the smallest
    return sum(held[1:] if len(held) > 1 else held)


def node_ids_fit(rows: int, trees: int, features: int, memory: int) -> bool:
    """Whether ``memory`` holds a forest's binned rows with their draws, and twice (before and after a level) each row's nodes.

    Spark keeps them as objects, of some 100 bytes beside the numbers, and an array more for the nodes. What does not fit goes to disk: the
    rows are written there once, but the nodes anew at each level, which takes longer than to walk from the root.
    """
    return rows * (100 + 4 * features + 4 * trees + 2 * (20 + 4 * trees)) <= memory


def node_params(pipeline: Pipeline, src: DataFrame) -> dict:
    """For a deep forest whose rows' nodes don't fit the memory: not to keep them. The fitted trees are the same."""
    stage = model_stage_spec(pipeline)
    if not hasattr(stage, "cacheNodeIds") or not stage.getCacheNodeIds():
        return {}
    features = sum(len(s.getInputCols()) for s in pipeline.getStages() if isinstance(s, VectorAssembler))
    return {} if node_ids_fit(src.count(), stage.getNumTrees(), features, storage_memory(src.sparkSession)) else {stage.cacheNodeIds: False}


def fit(pipeline: Pipeline, df: DataFrame, *, keys: Sequence[str] | None = None,
        partitions: int | None = None, persist: bool = True, by_cells: bool = False) -> PipelineModel:
    """Fit on the rows of ``df`` that have a label. Every fitted stage (scaler,
    label index, model) reads the input several times, so it is kept for the
    fit unless ``persist`` is False. A forest samples its rows by partition and
    place: for one the input is dealt out first (``operators.columns.fixed_layout``, by
    ``keys`` or evenly), so that the same rows give the same model on any
    layout of the input and any number of cores, at every size; ``partitions``
    (default: the session's shuffle partitions) is part of what the model
    depends on. Logistic regression sums over all rows in each pass, so its input stays where it is. Only the columns that
    the pipeline reads are kept; the others have their part in the layout alone. A deep forest keeps its rows' nodes where
    the memory holds them (:func:`node_params`). ``by_cells``: with many rows a forest is grown on their cells
    (``plans.cells``), which depend on the rows and not on their layout."""
    rows = trainable(pipeline, df)
    stage = model_stage_spec(pipeline)
    if not isinstance(stage, LogisticRegression):
        found = cells.fit(pipeline, stage, rows.select(*map(qcol, input_columns(pipeline)))) if by_cells else None
        if found is not None:
            return scorable(found)
        rows = fixed_layout(rows, keys, partitions)
    rows = rows.select(*map(qcol, input_columns(pipeline)))
    if not persist:
        return scorable(pipeline.fit(rows))
    with persisted(rows) as src:
        return scorable(pipeline.fit(src, node_params(pipeline, src)))


def with_depth(stage, params: dict) -> dict:
    """``params`` of a grid point, and for a forest how its fit finds a row's node, by the point's depth: a spec built for
    a shallow forest walks from the root at each level, a deep one must not. The fitted trees are the same."""
    if not hasattr(stage, "cacheNodeIds"):
        return params
    return {stage.cacheNodeIds: params.get(stage.maxDepth, stage.getMaxDepth()) > DEEP, **params}


def model_stage_spec(pipeline: Pipeline):
    """The (unfitted) model estimator of a pipeline built here."""
    for s in reversed(pipeline.getStages()):
        if isinstance(s, (LogisticRegression, RandomForestClassifier, RandomForestRegressor)):
            return s
    raise LookupError("no model stage")


def model_stage(model: PipelineModel, kind: str | type | None = None):
    """The fitted model stage of a pipeline: by class (or class name), else
    the last stage that has ``featureImportances`` or ``coefficientMatrix``."""
    for s in reversed(model.stages):
        if kind is None and (hasattr(s, "featureImportances") or hasattr(s, "coefficientMatrix")):
            return s
        if isinstance(kind, str) and type(s).__name__ == kind:
            return s
        if isinstance(kind, type) and isinstance(s, kind):
            return s
    raise LookupError(f"no stage of kind {kind!r}")


def model_summary(spark, model: PipelineModel):
    """``(stage, kind, trees, total_nodes, max_depth, features)`` per model
    stage: bounded metadata of the fitted pipeline."""
    rows = []
    for i, s in enumerate(model.stages):
        if hasattr(s, "trees"):
            trees = s.trees
            rows.append((i, type(s).__name__, len(trees), int(s.totalNumNodes),
                         max(t.depth for t in trees), int(s.numFeatures)))
        elif hasattr(s, "coefficientMatrix"):
            rows.append((i, type(s).__name__, 0, 0, 0, int(s.numFeatures)))
    return spark.createDataFrame(
        rows, "stage int, kind string, trees int, total_nodes int, max_depth int, features int")
