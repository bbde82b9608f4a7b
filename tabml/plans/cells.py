"""Forests of tables whose rows far outnumber the cells of their bins.

A forest sees a feature by its bins (``maxBins`` of them), so rows with the same bins and label are alike to it: a cell of n
such rows. The number of cells has a bound that does not grow with the rows. A bootstrap gives each row a Poisson
count of mean 1; those of a cell add up to a Poisson count of mean n. So a tree is fitted by Spark ML on the cells, each
weighted with its drawn count, and the trees make a forest: the same distribution as fitted on the rows, other draws.

Each bin is represented by a value of its feature: all its values if they are at most ``maxBins``, else quantiles. Spark tries the
midpoints between neighbouring values as thresholds, and rows are dealt to bins by these same midpoints, so the trees
predict for rows what they predict for their cells.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import TaskContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.operators.columns import persisted, qcol
from tabml.operators.quantiles import exact_quantiles

#: Rows from which cells are tried, rows for each cell at least, and cells of a partition.
FROM_ROWS, EACH, PER_PARTITION = 1 << 20, 4, 1 << 16


def suits(stage) -> bool:
    """Whether a forest's cells tell all that its fit asks of the rows."""
    return (isinstance(stage, (RandomForestRegressor, RandomForestClassifier)) and stage.getBootstrap() and stage.getSubsamplingRate() == 1.0
            and stage.getMinInstancesPerNode() == 1 and stage.getMinWeightFractionPerNode() == 0.0 and not stage.isSet("weightCol"))


def _few_values(most: int):
    """(feature, value): the values of each feature in a task, up to one more than ``most``; NaN for any that is not finite."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held: dict[int, np.ndarray] = {}
        for batch in batches:
            x = batch.column("x")
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            for i in range(x.shape[1]):
                seen, own = held.get(i, np.empty(0)), x[:, i]
                if not np.isfinite(own).all():
                    own = np.append(own[np.isfinite(own)], np.nan)
                if len(seen) <= most or np.isnan(own[-1:]).any():
                    found = np.unique(np.concatenate([seen, own]))
                    held[i] = found if len(found) <= most else np.append(found[:most], found[-1])
        for i, v in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(v), pa.int32()), pa.array(v)], ["feature", "value"])

    return run


def bin_values(rows: DataFrame, features: int, bins: int) -> list[list[float]] | None:
    """The values that stand for each feature's bins, rising; None if a value is not finite."""
    seen = rows.select("x").mapInArrow(_few_values(bins), "feature int, value double").distinct().collect()
    values = [sorted(r["value"] for r in seen if r["feature"] == i) for i in range(features)]
    if any(math.isnan(v) for of in values for v in of):
        return None
    many = [i for i, of in enumerate(values) if len(of) > bins]
    if many:
        # exact, as approximate ones depend on the layout of the rows
        found = exact_quantiles(rows.select(*[F.col("x")[i].alias(f"x{i}") for i in many]), [f"x{i}" for i in many], [(k + 0.5) / bins for k in range(bins)]).collect()
        for i in many:
            values[i] = sorted({r["value"] for r in found if r["column"] == f"x{i}"})
    return values if all(math.isfinite(a + b) for of in values for a, b in zip(of, of[1:])) else None


def _codes(values: Sequence[Sequence[float]], columns: Sequence[str]):
    """Each row's bins as one number."""
    cuts = [[(a + b) / 2.0 for a, b in zip(of, of[1:])] for of in values]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = batch.column("x")
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            code = np.zeros(len(x), np.int64)
            for i, of in enumerate(cuts):
                # left of a threshold is what is at most it
                code = code * (len(of) + 1) + np.searchsorted(np.array(of), x[:, i], side="left")
            yield pa.RecordBatch.from_arrays([pa.array(code), *[batch.column(c) for c in columns]], ["code", *columns])

    return run


def _decoded(values: Sequence[Sequence[float]]):
    """The values of a cell's bins."""
    parts, rest = [], "code"
    for of in reversed(values):
        parts.append(F.element_at(F.array(*map(F.lit, of)), F.expr(f"cast({rest} % {len(of)} + 1 as int)")))
        rest = f"({rest} div {len(of)})"
    return F.array(*reversed(parts))


@dataclass
class Cells:
    """``table``: (x, y, n, folds) of each cell and label, in a fixed order; ``folds`` maps a fold to its rows, if there are folds."""

    table: DataFrame
    features: int
    folds: list[int]
    count: int

    def drawn(self, n, trees: int, seed: int) -> DataFrame:
        """(features, y, w): the cells with a count ``n`` of rows, and how often each tree's bootstrap draws them."""

        def run(batches):
            import numpy as np
            import pyarrow as pa

            part = TaskContext.get().partitionId()
            of = [np.random.default_rng([seed & 0xFFFFFFFFFFFFFFFF, part, t]) for t in range(trees)]
            for batch in batches:
                w = np.stack([g.poisson(batch.column("n").to_numpy()) for g in of], axis=1).astype(np.int64)
                ends = pa.array(np.arange(0, w.size + 1, trees), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.ListArray.from_arrays(ends, pa.array(w.ravel()))], ["x", "y", "w"])

        kept = self.table.select("x", "y", n.alias("n")).mapInArrow(run, "x array<double>, y double, w array<long>")
        return kept.select(array_to_vector("x").alias("features"), "y", "w")

    def train(self, fold: int) -> DataFrame:
        """A column of the rows of each cell that are not in ``fold``."""
        return F.col("n") - F.coalesce(F.col("folds")[fold], F.lit(0))

    def held(self, fold: int) -> DataFrame:
        """(y, x, n): the cells' rows in ``fold``."""
        return self.table.select("y", "x", F.col("folds")[fold].alias("n")).where("n > 0")


@contextmanager
def cells_of(rows: DataFrame, features: int, bins: int, fold: str | None = None) -> Iterator[Cells | None]:
    """The cells of ``rows`` (``x`` array of doubles, ``y`` double, and the fold); None where they are not few."""
    values = bin_values(rows, features, bins)
    if values is None or math.prod(map(len, values)) >= 1 << 62 or not all(values):
        yield None
        return
    kept = ["y"] if fold is None else ["y", fold]
    kinds = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in kept)
    counted = rows.select("x", *kept).mapInArrow(_codes(values, kept), f"code long, {kinds}").groupBy("code", *kept).count()
    if fold is None:
        counted = counted.select("code", "y", F.col("count").alias("n"), F.lit(None).cast("map<int, bigint>").alias("folds"))
    else:
        entry = F.struct(F.col(fold).cast("int"), F.col("count"))
        counted = counted.groupBy("code", "y").agg(F.sum("count").alias("n"), F.map_from_entries(F.collect_list(entry)).alias("folds"))
    with persisted(counted) as counted:
        one = counted.agg(F.count("*").alias("cells"), F.sum("n").alias("rows")).first()
        if one["cells"] * EACH > one["rows"]:
            yield None
            return
        # draws go by partition and place
        dealt = counted.repartition(1 + one["cells"] // PER_PARTITION, "code", "y").sortWithinPartitions("code", "y")
        with persisted(dealt.select(_decoded(values).alias("x"), "y", "n", "folds")) as table:
            there = [] if fold is None else sorted(r[0] for r in table.select(F.explode(F.map_keys("folds"))).distinct().collect())
            yield Cells(table, features, there, one["cells"])


def grow(stage, cells: Cells, n, classes: int, pool: ThreadPool):
    """A forest of ``stage``'s kind, number of trees and depth on the cells with ``n`` rows each."""
    spark, trees, classifies = cells.table.sparkSession, stage.getNumTrees(), isinstance(stage, RandomForestClassifier)
    subset = stage.getFeatureSubsetStrategy()
    if subset == "auto":
        subset = "all" if trees == 1 else "sqrt" if classifies else "onethird"
    # as many values of a feature as there are bins are all tried, if the splits are found from all cells
    single = stage.copy({stage.numTrees: 1, stage.bootstrap: False, stage.featureSubsetStrategy: subset, stage.featuresCol: "features", stage.labelCol: "y",
                         stage.weightCol: "w", stage.cacheNodeIds: False, stage.maxBins: max(stage.getMaxBins(), math.isqrt(cells.count) + 1)})
    label = F.col("y").alias("y", metadata={"ml_attr": {"type": "nominal", "num_vals": classes}}) if classifies else F.col("y")
    with persisted(cells.drawn(n, trees, stage.getSeed())) as drawn:
        def one(t: int):
            return single.copy({single.seed: stage.getSeed() + t}).fit(drawn.select("features", label, F.col("w")[t].cast("double").alias("w")).where("w > 0"))

        found = pool.map(one, range(trees), chunksize=1)
    gateway, ml = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml
    kind = ml.classification.DecisionTreeClassificationModel if classifies else ml.regression.DecisionTreeRegressionModel
    held = gateway.new_array(kind, trees)
    for t, model in enumerate(found):
        held[t] = model._java_obj.trees()[0]
    java = (ml.classification.RandomForestClassificationModel(stage.uid, held, cells.features, classes) if classifies
            else ml.regression.RandomForestRegressionModel(stage.uid, held, cells.features))
    model = stage._copyValues(stage._create_model(java))
    model._transfer_params_to_java()
    return model


def threads(rows: DataFrame) -> ThreadPool:
    """Trees are small jobs of a few tasks, in turn with work of the driver: more at once than there are cores."""
    return ThreadPool(2 * max(2, min(16, rows.sparkSession.sparkContext.defaultParallelism)))


def prepared(pipeline: Pipeline, stage, label: str, rows: DataFrame, *more: str) -> tuple[PipelineModel, DataFrame, int, int]:
    """The fitted stages before the forest, (x, y, more) of the rows, the number of features and of classes."""
    stages = pipeline.getStages()
    before = Pipeline(stages=stages[: stages.index(stage)]).fit(rows)
    out = before.transform(rows)
    features = out.schema[stage.getFeaturesCol()].metadata["ml_attr"]["num_attrs"]
    ready = out.select(vector_to_array(qcol(stage.getFeaturesCol())).alias("x"), qcol(label).cast("double").alias("y"), *map(qcol, more))
    classes = 0
    if isinstance(stage, RandomForestClassifier):
        attr = out.schema[label].metadata.get("ml_attr", {})
        classes = len(attr["vals"]) if "vals" in attr else int(ready.agg(F.max("y")).first()[0]) + 1
    return before, ready, features, classes


def fit(pipeline: Pipeline, stage, rows: DataFrame) -> PipelineModel | None:
    """The pipeline fitted on ``rows`` with its forest grown on their cells; None where the cells are not few or don't suit the fit."""
    if not suits(stage) or rows.count() < FROM_ROWS:
        return None
    with persisted(rows) as kept:
        before, ready, features, classes = prepared(pipeline, stage, stage.getLabelCol(), kept)
        with cells_of(ready, features, stage.getMaxBins()) as cells:
            if cells is None:
                return None
            with threads(rows) as pool:
                forest = grow(stage, cells, F.col("n"), classes, pool)
    stages = pipeline.getStages()
    return PipelineModel(stages=[*before.stages, forest, *stages[stages.index(stage) + 1:]])
