"""Feature transformers: assembling, scaling, label indexing.

These are ``pyspark.ml`` stages (JVM-side). Fitting a scaler is one
distributed summary pass; the fitted stage is a narrow map, so scoring never
shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.operators.columns import persisted, qcol

ASSEMBLED = "assembledFeatures"
NORMALIZED = "normalizedFeatures"
STANDARDIZED = "standardScaledFeatures"


def assembler(features: Sequence[str], output: str = ASSEMBLED,
              handle_invalid: str = "error") -> VectorAssembler:
    """Vector of ``features``; a null is an error unless ``handle_invalid`` is
    'skip' (drop the row) or 'keep' (NaN)."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=handle_invalid)


def minmax_scaler(input_col: str = ASSEMBLED, output: str = NORMALIZED) -> MinMaxScaler:
    """Rescale to [0, 1] by the fitted min and max (a constant column maps to 0.5)."""
    return MinMaxScaler(inputCol=input_col, outputCol=output)


def standard_scaler(input_col: str = ASSEMBLED, output: str = STANDARDIZED) -> StandardScaler:
    """Subtract the mean, divide by the sample standard deviation (constant -> 0)."""
    return StandardScaler(inputCol=input_col, outputCol=output, withMean=True, withStd=True)


def label_indexer(input_col: str, output: str = "label", handle_invalid: str = "skip") -> StringIndexer:
    """Index labels by descending frequency, ties alphabetically. Fitted inside
    a pipeline (never on rows that are later held out). Null labels, and in
    cross validation labels that the fold was not fitted on, are left out
    (``skip``), so the classes are the labels seen and nothing else;
    ``plans.models.fit`` lets the fitted index keep other labels when scoring."""
    return StringIndexer(inputCol=input_col, outputCol=output, handleInvalid=handle_invalid)


def assemble(df: DataFrame, features: Sequence[str], output: str = ASSEMBLED,
             handle_invalid: str = "error") -> DataFrame:
    return assembler(features, output, handle_invalid).transform(df)


def vector_columns(df: DataFrame, vector: str, names: Sequence[str], keep: Sequence[str] = (),
                   digits: int | None = None) -> DataFrame:
    """Expand a vector column into named double columns (for SQL-side checks
    and plain-table sinks)."""
    arr = vector_to_array(F.col(vector))
    outs = []
    for i, n in enumerate(names):
        v = arr[i]
        outs.append((F.round(v, digits) if digits is not None else v).alias(n))
    return df.select(*keep, *outs)


def fit_scalers(df: DataFrame, features: Sequence[str], minmax: bool = True,
                standard: bool = False) -> PipelineModel:
    """Fit assembler + the requested scalers as one pipeline (both scalers
    share the assembled column and each takes one summary pass)."""
    stages = [assembler(features)]
    if minmax:
        stages.append(minmax_scaler())
    if standard:
        stages.append(standard_scaler())
    # one summary pass per scaler; the narrow frame is kept for the second
    narrow = df.select(*[qcol(c) for c in features])
    if minmax and standard:
        with persisted(narrow) as src:
            return Pipeline(stages=stages).fit(src)
    return Pipeline(stages=stages).fit(narrow)


def index_labels(df: DataFrame, input_col: str, output: str = "label") -> DataFrame:
    """Fit a label index on ``df`` and apply it; a null gets the index after
    all labels. One row per distinct label reaches the driver: for labels,
    not for keys."""
    return label_indexer(input_col, output, "keep").fit(df).transform(df)
