"""Pearson correlation of many columns, each pair over its complete rows.

``corr_pairs`` takes one route at every width, in one scan. The moments of a
pair (rows, both means, both squared deviations, co-deviation) form a state
that merges exactly (Chan, Golub, LeVeque): each Arrow batch gives the states
of all pairs as masked matrix products around the batch's own means, a task
merges its batches, and the tasks' states are merged by pair. ``pair_moments``
is that table of states, ``merge_moments`` adds up any number of them, so that
new parts of a data set need no second look at the old ones. Nulls, NaN and
infinities are missing: a pair's moments run over the rows where both columns
have a finite value, as in pandas. Results are long tables ``(feature_a,
feature_b, corr)``; the wide, named matrix is a pivot of the long one, so names
travel with values and no row-id join is needed.

``corr_matrix_ml`` is the same table through ``pyspark.ml.stat.Correlation``,
which needs rows without missing values and leaves the others out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.expressions import DIGITS

from tabml.operators.columns import persisted, qcol, sql_str

_MOMENTS = ("n", "ma", "mb", "qa", "qb", "c")
STATE = "i int, j int, part long, " + ", ".join(f"{c} double" for c in _MOMENTS)
# squared deviations below this share of the squared values are rounding of a constant: within a batch (values
# around the batch's mean), and of merged states (values as they are)
_TINY, _TINY_MERGED = 1e-13, 1e-28
#: States that one step of a merge takes at once, about.
FAN_IN = 1024


def _merge(s, t):
    """The moments of two disjoint sets of rows as those of both; arrays of states merge place by place."""
    import numpy as np

    n = s[0] + t[0]
    some = np.maximum(n, 1.0)
    da, db, w = t[1] - s[1], t[2] - s[2], s[0] * t[0] / some
    share = t[0] / some
    return np.stack([n, s[1] + da * share, s[2] + db * share, s[3] + t[3] + da * da * w, s[4] + t[4] + db * db * w, s[5] + t[5] + da * db * w])


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """States of the pairs ``i <= j`` of ``columns``: ``i, j, part, n, ma, mb, qa, qb, c``, one per pair and part of the
    input that has a complete row. Any union of such tables is one of the union of their rows."""
    import numpy as np

    k = len(columns)
    typed = df.select(*[qcol(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    upper = np.triu_indices(k)

    def state(x: np.ndarray) -> np.ndarray:
        there = np.isfinite(x)
        m = there.astype(float)
        shift = np.where(there, x, 0.0).sum(axis=0) / np.maximum(m.sum(axis=0), 1.0)
        shift = np.where(np.isfinite(shift), shift, 0.0)
        x = np.where(there, x - shift, 0.0)
        n, s, q, c = m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x
        some = np.maximum(n, 1.0)
        mean = s / some
        dev = q - s * mean
        dev = np.where(dev > _TINY * q, dev, 0.0)
        return np.stack([n, mean + shift[:, None], mean.T + shift, dev, dev.T, c - s * s.T / some])

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, 65_536):
                part = batch.slice(start, 65_536)
                # a null is NaN here
                with np.errstate(over="ignore", invalid="ignore"):
                    own = state(np.column_stack([part.column(i).to_numpy(zero_copy_only=False) for i in range(k)]).astype(float))
                    # means of pairs without rows are no more than a start
                    own[1:3] = np.where(own[0] > 0, own[1:3], 0.0)
                    total = own if total is None else _merge(total, own)
        if total is not None:
            i, j = (u[total[0][upper] > 0] for u in upper)
            cols = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.full(len(i), TaskContext.get().partitionId()), pa.int64()), *[pa.array(t[i, j]) for t in total]]
            yield pa.RecordBatch.from_arrays(cols, ["i", "j", "part", *_MOMENTS])

    return typed.mapInArrow(run, STATE)


def merge_moments(states: DataFrame) -> DataFrame:
    """One state per pair from any number of them. Groups of about ``FAN_IN`` states are folded, then their results;
    both folds go by part, so that the same parts give the same digits."""
    fold = """aggregate(array_sort(collect_list(struct(part, n, ma, mb, qa, qb, c))), cast(named_struct('part', 0L, 'n', 0D, 'ma', 0D, 'mb', 0D, 'qa', 0D, 'qb', 0D, 'c', 0D)
        as struct<part: bigint, n: double, ma: double, mb: double, qa: double, qb: double, c: double>), (s, t) -> named_struct(
        'part', s.part, 'n', s.n + t.n, 'ma', s.ma + (t.ma - s.ma) * (t.n / (s.n + t.n)), 'mb', s.mb + (t.mb - s.mb) * (t.n / (s.n + t.n)),
        'qa', s.qa + t.qa + if(s.n = 0, 0D, (t.ma - s.ma) * (t.ma - s.ma) * (s.n * t.n / (s.n + t.n))), 'qb', s.qb + t.qb + if(s.n = 0, 0D, (t.mb - s.mb) * (t.mb - s.mb) * (s.n * t.n / (s.n + t.n))),
        'c', s.c + t.c + if(s.n = 0, 0D, (t.ma - s.ma) * (t.mb - s.mb) * (s.n * t.n / (s.n + t.n)))))"""
    some = states.filter("n > 0").withColumn("group", F.expr(f"part div {FAN_IN}"))
    first = some.groupBy("i", "j", "group").agg(F.expr(fold).alias("s")).select("i", "j", F.col("group").alias("part"), *[F.col(f"s.{c}").alias(c) for c in _MOMENTS])
    return first.groupBy("i", "j").agg(F.expr(fold).alias("s")).select("i", "j", *[F.col(f"s.{c}").alias(c) for c in _MOMENTS])


def corr_long(df: DataFrame, columns: Sequence[str], digits: int | None = DIGITS) -> DataFrame:
    """``(feature_a, pos_a, feature_b, pos_b, corr)`` for all ordered pairs,
    diagonal included (1). Null where fewer than two rows are complete or
    either column is constant over them, as pandas' ``corr()`` gives NaN."""
    return corr_of_moments(pair_moments(df, columns), columns, digits)


def corr_of_moments(states: DataFrame, columns: Sequence[str], digits: int | None = DIGITS) -> DataFrame:
    """``corr_long`` from states of :func:`pair_moments` over ``columns``."""
    cols = list(columns)
    m = merge_moments(states)
    # square roots apart: their product can neither overflow nor underflow before the columns do
    value = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.col("c") / F.sqrt("qa") / F.sqrt("qb"))
    varies = [F.col(q) > F.col("n") * F.col(x) * F.col(x) * _TINY_MERGED for q, x in (("qa", "ma"), ("qb", "mb"))]
    defined = (F.col("n") > 1) & varies[0] & varies[1]
    corr = F.when(defined & ~F.isnan(value), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value)))
    got = m.select("i", "j", corr.alias("corr"))
    if digits is not None:
        got = got.withColumn("corr", F.round("corr", digits))
    # every pair is there, also of columns (or tables) without any complete row
    names = "array(" + ", ".join(sql_str(c) for c in cols) + ")"
    every = states.sparkSession.range(len(cols) * len(cols)).select(
        (F.col("id") / len(cols)).cast("int").alias("pos_a"), (F.col("id") % len(cols)).cast("int").alias("pos_b"))
    hit = (F.least("pos_a", "pos_b") == F.col("i")) & (F.greatest("pos_a", "pos_b") == F.col("j"))
    return every.join(got, hit, "left").select(
        F.expr(f"element_at({names}, pos_a + 1)").alias("feature_a"), "pos_a",
        F.expr(f"element_at({names}, pos_b + 1)").alias("feature_b"), "pos_b", "corr")


def corr_pairs(df: DataFrame, columns: Sequence[str], digits: int | None = DIGITS) -> DataFrame:
    """``(feature_a, feature_b, corr)`` for all ordered pairs."""
    return corr_long(df, columns, digits).select("feature_a", "feature_b", "corr")


def corr_matrix_ml(df: DataFrame, columns: Sequence[str], digits: int | None = DIGITS) -> DataFrame:
    """``corr_pairs`` through ``Correlation.corr`` on an assembled vector,
    over the rows complete in ALL columns (its Gramian knows no missing
    values); without nulls both agree. The k x k matrix (bounded by the
    column count, not the rows) comes back to the driver and is returned as
    rows; a constant column gives null, and so does everything when no row is
    complete."""
    spark = df.sparkSession
    cols = list(columns)
    typed = df.select(*[F.when(F.abs(qcol(c).cast("double")) < float("inf"), qcol(c).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)]).na.drop()
    vec = VectorAssembler(inputCols=typed.columns, outputCol="_features").transform(typed)
    # two passes (column summary, then Gramian)
    with persisted(vec.select("_features")) as src:
        same = vec.agg(*[(F.min(c) == F.max(c)).alias(c) for c in typed.columns]).first()
        constant = [s is None or s for s in same]
        m = None if same[0] is None else Correlation.corr(src, "_features", "pearson").head()[0].toArray()
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = None if m is None or constant[i] or constant[j] else float(m[i][j])
            rows.append((a, b, v))
    out = spark.createDataFrame(rows, "feature_a string, feature_b string, corr double")
    return out if digits is None else out.withColumn("corr", F.round("corr", digits))


def corr_matrix_wide(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pivot a long pair table to ``(feature, <one column per feature>)``.
    The pivot values are given, so no extra job discovers them."""
    return (pairs.groupBy(F.col("feature_a").alias("feature"))
            .pivot("feature_b", list(columns)).agg(F.first("corr")))


def high_corr_features(df: DataFrame, columns: Sequence[str], threshold: float = 0.7) -> DataFrame:
    """``(feature)``: each column whose |corr| with an EARLIER column (schema
    order) exceeds ``threshold``, named once."""
    pairs = corr_long(df, columns, digits=None)
    return (pairs.where((F.col("pos_b") < F.col("pos_a")) & (F.abs("corr") > threshold))
            .select(F.col("feature_a").alias("feature")).distinct())
