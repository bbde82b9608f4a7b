"""Connected components of an edge table by large-star and small-star rounds.

Each round rewires every edge towards the smallest neighbour (Kiveris et al.,
"Connected Components in MapReduce and Beyond", 2014). A round is a grouped
minimum, which Spark combines before the shuffle, and a join of the edges with
those minima; the minima are stored first, so that both sides of the join come
straight from a shuffle and adaptive execution can split a hot vertex. Edges
are stored after every round, so that lineage stays short and a lost executor
costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import stored

EDGE = "a long, b long"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member) of every component of the edges a-b, without the smallest itself."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    keep = label != np.arange(len(ids))
    return ids[keep], ids[label[keep]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _toward(nb: DataFrame, low: DataFrame) -> DataFrame:
    """Neighbour rows (u, v) with the smallest neighbour m of u, from stored minima."""
    low = low.select(F.col("u").alias("w"), "m")
    return nb.join(low, nb.u == low.w).select("u", "v", "m")


def _large(edges: DataFrame) -> DataFrame:
    nb = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    low = stored(nb.groupBy("u").agg(F.min("v").alias("m")).filter("m < u"), "components-min")
    moved = _toward(nb.filter("v > u"), low).select(F.col("v").alias("a"), F.col("m").alias("b"))
    # a vertex below all its neighbours keeps its edges: no join, however many they are
    kept = edges.join(low.select(F.col("u").alias("b")), "b", "left_anti")
    return moved.union(kept.select("a", "b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    nb = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    low = stored(nb.groupBy("u").agg(F.min("v").alias("m")), "components-min")
    own = low.select(F.col("u").alias("a"), F.col("m").alias("b"))
    rest = _toward(nb, low).filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return own.union(rest).distinct()


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(h.bitwiseAND(F.lit((1 << 40) - 1))), F.bit_xor(h)).first())


def components(edges: DataFrame) -> DataFrame:
    """(v, c): each vertex that is not the smallest of its component, and the smallest.

    ``edges``: columns a and b (long); direction, repeats, loops and rows with
    nulls don't matter. Vertices without a row are components of their own or
    the smallest member.
    """
    clean = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    now = stored(clean.filter("a is not null and b is not null").mapInArrow(_local, EDGE).distinct(), "components")
    mark = _mark(now)
    while mark[0]:
        now = stored(_small(stored(_large(now), "components")), "components")
        was, mark = mark, _mark(now)
        if mark == was:
            break
    return now.select(F.col("a").alias("v"), F.col("b").alias("c"))
