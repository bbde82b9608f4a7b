"""Embedding near-duplicates by spherical k-means cells and blocked cosine products.

Vectors of a label are assigned to the nearest of its centres. Two vectors of
different cells can only be within the angle of the threshold if either is as
near to the plane between the two centres, so a vector also visits every cell
with a lower number whose plane is near enough and whose radius reaches it.
That makes the comparison complete, however well the centres fit. Cells beyond
a block are dealt out as pairs of blocks. Equal vectors are compared once and
counted as often as they occur. A task returns link counts and a spanning forest
of its links, not the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabml.llm.common import stored
from tabml.llm.components import components, forest

#: Vectors of a cell on average, cells in all, and vectors of a block.
CELL, MOST_CELLS, BLOCK = 2048, 4096, 2048
#: Sampled vectors for each cell, and rounds, of the k-means fit.
SAMPLE, ROUNDS = 32, 8
#: Cosines that a task holds at once.
PRODUCTS = 1 << 20


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.array(rows.tolist(), np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no overflow or underflow of the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _chunks(rows: int, columns: int) -> Iterator[slice]:
    """Slices of rows whose cosines with ``columns`` centres are at most ``PRODUCTS`` numbers (one row at least)."""
    step = max(1, PRODUCTS // max(1, columns))
    return (slice(k, k + step) for k in range(0, rows, step))


Centres = dict[tuple[int, int], np.ndarray]


def _partial_sums(centres: Centres):
    """The sum of a task's vectors for each nearest centre."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {}
        for pdf in batches:
            for key, g in pdf.groupby(["label", "dim"], sort=False):
                c, x = centres[key], _unit(g["x"])
                total, met = sums.setdefault(key, (np.zeros_like(c), np.zeros(len(c), bool)))
                for part in _chunks(len(x), len(c)):
                    home = (x[part] @ c.T).argmax(1)
                    np.add.at(total, home, x[part])
                    met[home] = True
        for (label, dim), (total, met) in sums.items():
            cells = np.flatnonzero(met)
            yield pd.DataFrame({"label": label, "dim": dim, "cell": cells, "s": list(total[cells])})

    return run


def spherical_kmeans(sample: DataFrame, centres: Centres, rounds: int = ROUNDS) -> Centres:
    """Unit centres of the vectors of ``sample`` (label, dim, x), from the given ones: assignment by cosine, means scaled to length one.

    A round sums in the tasks and then by centre; one sum for each centre reaches the driver.
    """
    kinds = "label long, dim int, cell int, s array<double>"
    for _ in range(rounds):
        sums = sample.mapInPandas(_partial_sums(centres), kinds).groupBy("label", "dim", "cell").agg(Summarizer.sum(array_to_vector("s")).alias("s"))
        centres = {key: c.copy() for key, c in centres.items()}
        for r in sums.select("label", "dim", "cell", vector_to_array("s").alias("s")).collect():
            s = np.array(r.s)
            size = np.linalg.norm(s)
            if size > 1e-12:
                centres[r.label, r.dim][r.cell] = s / size
    return centres


def fit_centres(vectors: DataFrame, cell: int = CELL, most: int = MOST_CELLS) -> Centres:
    """Centres of each (label, dimension) with more than a cell's vectors.

    At most ``most`` cells in all, fitted to a sample of about ``SAMPLE`` vectors for
    each, chosen by a hash of the id. The bound holds for the fit alone; all
    vectors are assigned. The sample stays on the executors.
    """
    total = vectors.count()
    cell = max(cell, -(-total // most))
    large = vectors.groupBy("label", "dim").agg(F.count("*").alias("n")).filter(F.col("n") > cell)
    large = vectors.sparkSession.createDataFrame(large.collect(), large.schema)  # fewer than cells
    cells = large.withColumn("cells", F.ceil(F.col("n") / cell)).drop("n")
    if not large.head(1):
        return {}
    share = min(1.0, SAMPLE / cell)
    picked = vectors.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < math.ceil(share * (1 << 30))).select("label", "dim", "v", "x")
    sample = stored(picked.join(F.broadcast(cells), ["label", "dim"]), "embedding-sample")
    # the first centres: of each label, vectors with the smallest of another hash; ids alone are ordered
    order = W.partitionBy("label", "dim").orderBy(F.xxhash64(F.lit(5), "v"), "v")
    first = sample.select("label", "dim", "v", "cells").withColumn("r", F.row_number().over(order)).filter("r <= cells").select("v", "r")
    start: dict[tuple[int, int], list[np.ndarray]] = {}
    chosen = sample.select("label", "dim", "v", "x").join(F.broadcast(first), "v").collect()
    for r in sorted(chosen, key=lambda r: (r.label, r.dim, r.r)):
        start.setdefault((r.label, r.dim), []).append(_unit(pd.Series([r.x]))[0])
    if not start:
        return {}
    held = F.broadcast(vectors.sparkSession.createDataFrame(list(start), "label long, dim int"))
    return spherical_kmeans(sample.join(held, ["label", "dim"], "left_semi").select("label", "dim", "x"), {key: np.array(c) for key, c in start.items()})


def _assign(centres: Centres, far: float):
    """Home cell of each vector, and the cells whose plane is within the angle; cosines of both."""

    def run(batches):
        for pdf in batches:
            for key, g in pdf.groupby(["label", "dim"], sort=False):
                x = _unit(g["x"])
                c = centres.get(key)
                if c is None or len(c) < 2:
                    yield g.assign(home=0, cell=0, to=1.0)[["label", "dim", "v", "m", "x", "home", "cell", "to"]]
                    continue
                for part in _chunks(len(x), len(c)):
                    cos = x[part] @ c.T
                    home, at = cos.argmax(1), np.arange(len(cos))
                    apart = np.sqrt(np.maximum(2 - 2 * (c[home] @ c.T), 1e-30))
                    # signed distance from the plane between the own centre and each other
                    near = (cos[at, home][:, None] - cos <= (far + 1e-9) * apart) & (np.arange(len(c)) < home[:, None])
                    near[at, home] = True
                    row, cell = np.nonzero(near)
                    out = g.iloc[part].iloc[row]
                    yield out.assign(home=home[row], cell=cell, to=cos[row, cell])[["label", "dim", "v", "m", "x", "home", "cell", "to"]]

    return run


def _compare(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """One block against another, or against itself."""
        a = pdf[pdf["side"] != 1].sort_values("v")
        same = bool(pdf["same"].iat[0])
        b = a if same else pdf[pdf["side"] == 1].sort_values("v")
        if not len(a) or not len(b):
            return pd.DataFrame({"a": [], "b": [], "n": []})
        xa, xb = _unit(a["x"]), _unit(b["x"])
        va, vb, ma, mb = a["v"].to_numpy(), b["v"].to_numpy(), a["m"].to_numpy(), b["m"].to_numpy()
        na, nb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        one, two = np.empty(0, np.int64), np.empty(0, np.int64)
        for k in range(0, len(a), 512):
            cos = xa[k:k + 512] @ xb.T
            hit = cos >= threshold
            for i, j in np.argwhere(np.abs(cos - threshold) < 1e-12):  # at the threshold: the plain formula decides
                p, q = np.array(a["x"].iat[k + i], np.float64), np.array(b["x"].iat[j], np.float64)
                hit[i, j] = p @ q / (math.sqrt(p @ p) * math.sqrt(q @ q)) >= threshold
            if same:
                hit &= np.arange(len(b)) > np.arange(k, k + len(cos))[:, None]
            i, j = np.nonzero(hit)
            np.add.at(na, i + k, mb[j])
            np.add.at(nb, j, ma[i + k])
            one, two = forest(np.concatenate([one, va[i + k]]), np.concatenate([two, vb[j]]))
        counts = pd.DataFrame({"a": np.concatenate([va, vb]), "n": np.concatenate([na, nb])})
        return pd.concat([counts[counts["n"] > 0].assign(b=None), pd.DataFrame({"a": one, "b": two, "n": 0})])[["a", "b", "n"]].astype({"a": "int64", "b": "Int64", "n": "int64"})

    return run


def _usable(x: Column) -> Column:
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & sound & F.exists(x, lambda c: c != 0)


def embedding_groups(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """Near-duplicate groups of vectors of one label by cosine.

    Returns vec_id, n_links (other vectors linked directly), component_id
    (smallest vec_id reachable, itself included) and kept (vec_id =
    component_id), one row per input row. Vectors that are null, empty or zero,
    hold null or non-finite components, or have no label or id link with
    nothing, and so do vectors of different length; a null id has a null
    component and is not kept. Copies, and rows that repeat an id, count as
    other vectors. ``label_col`` None: all vectors are of one label.
    """
    if not 0 < threshold < 1:
        raise ValueError("the threshold must lie between 0 and 1")
    label = F.lit(0) if label_col is None else vectors[label_col]
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), label.cast("long").alias("label"), vectors[vector_col].cast("array<double>").alias("x"))
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & _usable(F.col("x"))
    keyed = rows.withColumn("ok", usable)
    # the number comes first: a hash is the seed of the next column's, so behind x both would follow from one hash of x
    keyed = keyed.withColumn("h1", F.xxhash64(F.lit(1), "x")).withColumn("h2", F.xxhash64(F.lit(2), "x"))
    same = ["label", "h1", "h2"]
    classes = keyed.filter("ok").groupBy(*same).agg(F.min("vec_id").alias("v"), F.count("*").alias("m"), F.min_by("x", "vec_id").alias("x"))
    classes = stored(classes.withColumn("dim", F.size("x")), "embedding-classes")

    centres = fit_centres(classes, cell)
    kinds = "label long, dim int, v long, m long, x array<double>, home int, cell int, to double"
    spread = classes.select("label", "dim", "v", "m", "x").mapInPandas(_assign(centres, math.sqrt(1 - threshold * threshold)), kinds)
    spread = stored(spread, "embedding-cells")
    of = ["label", "dim", "cell"]
    # counts and radius of each cell; no more rows than cells
    stats = spread.groupBy(*of).agg(
        F.sum(F.when(F.col("home") == F.col("cell"), 1).otherwise(0)).alias("homes"), F.count("*").alias("all"), F.min(F.when(F.col("home") == F.col("cell"), F.col("to"))).alias("edge")
    )
    dealt = spread.join(stats, of)
    reach = F.acos(F.least(F.lit(1.0), F.col("edge"))) + math.acos(threshold) + 1e-9
    dealt = dealt.filter((F.col("home") == F.col("cell")) | (F.acos(F.least(F.lit(1.0), F.col("to"))) <= reach))
    k_home, k_guest = F.ceil(F.col("homes") / block).cast("int"), F.ceil((F.col("all") - F.col("homes")) / block).cast("int")
    mix = F.xxhash64("v", F.lit(3))
    at_home = F.col("home") == F.col("cell")
    dealt = dealt.withColumn("kh", k_home).withColumn("kg", k_guest).withColumn("i", F.pmod(mix, F.when(at_home, F.col("kh")).otherwise(F.col("kg"))).cast("int"))
    # home blocks meet each other and every block of guests
    among = F.expr("transform(sequence(0, kh - 1), j -> named_struct('x', least(i, j), 'y', greatest(i, j), 'side', IF(i <= j, 0, 1), 'same', i = j))")
    host = F.expr("IF(kg > 0, transform(sequence(0, greatest(kg, 1) - 1), j -> named_struct('x', -1 - j, 'y', i, 'side', 0, 'same', false)), array())")
    guest = F.expr("transform(sequence(0, kh - 1), j -> named_struct('x', -1 - i, 'y', j, 'side', 1, 'same', false))")
    dealt = dealt.withColumn("p", F.explode(F.when(at_home, F.concat(among, host)).otherwise(guest)))
    pairs = dealt.select(*of, "p.x", "p.y", "p.side", "p.same", "v", "m", F.col("x").alias("vector"))
    pairs = pairs.select(*of, F.col("x").alias("bx"), F.col("y").alias("by"), "side", "same", "v", "m", F.col("vector").alias("x"))
    found = stored(pairs.groupBy(*of, "bx", "by").applyInPandas(_compare(threshold), "a long, b long, n long"), "embedding-links")

    links = found.groupBy(F.col("a").alias("v")).agg(F.sum("n").alias("n"))
    roots = components(found.filter("b is not null").select("a", "b"))
    per_class = classes.select(*same, "v", "m").join(links, "v", "left").join(roots, "v", "left")
    per_class = stored(per_class.select(*[F.col(c).alias(f"k_{c}") for c in same], F.coalesce("c", "v").alias("root"), (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")), "embedding-classes-linked")
    matched = keyed.select("vec_id", "ok", *same).join(per_class, F.col("ok") & (F.col("label") == F.col("k_label")) & (F.col("h1") == F.col("k_h1")) & (F.col("h2") == F.col("k_h2")), "left")
    component = F.coalesce("root", "vec_id")
    return matched.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
