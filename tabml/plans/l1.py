"""Multinomial logistic regression with an elastic-net penalty, by proximal Newton steps.

The objective is Spark's: mean log loss of the softmax over all classes, plus ``reg * (elastic_net * |w|_1 +
(1 - elastic_net) / 2 * |w|_2^2)`` over the coefficients of features divided by their standard deviations; intercepts
are free. Each step takes one pass over the rows: every Arrow batch adds its loss at a few step lengths of the last
direction, its gradient and its Hessian (the Gram matrix of the features, weighted by each pair of classes) as
matrix products over the rows that are complete, and the sums of the tasks meet in one grouped aggregate. The
driver receives (classes x features)^2 numbers whatever the rows, and solves the penalized quadratic by coordinate
descent. Newton steps need some ten passes where gradient methods need a hundred.

The result carries its certificate: the residual of the optimality (Karush-Kuhn-Tucker) conditions of every coefficient.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators.columns import persisted, qcol

#: Step lengths whose loss one pass computes beside the full one's derivatives.
STEPS = (1.0, 0.5, 0.25, 0.125, 0.03125)
#: Largest number of classes and of unknowns ((features + 1) x classes); the Hessian has the square of the latter.
MOST_CLASSES, MOST_UNKNOWNS = 100, 2000
_ROWS = 16_384


@dataclass
class L1Model:
    """A fitted model: coefficients of the features as they are (class by feature), intercepts, and the certificate."""

    features: list[str]
    labels: list
    coefficients: np.ndarray
    intercepts: np.ndarray
    deviations: np.ndarray
    gradient: np.ndarray
    residual: np.ndarray
    passes: int
    rows: int
    objective: list[float] = field(default_factory=list)

    def margins(self) -> list[Column]:
        """One built-in expression per class."""
        x = [qcol(c).cast("double") for c in self.features]
        out = []
        for w, b in zip(self.coefficients, self.intercepts):
            e = F.lit(float(b))
            for column, v in zip(x, w):
                if v:
                    e = e + column * float(v)
            out.append(e)
        return out

    def predict(self, df: DataFrame, prediction: str = "prediction", probability: str | None = None) -> DataFrame:
        """``df`` with the likeliest label (ties: the first), null where a feature is missing or not finite; and the classes' probabilities."""
        inside = F.lit(True)
        for c in self.features:
            inside = inside & F.coalesce(F.abs(qcol(c).cast("double")) < float("inf"), F.lit(False))
        z = F.array(*self.margins())
        labels = F.array(*map(F.lit, self.labels))
        best = F.get(labels, (_once(z, lambda z: F.array_position(z, F.array_max(z))) - 1).cast("int"))
        out = df.withColumn(prediction, F.when(inside, best))
        if probability:
            e = _once(z, lambda z: _once(F.array_max(z), lambda top: F.transform(z, lambda v: F.exp(v - top))))
            shares = _once(e, lambda e: _once(F.aggregate(e, F.lit(0.0), lambda a, v: a + v), lambda total: F.transform(e, lambda v: v / total)))
            out = out.withColumn(probability, F.when(inside, shares))
        return out

    def certificate(self, spark: SparkSession) -> DataFrame:
        """(class, feature, coefficient, gradient, residual) for each coefficient (of the scaled features) and intercept (feature null)."""
        rows = []
        for k, label in enumerate(self.labels):
            scaled = [*(self.coefficients[k] * self.deviations), self.intercepts[k]]
            for j, name in enumerate([*self.features, None]):
                rows.append((str(label), name, float(scaled[j]), float(self.gradient[k, j]), float(self.residual[k, j])))
        return spark.createDataFrame(rows, "class string, feature string, coefficient double, gradient double, residual double")


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row: named inside another lambda it would be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(n: int) -> list[tuple[int, int]]:
    return [(k, m) for k in range(n) for m in range(k, n)]


def _pass(typed: DataFrame, scale: np.ndarray, base: np.ndarray, move: np.ndarray | None) -> dict[int, float]:
    """Sums over the rows of ``typed`` (label number ``y``, features ``x0``...): the loss at ``base + step * move`` for each of
    ``STEPS`` (one step without ``move``), gradient and Hessian blocks at ``base + move``."""
    classes, q = base.shape
    steps = STEPS if move is not None else (1.0,)
    at = [base + s * (move if move is not None else 0.0) for s in steps]
    pairs = _blocks(classes)

    def run(batches):
        import pyarrow as pa

        losses, gradient, hessian = np.zeros(len(steps)), np.zeros((classes, q)), np.zeros((len(pairs), q, q))
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                y = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                x = np.column_stack([*(part.column(j + 1).to_numpy(zero_copy_only=False) for j in range(q - 1)), np.ones(len(y))]) * scale
                own = np.arange(len(y))
                for s, w in enumerate(at):
                    z = x @ w.T
                    top = z.max(axis=1, keepdims=True)
                    e = np.exp(z - top)
                    total = e.sum(axis=1)
                    losses[s] += float(np.sum(np.log(total) + top[:, 0] - z[own, y]))
                    if not s:
                        p = e / total[:, None]
                d = p.copy()
                d[own, y] -= 1.0
                gradient += d.T @ x
                for b, (k, m) in enumerate(pairs):
                    weight = p[:, k] * ((1.0 if k == m else 0.0) - p[:, m])
                    hessian[b] += (x * weight[:, None]).T @ x
        values = np.concatenate([losses, gradient.ravel(), hessian.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], ["i", "v"])

    sums = typed.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    return {r["i"]: r["v"] for r in sums}


def _unpack(sums: dict[int, float], n_steps: int, classes: int, q: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pairs = _blocks(classes)
    values = np.array([sums[i] for i in range(len(sums))]) / rows
    gradient = values[n_steps: n_steps + classes * q].reshape(classes, q)
    blocks = values[n_steps + classes * q:].reshape(len(pairs), q, q)
    hessian = np.zeros((classes, q, classes, q))
    for (k, m), b in zip(pairs, blocks):
        hessian[k, :, m, :] = b
        hessian[m, :, k, :] = b.T
    return values[:n_steps], gradient, hessian.reshape(classes * q, classes * q)


def _direction(w: np.ndarray, g: np.ndarray, h: np.ndarray, l1: np.ndarray, sweeps: int = 2000) -> np.ndarray:
    """The move that makes ``g.d + d.h.d / 2 + sum(l1 * |w + d|)`` smallest, by cyclic coordinate descent."""
    d, hd = np.zeros_like(w), np.zeros_like(w)
    curvature = np.maximum(np.diag(h), 1e-12)
    for _ in range(sweeps):
        most = 0.0
        for i in range(len(w)):
            now = w[i] + d[i]
            new = now - (g[i] + hd[i]) / curvature[i]
            new = math.copysign(max(abs(new) - l1[i] / curvature[i], 0.0), new)
            if new != now:
                step = new - now
                d[i] += step
                hd += h[:, i] * step
                most = max(most, abs(step) * math.sqrt(curvature[i]))
        if most < 1e-13:
            break
    return d


def _residual(w: np.ndarray, g: np.ndarray, l1: np.ndarray) -> np.ndarray:
    """How far each unknown is from its optimality condition: the smallest absolute subgradient."""
    return np.where(w != 0, np.abs(g + l1 * np.sign(w)), np.maximum(np.abs(g) - l1, 0.0))


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, *, reg: float = 0.01, elastic_net: float = 1.0, max_passes: int = 15,
                 tolerance: float = 1e-8, missing: str = "skip", persist: bool = True) -> L1Model:
    """Fits on the rows of ``df`` that have a label. A feature is missing if null, NaN or infinite: such rows are left out
    (``missing="skip"``) or raise (``"error"``). A constant feature gets coefficient 0. Classes are the labels that occur,
    in their order. Stops when every optimality residual is below ``tolerance``, or after ``max_passes`` passes over the rows
    (the certificate then says how far it came). The narrow input is kept for the passes unless ``persist`` is False."""
    if missing not in ("skip", "error"):
        raise ValueError(f"unknown answer to missing features {missing!r}")
    features = list(features)
    x = [qcol(c).cast("double") for c in features]
    typed = df.select(qcol(label).alias("label"), *[F.when(F.abs(c) < float("inf"), c).alias(f"x{j}") for j, c in enumerate(x)])
    typed = typed.where(F.col("label").isNotNull() & ~F.coalesce(F.isnan(F.col("label").try_cast("double")), F.lit(False)))
    whole = F.lit(True)
    for j in range(len(features)):
        whole = whole & F.col(f"x{j}").isNotNull()
    seen = typed.groupBy("label").agg(F.count_if(whole).alias("n"), F.count_if(~whole).alias("bad"), *[
        f(F.when(whole, F.col(f"x{j}"))).alias(f"{name}{j}") for j in range(len(features)) for name, f in (("mean", F.avg), ("dev", F.var_pop))]).limit(MOST_CLASSES + 1).collect()
    if len(seen) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} values of {label!r}: not a class label")
    if missing == "error" and any(r["bad"] for r in seen):
        raise ValueError(f"{sum(r['bad'] for r in seen)} rows have a missing or infinite feature")
    seen = sorted((r for r in seen if r["n"]), key=lambda r: r["label"])
    if not seen:
        raise ValueError("no row has a label and all features")
    labels, count = [r["label"] for r in seen], np.array([r["n"] for r in seen], float)
    classes, q, rows = len(seen), len(features) + 1, int(count.sum())
    if classes * q > MOST_UNKNOWNS:
        raise ValueError(f"{classes} classes of {len(features)} features are {classes * q} unknowns: more than {MOST_UNKNOWNS}")
    # sample deviations from those within and between the classes
    mean = np.array([[r[f"mean{j}"] for j in range(q - 1)] for r in seen]).reshape(classes, q - 1)
    within = np.array([[r[f"dev{j}"] for j in range(q - 1)] for r in seen]).reshape(classes, q - 1)
    centre = count @ mean / rows
    spread = count @ (within + (mean - centre) ** 2)
    dev = np.sqrt(spread / max(1, rows - 1))
    dev = np.where(dev > 1e-14 * np.abs(centre), dev, 0.0)
    inverse = np.divide(1.0, dev, out=np.zeros_like(dev), where=dev > 0)

    index = F.array_position(F.array(*map(F.lit, labels)), F.col("label")) - 1
    typed = typed.where(whole).select(index.cast("int").alias("y"), *[(F.col(f"x{j}") - F.lit(float(centre[j]))).alias(f"x{j}") for j in range(q - 1)])
    scale = np.append(inverse, 1.0)
    free = np.append(dev > 0, True)
    l1 = np.tile(np.append(np.full(q - 1, reg * elastic_net), 0.0), classes)
    l2 = np.tile(np.append(np.full(q - 1, reg * (1 - elastic_net)), 0.0), classes)
    open_ = np.tile(free, classes)

    def penalty(w: np.ndarray) -> float:
        return float(np.sum(l1 * np.abs(w)) + 0.5 * np.sum(l2 * w * w))

    w = np.zeros((classes, q))
    w[:, -1] = np.log(count / rows) - np.mean(np.log(count / rows))
    move, history, passes, value = None, [], 0, math.inf
    with persisted(typed) if persist else _as_is(typed) as kept:
        while True:
            sums = _pass(kept, scale, w, move)
            passes += 1
            n_steps = len(STEPS) if move is not None else 1
            losses, g, h = _unpack(sums, n_steps, classes, q, rows)
            tried = [float(v) + penalty((w + s * (move if move is not None else 0.0)).ravel()) for v, s in zip(losses, STEPS)]
            if move is not None and not tried[0] <= value + 1e-12 * abs(value) and passes < max_passes:
                # the full step goes too far: the best shorter one is the next point, and a pass there gives its derivatives
                s = int(np.argmin(tried))
                w, move = (w + STEPS[s] * move, None) if tried[s] < value else (w, 0.01 * move)
                continue
            if move is not None:
                w = w + move
            value = tried[0]
            history.append(value)
            flat = w.ravel()
            g = g.ravel() + l2 * flat
            residual = np.where(open_, _residual(flat, g, l1), 0.0)
            if residual.max() < tolerance or passes >= max_passes:
                break
            h = h + np.diag(l2)
            step = np.zeros_like(flat)
            step[open_] = _direction(flat[open_], g[open_], h[np.ix_(open_, open_)], l1[open_])
            move = step.reshape(classes, q)
    coefficients = w[:, :-1] * inverse
    intercepts = w[:, -1] - coefficients @ centre
    shape = (classes, q)
    return L1Model(features, labels, coefficients, intercepts - intercepts.mean(), dev, g.reshape(shape), residual.reshape(shape), passes, rows, history)


class _as_is:
    def __init__(self, df: DataFrame):
        self.df = df

    def __enter__(self) -> DataFrame:
        return self.df

    def __exit__(self, *_) -> None:
        pass
