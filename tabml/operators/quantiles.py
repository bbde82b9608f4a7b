"""Quantiles of many columns: approximate (one sketch pass) and exact.

Exact quantiles use linear interpolation between the two values around rank
``(n - 1) * p`` (the same definition as Spark's ``percentile`` and SQL's
``quantile_cont``), but unlike ``percentile`` they never hold a whole column in
one aggregation buffer: counts by fixed magnitude buckets, then rounds of
equal-width bucket counts inside ever narrower value brackets (partial
aggregation keeps a bounded number of rows per bracket and task, whatever the
skew), then one exact count of the values inside the final brackets. Brackets
are literals; for one column their range is pushed into the Parquet scan (for
several a row group is skipped only if all of their brackets miss it). Two
scans on typical data; no sketch.

The final step is ``groupBy(bracket, value).count()`` (map-side combine folds
hot values to one row per task) and a running sum per bracket; only one row per
wanted rank reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions.expressions import qname
from tabml.operators.columns import qcol


def _dlit(x: float) -> str:
    """An exact double literal for a SQL string (shortest round-trip form)."""
    return f"{x!r}D" if x >= 0 else f"(-{-x!r}D)"


def _bucket_scale(lo: float, hi: float, buckets: int) -> float | None:
    """Multiplier that maps ``[lo, hi]`` onto ``[0, buckets]`` (halves keep
    ``hi - lo`` finite for any pair of doubles); None when the range cannot be
    split further."""
    width = hi * 0.5 - lo * 0.5
    if not width > 0:
        return None
    scale = buckets / width
    return scale if math.isfinite(scale) else None


def _bracket_rows(df: DataFrame, brackets: Sequence[dict], buckets: int | None) -> DataFrame:
    """``(bid, key, value)`` for every value inside a bracket, a finite range
    ``[lo, hi]`` of one column (``key``, the equal-width bucket, only when
    ``buckets`` is given). Brackets are literals of the projection, so no
    join is needed; their ranges are also a filter on the wide rows, which
    reaches the Parquet scan."""
    structs, ranges = [], []
    for b in brackets:
        x = f"CAST({qname(b['column'])} AS DOUBLE)"
        inside = f"{x} >= {_dlit(b['lo'])} AND {x} <= {_dlit(b['hi'])}"
        ranges.append(f"({inside})")
        fields = f"'bid', {b['bid']}, 'value', CASE WHEN {inside} THEN {x} END"
        if buckets is not None:
            scale = _bucket_scale(b["lo"], b["hi"], buckets)
            step = (f"CAST(FLOOR(LEAST({buckets - 1}D, GREATEST(0D, "
                    f"({x} * 0.5D - {_dlit(b['lo'] * 0.5)}) * {_dlit(scale)}))) AS INT)") if scale else "0"
            fields += f", 'key', {step}"
        structs.append(f"named_struct({fields})")
    return (df.where(" OR ".join(ranges)).selectExpr(f"inline(array({', '.join(structs)}))")
            .where("value IS NOT NULL"))


# Fixed first-round buckets: at most 64 per octave of |x| (each spans a
# factor of 2^(1/64), about 1.1%), so any double has one of at most about
# 270k keys.
LOG_STEPS = 64
_OFF = 1 << 21  # above |floor(log2|x| * LOG_STEPS)| for every double


def _magnitude_key(x: str, steps: int = LOG_STEPS) -> str:
    """An int that never decreases as the double ``x`` grows: -inf < negative
    values (by falling magnitude) < zero < positive values (by rising
    magnitude) < +inf < NaN, with ``steps`` keys per octave. It needs no
    statistics of the data, because ``log2`` is monotone (Java's log is
    semi-monotonic) and so is every other step."""
    mag = f"CAST(FLOOR(LOG2(ABS({x})) * {int(steps)}D) AS INT)"
    return (f"CASE WHEN isnan({x}) THEN {4 * _OFF + 1} WHEN {x} = double('inf') THEN {4 * _OFF} "
            f"WHEN {x} = double('-inf') THEN 0 WHEN {x} > 0D THEN {3 * _OFF} + {mag} "
            f"WHEN {x} < 0D THEN {_OFF} - {mag} ELSE {2 * _OFF} END")


def _ranked_hits(spark, counted: DataFrame, order: str, wanted: Sequence[tuple],
                 extra: Sequence[str]) -> list:
    """Running count per bracket over ``order`` (rows ``(bid, <order>, c,
    ...)``), joined with the wanted local ranks ``(bid, tid, rank)``: the rows
    that hold them."""
    needs = spark.createDataFrame(list(wanted), "bid int, tid int, rank long")
    w = Window.partitionBy("bid").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    k = counted.withColumn("end", F.sum("c").over(w)).alias("k")
    n = needs.alias("n")
    hit = k.join(F.broadcast(n), (F.col("k.bid") == F.col("n.bid"))
                 & (F.col("k.end") - F.col("k.c") <= F.col("n.rank"))
                 & (F.col("n.rank") < F.col("k.end")))
    return hit.select("n.tid", *[f"k.{c}" for c in (order, "c", "end", *extra)]).collect()


# Most (bracket, bucket) groups one histogram round may produce, so a task's
# partial-aggregation map stays bounded for inputs with many columns.
HIST_MAX_GROUPS = 1 << 20


def _histogram_select(df: DataFrame, columns: Sequence[str], probs: Sequence[float], *,
                      buckets: int, max_exact: int) -> DataFrame:
    """Exact quantiles by histogram selection.

    1. One pass counts every column's values by magnitude bucket (64 per
       octave, with -inf, zero, +inf and NaN on their own; see
       ``_magnitude_key``), with min and max per bucket. The keys need no
       statistics of the data, so this is the first scan. Partial
       aggregation leaves at most a few hundred rows per column and task on
       typical data, whatever the skew. A running count and the column total
       per column (windows over those few rows) give each wanted rank's
       bucket in the same plan; only those rows reach the driver.
    2. A bucket with one value is the answer; one of at most ``max_exact``
       rows goes to step 3; a larger one becomes a bracket ``[its min, its
       max]``, and each further round maps every open bracket to ``buckets``
       equal-width buckets (fewer when many brackets would exceed
       ``HIST_MAX_GROUPS``), shrinking the value range by about ``buckets``.
    3. One pass counts each value inside the final brackets
       (``groupBy(bracket, value)``, at most ``max_exact`` distinct values per
       bracket) and a running count picks the exact value at each rank.

    Bucket numbers never decrease as the value grows, so buckets never
    overlap and counts below a bucket are exact. Brackets are literals (a
    few per column), so later passes filter the scan to the bracket ranges
    and explode only the values inside them. On typical data this is two
    scans; a 100 TB column takes one linear round more.
    """
    spark = df.sparkSession
    structs = ", ".join(f"named_struct('bid', {i}, 'value', CAST({qname(c)} AS DOUBLE))"
                        for i, c in enumerate(columns))
    long = df.selectExpr(f"inline(array({structs}))").where("value IS NOT NULL")
    # steps per octave within the group budget for data spanning about 32
    # octaves: 64 for up to ~500 columns, fewer for wider inputs
    steps = max(1, min(LOG_STEPS, HIST_MAX_GROUPS // (32 * max(1, len(columns)))))
    counted = (long.groupBy("bid", F.expr(_magnitude_key("value", steps)).alias("key"))
               .agg(F.count(F.lit(1)).alias("c"), F.min("value").alias("vmin"),
                    F.max("value").alias("vmax")))
    run = Window.partitionBy("bid").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    ps = F.array(*[F.lit(float(p)) for p in probs])
    ranked = (counted.withColumn("end", F.sum("c").over(run))
              .withColumn("n", F.sum("c").over(Window.partitionBy("bid")))
              .select("*", F.explode(ps).alias("p"))
              .withColumn("pos", (F.col("n") - 1) * F.col("p")))

    def covers(r):
        return (F.col("end") - F.col("c") <= r) & (r < F.col("end"))

    first = ranked.where(covers(F.floor("pos")) | covers(F.ceil("pos"))).select(
        "bid", "n", "key", "c", "end", "vmin", "vmax").collect()

    # one target per (column, p); each needs the values at ranks floor and
    # ceil of (n - 1) * p, 0-based
    hits_of: dict[int, list] = {}
    n_of: dict[int, int] = {}
    for r in first:
        hits_of.setdefault(r["bid"], []).append(r)
        n_of[r["bid"]] = r["n"]
    targets = []  # (column, p, pos, r_lo, r_hi)
    rank_ids: dict[tuple[str, int], int] = {}
    value_at: dict[int, float] = {}
    state: dict[int, tuple] = {}  # open rank id -> (bracket key, rows below the bracket)
    final: dict[tuple, dict] = {}
    brackets: dict[tuple, dict] = {}  # (column, lo, hi) -> bracket

    def place(rid: int, col: str, r, below: int) -> None:
        """Resolve a rank from the bucket row ``r`` that holds it, or open
        the bucket as a bracket (exact count or another round)."""
        lo, hi = r["vmin"], r["vmax"]
        if lo == hi or not (math.isfinite(lo) and math.isfinite(hi)):
            value_at[rid] = lo  # one value (incl. -inf, +inf, NaN buckets)
            return
        key = (col, lo, hi)
        if r["c"] <= max_exact or _bucket_scale(lo, hi, buckets) is None:
            final[key] = dict(column=col, lo=lo, hi=hi)
        else:
            brackets[key] = dict(column=col, lo=lo, hi=hi)
        state[rid] = (key, below)

    for i, c in enumerate(columns):
        n = n_of.get(i)
        if not n:
            continue
        for p in probs:
            pos = (n - 1) * float(p)
            r_lo, r_hi = math.floor(pos), math.ceil(pos)
            targets.append((c, float(p), pos, r_lo, r_hi))
            for rank in (r_lo, r_hi):
                if (c, rank) in rank_ids:
                    continue
                rid = rank_ids[(c, rank)] = len(rank_ids)
                r = next(h for h in hits_of[i] if h["end"] - h["c"] <= rank < h["end"])
                place(rid, c, r, r["end"] - r["c"])
    ranks = {rid: r for (_, r), rid in rank_ids.items()}

    def numbered(open_ids, table):
        used = sorted({state[rid][0] for rid in open_ids}, key=repr)
        bid = {k: i for i, k in enumerate(used)}
        rows = [dict(table[k], bid=bid[k]) for k in used]
        wanted = [(bid[state[rid][0]], rid, ranks[rid] - state[rid][1]) for rid in open_ids]
        return rows, wanted

    # ends: a round narrows each bracket about ``buckets`` times, until it holds few rows, one value, or a
    # range that doubles cannot divide further
    while True:
        open_ids = [rid for rid, (k, _) in state.items() if k in brackets and rid not in value_at]
        if not open_ids:
            break
        rows, wanted = numbered(open_ids, brackets)
        # bound the groups a task's partial aggregation holds, however wide
        # the input: fewer buckets per bracket when there are many brackets
        nb = max(16, min(buckets, HIST_MAX_GROUPS // len(rows)))
        counted = (_bracket_rows(df, rows, nb).groupBy("bid", "key")
                   .agg(F.count(F.lit(1)).alias("c"), F.min("value").alias("vmin"),
                        F.max("value").alias("vmax")))
        current, brackets = brackets, {}
        for r in _ranked_hits(spark, counted, "key", wanted, ["vmin", "vmax"]):
            rid = r["tid"]
            bkey, below = state.pop(rid)
            place(rid, current[bkey]["column"], r, below + r["end"] - r["c"])
    open_ids = [rid for rid in state if rid not in value_at]
    if open_ids:
        rows, wanted = numbered(open_ids, final)
        counted = _bracket_rows(df, rows, None).groupBy("bid", "value").agg(F.count(F.lit(1)).alias("c"))
        for r in _ranked_hits(spark, counted, "value", wanted, []):
            value_at[r["tid"]] = r["value"]

    out = []
    for c, p, pos, r_lo, r_hi in targets:
        a, b = value_at[rank_ids[(c, r_lo)]], value_at[rank_ids[(c, r_hi)]]
        out.append((c, p, a if a == b else a + (pos - r_lo) * (b - a)))
    found = {c for c, *_ in targets}
    out += [(c, float(p), None) for c in columns if c not in found for p in probs]
    return spark.createDataFrame(out, "column string, p double, value double")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], *, max_exact: int = 1_000_000,
                    buckets: int = 4096) -> DataFrame:
    """``(column, p, value)``: exact interpolated quantiles of each column
    (see ``_histogram_select``).

    Nulls are ignored; a column without values gives null. Values are
    doubles: whole numbers beyond 2^53 lose their last digits.
    """
    if any(not 0.0 <= p <= 1.0 for p in probs):
        raise ValueError("probabilities must lie in [0, 1]")
    # the values once per pass, however many brackets test them
    doubles = df.select(*[qcol(c).cast("double").alias(c) for c in dict.fromkeys(columns)])
    return _histogram_select(doubles, list(dict.fromkeys(columns)), probs, buckets=buckets, max_exact=max_exact)


def quartiles(df: DataFrame, columns: Sequence[str], *, exact: bool = True,
              relative_error: float = 0.05, **kwargs) -> DataFrame:
    """``(column, q1, q3)``. ``exact=False`` gives the sketch answer with the
    stated relative rank error (0.05 means accuracy 20). The exact answer is
    two values per column, pivoted once on the driver into a local table."""
    if exact:
        cols = list(dict.fromkeys(columns))
        got = {(r["column"], r["p"]): r["value"]
               for r in exact_quantiles(df, cols, [0.25, 0.75], **kwargs).collect()}
        return df.sparkSession.createDataFrame(
            [(c, got.get((c, 0.25)), got.get((c, 0.75))) for c in cols], "column string, q1 double, q3 double")
    # the sketch aggregate is one row; both quartiles of a column are read
    # from it directly (no second aggregation)
    ps = F.array(F.lit(0.25), F.lit(0.75))
    acc = max(1, round(1 / relative_error))
    one = df.agg(*[F.percentile_approx(qcol(c).cast("double"), ps, acc).alias(f"q{i}")
                   for i, c in enumerate(columns)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"q{i}")[0].alias("q1"), F.col(f"q{i}")[1].alias("q3"))
        for i, c in enumerate(columns)])))
