"""Ranked lexical search by pipelined term partitioning (Moffat, Webber, Zobel, Baeza-Yates, "A pipelined architecture
for distributed text query evaluation", 2007).

Terms belong to owners, the rarest to the first. Items travel in bundles through the owners' stages; a bundle carries
sparse accumulators, the scores so far of the documents that it has met. In each stage a cogroup by bundle and block of
documents brings them together with the owner's postings of that block, and the owner adds its integer contributions.
After the last stage each block selects its best, and the best of all blocks are the answer.

Blocks bound what meets in a task: some megabytes of text and some thousand documents, whatever the frequency of a
term. Between stages an accumulator goes if it can no longer count: if it and all that later owners could add stay under
a bound that the item's k-th best document has passed already, in the same block or (after a stage is stored) in any. A
document that appears for the first time stays under the same rule. Both bounds are exact, so no answer is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import stored
from tabml.llm.words import Sieve, cut, hashes, make_sieve, words_of

#: Text and documents of a block, and items of a bundle (on average).
BLOCK_BYTES, BLOCK_ROWS, BUNDLE = 8 << 20, 4096, 256
#: A term belongs to the first owner whose share of the documents it stays below; the commonest to the last.
OWNERS = (1 / 256, 1 / 32, 1 / 4)
#: No document's share of a term, before the term's weight, reaches this.
MOST = 1_000_000

_POSTINGS = "block long, term string, docs binary, tfs binary, ids binary, lengths binary, no_ids binary"
_ASKED = "item long, term string, times long"
_CARRIED = "bundle long, block long, ids binary, no_ids binary, m binary, rows binary, docs binary, scores binary, tops array<struct<item: long, score: long>>"
_BEST = "item long, score long, doc_id long"


def _block_postings(sieve: Sieve):
    """Per block a row with its documents (no term), and a row for each term that passes the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in cut(batches, BLOCK_BYTES, BLOCK_ROWS):
            w = words_of(batch.column("text"))
            ids = batch.column("doc_id")
            rows = [{"block": block, "ids": ids.fill_null(0).to_numpy().tobytes(), "no_ids": ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                     "lengths": w.count.astype(np.int64).tobytes()}]
            if len(w.code):
                asked = np.flatnonzero(sieve.passes(hashes(w.distinct)))
                place = np.full(len(w.distinct), -1, np.int64)
                place[asked] = np.arange(len(asked))
                at = place[w.code]
                key, tf = np.unique(at[at >= 0] * batch.num_rows + w.text[at >= 0], return_counts=True)
                ends = np.searchsorted(key, np.arange(len(asked) + 1) * batch.num_rows)
                doc, tf = (key % batch.num_rows).astype(np.int32), tf.astype(np.int32)
                terms = w.distinct.take(pa.array(asked)).to_pylist()
                rows += [{"block": block, "term": t, "docs": doc[a:b].tobytes(), "tfs": tf[a:b].tobytes()} for t, a, b in zip(terms, ends, ends[1:])]
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
            block += 1

    return run


_SCHEMA = pa.schema([("block", pa.int64()), ("term", pa.string()), *[(c, pa.binary()) for c in ("docs", "tfs", "ids", "lengths", "no_ids")]])


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut(batches, BLOCK_BYTES, BLOCK_ROWS):
        w = words_of(batch.column("text"))
        if len(w.code):
            key, times = np.unique(w.text * len(w.distinct) + w.code, return_counts=True)
            yield pa.RecordBatch.from_arrays([
                batch.column("item").take(pa.array(key // len(w.distinct))), w.distinct.take(pa.array(key % len(w.distinct))), pa.array(times, pa.int64())], ["item", "term", "times"])


def _hash_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"h": pa.array(hashes(batch.column("term")).view(np.int64))})


def _statistics(postings: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""
    lengths = postings.filter("term is null").select("lengths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("lengths"):
                n = np.frombuffer(x.as_py(), np.int64)
                yield pa.RecordBatch.from_pydict({"n": [int((n > 0).sum())], "total": [int(n.sum())]})

    one = lengths.mapInArrow(run, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return one[0] or 0, one[1] or 0


def _start(n: int, total: int):
    """Blocks as bundles without accumulators; m is what a document's length makes of a term's occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                length = np.frombuffer(row["lengths"], np.int64)
                m = 25 + (75 * length * n) // max(1, total)
                yield pa.RecordBatch.from_pylist([{"block": row["block"], "ids": row["ids"], "no_ids": row["no_ids"], "m": m.tobytes()}], schema=_START)

    return run


_START = pa.schema([("block", pa.int64()), *[(c, pa.binary()) for c in ("ids", "no_ids", "m")]])


def _best(score: np.ndarray, ids: np.ndarray, no_ids: np.ndarray, top: int) -> np.ndarray:
    """The places of the ``top`` best: by score, falling, then id, the ones without last."""
    if len(score) > top:
        least = np.partition(score, len(score) - top)[len(score) - top]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], no_ids[some], -score[some]))][:top]


def _stage(owner: int, top: int, last: bool):
    """Adds the contributions of one owner's postings to the bundle's accumulators of a block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            items = {item: i for i, item in enumerate(sorted(x["item"] for x in row["limits"]))}
            rest, bound = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
            for x in row["limits"]:
                rest[items[x["item"]]], bound[items[x["item"]]] = x["rest"], x["bound"]
            ids, no_ids, m = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["no_ids"], bool), np.frombuffer(row["m"], np.int64)
            scores = np.zeros((len(items), len(m)), np.int64)
            scores[np.frombuffer(row["rows"] or b"", np.int32), np.frombuffer(row["docs"] or b"", np.int32)] = np.frombuffer(row["scores"] or b"", np.int64)
            for t in range(right.num_rows):
                docs, tf = (np.frombuffer(right.column(c)[t].as_py(), np.int32) for c in ("docs", "tfs"))
                tf = tf.astype(np.int64)
                share = right.column("weight")[t].as_py() * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[docs]))
                for x in right.column("askers")[t].as_py():
                    scores[items[x["item"]], docs] += x["times"] * share
            kept, tops = [], []
            names = sorted(items)
            for i, item in enumerate(names):
                there = np.flatnonzero(scores[i])
                score = scores[i, there]
                if last:
                    at = there[_best(score, ids[there], no_ids[there], top)]
                    out += [{"item": item, "score": int(scores[i, d]), "doc_id": None if no_ids[d] else int(ids[d])} for d in at]
                    continue
                if len(score) >= top:
                    own = int(np.partition(score, len(score) - top)[len(score) - top])
                    bound[i] = max(bound[i], own)
                best = np.sort(score)[-top:]
                tops += [{"item": item, "score": int(s)} for s in best]
                there = there[score + rest[i] >= bound[i]]
                kept.append((np.full(len(there), i), there, scores[i, there]))
            if not last:
                rows, docs, score = (np.concatenate(x) if kept else np.zeros(0, np.int64) for x in (zip(*kept) if kept else [()] * 3))
                out.append({"bundle": row["bundle"], "block": row["block"], "ids": row["ids"], "no_ids": row["no_ids"], "m": row["m"], "rows": rows.astype(np.int32).tobytes(),
                            "docs": docs.astype(np.int32).tobytes(), "scores": score.astype(np.int64).tobytes(), "tops": tops})
        return pa.Table.from_pylist(out, schema=_best_schema if last else _carried_schema)

    return run


_best_schema = pa.schema([("item", pa.int64()), ("score", pa.int64()), ("doc_id", pa.int64())])
_carried_schema = pa.schema([
    ("bundle", pa.int64()), ("block", pa.int64()), *[(c, pa.binary()) for c in ("ids", "no_ids", "m", "rows", "docs", "scores")],
    ("tops", pa.list_(pa.struct([("item", pa.int64()), ("score", pa.int64())])))])


def ranked_search(
    docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """The ``top`` documents with the highest scores above 0 for each item: (the item's id column, rank from 1, doc_id long, score long).

    Terms are runs of ASCII letters (in lower case), digits and characters beyond ASCII. With N documents that have a term, L their terms,
    n the document's, df and tf as usual, a term weighs ``w = floor(1000 * ln((2N + 2) / (2 df + 1)))``; a document's
    ``m = 25 + 75 * n * N div L``; its score sums ``w * (1000000000 * tf div (1000 * tf + 8 * m))`` over the item's
    terms, repeats included, in whole numbers. Equal scores: by doc_id.

    A null or empty text has no terms; an item without terms, or whose terms no document holds, gets no rows; a document without an
    id comes after those of equal score. Rows of ``docs`` are documents of their own, also with equal ids; repeated rows of ``items`` (id
    and text) are one item, and rows of an id with different texts are ranked apart. Whole texts of any length are read. Further columns don't matter.
    """
    name = items[item_col].alias(item_col)
    asked = items.select(name, F.coalesce(items[item_text_col].cast("string"), F.lit("")).alias("text")).distinct()
    asked = stored(asked.withColumn("item", F.monotonically_increasing_id()), "search-items")
    terms = stored(asked.select("item", "text").mapInArrow(_item_terms, _ASKED), "search-terms")
    sieve = make_sieve(terms.select("term").distinct().mapInArrow(_hash_terms, "h long"))

    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    postings = stored(texts.mapInArrow(_block_postings(sieve), _POSTINGS), "search-postings", compression="zstd")
    n, total = _statistics(postings)
    df = postings.filter("term is not null").groupBy("term").agg(F.sum(F.octet_length("docs") / 4).cast("long").alias("df"))
    weighed = terms.join(df, "term").withColumn("weight", F.expr(f"cast(floor(1000 * ln((2D * {n} + 2) / (2 * df + 1))) as bigint)")).filter("weight > 0")
    owner = F.lit(0)
    for share in OWNERS:
        owner = owner + (F.col("df") >= share * n).cast("int")
    bundles = max(1, -(-asked.count() // BUNDLE))
    weighed = stored(weighed.withColumn("owner", owner).withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles))), "search-weights")
    askers = stored(weighed.groupBy("bundle", "owner", "term").agg(F.first("weight").alias("weight"), F.collect_list(F.struct("item", "times")).alias("askers")), "search-askers")

    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bundles - 1).cast("long"))).alias("bundle")
    carried = postings.filter("term is null").select("block", "ids", "no_ids", "lengths").mapInArrow(_start(n, total), "block long, ids binary, no_ids binary, m binary")
    none = F.lit(None).cast("binary")
    carried = carried.select(spread, "*").select("bundle", "block", "ids", "no_ids", "m", none.alias("rows"), none.alias("docs"), none.alias("scores"))
    bounds = None
    for stage in range(len(OWNERS) + 1):
        last = stage == len(OWNERS)
        # all that later owners could add to any document
        limits = weighed.groupBy("bundle", "item").agg(F.coalesce(F.sum(F.when(F.col("owner") > stage, F.col("weight") * F.col("times") * MOST)), F.lit(0)).alias("rest"))
        limits = limits.join(bounds, "item", "left") if bounds is not None else limits.withColumn("bound", F.lit(0))
        limits = limits.groupBy(F.col("bundle").alias("of")).agg(F.collect_list(F.struct("item", "rest", F.coalesce("bound", F.lit(0)).cast("long").alias("bound"))).alias("limits"))
        left = carried.join(limits, carried["bundle"] == limits["of"]).drop("of", "tops")
        held = postings.filter("term is not null").select(F.col("block").alias("at"), F.col("term").alias("word"), "docs", "tfs")
        right = held.join(askers.filter(F.col("owner") == stage), F.col("word") == F.col("term")).select(F.col("bundle").alias("to"), "at", "weight", "askers", "docs", "tfs")
        met = left.groupBy("bundle", "block").cogroup(right.groupBy("to", "at"))
        if last:
            found = met.applyInArrow(_stage(stage, top, last), _BEST)
            break
        carried = stored(met.applyInArrow(_stage(stage, top, last), _CARRIED), f"search-stage-{stage}", compression="zstd")
        scores = carried.select(F.inline("tops"))
        ranked = scores.withColumn("r", F.expr("row_number() over (partition by item order by score desc)")).filter(F.col("r") <= top)
        bounds = stored(ranked.groupBy("item").agg(F.when(F.count("*") == top, F.min("score")).otherwise(0).alias("bound")), "search-bounds")
    rank = F.expr("row_number() over (partition by item order by score desc, doc_id nulls last)")
    best = found.withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.join(asked.select("item", item_col), "item").select(item_col, F.col("rank").cast("int").alias("rank"), "doc_id", "score")
