"""Document fingerprints by I-Match with randomised lexicons, in built-in functions only.

The lexicon is the terms whose inverse document frequency over all documents
lies in a band. The band bounds its size whatever the corpus: a term above the
smallest document share uses up that share of all (document, term) pairs, so
there are at most (mean distinct terms of a document) / (smallest share) of
them. Each subset is a random part of the lexicon; a document's part of it, as
sorted distinct terms, is hashed. Subsets come in several rates, so that texts
of any length have some with few terms, which survive an edit elsewhere.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabml.llm.common import shuffle_partitions
from tabml.llm.licenses import WORD

#: idf = ln(documents / documents with the term); the band, and the fewest documents of a term.
IDF_BAND, LEAST_DOCS = (1.5, 5.5), 2
#: (one of how many terms, subsets, bits of the term's hash skipped) of each rate.
RATES = ((16, 8, 0), (64, 16, 8), (256, 32, 20))
_SUBSETS = sum(n for _, n, _ in RATES)
_FIRST = -(1 << 63)


def term_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-cased words of a whole text, repeats included."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, text: str = "text", band: tuple[float, float] = IDF_BAND) -> list[int]:
    """Hashes of the terms in the band; counts run over all documents and whole texts."""
    n = docs.count()
    low, high = max(LEAST_DOCS, math.ceil(n * math.exp(-band[1]))), math.floor(n * math.exp(-band[0]))
    terms = docs.select(F.explode(F.array_distinct(term_hashes(F.col(text)))).alias("h")).groupBy("h").agg(F.count("*").alias("df"))
    return sorted(r.h for r in terms.filter(F.col("df").between(low, high)).select("h").collect())


def subset_hashes(text: str, known: list[int]) -> Column:
    """For each subset the 16-bit hash of the text's terms in it (null: none), as an array.

    The lexicon is part of the expression: its size has the bound stated above.
    """
    if not known:
        return F.expr(f"transform(sequence(1, {_SUBSETS}), k -> CAST(NULL AS int))")
    inside = ", ".join(f"{h}L" for h in known if h != _FIRST)
    words = f"regexp_extract_all(lower({text}), '{WORD}', 0)".replace("\\", "\\\\")
    terms = f"array_distinct(filter(transform({words}, w -> xxhash64(w)), h -> h IN ({inside})))"
    parts, base = [], 0
    for one_of, n, skip in RATES:
        pick = f"pmod(shiftright(h, {skip}), {one_of})"
        parts.append(f"transform(filter(ts, h -> {pick} < {n}), h -> shiftleft({base} + {pick}, 48) | (h & {(1 << 48) - 1}L))")
        base += n
    kept = f"sort_array(concat({', '.join(parts)}))"
    each = f"transform(sequence(0, {_SUBSETS - 1}), k -> CAST(nullif(xxhash64(filter(es, e -> shiftright(e, 48) = k)), xxhash64(CAST(array() AS array<bigint>))) & 65535 AS int))"
    # a one-element transform names a value, so that it is computed once
    named = f"element_at(transform(array({terms}), ts -> element_at(transform(array({kept}), es -> {each}), 1)), 1)"
    return F.expr(named)


def fingerprint(parts: str, text: str) -> Column:
    """Four hex digits or "----" for each subset; a text without any lexicon term has the hash of the whole text."""
    digits = F.array_join(F.transform(parts, lambda p: F.coalesce(F.lower(F.lpad(F.hex(p), 4, "0")), F.lit("----"))), "")
    return F.when(F.exists(parts, lambda p: p.isNotNull()), digits).otherwise(F.concat(F.lit("text:"), F.substring(F.sha2(text, 256), 1, 32)))


def likeness(a: str, b: str, fp_a: str, fp_b: str) -> Column:
    """Share of equal hashes among the subsets that either text has terms in; without any, whether the fingerprints are equal."""
    same = f"aggregate(zip_with({a}, {b}, (x, y) -> IF(x = y, 1, 0)), 0, (s, v) -> s + coalesce(v, 0))"
    either = f"aggregate(zip_with({a}, {b}, (x, y) -> IF(x IS NULL AND y IS NULL, 0, 1)), 0, (s, v) -> s + v)"
    return F.expr(f"IF({fp_a} = {fp_b}, 1D, IF({either} = 0, 0D, {same} / CAST({either} AS double)))")


def _literal(k: int) -> str:
    return f"{k}L" if k != _FIRST else "(-9223372036854775807L - 1L)"


def _bounds(docs: DataFrame, parts: int) -> tuple[list[int], dict[int, int]]:
    """At most ``parts`` + 1 ids that cut ``docs`` in about equal parts, and the ids that fill several parts, with how many."""
    cut = [k / parts for k in range(1, parts)]
    row = docs.select(F.percentile_approx("k", cut or [0.5]).alias("p"), F.min("k").alias("a"), F.max("k").alias("z")).first()
    if row.a is None:
        return [0], {}
    return sorted({row.a, *(row.p or []), row.z}), {k: n for k, n in Counter(row.p or []).items() if n > 1}


def _bucket(bounds: list[int], hot: dict[int, int]) -> Column:
    """A bucket for each row: in the order of ids, and within a hot id (a bound, so the largest of its bucket) by falling hash ``th`` of its text."""
    level = f"size(filter(array({', '.join(map(_literal, bounds))}), b -> b < k))"
    # eight steps of equal width inside the span between two bounds
    low, high = (F.lit(0.0) + F.element_at(F.array(*[F.lit(float(b)) for b in bounds]), F.greatest(F.lit(1), F.expr(level) + d)) for d in (0, 1))
    inside = F.floor((F.col("k").cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * 8)
    number = F.expr(level).cast("long") * 8 + F.when(F.expr(level) == 0, F.lit(0)).otherwise(F.least(F.lit(7), F.greatest(F.lit(0), inside)))
    if not hot:
        return number
    # the smallest hash comes first in the order, so it has the last of the id's own buckets
    steps = F.expr(f"CASE {' '.join(f'WHEN k = {_literal(k)} THEN {8 * n}' for k, n in hot.items())} ELSE 0 END")
    share = (F.col("th").cast("double") + F.lit(float(1 << 63))) / F.lit(float(1 << 64))
    own = F.when(steps > 0, steps - F.least(steps - 1, F.floor(share * steps))).otherwise(F.lit(0))
    return number * (8 * max(hot.values()) + 1) + own


def _guests(rows: DataFrame) -> DataFrame:
    """For each bucket the row that follows its last one: the first of the bucket before, by id and hash of the text.

    One row a bucket reaches the driver, at most 16 for each shuffle partition.
    """
    firsts = rows.groupBy("bucket").agg(F.max(F.struct("k", F.bitwise_not("th").alias("nth"))).alias("m"))
    ends = sorted((r.bucket, r.m.k, ~r.m.nth) for r in firsts.collect())
    # after the smallest id of a bucket comes the largest of the bucket before; after the last of all, the first
    return rows.sparkSession.createDataFrame([(b, *ends[i - 1][1:]) for i, (b, *_) in enumerate(ends)], "to_bucket long, g long, gh long")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """Fingerprints of every whole text and of an edited version of it.

    The next document is the one with the next smaller id (after the last: the
    first). The edited text has its last floor(n_chars / 2) code points
    replaced by the first as many of the next document (or all of them).
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (likeness to the edited text's and to the next
    document's fingerprint, 0 to 1). A null text is empty; rows without id
    come last; rows with equal ids follow in the order of their texts; equal
    texts have equal fingerprints; a single document is its own next. An id
    (or its absence) that many rows share is dealt out by the hash of the
    texts, and its equal rows are worked on once.
    """
    chosen = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    chosen = chosen.withColumn("k", F.coalesce("doc_id", F.lit(_FIRST).cast("long")))
    known = lexicon(chosen, "text", band)
    chosen = chosen.withColumn("th", F.xxhash64("text"))
    bounds, hot = _bounds(chosen.select("k"), shuffle_partitions(docs.sparkSession))
    own = chosen.withColumn("copies", F.lit(1).cast("long"))
    if hot:
        often = F.expr(f"k IN ({', '.join(map(_literal, hot))})")
        # tasks send one row for each text of a hot id
        once = chosen.filter(often).groupBy("doc_id", "text", "k", "th").agg(F.count("*").alias("copies"))
        own = own.filter(~often).unionByName(once)
    own = own.withColumn("bucket", _bucket(bounds, hot))
    # without hot ids the guests are known by their id, and no text is read for them
    th = F.col("th") if hot else F.lit(0).cast("long").alias("th")
    guests = _guests(chosen.select("k", th, _bucket(bounds, hot).alias("bucket")))
    names = ("doc_id", "text", "k", "th", "copies")
    invited = own.join(F.broadcast(guests), (own.k == guests.g) & (own.th == guests.gh) if hot else own.k == guests.g).select(*names, F.col("to_bucket").alias("bucket"), F.lit(True).alias("guest"))
    rows = own.select(*names, "bucket", F.lit(False).alias("guest")).union(invited)
    rows = rows.withColumn("parts", subset_hashes("text", known))
    after = W.partitionBy("bucket").orderBy(F.col("guest"), F.col("k").desc(), F.col("th"), F.col("text"))
    rows = rows.withColumn("next_text", F.lead("text").over(after)).withColumn("next_parts", F.lead("parts").over(after)).filter(~F.col("guest"))
    if hot:
        # all copies but the last are followed by their own text
        rows = rows.withColumn("times", F.explode(F.when(F.col("copies") > 1, F.array(F.lit(1).cast("long"), -(F.col("copies") - 1))).otherwise(F.array(F.lit(1).cast("long")))))
        rows = rows.withColumn("next_text", F.when(F.col("times") < 0, F.col("text")).otherwise(F.col("next_text")))
        rows = rows.withColumn("next_parts", F.when(F.col("times") < 0, F.col("parts")).otherwise(F.col("next_parts")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)))
    rows = rows.withColumn("edited_parts", subset_hashes("edited", known))
    rows = rows.withColumn("fingerprint", fingerprint("parts", "text")).withColumn("edited_fingerprint", fingerprint("edited_parts", "edited")).withColumn("next_fingerprint", fingerprint("next_parts", "next_text"))
    out = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("parts", "edited_parts", "fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("parts", "next_parts", "fingerprint", "next_fingerprint").alias("near_next"),
        *(["times"] if hot else []),
    )
    return out.withColumn("times", F.explode(F.sequence(F.lit(1), F.abs("times")))).drop("times") if hot else out
