"""Phrase collocations by set-oriented mining (SETM: Houtsma and Swami, "Set-oriented mining for association rules", 1995).

An occurrence relation holds (piece, position, group) in that order. Relations
are persisted in blocks of a few megabytes of text, one language each, and stay
in the order of the text. For each length

1. the relation of the occurrences so far is merge-joined with that of the
   words, by piece and adjacent position, within each block;
2. the joined rows are counted by group (the words of the earlier group, and the next): each block
   counts its own, and a grouped sum adds the blocks up. That is done twice: by 32 bits of the group's hash, which takes
   two bytes or so of the shuffle a group, and by the words of the groups whose bits occur often enough;
3. groups that occur often enough are stored, each block's occurrences are
   semi-joined with them, and what is left is persisted and extended next.

The semi-join is one with a Bloom filter of bounded size (``words.Sieve``), so occurrences stay where they are. It loses no
frequent group; one that it passes wrongly is counted again with its next word and can't be frequent then, as no group is more
frequent than a part of it. Words are known by hashes that are checked to differ. Groups that share their 32 bits
only pass the first count more easily; the second is by their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import stored
from tabml.llm.words import Sieve, byte_table, cut, hashes, make_sieve, mixed, words_of

#: Words are separated by blanks and tabs, pieces by punctuation and line ends.
TABLE = byte_table(lambda b: b in (0x20, 0x09), b".,;:!?\n\x0b\x0c\r")
#: Text of a block; a worker holds a few of them, one for each language that it meets.
BLOCK_BYTES, BLOCKS_HELD, BATCH_ROWS = 8 << 20, 4, 65_536
#: Blocks in a file of a relation, as a task has a file's blocks in memory.
PER_FILE = 4
#: Rows of a batch that a worker returns.
ROWS = 65_536
#: Occurrences of words for each bucket that counts are added up in: no bucket receives more groups than about so many.
BUCKET = 1 << 21
#: Bits of a word's hash beyond those that number all pairs of a frequent word and any other.
SPARE_BITS = 7

# words are numbers within a block, of a place in word_ids; groups are numbers of a row of parts (their words); heads marks
# where a group starts. Without parts, each word is a group
_RELATION = "lang string, gaps binary, words binary, word_ids binary, heads binary, grams binary, parts binary"
_FIRST = "lang string, gaps binary, words binary, n_words long, distinct array<string>, counts array<long>"
# a block's counts in one bucket: columns of numbers, packed, the last of them the occurrences
_PARCEL = "bucket int, size int, columns array<binary>"
_KINDS = {"int": pa.int32(), "array<binary>": pa.list_(pa.binary()), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _small(n: int) -> type:
    """What holds the numbers below n."""
    return np.uint16 if n <= 1 << 16 else np.int32


def _blob(x: np.ndarray, kind: type) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _gaps(position: np.ndarray, far: int) -> np.ndarray:
    """Steps between positions that rise, ``far`` before the first; a step of ``far`` or more is as good as any other."""
    return np.minimum(np.diff(position, prepend=-far), far)


def _positions(gaps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(gaps, np.uint8), dtype=np.int64)


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    """One at a time: each holds megabytes."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _word_blocks(far: int):
    """The words of the texts of each language, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        size: dict[str, int] = {}

        def packed(lang: str) -> Iterator[pa.RecordBatch]:
            w = words_of(pa.concat_arrays(held.pop(lang)), TABLE)
            del size[lang]
            if not len(w.code):
                return
            # one step within a piece, at least ``far`` between pieces
            position = np.arange(len(w.code)) + far * np.cumsum(np.diff(w.piece, prepend=w.piece[0]) > 0)
            counts = np.bincount(w.code, minlength=len(w.distinct))
            ends = pa.array([0, len(counts)], pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array([lang], pa.string()), pa.array([_blob(_gaps(position, far), np.uint8)]), pa.array([_blob(w.code, _small(len(counts)))]),
                pa.array([len(w.code)]), pa.ListArray.from_arrays(ends, w.distinct), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
            ], schema=_arrow(_FIRST))

        for batch in cut(batches, BLOCK_BYTES, BATCH_ROWS):
            langs = batch.column("lang").dictionary_encode()
            of = langs.indices.to_numpy(zero_copy_only=False)
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                texts = batch.column("text").filter(pa.array(of == i))
                held.setdefault(lang, []).append(texts)
                size[lang] = size.get(lang, 0) + texts.nbytes
                if size[lang] >= BLOCK_BYTES:
                    yield from packed(lang)
            while sum(size.values()) > BLOCKS_HELD * BLOCK_BYTES:
                yield from packed(max(size, key=size.get))
        for lang in list(held):
            yield from packed(lang)

    return run


def _block_words(batch: pa.RecordBatch, seed: int, bits: int = 64) -> Iterator[tuple[str, pa.Array, np.ndarray, pa.Array]]:
    """(language, words, their hashes of so many bits, their occurrences) of each block."""
    for i in range(batch.num_rows):
        lang, words = batch.column("lang")[i].as_py(), batch.column("distinct")[i].values
        h = hashes(words, xxhash.xxh64_intdigest(lang, seed) & 0xFFFFFFFF) >> np.uint64(64 - bits)
        yield lang, words, h, batch.column("counts")[i].values


def _count_words(seed: int):
    """The words of each block under their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, h, n in _block_words(batch, seed):
                full = pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), n], ["h", "n"])
                for at in range(0, len(h), ROWS):
                    yield full.slice(at, ROWS)

    return run


def _spell(sieve: Sieve, seed: int, bits: int):
    """The words that pass the sieve, with their letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, h, _ in _block_words(batch, seed, bits):
                ok = sieve.passes(mixed(h))
                yield pa.RecordBatch.from_arrays([pa.array(h[ok].view(np.int64)), pa.repeat(lang, int(ok.sum())), words.filter(pa.array(ok))], ["h", "lang", "phrase"])

    return run


def _frequent_words(first: DataFrame, least: int) -> tuple[DataFrame, Sieve, int, int]:
    """(h, lang, phrase, f) of the words that occur ``least`` times, their sieve, the seed of their hashes and the bits of h.

    Words are known by h from here on: as many bits of their hashes as make it unlikely (1 in 128) that a frequent
    word and any other of any language share them. That is tried out, and where two do, the next seed is taken.
    """
    blocks, seed = first.select("lang", "distinct", "counts"), 0
    listed = first.agg(F.sum(F.size("distinct"))).first()[0] or 0
    while True:
        counts = blocks.mapInArrow(_count_words(seed), "h long, n long").groupBy("h").agg(F.sum("n").alias("f"))
        often = stored(counts.filter(F.col("f") >= least), "setm-words-often")
        n = often.count()
        bits = min(64, max(1, (n * listed).bit_length() + SPARE_BITS))
        often = often.select((F.shiftrightunsigned("h", 64 - bits) if bits < 64 else F.col("h")).alias("h"), "f")
        sieve = make_sieve(often.select("h").mapInArrow(_hash_groups, "h long"))
        # every word with the h of a frequent one passes the sieve
        letters = blocks.mapInArrow(_spell(sieve, seed, bits), "h long, lang string, phrase string").distinct()
        words = stored(often.join(letters, "h"), "setm-frequent")
        if words.count() == n:
            return words, sieve, seed, bits
        seed += 1


def _first_relation(sieve: Sieve, seed: int, bits: int):
    """A block's occurrences of the words that pass the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (lang, _, h, _) in enumerate(_block_words(batch, seed, bits)):
                kept = np.flatnonzero(sieve.passes(mixed(h)))
                local = np.full(len(h), -1, np.int32)
                local[kept] = np.arange(len(kept))
                word = local[np.frombuffer(batch.column("words")[i].as_py(), _small(len(h)))]
                gaps, there = batch.column("gaps")[i].as_py(), word >= 0
                if there.any():
                    yield _packed(lang, _gaps(_positions(gaps)[there], gaps[0]), word[there], h[kept])

    return run


def _packed(lang: str, gaps: np.ndarray, word: np.ndarray, word_id: np.ndarray, heads: np.ndarray | None = None, gram: np.ndarray | None = None,
            parts: np.ndarray | None = None) -> pa.RecordBatch:
    """A block's relation as a row."""
    some = parts is not None
    return pa.RecordBatch.from_pylist([{
        "lang": lang, "gaps": _blob(gaps, np.uint8), "words": _blob(word, _small(len(word_id))), "word_ids": _blob(word_id, np.uint64),
        "heads": _blob(heads, np.uint8) if some else b"", "grams": _blob(gram, _small(len(parts))) if some else b"", "parts": _blob(parts, _small(len(word_id))) if some else b"",
    }], schema=_arrow(_RELATION))


class _Relation:
    """A block's words by position, and its groups of ``k`` words by the place of their first word."""

    def __init__(self, row: dict, k: int):
        self.k, self.lang, self.far, self.position = k, row["lang"], row["gaps"][0], _positions(row["gaps"])
        self.word_id = np.frombuffer(row["word_ids"], np.uint64)
        n, kind = len(self.word_id), _small(len(self.word_id))
        self.word = np.frombuffer(row["words"], kind)
        if k == 1:
            self.start, self.gram, self.parts = np.arange(len(self.word)), self.word, np.arange(n).reshape(n, 1)
        else:
            self.parts = np.frombuffer(row["parts"], kind).reshape(-1, k)
            self.start = np.flatnonzero(np.frombuffer(row["heads"], np.uint8))
            self.gram = np.frombuffer(row["grams"], _small(len(self.parts)))

    def extended(self) -> tuple[np.ndarray, np.ndarray]:
        """Merge join: (row of the group, row of the word) where the word follows the group in its piece,
        and the group's other words with it are a group as well."""
        after = self.position[self.start] + self.k
        at = np.searchsorted(self.position, after)
        found = at < len(self.position)
        found[found] = self.position[at[found]] == after[found]
        # starts rise, so the group one word on is the next row
        found[:-1] &= self.start[1:] == self.start[:-1] + 1
        found[-1:] = False
        rows = np.flatnonzero(found)
        return rows, at[rows]

    def keys(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.gram[rows].astype(np.int64) * len(self.word_id) + self.word[at]

    def longer(self, key: np.ndarray) -> np.ndarray:
        """The words, by their numbers in the block, of groups of k + 1 words."""
        n = max(1, len(self.word_id))
        return np.concatenate([self.parts[key // n], (key % n)[:, None]], axis=1)

    def kept(self, sieve: Sieve) -> pa.RecordBatch | None:
        """The occurrences of the longer groups that pass the sieve, and the words that these cover."""
        rows, at = self.extended()
        key, of = np.unique(self.keys(rows, at), return_inverse=True)
        parts = self.longer(key)
        ok = sieve.passes(_group_hash(self.word_id[parts].T))
        start, gram = self.start[rows[ok[of]]], (np.cumsum(ok) - 1)[of[ok[of]]]
        if not len(start):
            return None
        edge = np.zeros(len(self.word) + 1, np.int64)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + self.k + 1, -1)
        covered = np.cumsum(edge)[:-1] > 0
        heads = np.zeros(len(self.word), np.uint8)
        heads[start] = 1
        return _packed(self.lang, _gaps(self.position[covered], self.far), self.word[covered], self.word_id, heads[covered], gram, parts[ok])


def _squeezed(x: np.ndarray) -> bytes:
    """Numbers by byte of equal weight, compressed: those of sorted or small numbers are much alike."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T), codec="zstd", asbytes=True)


def _unsqueezed(data: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(data, size * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(width, size).T).view(kind).ravel()


def _parcels(mark: np.ndarray, columns: list[np.ndarray], n: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A block's counts ``n`` of the keys in ``columns``, dealt out to buckets by ``mark`` (32 bits)."""
    bucket = (mark.astype(np.uint64) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.lexsort([*columns[::-1], bucket])
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
    some = np.flatnonzero(np.diff(edge))
    columns = [c[order] for c in [*columns, n.astype(np.uint32)]]
    packed = [[_squeezed(c[edge[i]: edge[i + 1]]) for c in columns] for i in some]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(np.diff(edge)[some], pa.int32()), pa.array(packed, pa.list_(pa.binary()))], schema=_arrow(_PARCEL))


def _often(kind: type, names: list[str], least: int):
    """The keys of a bucket's parcels that occur ``least`` times or more, and how often."""

    def run(table: pa.Table) -> pa.Table:
        sizes, packed = table.column("size").to_pylist(), table.column("columns").to_pylist()
        *keys, n = (np.concatenate([_unsqueezed(p[c], size, of) for size, p in zip(sizes, packed)])
                    for c, of in enumerate([*[kind] * len(names), np.uint32]))
        order = np.lexsort(keys[::-1])
        keys = [key[order] for key in keys]
        new = np.ones(len(n), bool)
        new[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
        first = np.flatnonzero(new)
        f = np.add.reduceat(n[order].astype(np.int64), first)
        kept = first[f >= least]
        return pa.table([*(pa.array(key[kept].astype(np.uint64).view(np.int64)) for key in keys), pa.array(f[f >= least])], names=[*names, "f"])

    return run


def _mark(h: np.ndarray) -> np.ndarray:
    """The 32 bits of a group's hash that it is first counted by."""
    return (h >> np.uint64(32)).astype(np.uint32)


def _count_marks(k: int, buckets: int):
    """Each block's groups of k + 1 words, counted by their marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                r = _Relation(row, k)
                key, n = np.unique(r.keys(*r.extended()), return_counts=True)
                mark = _mark(_group_hash(r.word_id[r.longer(key)].T))
                yield _parcels(mark, [mark], n, buckets)

    return run


def _count_groups(k: int, sieve: Sieve, buckets: int):
    """Each block's groups of k + 1 words whose marks pass the sieve, counted by the hashes of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                r = _Relation(row, k)
                key, n = np.unique(r.keys(*r.extended()), return_counts=True)
                ids = r.word_id[r.longer(key)].T
                mark = _mark(_group_hash(ids))
                ok = sieve.passes(mixed(mark))
                yield _parcels(mark[ok], list(ids[:, ok]), n[ok], buckets)

    return run


def _frequent_groups(relation: DataFrame, k: int, least: int, buckets: int) -> DataFrame:
    """(w0 .. wk, f): the groups of k + 1 words that occur ``least`` times or more, and no other."""
    marks = relation.mapInArrow(_count_marks(k, buckets), _PARCEL).groupBy("bucket").applyInArrow(_often(np.uint32, ["h"], least), "h long, f long")
    sieve = make_sieve(stored(marks.select("h"), "setm-marks").mapInArrow(_hash_groups, "h long"))
    of = _words(k + 1)
    groups = relation.mapInArrow(_count_groups(k, sieve, buckets), _PARCEL).groupBy("bucket")
    return groups.applyInArrow(_often(np.uint64, of, least), ", ".join(f"{w} long" for w in [*of, "f"]))


def _words(k: int) -> list[str]:
    return [f"w{i}" for i in range(k)]


def _group_hash(ids: np.ndarray) -> np.ndarray:
    """One hash of the words' hashes, given word by word."""
    h = mixed(ids[0])
    for x in ids[1:]:
        h = mixed(h ^ x)
    return h


def _hash_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = _group_hash([c.to_numpy().view(np.uint64) for c in batch.columns])
        yield pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64))})


def _keep_groups(k: int, sieve: Sieve):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                out = _Relation(row, k).kept(sieve)
                if out is not None:
                    yield out

    return run


def frequent_phrases(docs: DataFrame, least: int = 30, longest: int = 4, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``longest`` words that occur ``least`` times or more in a language, and the words of each language.

    (lang, phrase, words, f, each) with f the contiguous occurrences within pieces, overlaps included, and each those
    of the words by themselves; and (lang, n). Languages are those of ``lang_col`` (null: ``und``); a null or empty text
    has no words. Repeated rows all count. Further columns, whatever their names, don't matter.
    """
    texts = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    first = stored(texts.mapInArrow(_word_blocks(longest + 1), _FIRST), "setm-words", compression="zstd", rows_per_file=PER_FILE)
    totals = first.groupBy("lang").agg(F.sum("n_words").alias("n"))
    buckets = 1 + (first.agg(F.sum("n_words")).first()[0] or 0) // BUCKET
    words, sieve, seed, bits = _frequent_words(first, least)
    relation = stored(first.mapInArrow(_first_relation(sieve, seed, bits), _RELATION), "setm-1", compression="zstd", rows_per_file=PER_FILE)
    found = words.select("lang", "phrase", F.array("phrase").alias("words"), "f", F.array("f").alias("each"))
    for k in range(1, longest):
        of = _words(k + 1)
        counts = stored(_frequent_groups(relation, k, least, buckets).withColumn("id", F.monotonically_increasing_id()), "setm-groups")
        # words get their letters back; a group with a word that isn't frequent can't be
        member = counts.select("id", F.posexplode(F.array(*of)).alias("at", "h")).join(words.select("h", "lang", "phrase", F.col("f").alias("each")), "h")
        member = member.groupBy("id").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "phrase", "each"))).alias("m"))
        named = member.join(counts.select("id", "f"), "id").select("lang", F.array_join("m.phrase", " ").alias("phrase"), F.col("m.phrase").alias("words"), "f", F.col("m.each").alias("each"))
        found = found.unionByName(stored(named, "setm-phrases"))
        if k + 1 < longest:
            sieve = make_sieve(counts.select(*of).mapInArrow(_hash_groups, "h long"))
            relation = stored(relation.mapInArrow(_keep_groups(k, sieve), _RELATION), f"setm-{k + 1}", compression="zstd", rows_per_file=PER_FILE)
    return found, totals


def _part(first: str, n: str) -> str:
    return f"array_join(slice(words, {first}, {n}), ' ')"


def collocations(
    docs: DataFrame, least: int = 30, longest: int = 4, inside_percent: int = 80, scale: int = 2_000_000, top: int = 2000, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """The ``top`` phrases of each language whose words keep together.

    Candidates are the phrases of 2 to ``longest`` words with f >= ``least``. Cut after its first words, a phrase scores
    ``floor(scale * a / (l + r))`` with a, l, r the occurrences of the whole, the first part and the rest; its
    lowest-scoring cut counts (ties: the shortest first part). A candidate whose words lie contiguously in a longer one
    with at least ``inside_percent`` % of its occurrences is dropped. Returns (lang, rank from 1, phrase with blanks
    between words, a, l, r, n, score) by score, then a (both falling), then phrase in byte order. Numbers are exact.

    Null or empty texts have no words; null languages are ``und``; an empty table, or one without frequent phrases,
    gives no rows; long texts are read whole; repeated rows count each time; other columns don't matter.
    """
    phrases, totals = frequent_phrases(docs, least, longest, lang_col, text_col)
    candidates = phrases.withColumn("len", F.size("words")).filter("len > 1")
    pairs, longer = candidates.filter("len = 2"), candidates.filter("len > 2")
    # contiguous shorter phrases of each candidate: few, whatever the data
    inside = longer.selectExpr("lang", "len", "f", "words", "explode(sequence(2, len - 1)) as m")
    inside = inside.selectExpr("lang", "f", "words", "m", "explode(sequence(1, len - m + 1)) as s").selectExpr("lang", f"{_part('s', 'm')} as phrase", "f")
    most = inside.groupBy("lang", "phrase").agg(F.max("f").alias("within"))
    # parts of one word have their occurrences beside them, others are looked up
    cuts = longer.selectExpr("lang", "f as a", "words", "each", "len", "explode(sequence(1, len - 1)) as k").selectExpr(
        "lang", "a", "k", f"{_part('1', 'k')} as head", f"{_part('k + 1', 'len - k')} as rest", "if(k = 1, each[0], null) as l", "if(k = len - 1, each[k], null) as r")
    for part, known in (("head", "l"), ("rest", "r")):
        f = candidates.select("lang", F.col("phrase").alias(part), F.col("f").alias("looked"))
        cuts = cuts.join(f, ["lang", part], "left").withColumn(known, F.coalesce(known, "looked")).drop("looked")
    cuts = cuts.select("lang", F.concat_ws(" ", "head", "rest").alias("phrase"), "a", "k", "l", "r")
    cuts = cuts.unionByName(pairs.selectExpr("lang", "phrase", "f as a", "1 as k", "each[0] as l", "each[1] as r"))
    cuts = cuts.withColumn("score", F.expr(f"cast(cast(a as decimal(20, 0)) * {scale} div cast(l + r as decimal(20, 0)) as bigint)"))
    best = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    left = best.join(most, ["lang", "phrase"], "left").filter(F.expr(f"within is null or 100 * within < {inside_percent} * a"))
    ranked = left.selectExpr("lang", "phrase", "a", "cut.l as l", "cut.r as r", "cut.score as score")
    order = "row_number() over (partition by lang order by score desc, a desc, phrase)"
    ranked = ranked.withColumn("rank", F.expr(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
