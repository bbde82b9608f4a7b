"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, negation, reported speech, other,
clause end). Small transducers read them in a row: reported speech marks what
follows a reporting word in its clause, negation marks the next words, the
target transducer marks what follows a person that is addressed or spoken of,
the insult transducer marks insults after another one, and the threat
transducer marks threats that no target stands before. Their composition is one
machine, whose arcs carry the product of their marks' factors. A clause scores
the weights of its matches times those factors; a document is scored by its
worst clause and by the sum over its clauses.

Insults are a short fixed list and what labelled documents teach: words, and
strict beginnings of words, that toxic ones hold far more often than others,
anywhere or where no negation or reporting word stands before them. A learned
word does not leave its fixed class. The same documents teach the factor of each mark, from
how much rarer marked matches make toxic documents than unmarked ones do, and a
logistic function that maps clause scores to 0..1.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import id_text, pieces, schema_of, stored, texts_of, with_row_of

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, END = "INSULT", "THREAT", "TARGET", "NEGATION", "REPORT", "OTHER", "END"
# General English words of each class.
WORDS = {
    INSULT: "idiot moron stupid dumb loser scum trash clown pathetic worthless disgusting vermin filth imbecile coward",
    THREAT: "kill hurt destroy beat burn shoot stab strangle attack murder",
    TARGET: "you your yours yourself he she him her they them their these those people everyone",
    NEGATION: "not never no nobody without isn aren wasn weren don doesn didn won",
    REPORT: "said says say saying called calls wrote writes quoted quote quotes claimed reportedly according",
}
SEED_WEIGHT = 2.0
#: Words of reach: of a negation, and of a target.
NEGATION_REACH, TARGET_REACH = 2, 4
#: Factors of a match in its context, before labelled documents teach others; the prior weighs as many documents as it says.
FACTORS = {"targeted": 1.25, "negated": 0.25, "reported": 0.5, "unaimed": 0.25, "repeated": 1.0}
PRIOR_DOCS = 20
#: A target strengthens at most; the other marks only weaken (repeated matches add up in their clause as it is).
LARGEST = {"targeted": 2.0, "negated": 1.0, "reported": 1.0, "unaimed": 1.0, "repeated": 1.0}
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]")
_SHORTEST, _LONGEST = 4, 10
#: Words that a worker remembers the class of; results don't depend on it.
MEMORY = 200_000


@dataclass(frozen=True)
class Transducer:
    """A deterministic sequential transducer: arcs (state, symbol) to (output symbol, factor, state)."""

    start: object
    arcs: dict = field(hash=False)

    def __rshift__(self, then: Transducer) -> Transducer:
        """Composition: the output of this one is the input of ``then``; factors multiply."""
        start = (self.start, then.start)
        arcs, todo, seen = {}, [start], {start}
        symbols = {s for _, s in self.arcs}
        while todo:
            a, b = state = todo.pop()
            for s in symbols:
                mid, x, a2 = self.arcs[a, s]
                out, y, b2 = then.arcs[b, mid]
                arcs[state, s] = (out, x * y, (a2, b2))
                if (a2, b2) not in seen:
                    seen.add((a2, b2))
                    todo.append((a2, b2))
        return Transducer(start, arcs)


def _marker(trigger: str, reach: int | None, factor: float) -> Transducer:
    """After ``trigger``, matches carry ``factor`` for ``reach`` further words (None: to the end of the clause)."""
    symbols = (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, END)
    last = 1 if reach is None else reach
    arcs = {}
    for left in range(last + 1):
        for s in symbols:
            to = 0 if s == END else last if s == trigger else left if reach is None else max(0, left - 1)
            arcs[left, s] = (s, factor if left and s in (INSULT, THREAT) else 1.0, to)
    return Transducer(0, arcs)


def _insults(factor: float) -> Transducer:
    """An insult after another one in its clause carries ``factor``."""
    arcs = {}
    for met in (0, 1):
        for s in (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, END):
            arcs[met, s] = (s, factor if met and s == INSULT else 1.0, 0 if s == END else 1 if s == INSULT else met)
    return Transducer(0, arcs)


def _threats(factor: float) -> Transducer:
    """A threat without a target before it in its clause carries ``factor``."""
    arcs = {}
    for met in (0, 1):
        for s in (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, END):
            arcs[met, s] = (s, factor if not met and s == THREAT else 1.0, 0 if s == END else 1 if s == TARGET else met)
    return Transducer(0, arcs)


def _matches() -> Transducer:
    """Only insults and threats count."""
    return Transducer(0, {(0, s): (s, float(s in (INSULT, THREAT)), 0) for s in (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, END)})


def _scorer(factors: dict[str, float] = FACTORS) -> Transducer:
    return _insults(factors["repeated"]) >> _threats(factors["unaimed"]) >> _matches()


def grammar(factors: dict[str, float] = FACTORS) -> dict:
    """The composed machine, its states numbered from 0: (state, symbol) to (factor, state)."""
    whole = (
        _marker(REPORT, None, factors["reported"]) >> _marker(NEGATION, NEGATION_REACH, factors["negated"])
        >> _marker(TARGET, TARGET_REACH, factors["targeted"]) >> _scorer(factors)
    )
    number = {whole.start: 0}
    for state, _ in whole.arcs:
        number.setdefault(state, len(number))
    return {(number[a], s): (factor, number[b]) for (a, s), (_, factor, b) in whole.arcs.items()}


@cache
def marks_of_arcs() -> dict:
    """The arcs of matches in :func:`grammar` to bits: those of their marks, in the order of ``FACTORS``, then those of the marks they lack.

    An arc has a mark if it carries the mark's factor when all others are 1.
    """
    plain = dict.fromkeys(FACTORS, 1.0)
    bits = {arc: 0 for arc, (factor, _) in grammar(plain).items() if factor}
    for k, name in enumerate(FACTORS):
        marked = grammar({**plain, name: 2.0})
        bits = {arc: b | 1 << (k if marked[arc][0] == 2.0 else k + len(FACTORS)) for arc, b in bits.items()}
    return bits


@dataclass
class ToxicityModel:
    """Learned words, strict beginnings (both with weights), the logistic function and the factors of the marks."""

    words: dict[str, float]
    starts: dict[str, float]
    coef: tuple[float, float, float] = (-3.0, 1.0, 0.5)
    factors: dict[str, float] = field(default_factory=FACTORS.copy)
    memo: dict[str, tuple[str, float]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.arcs = grammar(self.factors)
        self.fixed = {w: (kind, SEED_WEIGHT if kind in (INSULT, THREAT) else 0.0) for kind, words in WORDS.items() for w in words.split()}

    def symbol(self, word: str) -> tuple[str, float]:
        """Class and weight of a lower-case word or clause end."""
        found = self.memo.get(word)
        if found is None:
            found = (END, 0.0) if word in ".!?;\n" else self.fixed.get(word, (OTHER, 0.0))
            learned = max([self.words.get(word, 0.0), *(self.starts.get(word[:k], 0.0) for k in range(_SHORTEST, min(len(word), _LONGEST + 1)))])
            if learned > found[1] and found[0] in (OTHER, INSULT, THREAT):  # a threat stays one
                found = (THREAT if found[0] == THREAT else INSULT, learned)
            if len(self.memo) >= MEMORY:
                self.memo.clear()
            self.memo[word] = found
        return found

    def clauses(self, text: str) -> list[tuple[float, str]]:
        """(score, matched words) of every clause with a match, in order."""
        tokens = _TOKEN.findall(text.lower())
        symbol = self.symbol
        if not any(symbol(w)[1] for w in set(tokens)):
            return []
        out, state, score, hits = [], 0, 0.0, []
        for w in [*tokens, "."]:
            kind, weight = symbol(w)
            factor, state = self.arcs[state, kind]
            if weight:
                score += weight * factor
                hits.append(w)
            elif kind == END and hits:
                out.append((score, " ".join(hits)))
                score, hits = 0.0, []
        return out

    def features(self, text: str | None) -> tuple[float, float]:
        found = [s for s, _ in self.clauses(text or "")]
        return (max(found), math.log1p(sum(found))) if found else (0.0, 0.0)

    def marks(self, text: str | None) -> int:
        """The bits of :func:`marks_of_arcs` that the matches of the text have."""
        bits, state, found = marks_of_arcs(), 0, 0
        tokens = _TOKEN.findall((text or "").lower())
        if not any(self.symbol(w)[1] for w in set(tokens)):
            return 0
        for w in tokens:
            kind, weight = self.symbol(w)
            if weight:
                found |= bits[state, kind]
            state = self.arcs[state, kind][1]
        return found

    def score(self, text: str | None) -> float:
        a, b, c = self.coef
        worst, total = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * worst + c * total))))


def _beginnings(words: Iterable[str]) -> set[str]:
    return {w[:k] for w in words for k in range(_SHORTEST, min(len(w), _LONGEST + 1))}


def _words_of(text: str) -> tuple[list[str], list[str]]:
    """The different words, and those that stand only within the reach of negations and reporting words."""
    tokens = _TOKEN.findall(text.lower())
    words = sorted(set(tokens))
    triggers = {w: kind for kind in (NEGATION, REPORT) for w in WORDS[kind].split()}
    if triggers.keys().isdisjoint(tokens):
        return words, []
    guard = _marker(REPORT, None, 0.0) >> _marker(NEGATION, NEGATION_REACH, 0.0)
    state, out = guard.start, set()
    for w in tokens:
        # any other word could be a match
        kind = END if w in ".!?;\n" else triggers.get(w, INSULT)
        _, factor, state = guard.arcs[state, kind]
        if factor:
            out.add(w)
    return words, sorted(set(words) - out)


@dataclass(frozen=True)
class Sample:
    """A labelled document as its different words, and those only within the reach of negations and reporting words."""

    key: int
    words: list[str]
    reached: list[str]
    toxic: int


def _distinct(samples: list[Sample]) -> list[Sample]:
    """Without near copies of earlier samples: those that share most of their lowest word hashes."""
    seen, out = set(), []
    for x in samples:
        low = sorted({zlib.crc32(w.encode()) for w in x.words if len(w) > 5})[:8] or [" ".join(x.words)]
        if sum((h, x.toxic) in seen for h in low) * 2 <= len(low):
            out.append(x)
        seen.update((h, x.toxic) for h in low)
    return out


def _lexicons(samples: list[Sample], evidence: float, ratio: float) -> list[dict[str, float]]:
    """Words and beginnings with their weights: the larger of those from all places and from those outside any reach."""
    views = [_lexicons_of([(sorted(set(x.words).difference(x.reached if bare else ())), x.toxic) for x in samples], evidence, ratio) for bare in (False, True)]
    return [{w: max(one.get(w, 0.0), two.get(w, 0.0)) for w in one.keys() | two.keys()} for one, two in zip(*views, strict=True)]


def _lexicons_of(samples: list[tuple[list[str], int]], evidence: float, ratio: float) -> list[dict[str, float]]:
    toxic, clean = [words for words, y in samples if y], [words for words, y in samples if not y]
    bad = (Counter(), Counter())
    for words in toxic:
        for c, found in zip(bad, (words, _beginnings(words)), strict=True):
            c.update(found)
    few = [{x for x, n in c.items() if n >= 4} for c in bad]
    good = (Counter(), Counter())
    for words in clean:
        for c, found, wanted in zip(good, (set(words), _beginnings(words)), few, strict=True):
            c.update(found & wanted)
    most = Counter()  # the commonest word of each beginning: a beginning that is nearly one word teaches nothing more
    for w, n in bad[0].items():
        for k in range(_SHORTEST, min(len(w), _LONGEST + 1)):
            most[w[:k]] = max(most[w[:k]], n)
    base, out = len(toxic) / max(1, len(samples)), []
    for kind in (0, 1):
        taken = {}
        for x in few[kind]:
            if kind and most[x] > 0.6 * bad[1][x]:
                continue
            a, b = bad[kind][x], good[kind][x]
            odds = math.log((a + 0.5) / (len(toxic) + 1)) - math.log((b + 0.5) / (len(clean) + 1))
            if odds >= math.log(ratio) and a * math.log(a / ((a + b) * base)) >= evidence:
                taken[x] = odds
        out.append(taken)
    return out


def fit_factors(seen: Iterable[tuple[int, bool]], prior: dict[str, float] = FACTORS) -> dict[str, float]:
    """The factor of each mark from (bits of the marks, whether toxic) of documents.

    The log odds of toxic documents to hold matches with the mark, over those
    to hold matches without it, from 0 to the mark's ``LARGEST``; ``PRIOR_DOCS``
    documents with the mark weigh as much as the prior. Where matches without
    the mark tell nothing, the prior stays.
    """
    seen = list(seen)
    toxic = sum(bool(y) for _, y in seen)

    def odds(bit: int) -> tuple[float, int]:
        a, b = (sum(bool(m >> bit & 1) for m, y in seen if bool(y) is kind) for kind in (True, False))
        return math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (len(seen) - toxic + 1)), a + b

    out = {}
    for k, (name, before) in enumerate(prior.items()):
        (marked, n), (plain, m) = odds(k), odds(k + len(prior))
        told = min(LARGEST[name], max(0.0, marked / plain)) if plain > 0 and m else before
        out[name] = (n * told + PRIOR_DOCS * before) / (n + PRIOR_DOCS)
    return out


def learn_from(samples: list[Sample], features: Callable[[list[tuple[ToxicityModel, list[int]]]], dict[int, tuple[float, float, int]]], evidence: float = 18.0, ratio: float = 12.0) -> ToxicityModel:
    """Learns from samples; near copies count once.

    A word or strict beginning is taken if toxic samples hold it at least
    ``ratio`` times as often as clean ones and its log-likelihood gain over
    the base rate is at least ``evidence``. The factors and then the logistic function are fitted to
    marks and scores that each half of the samples gets from the other half's lexicon: ``features`` gives
    (worst, total, marks) of whole texts, by key, for each model and the keys of its texts.
    """
    samples = _distinct(samples)
    model = ToxicityModel(*_lexicons(samples, evidence, ratio))
    if {bool(x.toxic) for x in samples} == {True, False}:
        halves = [[s for k, s in enumerate(sorted(samples, key=lambda s: s.toxic)) if k % 2 == h] for h in (0, 1)]
        parts = [(ToxicityModel(*_lexicons(one, evidence, ratio)), [s.key for s in other]) for one, other in (halves, halves[::-1])]
        judged = halves[1] + halves[0]
        found = features(parts)
        factors = fit_factors((found[s.key][2], bool(s.toxic)) for s in judged)
        parts = [(replace(m, factors=factors, memo={}), keys) for m, keys in parts]
        model = replace(model, factors=factors, memo={})
        found = features(parts)
        x = np.array([(1.0, *found[s.key][:2]) for s in judged])
        y, w = np.array([float(bool(s.toxic)) for s in judged]), np.zeros(3)
        for _ in range(25):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
            w -= np.linalg.solve(h, x.T @ (p - y) + 0.1 * w)
        model.coef = tuple(map(float, w))
    return model


def learn(samples: Iterable[tuple[str, int]], evidence: float = 18.0, ratio: float = 12.0) -> ToxicityModel:
    """:func:`learn_from` (text, 0/1) samples that are here."""
    given = list(samples)
    marked = [Sample(k, *_words_of(t), int(y)) for k, (t, y) in enumerate(given)]
    return learn_from(marked, lambda parts: {k: (*m.features(given[k][0]), m.marks(given[k][0])) for m, keys in parts for k in keys}, evidence, ratio)


def _sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, "t", 2 << 20):
        found = [_words_of(t) for t in b.column("t").to_pylist()]
        words, reached = (pa.array([w[k] for w in found], pa.list_(pa.string())) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([b.column("k"), b.column("y"), words, reached], ["k", "y", "words", "reached"])


def _sample_features(parts: list[tuple[ToxicityModel, list[int]]]):
    by_key = {k: m for m, keys in parts for k in keys}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "t", 2 << 20):
            rows = [(k, *by_key[k].features(t), by_key[k].marks(t)) for k, t in zip(b.column("k").to_pylist(), b.column("t").to_pylist(), strict=True) if k in by_key]
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            kinds = (pa.int64(), pa.float64(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["k", "worst", "total", "marks"])

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: tuple[int, int] = (1200, 2400)) -> ToxicityModel:
    """Learns from at most ``sample`` (toxic, clean) labelled documents, those with the smallest hash of the id modulo 2^20.

    The bounds hold for the fit alone. Sampled texts are read whole, in the tasks: the driver receives the different words of
    each, and then three numbers, twice. Of the texts of a repeated id the one with the
    smallest hash counts. Rows without id, text or label are left out.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("k"), F.col(label_col).cast("int").alias("y")).filter("k is not null and y is not null")
    marked = marked.filter("y in (0, 1)").groupBy("k").agg(F.max("y").alias("y"))
    marked = marked.withColumn("h", F.xxhash64("k")).withColumn("m", F.pmod("h", F.lit(1 << 20)))
    given = {r.y: r.n for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = []
    for y, n in ((1, sample[0]), (0, sample[1])):
        # about four times as many by hash, so that a task sends a few rows however many it has
        share = min(1.0, 4 * n / max(1, given.get(y, 0)))
        chosen += marked.filter((F.col("y") == y) & (F.col("m") < math.ceil(share * (1 << 20)))).orderBy("m", "h", "k").limit(n).collect()
    if not chosen:
        return learn([])
    picked = docs.sparkSession.createDataFrame([(r.k, r.y) for r in chosen], "k long, y int")  # as many as ``sample`` says
    texts = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).cast("string").alias("t"))
    # one text of each id: a task sends one however often the id is repeated
    rows = texts.filter("t is not null").join(F.broadcast(picked), "k").groupBy("k", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    rows = stored(rows, "toxicity-sample")
    samples = [Sample(r.k, list(r.words), list(r.reached), r.y) for r in rows.mapInArrow(_sample_words, "k long, y int, words array<string>, reached array<string>").collect()]

    def features(parts: list[tuple[ToxicityModel, list[int]]]) -> dict[int, tuple[float, float, int]]:
        found = rows.select("k", "t").mapInArrow(_sample_features(parts), "k long, worst double, total double, marks int").collect()
        return {r.k: (r.worst, r.total, r.marks) for r in found}

    return learn_from(sorted(samples, key=lambda s: s.key), features)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", with_row: bool = False) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5 on), clauses (the matched ones: score, words) of every whole text, and the input row as ``row`` if asked for.

    A null text is empty; an empty one has the base score. A null id stays
    null and repeated rows come back as often as given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("score", pa.float64()), ("words", pa.string())]))
        a, b, c = model.coef
        for batch in pieces(batches, text_col, 2 << 20):
            scores, matched = [], []
            for t in texts_of(batch, text_col).to_pylist():
                found = model.clauses(t)
                worst, total = (max(s for s, _ in found), math.log1p(sum(s for s, _ in found))) if found else (0.0, 0.0)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * worst + c * total)))))
                matched.append([{"score": s, "words": w} for s, w in found])
            yield with_row_of(
                batch,
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(matched, kind)],
                ["doc_id", "score", "predicted", "clauses"],
            )

    chosen = id_text(docs, id_col, text_col, with_row)
    return chosen.mapInArrow(run, schema_of("doc_id long, score double, predicted int, clauses array<struct<score:double,words:string>>", chosen))
