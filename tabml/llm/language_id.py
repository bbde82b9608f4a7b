"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a segment forwards and backwards and labels every position; a
document's probabilities are the mean over the positions of all its segments.
A segment is a run without white space; one longer than a model's ``segment`` bytes is cut, between characters.
Segments start from a zero state, so the network's context is a segment, equal segments have equal labels and a
worker computes each of them once. Weights are learned in numpy by
backpropagation through time with Adam on a bounded sample of the documents
of each label.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import id_text, pieces, schema_of, texts_of, with_row_of

#: Segments that are remembered per worker (a memory that is full becomes the old one); results don't depend on it.
MEMORY = 200_000
UNKNOWN = "und"
#: Steps between scores 0 and 1 by which the scores of all held-out rows are counted.
GRAIN = 4096


def segments(text: str, size: int = 32) -> Counter[bytes]:
    """How often each segment of at most ``size`` bytes (4 or more) occurs in the whole text, letter case aside."""
    found = Counter(text.lower().encode().split())
    for long in [s for s in found if len(s) > size]:
        n, at = found.pop(long), 0
        while at < len(long):
            end = at + size
            while end < len(long) and long[end] & 0xC0 == 0x80:  # inside a character
                end -= 1
            found[long[at:end]] += n
            at = end
    return found


def _batch(segs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes (time, segment) and lengths."""
    size = np.array([len(s) for s in segs])
    codes = np.zeros((len(segs), int(size.max())), np.uint8)
    codes[np.arange(codes.shape[1]) < size[:, None]] = np.frombuffer(b"".join(segs), np.uint8)
    return codes.T, size


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Gru:
    """One direction: input rows per byte value (update, reset, candidate), recurrent weights."""

    x: np.ndarray  # (256, 3h)
    u: np.ndarray  # (h, 2h)
    c: np.ndarray  # (h, h)

    @classmethod
    def random(cls, h: int, rng: np.random.Generator) -> Gru:
        draw = lambda *s: rng.normal(0, 0.5 / math.sqrt(h), s).astype(np.float32)
        return cls(draw(256, 3 * h), draw(h, 2 * h), draw(h, h))

    def forward(self, codes: np.ndarray, alive: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States (time, segment, h); a segment's state stays as it is once the segment has ended."""
        h = self.c.shape[0]
        state, out, tape = np.zeros((codes.shape[1], h), np.float32), np.empty((*codes.shape, h), np.float32), []
        for t in range(len(codes)):
            x = self.x[codes[t]]
            gates = _sigmoid(x[:, :2 * h] + state @ self.u)
            z, r = gates[:, :h] * alive[t][:, None], gates[:, h:]
            new = np.tanh(x[:, 2 * h:] + (r * state) @ self.c)
            if keep:
                tape.append((state, gates, z, r, new))
            state = state + z * (new - state)
            out[t] = state
        return out, tape

    def backward(self, codes: np.ndarray, alive: np.ndarray, tape: list, d_out: np.ndarray) -> Gru:
        """Gradients, backpropagated through time."""
        h = self.c.shape[0]
        g, d_state = Gru(np.zeros_like(self.x), np.zeros_like(self.u), np.zeros_like(self.c)), np.zeros_like(d_out[0])
        for t in range(len(codes) - 1, -1, -1):
            state, gates, z, r, new = tape[t]
            d = d_state + d_out[t]
            d_new = d * z * (1 - new * new)
            d_z = d * (new - state) * alive[t][:, None] * gates[:, :h] * (1 - gates[:, :h])
            d_rs = d_new @ self.c.T
            d_r = d_rs * state * r * (1 - r)
            d_gate = np.concatenate([d_z, d_r], 1)
            d_state = d * (1 - z) + d_rs * r + d_gate @ self.u.T
            g.u += state.T @ d_gate
            g.c += (r * state).T @ d_new
            np.add.at(g.x, codes[t], np.concatenate([d_gate, d_new], 1))
        return g


@dataclass
class LanguageModel:
    """Both directions, the output layer and the labels."""

    labels: list[str]
    ahead: Gru
    back: Gru
    w: np.ndarray  # (2h, labels)
    b: np.ndarray
    segment: int = 32

    def _both(self, segs: list[bytes], keep: bool = False):
        codes, size = _batch(segs)
        alive = (np.arange(len(codes))[:, None] < size).astype(np.float32)
        turn = np.maximum(size - 1 - np.arange(len(codes))[:, None], 0)  # position t of the reversed segment
        at = np.arange(len(segs))
        turned = codes[turn, at]
        f, f_tape = self.ahead.forward(codes, alive, keep)
        b, b_tape = self.back.forward(turned, alive, keep)
        states = np.concatenate([f, b[turn, at]], 2)
        logits = states @ self.w + self.b
        p = np.exp(logits - logits.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        return codes, turned, alive, turn, at, f_tape, b_tape, states, p

    def pooled(self, segs: list[bytes]) -> np.ndarray:
        """The sum of the positions' probabilities of each segment."""
        out = np.empty((len(segs), len(self.labels)), np.float32)
        order = np.argsort([len(s) for s in segs], kind="stable")
        for k in range(0, len(order), 4096):
            at = order[k:k + 4096]
            _, _, alive, *_, p = self._both([segs[i] for i in at])
            out[at] = (p * alive[:, :, None]).sum(0)
        return out

    def step(self, segs: list[bytes], y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy of all positions."""
        codes, turned, alive, turn, at, f_tape, b_tape, states, p = self._both(segs, keep=True)
        d = p.copy()
        d[:, np.arange(len(y)), y] -= 1
        d *= alive[:, :, None] / alive.sum()
        d_states = d @ self.w.T
        h = self.ahead.c.shape[0]
        d_b = np.zeros_like(d_states[:, :, h:])
        np.add.at(d_b, (turn, np.broadcast_to(at, turn.shape)), d_states[:, :, h:] * alive[:, :, None])
        gf = self.ahead.backward(codes, alive, f_tape, d_states[:, :, :h])
        gb = self.back.backward(turned, alive, b_tape, d_b)
        return [gf.x, gf.u, gf.c, gb.x, gb.u, gb.c, np.einsum("tnh,tnl->hl", states, d), d.sum((0, 1))]

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.x, self.ahead.u, self.ahead.c, self.back.x, self.back.u, self.back.c, self.w, self.b]


def train(samples: list[tuple[str | list[bytes], str]], hidden: int = 16, steps: int = 300, batch: int = 512, rate: float = 0.02, seed: int = 7, segment: int = 32) -> LanguageModel:
    """Fits the network to samples of (text, or segments, and language); ``steps`` of Adam on ``batch`` segments each."""
    rng = np.random.default_rng(seed)
    labels = sorted({lang for _, lang in samples})
    h, n = hidden, len(labels)
    model = LanguageModel(labels, Gru.random(h, rng), Gru.random(h, rng), rng.normal(0, 0.1, (2 * h, n)).astype(np.float32), np.zeros(n, np.float32), segment)
    segs, y = [], []
    for text, lang in samples:
        found = list(segments(text, segment)) if isinstance(text, str) else text
        segs += found
        y += [labels.index(lang)] * len(found)
    y = np.array(y)
    if not len(y) or n < 2:
        return model
    # every language weighs the same
    share = 1 / np.bincount(y, minlength=n)[y]
    share /= share.sum()
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in model.parameters()]
    for k in range(1, steps + 1):
        pick = rng.choice(len(y), batch, p=share)
        grads = model.step([segs[i] for i in pick], y[pick])
        now = rate * 0.5 * (1 + math.cos(math.pi * (k - 1) / steps))
        for p, g, (m, v) in zip(model.parameters(), grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= now * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return model


def held_out(id_col: Column, modulus: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``."""
    return F.crc32(id_col.cast("string").cast("binary")) % modulus == rest


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """v, l, t: a hash of id and text, label and text; rows without label, or whose text is null or blank, are left out."""
    return docs.select(
        F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col)), 10).alias("v"), F.col(lang_col).cast("string").alias("l"), F.col(text_col).cast("string").alias("t")
    ).filter(F.col("l").isNotNull() & F.col("t").rlike(r"\S"))


def _sampled(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int) -> DataFrame:
    """v, l, t: the rows of each label with the smallest hash v of id and text, somewhat more than ``sample`` different ones if there are as many.

    Rows without label, or whose text is null or blank, are left out. Every
    other label has a row at least; the driver receives one row per label.
    """
    rows = _labelled(docs, id_col, text_col, lang_col)
    given = rows.groupBy("l").agg(F.approx_count_distinct("v", 0.02).alias("n"), F.min("v").alias("first")).collect()
    # a share with room for the spread of a draw and of the count
    many = 1.1 * sample + 6 * math.sqrt(sample)
    below = [(r.l, max(r.first + 1, math.ceil(min(1.0, many / max(1, r.n)) * (1 << 54)))) for r in given]
    cuts = docs.sparkSession.createDataFrame(below, "l string, below long")
    return rows.join(F.broadcast(cuts), "l").filter("v < below").select("v", "l", "t")


def _some_segments(segment: int, most: int):
    """Of each whole text its different segments, or the ``most`` with the smallest hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "t", 2 << 20):
            found = [sorted(segments(t, segment), key=lambda s: (zlib.crc32(s), s))[:most] for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("l"), b.column("v"), pa.array(found, pa.list_(pa.binary()))], ["l", "v", "segs"])

    return run


def fit_language_model(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 600, sample_segments: int = 512, segment: int = 32, **train_args
) -> LanguageModel:
    """Trains on at most ``sample`` different labelled rows of each label: those with the smallest hash of id and text.

    Every label that has a text is learned, however rare. The bound holds for
    the fit alone; sampled texts are read whole, in the tasks, and the driver receives of each its different segments,
    or the ``sample_segments`` with the smallest hash if there are more.
    Rows without label, or whose text is null or blank, are left out.
    """
    chosen = _sampled(docs, id_col, text_col, lang_col, sample).dropDuplicates(["l", "v"]).select("l", "v", "t")
    rows = chosen.mapInArrow(_some_segments(segment, sample_segments), "l string, v long, segs array<binary>").collect()
    taken: Counter[str] = Counter()
    samples = []
    for r in sorted(rows, key=lambda r: (r.l, r.v)):
        taken[r.l] += 1
        if taken[r.l] <= sample:
            samples.append(([bytes(s) for s in r.segs], r.l))
    return train(samples, segment=segment, **train_args)


def least_scores(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = 0.01, part: float = 0.75) -> dict[str, float]:
    """For each learned label the score from which on a long text counts as one of that language.

    It lies ``part`` of the way from chance (one over the number of labels) to
    the low ``quantile`` of the scores of rightly predicted labelled rows, and
    nearer to chance the fewer they are (half of that with 10). All labelled rows
    are scored, whole, and repeated ones count once; they must not be rows that the model
    was fitted to. Scores are counted by steps of one in ``GRAIN``, rounded down, so that the driver receives no
    more counts a label. A label without such rows is left out. With a single label
    every score is 1, and nothing can be told apart.
    """
    held = predict_languages(_labelled(docs, id_col, text_col, lang_col), model, "v", "t", with_row=True).filter("lang_pred = row.l")
    steps = held.select("doc_id", "lang_pred", F.floor(F.col("score") * GRAIN).alias("at")).distinct()
    counts: dict[str, list[tuple[int, int]]] = {}
    for r in steps.groupBy("lang_pred", "at").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r.lang_pred, []).append((r["at"], r.n))
    chance = 1 / max(1, len(model.labels))
    least = {}
    for lang, found in counts.items():
        at, n = np.array(sorted(found)).T
        upto = np.cumsum(n)
        place = quantile * (upto[-1] - 1)
        low, high = at[np.searchsorted(upto, [math.floor(place), math.ceil(place)], side="right")] / GRAIN
        reached = low + (high - low) * (place - math.floor(place))
        least[lang] = float(chance + part * upto[-1] / (upto[-1] + 10) * (reached - chance))
    return least


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", with_row: bool = False) -> DataFrame:
    """doc_id, lang_pred, score (the pooled probability, 0 to 1) of every whole text, and the input row as ``row`` if asked for.

    A text that is null or without letters is ``und`` with score 0, and so is
    every text if the model has learned no label; ties go to the label that
    sorts first; a null id stays null and repeated rows come back as often as
    given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        pooled = np.empty((0, len(model.labels)), np.float32)
        for b in pieces(batches, text_col, 2 << 20):
            counts = []
            for t in texts_of(b, text_col).to_pylist():
                # a text has a letter if any of its characters is one
                counts.append(segments(t, model.segment) if t and model.labels and any(map(str.isalpha, t)) else None)
            new = list({s for c in counts if c for s in c if s not in known})
            if new:
                if len(known) + len(new) > MEMORY:  # keep what this batch needs
                    here = {s for c in counts if c for s in c}
                    kept = [s for s in known if s in here]
                    pooled = pooled[[known[s] for s in kept]]
                    known = {s: i for i, s in enumerate(kept)}
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                pooled = np.concatenate([pooled, model.pooled(new)])
            lang, score = [], []
            for c in counts:
                if not c:
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    continue
                times = np.fromiter(c.values(), np.float64, len(c))
                p = times @ pooled[[known[s] for s in c]]
                p /= p.sum()
                lang.append(model.labels[int(p.argmax())])
                score.append(float(min(1.0, p.max())))
            yield with_row_of(b, [b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    chosen = id_text(docs, id_col, text_col, with_row)
    return chosen.mapInArrow(run, schema_of("doc_id long, lang_pred string, score double", chosen))
