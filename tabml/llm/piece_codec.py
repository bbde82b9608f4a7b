"""SentencePiece merge-type (BPE) encoding by a prefix table, and decoding.

Encoding by merges has a property that removes the need to replay them: every
prefix of a text ends in one token of its own, whatever follows, and the tokens
before it are the encoding of the shorter prefix. So a table with the last
token of each prefix holds the whole encoding. An automaton over the pieces
reports every piece that ends at a position; a piece is the last token there if
it is compatible with the last token of the prefix before it, i.e. if the two
stay apart when their joined text is encoded. Ids are recovered from the end
backwards. A character without a piece becomes its byte ids; nothing merges
across it.

No piece holds a space mark after another character, so the runs that begin at
a space mark are encoded apart, and short ones are remembered per worker.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tabml.llm.common import id_text, pieces

MARK = "▁"
#: Entries of the per-worker memories of runs and of token pairs; results don't depend on them. When that of runs is
#: full it becomes the old one, and what is met again moves to the new one; that of pairs is emptied.
MEMORY, PAIRS = 250_000, 1_000_000
SHORT = 48


class PieceCodec:
    """Encoder and decoder of one merge-type model with byte fallback."""

    def __init__(self, path: str) -> None:
        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.piece: dict[int, str] = {}
        self.byte = [0] * 256
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                self.byte[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.piece[i] = sp.id_to_piece(i)
        self.score = {s: sp.get_score(i) for i, s in self.piece.items()}
        if any(re.search(f"[^{MARK}]{MARK}", s) for s in self.score):
            raise ValueError("a piece holds a space mark after another character")
        self.name = [str(i) for i in range(sp.get_piece_size())]
        self.length = {i: len(s) for i, s in self.piece.items()}
        self.matches = ahocorasick.Automaton()
        for i, s in self.piece.items():
            self.matches.add_word(s, (i, len(s)))
        self.matches.make_automaton()
        # line breaks without a piece end a run like any character that nothing merges with
        known = set("".join(self.score))
        self.run = re.compile(" +[^ ]*" if "\n" in known else " +[^ \n]*|\n+|[^ \n]+")
        self.apart: dict[int, bool] = {}
        self.seen: dict[str, tuple[tuple[int, ...], str]] = {}
        self.old: dict[str, tuple[tuple[int, ...], str]] = {}

    def _merged(self, text: str) -> list[str]:
        """Encoding by replayed merges, for the short joined texts of two tokens."""
        parts, score = list(text), self.score.get
        gain = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for k, g in enumerate(gain):
                if g is not None and (best is None or g > best):
                    best, at = g, k
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del gain[at]
            if at:
                gain[at - 1] = score(parts[at - 1] + parts[at])
            if at < len(gain):
                gain[at] = score(parts[at] + parts[at + 1])

    def _compatible(self, before: int, piece: int) -> bool:
        """Whether the token ``piece`` can follow the token ``before`` (-1: start, or a character without a piece)."""
        if len(self.apart) >= PAIRS:
            self.apart.clear()
        parts = [self.piece[piece]] if before < 0 else [self.piece[before], self.piece[piece]]
        ok = self.apart[(before << 16) + piece] = self._merged("".join(parts)) == parts
        return ok

    def _run_ids(self, text: str) -> list[int]:
        last, apart = [-1] * (len(text) + 1), self.apart
        for end, (piece, n) in self.matches.iter(text):
            end += 1
            if last[end] < 0:
                before = last[end - n]
                ok = apart.get((before << 16) + piece)
                if ok or ok is None and self._compatible(before, piece):
                    last[end] = piece
        ids, at = [], len(text)
        while at:
            if (piece := last[at]) >= 0:
                ids.append(piece)
                at -= self.length[piece]
            else:
                at -= 1
                ids.extend(self.byte[b] for b in reversed(text[at].encode()))
        return ids[::-1]

    def _remember(self, run: str) -> tuple[tuple[int, ...], str]:
        found = self.old.get(run)
        if found is None:
            ids = tuple(self._run_ids(run.replace(" ", MARK)))
            found = ids, " ".join([self.name[i] for i in ids])
        if len(run) <= SHORT:
            if len(self.seen) >= MEMORY:
                self.old, self.seen = self.seen, {}
            self.seen[run] = found
        return found

    def encode_runs(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        """The ids of each run of the text, as numbers and as a joined string."""
        out = []
        # a mark stands before the text, like a space does
        for r in self.run.findall(" " + text.replace(MARK, " ")) if text else ():
            out.append(self.seen.get(r) or self._remember(r))
        return out

    def encode(self, text: str | None, end: bool = True) -> list[int]:
        """Ids of the whole text (null: empty), with the end id unless ``end`` is False."""
        ids = list(chain.from_iterable(r[0] for r in self.encode_runs(text or "")))
        return [*ids, self.processor.eos_id()] if end else ids

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """The codec of a model file, once per worker."""
    return PieceCodec(path)


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int, with the end id) of every whole text; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for b in pieces(batches, "text", 1 << 20):
            ids = [c.encode(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text from arrays of ids; a null array decodes like an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for b in batches:
            texts = [c.decode(x or []) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    chosen = encoded.select(encoded[id_col].cast("long").alias("doc_id"), encoded[ids_col].cast("array<int>").alias("ids"))
    return chosen.mapInArrow(run, "doc_id long, text string")


def codec_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the round trip: doc_id, n_tokens, ids_sha256, decoded_sha256, one row per input row.

    Ids and texts stay in the task that reads the document. A null text is
    empty and has the end id only; a null id stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        end = c.processor.eos_id()
        for b in pieces(batches, "text", 1 << 20):
            n, sha, back = [], [], []
            for text in b.column("text").to_pylist():
                runs = c.encode_runs(text)
                ids = list(chain.from_iterable([r[0] for r in runs]))
                ids.append(end)
                n.append(len(ids))
                sha.append(hashlib.sha256(" ".join([*[r[1] for r in runs], str(end)]).encode()).hexdigest())
                back.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
