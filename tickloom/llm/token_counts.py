"""Exact token counts of every prefix of a text, from tables of its pieces' prefixes.

The vocabulary never joins characters across white space or pre-token edges, so the count at
a prefix is the count at the last edge before it plus the count of the piece begun there. A
piece's table is its parent's (the piece without its last character) and one entry more:
tables grow from shorter to longer prefixes, and the library encodes each distinct prefix of a
piece on its own, once in a worker; no count is derived from an earlier one. A text's counts
at all prefixes are looked up and added; how many tokens a prefix has, where a budget ends and
whether a limit is passed need no further encoding.

* A null text counts as empty: 0 bytes, 0 tokens.
* Texts of any length are handled whole; so are pieces, whose tables hold wider numbers where
  a count passes 255. Pieces of over 64 code points are not remembered; their totals take one
  encoding, their counts at all prefixes time and memory quadratic in their length.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import each
from tickloom.llm.tokens import _SOLID, Encoder, plain, word_chunks, word_pieces

LIMIT = 2048
# A worker remembers about so many chunks, and half as many prefixes again; then it starts anew.
MAX_KNOWN = 500_000
LONG_PIECE = 64


class PrefixCounter:
    """Counts at every prefix of texts, for a vocabulary that drops white space."""

    def __init__(self, path: str) -> None:
        self.library = Encoder(path, word_chunks, word_pieces).library
        # Tokens after each character of a piece, and of whole chunks.
        self.tables: dict[str, bytes | array] = {"": b""}
        self.totals: dict[str, int] = {}

    def _lengths(self, texts: list[str]) -> list[int]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [len(e) for e in found]

    def learn(self, pieces: set[str]) -> None:
        """Tables of short pieces: every new prefix once, shorter ones first."""
        new: set[str] = set()
        for piece in pieces:
            while piece not in self.tables and piece not in new:
                new.add(piece)
                piece = piece[:-1]
        ordered = sorted(new, key=len)
        for piece, n in zip(ordered, self._lengths(ordered)):
            parent = self.tables[piece[:-1]]
            # Bytes as long as all counts fit, then wider numbers.
            narrow = n < 256 and type(parent) is bytes
            self.tables[piece] = parent + bytes((n,)) if narrow else array("I", [*parent, n])

    def table(self, piece: str) -> np.ndarray:
        """Tokens of the first 1, 2, ... characters of a piece."""
        if len(piece) > LONG_PIECE:
            return np.array(self._lengths([piece[: i + 1] for i in range(len(piece))]))
        if piece not in self.tables:
            self.learn({piece})
        return np.asarray(memoryview(self.tables[piece]))

    def _add(self, chunks: list[str]) -> None:
        """Totals of new chunks from the last entries of their pieces' tables."""
        split = [word_pieces(c) for c in chunks]
        pieces = {p for ps in split for p in ps}
        self.learn({p for p in pieces if len(p) <= LONG_PIECE and p not in self.tables})
        long = [p for p in pieces if len(p) > LONG_PIECE]
        last = dict(zip(long, self._lengths(long)))
        for chunk, ps in zip(chunks, split):
            self.totals[chunk] = sum([last[p] if p in last else self.tables[p][-1] for p in ps])

    def counts(self, text: str | None) -> np.ndarray:
        """Tokens of the first i code points, for i from 0 to the length."""
        text = text or ""
        step = np.zeros(len(text) + 1, dtype=np.int64)
        usual = plain(text)
        for found in _SOLID.finditer(text):
            chunk, at = found.group(), found.start() + 1
            for piece in word_pieces(chunk.lower()) if usual else [chunk]:
                table = self.table(piece).astype(np.int64)
                step[at : at + len(piece)] = np.diff(table, prepend=0)
                at += len(piece)
        return np.cumsum(step)

    def total(self, text: str | None) -> int:
        """Tokens of the whole text: the last entries of its tables, added."""
        chunks = word_chunks(text or "")
        try:
            return sum(map(self.totals.__getitem__, chunks))
        except KeyError:
            # Forgotten before, never while a text's chunks are added: it needs all of them.
            if len(self.totals) > MAX_KNOWN:
                self.totals.clear()
            if len(self.tables) > 1.5 * MAX_KNOWN:
                self.tables = {"": b""}
            self._add([c for c in set(chunks) if c not in self.totals])
            return sum(map(self.totals.__getitem__, chunks))

    def cut(self, text: str, budget: int) -> str:
        """The longest prefix of at most ``budget`` tokens."""
        return text[: int(np.flatnonzero(self.counts(text) <= budget)[-1])]


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def with_prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """Add ``prefix_tokens``: tokens of the first 0, 1, 2, ... code points of each text."""

    @F.arrow_udf("array<int>")
    def tables(texts: pa.Array) -> pa.Array:
        counts = counter(path).counts
        return pa.array([counts(t).astype("int32") for t in each(texts)], pa.list_(pa.int32()))

    return docs.withColumn("prefix_tokens", tables("text"))


def within_budget(prefix_tokens: str, budget: int):
    """Code points of the longest prefix within a budget, from stored prefix counts."""
    return F.size(F.filter(prefix_tokens, lambda n: n <= budget)) - 1


def counted(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """n_bytes, n_tokens and over_limit of every row, without writing the tables out."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = counter(path).total
        for batch in batches:
            n = pa.array([total(t) for t in each(batch.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), n], ["doc_id", "n_bytes", "n_tokens"]
            )

    size = F.coalesce(F.octet_length("text").cast("bigint"), F.lit(0)).alias("n_bytes")
    rows = docs.select("doc_id", "text", size)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(measure, f"doc_id {kind}, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
