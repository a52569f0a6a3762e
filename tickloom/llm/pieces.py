"""Sentence-piece ids of whole texts by an agenda of adjacent symbol pairs, and texts of ids.

A text is normalised by the model and cut where a space mark follows another character: no
piece of a merge-type vocabulary reaches over that edge, so no merge does. Inside a cut every
character is a symbol. The agenda holds each adjacent pair whose join is a piece, the best
score first, of equal scores the leftmost; the pair on top is joined if both its symbols are
still as they were, and its new neighbours enter the agenda. The short cuts of many texts
advance together, a join a step; a long cut has a heap of its own. Symbols that are no piece at
the end become the ids of their UTF-8 bytes (or the unknown id, one for a row of them, where
the vocabulary has no bytes). Decoding writes pieces and bytes one after another.

In each Arrow batch the sentencepiece library encodes every cut that is new to the worker, too,
and decodes every row's ids: ``agrees`` tells for a row whether each of its cuts has the same ids
there and the whole of it the same text.

* A null text counts as empty: no ids, an empty text.
* Texts of any length are encoded whole, also one cut of a megabyte (n log n in its length).
* Ties in score go to the left, as in the library. Repeated rows give repeated rows, an empty
  table an empty one. Columns other than ``doc_id`` and ``text`` are not read.
* A worker remembers the ids of about ``KNOWN`` cuts of at most ``SHORT`` characters, and then
  starts anew; longer cuts are worked out again for each text. This bounds memory and changes
  no result.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import accumulate, chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tickloom.llm.common import each

MARK = "▁"
KNOWN = 400_000
SHORT = 48
# Texts of about so many bytes are encoded together.
TOGETHER = 1 << 20
# Slots of the table of pairs, and the odd number that spreads pairs over them.
SLOT_BITS = 19
MIX = 0x9E3779B97F4A7C15
# A place after all scores.
NO_PAIR = 1 << 30

# A byte that belongs to no character becomes one replacement character.
codecs.register_error("bytewise", lambda e: ("�", e.start + 1))


class Pieces:
    """A merge-type vocabulary."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.bytes: dict[int, int] = {}
        self.controls: set[int] = set()
        self.unknown = lib.unk_id()
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                byte = int(piece[3:5], 16)
                self.bytes[byte] = i
                self.texts.append(bytes((byte,)))
            elif lib.is_unknown(i):
                self.texts.append(lib.decode([i]).encode())
            elif lib.is_control(i):
                self.controls.add(i)
                self.texts.append(b"")
            elif lib.is_unused(i):
                raise ValueError("vocabularies with unused pieces are not supported")
            else:
                self.pieces[piece] = i
                self.texts.append(piece.replace(MARK, " ").encode())
        self.marked = {i for p, i in self.pieces.items() if p[0] == MARK}
        # Where the model puts a space before a text, decoding takes it off again.
        self.prefixed = lib.normalize("a").startswith(MARK)
        inner = any(MARK in p.lstrip(MARK) for p in self.pieces)
        self.cuts = re.compile("(?s).+" if inner else f"{MARK}*[^{MARK}]+|{MARK}+")
        # Place of each piece among the scores, the best first; equal scores have equal places.
        # The last one, for no piece, is found by the piece -1.
        scores = np.array([lib.get_score(i) for i in range(len(self.texts))])
        self.ranks = np.append(np.unique(-scores, return_inverse=True)[1], NO_PAIR)
        self.rank_list = self.ranks.tolist()
        own = self.pieces
        self.by_pair = {
            own[p[:k]] << 21 | own[p[k:]]: i
            for p, i in own.items()
            for k in range(1, len(p))
            if p[:k] in own and p[k:] in own
        }
        # The same as an open table: a pair lies at its slot or the next free one.
        self.slots = np.zeros((1 << SLOT_BITS) + len(self.by_pair) + 1, np.uint64)
        self.joined = np.full(len(self.slots), -1)
        for pair, piece in self.by_pair.items():
            at = (pair * MIX & (1 << 64) - 1) >> 64 - SLOT_BITS
            while self.slots[at]:
                at += 1
            self.slots[at], self.joined[at] = pair, piece
        # Characters that are no piece are symbols from the size of the vocabulary on.
        self.symbol_of = np.arange(0x110000) + len(self.texts)
        for p in own:
            if len(p) == 1:
                self.symbol_of[ord(p)] = own[p]
            if any(c not in own for c in p):
                raise ValueError("vocabularies whose pieces have characters that are no pieces are not supported")
        self.known: dict[str, bytes] = {}
        self.differing: set[str] = set()

    def _joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols join to, -1 where there is none."""
        pairs = (left << 21 | right).astype(np.uint64)
        at = (pairs * np.uint64(MIX)) >> np.uint64(64 - SLOT_BITS)
        out = np.full(len(pairs), -1)
        open_ = np.arange(len(pairs))
        while len(open_):
            held = self.slots[at]
            same = held == pairs
            out[open_[same]] = self.joined[at[same]]
            further = ~same & (held != 0)
            open_, pairs, at = open_[further], pairs[further], at[further] + np.uint64(1)
        return out

    def together(self, cuts: list[str]) -> list[np.ndarray]:
        """The symbols left of each cut when no adjacent pair of it joins to a piece.

        All cuts advance together: each step joins the pair on top of every cut's agenda.
        """
        symbols = self.symbol_of[np.frombuffer("".join(cuts).encode("utf-32-le"), "<u4")]
        which, sizes = np.arange(len(cuts)), np.fromiter(map(len, cuts), np.int64, len(cuts))
        join = np.append(self._joins(symbols[:-1], symbols[1:]), -1)
        join[np.cumsum(sizes) - 1] = -1
        # A pair's place among the scores, before its own place: equal scores go to the left.
        rank = self.ranks[join] << 32
        out: list = [None] * len(cuts)
        while len(which):
            starts = np.cumsum(sizes) - sizes
            top = np.minimum.reduceat(rank + np.arange(len(rank)), starts)
            going = top < NO_PAIR << 32
            for i in np.flatnonzero(~going).tolist():
                out[which[i]] = symbols[starts[i] : starts[i] + sizes[i]]
            keep = np.repeat(going, sizes)
            at, which, sizes = top[going] & 0xFFFFFFFF, which[going], sizes[going] - 1
            symbols[at] = join[at]
            keep[at + 1] = False
            symbols, join, rank = symbols[keep], join[keep], rank[keep]
            starts, at = np.cumsum(sizes) - sizes, (np.cumsum(keep) - 1)[at]
            for left, same in ((at, at < starts + sizes - 1), (at - 1, at > starts)):
                join[left[~same & (left >= starts)]] = -1
                left = left[same]
                join[left] = self._joins(symbols[left], symbols[left + 1])
            changed = np.concatenate([at, at[at > starts] - 1])
            rank[changed] = self.ranks[join[changed]] << 32
        return out

    def alone(self, cut: str) -> np.ndarray:
        """The same for one cut of any length, with its agenda as a heap."""
        symbols = self.symbol_of[np.frombuffer(cut.encode("utf-32-le"), "<u4")]
        join = self._joins(symbols[:-1], symbols[1:])
        places = np.flatnonzero(join >= 0)
        agenda = list(zip(self.ranks[join[places]].tolist(), places.tolist(), join[places].tolist()))
        heapify(agenda)
        symbols, join, end = symbols.tolist(), join.tolist() + [-1], len(cut)
        before, after = list(range(-1, end)), list(range(1, end + 1))
        while agenda:
            _, left, joined = heappop(agenda)
            if join[left] != joined:
                continue  # one of the two has been joined to another since
            right = after[left]
            following = after[left] = after[right]
            symbols[left], symbols[right], join[right] = joined, -1, -1
            before[following] = left
            for place in (left, before[left]):
                if place < 0:
                    continue
                beside = after[place]
                pair = symbols[place] << 21 | symbols[beside] if beside < end else -1
                join[place] = wider = self.by_pair.get(pair, -1)
                if wider >= 0:
                    heappush(agenda, (self.rank_list[wider], place, wider))
        return np.array([s for s in symbols if s >= 0])

    def _spelt(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of symbols: those that are no piece are spelt in bytes."""
        size, out = len(self.texts), []
        for s in symbols.tolist():
            if s < size:
                out.append(s)
            elif self.bytes:
                out += map(self.bytes.__getitem__, chr(s - size).encode())
            else:
                out.append(self.unknown)
        return np.array(out)

    def learn(self, cuts: list[str]) -> None:
        """Remember the ids of these cuts, and which of them the library has other ids for."""
        short = [c for c in cuts if len(c) <= SHORT]
        long = [c for c in cuts if len(c) > SHORT]
        found = self.together(short) if short else []
        found += map(self.alone, long)
        symbols = np.concatenate(found)
        ends = np.cumsum([len(f) for f in found])
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(symbols >= len(self.texts)), "right")):
            found[i] = self._spelt(found[i])
        raw = np.concatenate(found).astype("<i4").tobytes()
        ends = (4 * np.cumsum([len(f) for f in found])).tolist()
        texts = [(c[1:] if self.prefixed else c).replace(MARK, " ") for c in short + long]
        theirs = self.library.encode(texts, num_threads=1)
        self.known.update((c, raw[a:b]) for c, a, b in zip(short + long, [0, *ends], ends))
        if np.fromiter(chain.from_iterable(theirs), "<i4").tobytes() == raw:
            if [4 * n for n in accumulate(map(len, theirs))] == ends:
                return
        for cut, text, their in zip(short + long, texts, theirs):
            # The library puts its space before no empty text: that cut is one piece or its bytes.
            ids = self._one_unknown(memoryview(self.known[cut]).cast("i").tolist())
            if ids != their and (text or ids != [self.library.piece_to_id(MARK)]):
                self.differing.add(cut)

    def _one_unknown(self, ids: list[int]) -> list[int]:
        """Unknown ids in a row are one."""
        if self.bytes or self.unknown not in ids:
            return ids
        rows = ([i] if i == self.unknown else g for i, g in groupby(ids))
        return list(chain.from_iterable(rows))

    def checked(self, texts: list[str]) -> Iterator[tuple[list[int], bool]]:
        """Of each text its ids, and whether the library has the same for each of its cuts."""
        cuts = [self.cuts.findall(self.library.normalize(t)) for t in texts]
        if len(self.known) > KNOWN:
            self.known.clear()
            self.differing.clear()
        new = set().union(*cuts).difference(self.known)
        if new:
            self.learn(list(new))
        for own in cuts:
            raw = b"".join(map(self.known.__getitem__, own))
            ids = memoryview(raw).cast("i").tolist()
            yield self._one_unknown(ids), self.differing.isdisjoint(own) if self.differing else True
        for cut in new:
            if len(cut) > SHORT:
                del self.known[cut]

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text."""
        return list(self.checked([text or ""]))[0][0]

    def decode(self, ids: list[int]) -> str:
        """The text of any ids. Control ids show nothing, but end a row of bytes."""
        if self.controls.isdisjoint(ids):
            shown = [b"".join(map(self.texts.__getitem__, ids))]
        else:
            rows = groupby(ids, self.controls.__contains__)
            shown = [b"".join(map(self.texts.__getitem__, row)) for _, row in rows]
        if self.prefixed:
            first = next((i for i in ids if i not in self.controls), None)
            if first in self.marked:
                at = next(k for k, part in enumerate(shown) if part)
                shown[at] = shown[at][1:]
        return "".join(part.decode("utf-8", "bytewise") for part in shown)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Pieces:
    return Pieces(path)


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows with about ``TOGETHER`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    groups = np.cumsum(sizes) // TOGETHER
    edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, the text decoded from them, and whether the library agrees on both."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for batch in batches:
            for part in parts(batch):
                ids, texts, agrees = [], [], []
                rows = [text or "" for text in each(part.column("text"))]
                for found, same in own.checked(rows):
                    shown = own.decode(found)
                    ids.append(array("i", found))
                    texts.append(shown)
                    agrees.append(same and own.library.decode(found) == shown)
                lengths = np.cumsum([0, *map(len, ids)], dtype="<i4")
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.ListArray.from_arrays(pa.array(lengths), flat),
                        pa.array(texts, pa.string()), pa.array(agrees, pa.bool_()),
                    ],
                    ["doc_id", "ids", "decoded", "agrees"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, decoded string, agrees boolean"
    return docs.select("doc_id", "text").mapInArrow(work, schema)
