"""Token ids of whole texts by the tokenizers library, each distinct chunk encoded once.

The vocabularies used here cut a text at white space before anything else, so ids of a text
are the ids of its chunks, one after another. A worker keeps the chunks it has seen; the
library sees new ones only. Texts that are not known to cut cleanly (special strings, runs of
spaces before byte-level pieces, control characters) go to the library as a whole or by its
own pre-token pattern.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import regex

# The end of a document in token streams.
END = 2

# A worker remembers about twice so many chunks and as many pieces, the latest used.
MAX_KNOWN = 80_000

# Characters whose lower case has one code point, that NFC leaves alone and that all
# libraries class alike: ASCII, Latin letters, common punctuation.
_UNUSUAL = regex.compile(r"[^\t-\r -~ -įı-ɏ‐-…€]")
_SOLID = regex.compile(r"\S+")
# The pre-token patterns of the word and the byte-level vocabulary.
_WORD_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_BYTE_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_RUNS = regex.compile(r"[\x00]|[^\S \n]|  | \n|\n |\n\n|^[ \n]|[ \n]$")


def plain(text: str) -> bool:
    """True if lower-casing and cutting here is sure to agree with the library."""
    return "<|" not in text and not _UNUSUAL.search(text)


def word_chunks(text: str) -> list[str]:
    """Chunks between white space, in lower case where the text is plain."""
    return text.lower().split() if plain(text) else _SOLID.findall(text)


def word_pieces(chunk: str) -> list[str]:
    """Pre-tokens of a chunk; letters alone are one, and a chunk that is not plain stays whole."""
    if chunk.isalpha():
        return [chunk]
    return _WORD_PIECES.findall(chunk) if plain(chunk) and chunk.islower() else [chunk]


def byte_chunks(text: str) -> list[str] | None:
    """Words with the space before them, and line ends; None if only the library can tell."""
    if "<|" in text:
        return None
    if _RUNS.search(text):
        return _BYTE_PIECES.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


def byte_pieces(chunk: str) -> list[str]:
    """Pre-tokens of a chunk; a space and letters are one."""
    if chunk[:1] == " " and chunk[1:].isalpha():
        return [chunk]
    return _BYTE_PIECES.findall(chunk)


class Recent:
    """A bounded memory of two generations: what the older one still gives moves to the newer."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, words: Iterable[str]) -> list[str]:
        """Words not remembered. The others are in ``young`` afterwards."""
        if len(self.young) > MAX_KNOWN:
            self.old, self.young = self.young, {}
        out, young, old = [], self.young, self.old
        for w in [w for w in words if w not in young]:
            if w in old:
                young[w] = old[w]
            else:
                out.append(w)
        return out


class Encoder:
    """Ids of texts, as little-endian unsigned 16-bit numbers."""

    def __init__(self, path: str, chunks: Callable, pieces: Callable, ends: bool = True) -> None:
        """``ends``: tokens mark the ends of words; else their spaces mark the beginnings."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        if self.library.get_vocab_size(with_added_tokens=True) > 65_536:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        self.chunks, self.pieces = chunks, pieces
        self.known, self.parts = Recent(), Recent()
        self.ends = ends
        self.marks = np.zeros(65_536, dtype=bool)
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.marks[i] = token.endswith("</w>") if ends else token.startswith("\u0120")

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u2").tobytes()

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. Plain words go to the library as one text, cut at its marks."""
        words = [p for p in pieces if (p if self.ends else p[1:]).isalpha()]
        if not self.ends:
            words = [p for p in words if p[0] == " "]
        ids = np.frombuffer(self.whole((" " if self.ends else "").join(words)), "<u2")
        at = np.flatnonzero(self.marks[ids])
        at = np.append(0, at + 1) if self.ends else np.append(at, len(ids))
        if len(at) != len(words) + 1:  # a word that is not one pre-token
            words, at = [], at[:0]
        raw, at = ids.tobytes(), (2 * at).tolist()
        found = {w: raw[a:b] for w, a, b in zip(words, at, at[1:])}
        others = [p for p in pieces if p not in found]
        coded = self.library.encode_batch_fast(others, add_special_tokens=False)
        found.update((p, np.array(e.ids, "<u2").tobytes()) for p, e in zip(others, coded))
        return [found[p] for p in pieces]

    def learn(self, chunks: set[str]) -> None:
        """Remember the ids of all these chunks; the library sees new pieces only."""
        new = self.known.missing(chunks)
        split = [self.pieces(chunk) for chunk in new]
        missing = self.parts.missing({p for pieces in split for p in pieces})
        parts = self.parts.young
        parts.update(zip(missing, self._ids(missing)))
        self.known.young.update(
            (c, parts[c] if len(ps) == 1 else b"".join([parts[p] for p in ps]))
            for c, ps in zip(new, split)
        )

    def encode(self, text: str | None) -> bytes:
        """The ids of one text; null is empty."""
        chunks = self.chunks(text or "")
        if chunks is None:
            return self.whole(text)
        try:
            return b"".join(map(self.known.young.__getitem__, chunks))
        except KeyError:
            self.learn(set(chunks))
            return b"".join(map(self.known.young.__getitem__, chunks))


@lru_cache(maxsize=4)
def word_encoder(path: str) -> Encoder:
    return Encoder(path, word_chunks, word_pieces)


@lru_cache(maxsize=4)
def byte_encoder(path: str) -> Encoder:
    return Encoder(path, byte_chunks, byte_pieces, ends=False)
