"""Token ids, counts, files and packed pieces against the tokenizers library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickloom.llm import packing, range_coder, token_counts, token_files, tokens
from tickloom.session import scratch_path

from .conftest import SF, odd_rows

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a  b   c\n\n d", "don't 'RE they'll <|endoftext|> x<|ENDOFTEXT|>y", "\0 nul\0l",
    "Σας ΣΑΣ İstanbul ½ ² é \xa0x\xa0 a　b 中文 字 \x1c q \x85 z", "a\tb \n c \n\n  ", "   lead",
    "'s's ''s !'s 123 4½", "a" * 300, " <|endoftext|> ", "ß ſ ǅ ŉ ẞ", "a<|endoftext|>  b", " \n x", "x \n",
]


def samples():
    pick = random.Random(1)
    return ODD + ["".join(pick.choice(" \n\t'sabé1!<|Σ́ ") for _ in range(30)) for _ in range(400)]


@pytest.mark.parametrize("path, make", [(WORD, tokens.word_encoder), (BYTE, tokens.byte_encoder)])
@pytest.mark.parametrize("known", [20, 500_000])
def test_ids_are_the_librarys(monkeypatch, path, make, known):
    monkeypatch.setattr(tokens, "MAX_KNOWN", known)
    library, encode = Tokenizer.from_file(path), make(path).encode
    for text in samples():
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u2").tolist() == ids, text


@pytest.mark.parametrize("known", [20, 500_000])
def test_counts_at_every_prefix(monkeypatch, known):
    monkeypatch.setattr(token_counts, "MAX_KNOWN", known)
    counter = token_counts.PrefixCounter(WORD)
    for text in samples()[:120]:
        want = [len(counter.library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counter.counts(text).tolist() == want
        assert counter.total(text) == want[-1]
        cut = counter.cut(text, 5)
        assert counter.total(cut) <= 5 and (cut == text or counter.total(text[: len(cut) + 1]) > 5)


def test_texts_of_more_chunks_than_are_remembered(monkeypatch):
    """A full memory is emptied before a text, not while its chunks are added."""
    monkeypatch.setattr(token_counts, "MAX_KNOWN", 50)
    counter = token_counts.PrefixCounter(WORD)
    for k, size in enumerate((60, 80, 200, 10, 500)):
        text = " ".join(f"w{k}x{i}" for i in range(size))
        assert counter.total(text) == len(counter.library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("char, n", [("\U00020000", 256), ("\U00012000", 256), ("\U0001d160", 576)])
def test_short_pieces_of_many_tokens(spark, char, n):
    """A piece of 64 code points may have more tokens than one byte can count."""
    counter = token_counts.PrefixCounter(WORD)
    text = f"a {char * 64} b"
    want = [len(counter.library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    assert counter.counts(text).tolist() == want
    assert counter.total(text) == want[-1] == n + 2
    table = spark.createDataFrame([(1, text), (2, "a")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts.counted(table, WORD).collect()} == {1: n + 2, 2: 1}


def test_stored_tables_answer_budgets(odd):
    got = token_counts.with_prefix_counts(odd.where("length(text) < 2000"), WORD)
    rows = got.select("text", "prefix_tokens", token_counts.within_budget("prefix_tokens", 7).alias("upto")).collect()
    counter = token_counts.PrefixCounter(WORD)
    for r in rows:
        assert r.prefix_tokens == counter.counts(r.text).tolist()
        assert r.text[: r.upto] == counter.cut(r.text, 7)


def test_count_query(spark, documents, queries, odd, nothing):
    library = Tokenizer.from_file(WORD)
    got = {r.doc_id: tuple(r)[1:] for r in queries["op8_token_counts"](spark, SF).collect()}
    for r in documents.collect():
        n = len(library.encode(r.text, add_special_tokens=False).ids)
        assert got[r.doc_id] == (len(r.text.encode()), n, n > 2048)
    assert token_counts.counted(odd, WORD).count() == len(odd_rows())
    assert token_counts.counted(odd, WORD).where("doc_id = 4").first()[1:] == (0, 0, False)
    assert token_counts.counted(nothing, WORD).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 4095, 4096, 4097, 9000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (
        rng.integers(0, 65_535, n), rng.integers(0, 3, n), np.full(n, 65_534),
        np.minimum(rng.zipf(1.3, n), 65_534),
    ):
        frame = range_coder.encode(ids.astype(np.uint16))
        assert (range_coder.decode(frame) == ids).all()


def test_coder_saves_space_and_notices_damage():
    ids = np.minimum(np.random.default_rng(0).zipf(1.4, 8192), 5000).astype(np.uint16)
    frame = bytearray(range_coder.encode(ids))
    assert len(frame) < 2 * len(ids) * 0.6
    frame[-40] ^= 1
    with pytest.raises(ValueError):
        range_coder.decode(bytes(frame))
    with pytest.raises(ValueError):
        range_coder.decode(bytes(frame[:-2]))
    with pytest.raises(ValueError):
        range_coder.encode(np.array([65_535], dtype=np.uint16))


def _streams(rows, library):
    return {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_file_query(spark, documents, queries):
    ids = _streams([(r.doc_id, r.text) for r in documents.collect()], Tokenizer.from_file(BYTE))
    start, want = 0, {}
    for i in sorted(ids):
        want[i] = (start, len(ids[i]), _crc(ids[i]))
        start += len(ids[i])
    assert {r.doc_id: tuple(r)[1:] for r in queries["op6_token_files"](spark, SF).collect()} == want


def test_files_of_odd_rows(spark, odd, nothing, monkeypatch):
    for table, frame in ((odd, token_files.FRAME), (odd, 50), (nothing, 50)):
        monkeypatch.setattr(token_files, "FRAME", frame)
        path = scratch_path(spark, "tokens")
        token_files.write_tokens(table, BYTE, path)
        got = token_files.read_tokens(spark, path).orderBy("start").collect()
        assert len(got) == table.count()
        at, library = 0, Tokenizer.from_file(BYTE)
        texts = {r[0]: r[1] for r in odd_rows()}
        for r in got:
            ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
            assert (r.start, np.frombuffer(r.ids, "<u4").tolist()) == (at, ids)
            at += len(ids)


def _check_pieces(pieces, ids, window):
    """Pieces cover every id once; sequences are gapless and all but the last are full."""
    covered, sequences = {}, {}
    for p in sorted(pieces, key=lambda p: (str(p.doc_id), p.start)):
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert len(part) == p.length and p.doc_tokens == len(ids[p.doc_id])
        crc = p.ids_crc32 if "ids_crc32" in p else zlib.crc32(p.ids)
        assert crc == _crc(part)
        covered[p.doc_id] = covered.get(p.doc_id, 0) + p.length
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    fill = []
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        fill.append(at)
    assert max(fill, default=0) <= window and sum(f < window for f in fill) <= 1
    assert sorted(sequences) == list(range(len(sequences)))
    return covered


def test_packing_query(spark, documents, queries):
    ids = _streams([(r.doc_id, r.text) for r in documents.collect()], Tokenizer.from_file(WORD))
    covered = _check_pieces(queries["op3_packing"](spark, SF).collect(), ids, packing.WINDOW)
    assert covered == {i: len(x) for i, x in ids.items()}


@pytest.mark.parametrize("window", [16, 4096])
def test_packing_odd_rows(odd, nothing, window):
    rows = odd_rows()
    ids = _streams([(r[0], r[1]) for r in rows], Tokenizer.from_file(WORD))
    covered = _check_pieces(packing.packed(odd, WORD, window).collect(), ids, window)
    assert covered == {i: len(x) * (2 if i == 9 else 1) for i, x in ids.items()}
    assert packing.packed(nothing, WORD, window).count() == 0


def test_plan_uses_exact_combinations():
    lengths = np.array([10, 20, 22, 30, 42, 54])
    counts = np.array([7, 5, 9, 4, 6, 3])
    slots = packing.plan(lengths, counts, 64)
    fill, used = {}, dict.fromkeys(lengths.tolist(), 0)
    for length, rank, sequence, _, n in slots.tolist():
        assert rank == used[length]
        used[length] += n
        for i in range(n):
            fill[sequence + i] = fill.get(sequence + i, 0) + length
    assert set(fill.values()) == {64} and len(fill) >= 9
    assert all(used[n] <= c for n, c in zip(lengths.tolist(), counts.tolist()))


def test_least_squares_is_non_negative_and_close():
    combos = np.array([[10, 54, 0], [20, 22, 22], [10, 12, 42]])
    histogram = np.zeros(65)
    np.add.at(histogram, [10, 54, 20, 22, 22, 12, 42], [11, 8, 5, 5, 5, 3, 3])
    x = packing.non_negative_least_squares(combos, histogram)
    assert (x >= 0).all() and np.allclose(x, [8, 5, 3], atol=1e-2)
