"""Ids and texts of the agenda against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
from sentencepiece import SentencePieceProcessor

from tickloom.llm import pieces

from .conftest import SF, odd_rows

PATH = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = " ▁ab\n\t\0<>0x41éß中\U0001f600　́s ​﻿�Theinger"


def test_random_texts_and_ids():
    own, library = pieces.vocabulary(PATH), SentencePieceProcessor(model_file=PATH)
    pick = random.Random(1)
    for _ in range(5000):
        text = "".join(pick.choice(LETTERS) for _ in range(pick.randrange(40)))
        ids = own.encode(text)
        assert ids == library.encode(text), text
        assert own.decode(ids) == library.decode(ids), text
    few = [0, 1, 2, 259, 28705, 264]
    for _ in range(5000):
        ids = [pick.choice([*few, pick.randrange(3, 259), pick.randrange(32_000)]) for _ in range(pick.randrange(9))]
        assert own.decode(ids) == library.decode(ids), ids


def test_best_score_first_then_the_left():
    """Steps in common and the heap of one cut join the same pairs."""
    own, pick = pieces.vocabulary(PATH), random.Random(3)
    # All joins of space marks have the same score.
    cuts = ["▁aaaaa", "▁" * 37] + ["▁s" + "".join(pick.choice("theainrß中") for _ in range(pick.randrange(20))) for _ in range(300)]
    for cut, symbols in zip(cuts, own.together(cuts)):
        assert symbols.tolist() == own.alone(cut).tolist()
        if "中" not in cut:
            assert symbols.tolist() == own.library.encode(cut[1:].replace("▁", " "))


def test_long_text_without_a_cut():
    own = pieces.vocabulary(PATH)
    text = "".join(random.Random(2).choice("abcdeé中") for _ in range(200_000))
    assert own.encode(text) == own.library.encode(text)


def test_a_differing_cut_is_told(monkeypatch):
    own = pieces.Pieces(PATH)
    real = own.together
    monkeypatch.setattr(own, "together", lambda cuts: [r[:-1] if c == "▁wrong" else r for c, r in zip(cuts, real(cuts))])
    texts = ["all right", "one wrong word", "right", "wrong"]
    assert [same for _, same in own.checked(texts)] == [True, False, True, False]


def test_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "KNOWN", 3)
    monkeypatch.setattr(pieces, "SHORT", 4)
    own = pieces.Pieces(PATH)
    for _, text, *_ in odd_rows():
        assert own.encode(text) == own.library.encode(text or "")
    assert max(map(len, own.known)) <= 4


def test_query(spark, documents, queries):
    library = SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: tuple(r)[1:] for r in queries["op11_piece_ids"](spark, SF).collect()}
    for r in documents.collect():
        ids = library.encode(r.text)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        assert got[r.doc_id] == (len(ids), *digests, True)


def test_odd_rows(odd, nothing):
    got = pieces.encoded(odd, PATH).collect()
    assert len(got) == len(odd_rows()) and all(r.agrees for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[4].ids == by_id[5].ids == [] and by_id[4].decoded == ""
    texts = {r[0]: r[1] or "" for r in odd_rows()}
    assert all(r.decoded == texts[r.doc_id] for r in got)
    assert pieces.encoded(nothing, PATH).collect() == []
