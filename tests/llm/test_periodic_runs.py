"""Runs of the grammar against all periods tried one by one."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import periodic_runs as R
from tickloom.llm.queries import planted

from .conftest import SF, odd_rows


def plain_runs(words):
    """Every period from 1 on; a stretch that a smaller period's run explains is none."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            lo, hi = i, j + q
            smaller = any(q % p == 0 and a <= lo and hi <= b for a, b, p in out)
            if hi - lo >= max(6, 4 * q) and not smaller:
                out.append((lo, hi, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


repeats = st.lists(
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 9)), max_size=5
).map(lambda parts: [w for base, times in parts for w in base * times])


@settings(max_examples=1500, deadline=None)
@given(repeats, st.integers(1, 4))
def test_runs_of_repetitive_sequences(words, times):
    assert R.runs_of(words * times) == plain_runs(words * times)


@pytest.mark.parametrize("letters", [1, 2, 3, 30])
def test_runs_of_random_sequences(letters):
    pick = random.Random(letters)
    for _ in range(60):
        words = [pick.randrange(letters) for _ in range(pick.randrange(300))]
        assert R.runs_of(words) == plain_runs(words)


def test_a_run_across_another_period():
    """The left half looks like a shorter period's run, the right half is a square of its own."""
    words = list("aaaaaaaabc") + list("aabc") * 4 + list("bcbcbcbcb")
    assert R.runs_of(words) == plain_runs(words)
    assert len(R.runs_of(words)) == 3


def test_grammar_expands_to_its_sequence():
    import numpy as np

    pick = random.Random(4)
    words = [pick.randrange(3) for _ in range(500)] + [0] * 100
    ids, base = np.array(words, "<i4"), 2 * (len(words) + 1)
    grammar = R.Grammar(ids, base, R.places(ids.astype("int64"), base))

    def expand(s):
        return [s] if s < grammar.first else [w for c in grammar.rules[s - grammar.first] for w in expand(c)]

    left = [grammar.symbol[p] for p in grammar.axiom()]
    assert [w for s in left for w in expand(s)] == words
    pairs = list(zip(left, left[1:]))
    apart = {p: [i for i, x in enumerate(pairs) if x == p] for p in pairs}
    assert all(len(at) == 1 or (len(at) == 2 and at[1] == at[0] + 1) for at in apart.values())
    for k, place in enumerate(grammar.place):
        expansion = expand(grammar.first + k)
        assert words[place : place + len(expansion)] == expansion


def test_long_sequences_take_no_quadratic_time():
    assert R.runs_of([0] * 300_000) == [(0, 300_000, 1)]
    assert R.runs_of([0, 1, 2] * 100_000) == [(0, 300_000, 3)]
    pick = random.Random(7)
    block = [pick.randrange(500) for _ in range(20_000)]
    assert R.runs_of(block * 5 + [1000])[-1] == (0, 100_000, 20_000)


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    lines = "".join(f"{lo},{hi - lo},{q}\n" for lo, hi, q in runs)
    dropped = {i for lo, hi, q in runs for i in range(lo + q, hi)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    top = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2])) if runs else None
    longest = (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4
    return (len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query(spark, documents, queries):
    got = {r.doc_id: tuple(r)[1:] for r in queries["op13_periodic_runs"](spark, SF).collect()}
    assert got == {r.doc_id: expected(r.doc_id, r.text) for r in documents.collect()}
    assert sum(r[0] for r in got.values()) > 10


def test_odd_rows(odd, nothing):
    got = R.with_runs(odd.where("coalesce(doc_id, 0) <> 8"), planted).collect()
    assert len(got) == len(odd_rows()) - 1
    texts = {r[0]: r[1] for r in odd_rows()}
    for r in got:
        want = expected(r.doc_id, texts[r.doc_id])
        assert len(r.runs) == want[0] and hashlib.sha256(r.collapsed.encode()).hexdigest() == want[-1]
        assert (r.longest is None) == (want[0] == 0)
    assert R.with_runs(odd, planted).count() == len(odd_rows())
    assert R.with_runs(nothing).collect() == []
