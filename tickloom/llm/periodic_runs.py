"""Runs: stretches of words that repeat with a period at least four times, by a grammar.

The word ids of a text are compressed by pair replacement (Re-Pair): the most frequent pair of
neighbours becomes a nonterminal until no pair occurs twice. What is left, the axiom, is cut in
halves over and over, so it is a tree of boundaries as well. A run lies inside exactly one
lowest nonterminal (or part of the axiom) and crosses its boundary, where its two sides meet.

Runs over a boundary are looked for once per nonterminal, within its expansion. Such a run
contains the pair of words at the boundary at three places or more, a period apart; so only the
distances to other places of this pair can be periods, and a pair with fewer places has none. A
distance is a period if a square of that period ends or begins at the boundary; how far it
reaches to both sides is found by comparing stretches of doubling length, then by halving. Each
nonterminal's runs are its children's, moved to their places, and those over its boundary;
intervals of one period that share a period's length are merged. The axiom's runs put together
in the same way are the text's.

* Words are the stretches between U+0020 and U+0009 to U+000D. A null text has none. A text
  without a word, or with fewer than six, has no runs and is its own collapsed text.
* Texts of any length are taken whole; one worker holds one text's ids and grammar at a time.
* Of equally long runs the longest is the one with the smallest start, then period. Repeated
  rows and null ids are rows like any other; an empty table gives an empty one. Columns other
  than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import each

# A run has at least so many words, and its period at least so many times.
LEAST_WORDS = 6
LEAST_TIMES = 4
SLICE = 512

# start, end (the word after it), period
Run = tuple[int, int, int]


def places(ids: np.ndarray, base: int) -> dict[int, list[int]]:
    """Where each pair of neighbours that occurs more than once begins, by first * base + second."""
    pairs = ids[:-1] * base + ids[1:]
    order = np.argsort(pairs, kind="stable")
    ordered = pairs[order]
    edges = np.flatnonzero(np.diff(ordered, prepend=-1, append=-1))
    many = np.flatnonzero(np.diff(edges) > 1)
    return {
        int(ordered[a]): order[a:b].tolist()
        for a, b in zip(edges[many].tolist(), edges[many + 1].tolist())
    }


class Grammar:
    """Pair replacement over one sequence. A symbol is known by the place of its first word."""

    def __init__(self, ids: np.ndarray, base: int, pairs: dict[int, list[int]]) -> None:
        n = len(ids)
        self.symbol = symbol = ids.tolist()
        self.after = after = list(range(1, n + 1))
        self.before = before = list(range(-1, n - 1))
        # Of each nonterminal: its two symbols, words, and a place where it stands.
        self.rules: list[tuple[int, int]] = []
        self.length: dict[int, int] = {}
        self.place: list[int] = []
        self.first = first = base // 2
        pairs = dict(pairs)
        agenda = [(-len(at), pair) for pair, at in pairs.items()]
        heapify(agenda)
        while agenda:
            count, pair = heappop(agenda)
            at = pairs.pop(pair, None)
            if at is None:
                continue
            left, right = divmod(pair, base)
            # Where the pair still stands, and of overlapping places the left ones.
            stands = [p for p in at if symbol[p] == left and after[p] < n and symbol[after[p]] == right]
            valid, taken = [], -1
            for p in stands:
                if p != taken:
                    valid.append(p)
                    taken = after[p]
            if len(valid) < 2:
                continue
            if len(valid) < -count:  # fewer than thought: wait for the turn of that many
                pairs[pair] = stands
                heappush(agenda, (-len(valid), pair))
                continue
            new = first + len(self.rules)
            self.rules.append((left, right))
            self.place.append(valid[0])
            self.length[new] = self.words(left) + self.words(right)
            met: dict[int, list[int]] = {}
            for p in valid:
                q = after[p]
                following = after[q]
                symbol[p], symbol[q] = new, -1
                after[p] = following
                if following < n:
                    before[following] = p
                    met.setdefault(new * base + symbol[following], []).append(p)
                preceding = before[p]
                # Where the neighbour is this nonterminal too, it has noted the pair above as it was.
                if preceding >= 0:
                    met.setdefault(symbol[preceding] * base + new, []).append(preceding)
            for pair, at in met.items():
                if len(at) > 1:
                    pairs[pair] = sorted(set(at))
                    heappush(agenda, (-len(pairs[pair]), pair))

    def words(self, symbol: int) -> int:
        return self.length.get(symbol, 1)

    def axiom(self) -> list[int]:
        """The places of the symbols left."""
        out, p, n = [], 0, len(self.symbol)
        while p < n:
            out.append(p)
            p = self.after[p]
        return out


def _common(raw: bytes, a: int, b: int, limit: int, back: bool) -> int:
    """How many words agree from two places on (or before them), at most ``limit``."""

    def same(lo: int, hi: int) -> bool:
        if back:
            return raw[4 * (a - hi) : 4 * (a - lo)] == raw[4 * (b - hi) : 4 * (b - lo)]
        return raw[4 * (a + lo) : 4 * (a + hi)] == raw[4 * (b + lo) : 4 * (b + hi)]

    done, step = 0, 1
    while done < limit and same(done, min(done + step, limit)):
        done, step = min(done + step, limit), 2 * step
    most = min(done + step, limit) - 1  # what lies beyond does not agree
    while done < most:
        middle = (done + most + 1) // 2
        if same(done, middle):
            done = middle
        else:
            most = middle - 1
    return done


def crossing(raw: bytes, at: list[int], start: int, edge: int, end: int) -> list[Run]:
    """Runs of the words from ``start`` to ``end`` that hold both sides of ``edge``.

    ``at``: the places of the pair of words around ``edge``.
    """
    low, high = bisect_left(at, start), bisect_left(at, end - 1)
    if high - low < 3:
        return []
    here, most = edge - 1, (end - start) // LEAST_TIMES
    distances = {abs(p - here) for p in at[low:high]}
    found: list[Run] = []
    for q in sorted(q for q in distances if 0 < q <= most):
        # Half of a run's four periods lie on one side, where they make a square.
        for middle in (edge - q, edge + q):
            a, b = middle - q, middle + q
            if a < start or b > end:
                continue
            if any(q % p == 0 and lo <= a and b <= hi for lo, hi, p in found):
                continue  # a run known already, of this period or a part of it
            if raw[4 * a : 4 * middle] != raw[4 * middle : 4 * b]:
                continue
            lo = a - _common(raw, a, middle, a - start, True)
            hi = b + _common(raw, middle, b, end - b, False)
            if lo < edge < hi and hi - lo >= max(LEAST_WORDS, LEAST_TIMES * q):
                found.append((lo, hi, q))
    return found


def merged(runs: list[Run]) -> list[Run]:
    """Intervals of one period that share a period's length put together."""
    out: list[Run] = []
    for lo, hi, q in sorted(runs, key=lambda r: (r[2], r[0])):
        if out and out[-1][2] == q and lo <= out[-1][1] - q:
            out[-1] = (out[-1][0], max(out[-1][1], hi), q)
        else:
            out.append((lo, hi, q))
    return out


def runs_of(words: list) -> list[Run]:
    """All runs of a sequence of hashable words, by start, then period."""
    n = len(words)
    if n < LEAST_WORDS:
        return []
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), "<i4", n)
    raw, wide, base = ids.tobytes(), ids.astype(np.int64), 2 * (n + 1)
    pairs = places(wide, base)
    grammar = Grammar(ids, base, pairs)
    codes = wide[:-1] * base + wide[1:]

    inside: dict[int, list[Run]] = {}
    for k, (left, right) in enumerate(grammar.rules):
        symbol, start = grammar.first + k, grammar.place[k]
        size, edge = grammar.length[symbol], start + grammar.words(left)
        if size < LEAST_WORDS:
            continue
        over = crossing(raw, pairs[int(codes[edge - 1])], start, edge, start + size)
        shift = grammar.words(left)
        runs = [(lo - start, hi - start, q) for lo, hi, q in over]
        runs += inside.get(left, [])
        runs += [(lo + shift, hi + shift, q) for lo, hi, q in inside.get(right, [])]
        if runs:
            inside[symbol] = merged(runs)

    cuts = grammar.axiom()
    runs = [
        (lo + p, hi + p, q)
        for p in cuts
        if grammar.symbol[p] in inside
        for lo, hi, q in inside[grammar.symbol[p]]
    ]
    for k, code in enumerate(codes[np.array(cuts[1:], np.int64) - 1].tolist(), 1):
        at = pairs.get(code, ())
        if len(at) > 2:
            # The part of the axiom whose halves meet at this cut.
            lo, hi = 0, len(cuts)
            while (middle := (lo + hi) // 2) != k:
                lo, hi = (lo, middle) if k < middle else (middle, hi)
            runs += crossing(raw, at, cuts[lo], cuts[k], cuts[hi] if hi < len(cuts) else n)
    return sorted(merged(runs), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run contains after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    keep, at = [], 0
    for lo, hi in sorted((lo + q, hi) for lo, hi, q in runs):
        keep += words[at:lo]
        at = max(at, hi)
    return b" ".join(keep + words[at:])


ROW = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def with_runs(
    docs: DataFrame, edit: Callable[[object, list[bytes]], list[bytes]] = lambda _, words: words
) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period), the longest, and the collapsed text.

    ``edit`` may change the words of a document (given its doc_id) before they are looked at.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found, rests = [], []
                for doc, text in zip(each(part.column("doc_id")), each(part.column("text"))):
                    words = edit(doc, (text or "").encode().split())
                    runs = runs_of(words)
                    found.append([{"start": lo, "length": hi - lo, "period": q} for lo, hi, q in runs])
                    rests.append(collapsed(words, runs).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found, pa.list_(ROW)), pa.array(rests, pa.string())],
                    ["doc_id", "runs", "collapsed"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    row = "struct<start:long,length:long,period:long>"
    rows = docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, runs array<{row}>, collapsed string")
    by_size = F.transform(
        "runs",
        lambda r: F.struct(
            r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less")
        ),
    )
    best = F.array_max(by_size)
    return rows.withColumn(
        "longest",
        F.when(
            F.size("runs") > 0,
            F.struct((-best["back"]).alias("start"), best["length"].alias("length"), (-best["less"]).alias("period")),
        ),
    )
