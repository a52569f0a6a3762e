"""Context-mixing range coder for ids up to 65,534, many independent blocks in step.

Each block starts from fresh models, so it can be read alone. For the next id there are

* an order-2 prediction: the id that last followed these two ids in the block,
* an order-1 prediction: the id that last followed this one,
* order-0 predictions: how often each magnitude (bit length) occurred, and how often each of
  the four bits below the leading one did with that magnitude.

What is coded is a hit of order 2, a hit of order 1, or the id's magnitude, its next four bits
and the bits left. The odds of the first choice mix two adaptive counts: those at the same
confidence of both predictions, and those of the block as a whole. Odds are brought up to date
every ``FRESH`` ids. The range is kept between 2^48 and 2^64 and gives off 16-bit words; an id
takes 34 bits of it at most. Carries run back into words already written.

numpy advances all blocks of a frame by one id at a time. Models belong to one block each.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096
_MAGIC = b"TKR1"
_HEAD = struct.Struct("<4sIII")

_EVENTS = 18  # hit of order 2, hit of order 1, magnitudes 0 to 15
_DETAILS = 16  # the four bits below the leading one
_GAIN = 24
_LIMIT = 1 << 11
FRESH = 128
_TOP = np.uint64(1 << 48)
_FULL = (1 << 64) - 1
_W = np.uint64(16)
_LAST = np.uint64(48)
_SLOTS = 2048
_LEVELS = 4

MAX_ID = 65_534
# Magnitude of each id: the bit length of id + 1, less one.
_MAGNITUDE = np.floor(np.log2(np.arange(1, MAX_ID + 2))).astype(np.int64)


class Odds:
    """Adaptive counts of ``rows`` contexts and their cumulative odds, each context's together."""

    def __init__(self, rows: int, symbols: int) -> None:
        self.n = symbols
        # Steps of a binary search over the symbols, and rows wide enough for it.
        self.steps = [1 << i for i in reversed(range((symbols - 1).bit_length()))]
        self.width = max(symbols + 1, sum(self.steps) + 1)
        self.counts = np.ones((rows, symbols), dtype=np.int32)
        self.cum = np.full((rows, self.width), 1 << 40, dtype=np.int64)
        self.cum[:, 0] = 0
        self.flat_counts, self.flat = self.counts.reshape(-1), self.cum.reshape(-1)

    def refresh(self, mixed: np.ndarray | None = None) -> None:
        """Bring the odds up to date; ``mixed`` holds other counts to add to each row's."""
        full = self.counts.sum(axis=1) > _LIMIT
        if full.any():
            self.counts[full] = (self.counts[full] + 1) >> 1
        counts = self.counts if mixed is None else self.counts + mixed
        np.cumsum(counts, axis=1, out=self.cum[:, 1 : self.n + 1])

    def span(self, row: np.ndarray, symbol: np.ndarray, span: np.ndarray):
        """The unit of each range, and where in units the symbols start and how many they have."""
        at = row * self.width
        unit = span // self.flat.take(at + self.n).view(np.uint64)
        at += symbol
        start = self.flat.take(at)
        size = self.flat.take(at + 1) - start
        return unit, start.view(np.uint64), size.view(np.uint64)

    def find(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The places, in rows that begin ``at``, of the symbols whose odds hold each value."""
        for step in self.steps:
            at = at + step * (self.flat.take(at + step) <= value)
        return at


class Model:
    """Adaptive state of ``lanes`` blocks. All arrays are flat, a lane's entries together."""

    def __init__(self, lanes: int) -> None:
        self.lanes = lanes
        self.slot_base = np.arange(lanes) * _SLOTS
        self.event_base = np.arange(lanes) * (_LEVELS * _LEVELS)
        self.detail_base = np.arange(lanes) * 16
        self.prev1 = np.zeros(lanes, dtype=np.int64)
        self.prev2 = np.zeros(lanes, dtype=np.int64)
        # The id and, in the two bits above it, how often in a row it was right.
        self.guess2 = np.zeros(lanes * _SLOTS, dtype=np.int32)
        self.guess1 = np.zeros(lanes * _SLOTS, dtype=np.int32)
        self.events = Odds(lanes * _LEVELS * _LEVELS, _EVENTS)
        self.whole = np.ones((lanes, _EVENTS), dtype=np.int32)
        self.flat_whole = self.whole.reshape(-1)
        self.whole_base = np.arange(lanes) * _EVENTS
        self.details = Odds(lanes * 16, _DETAILS)
        self.refresh()

    def refresh(self) -> None:
        full = self.whole.sum(axis=1) > _LIMIT
        if full.any():
            self.whole[full] = (self.whole[full] + 1) >> 1
        self.events.refresh(np.repeat(self.whole, _LEVELS * _LEVELS, axis=0))
        self.details.refresh()

    def predict(self, k: int) -> None:
        """Predictions of the first ``k`` lanes, and which odds hold."""
        p1, p2 = self.prev1[:k], self.prev2[:k]
        self.at2 = (((p1 * 40503) ^ (p2 * 30011)) >> 3 & (_SLOTS - 1)) + self.slot_base[:k]
        self.at1 = ((p1 ^ (p1 >> 6) * 13) & (_SLOTS - 1)) + self.slot_base[:k]
        self.g2, self.g1 = self.guess2.take(self.at2), self.guess1.take(self.at1)
        self.p2, self.p1 = self.g2 & 0xFFFF, self.g1 & 0xFFFF
        self.row = (self.g2 >> 16) * _LEVELS + (self.g1 >> 16) + self.event_base[:k]

    def update(self, k: int, ids: np.ndarray, event: np.ndarray) -> None:
        for table, at, g, p in (
            (self.guess2, self.at2, self.g2, self.p2), (self.guess1, self.at1, self.g1, self.p1)
        ):
            table[at] = np.where(ids == p, np.minimum(g + 65536, p + 3 * 65536), ids)
        self.events.flat_counts[self.row * _EVENTS + event] += _GAIN
        self.flat_whole[self.whole_base[:k] + event] += _GAIN // 4
        self.prev2[:k] = self.prev1[:k]
        self.prev1[:k] = ids

    def learn_detail(self, row: np.ndarray, detail: np.ndarray) -> None:
        """Count the details of literal ids."""
        self.details.flat_counts[row * _DETAILS + detail] += _GAIN


def _steps(n: int) -> list[tuple[int, int, int]]:
    """(first, last, active blocks): the last block may be shorter."""
    whole, rest = divmod(n, BLOCK)
    out = [(0, rest, whole + 1)] if rest else []
    return out + ([(rest, BLOCK, whole)] if whole else [])


def encode(ids: np.ndarray) -> bytes:
    """A frame: magic, counts, each block's words and checksum, then all words."""
    n = len(ids)
    if n and int(ids.max()) > MAX_ID:
        raise ValueError(f"ids above {MAX_ID} cannot be coded")
    lanes = -(-n // BLOCK)
    grid = np.zeros(lanes * BLOCK, dtype=np.int64)
    grid[:n] = ids
    columns = np.ascontiguousarray(grid.reshape(lanes, BLOCK).T)
    model = Model(lanes)
    low, span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, _FULL, dtype=np.uint64)
    # At most 34 bits an id.
    words = np.zeros((lanes, 3 * BLOCK + 8), dtype=np.uint16)
    used = np.zeros(lanes, dtype=np.int64)

    def settle(k: int, add: np.ndarray) -> None:
        """Raise the low end, run carries back and give off words where the range is small."""
        low[:k] += add
        carried = np.flatnonzero(low[:k] < add)
        at = used[carried] - 1
        while len(carried):
            words[carried, at] += np.uint16(1)
            again = words[carried, at] == 0
            carried, at = carried[again], at[again] - 1
        small = np.flatnonzero(span[:k] < _TOP)
        while len(small):
            value = low[small]
            words[small, used[small]] = value >> _LAST
            used[small] += 1
            low[small] = value << _W
            wide = span[small] << _W
            span[small] = wide
            small = small[wide < _TOP]

    for first, last, k in _steps(n):
        for t in range(first, last):
            now = columns[t, :k]
            model.predict(k)
            magnitude = _MAGNITUDE.take(now)
            event = np.where(now == model.p2, 0, np.where(now == model.p1, 1, magnitude + 2))
            unit, start, size = model.events.span(model.row, event, span[:k])
            add, inner = unit * start, unit * size
            lane = np.flatnonzero(event > 1)
            m = magnitude[lane]
            rest, left = now[lane] + 1 - (1 << m), np.maximum(m - 4, 0)
            part = inner[lane] >> left.view(np.uint64)
            row, detail = model.detail_base[lane] + m, rest >> left
            unit, start, size = model.details.span(row, detail, part)
            add[lane] += (rest - (detail << left)).view(np.uint64) * part + unit * start
            inner[lane] = unit * size
            span[:k] = inner
            settle(k, add)
            model.learn_detail(row, detail)
            model.update(k, now, event)
            if t % FRESH == FRESH - 1:
                model.refresh()
    for _ in range(4):
        words[np.arange(lanes), used] = low >> _LAST
        used += 1
        low <<= _W
    raw = ids.astype("<u2")
    sums = [zlib.crc32(raw[i * BLOCK : (i + 1) * BLOCK].tobytes()) for i in range(lanes)]
    head = np.column_stack([used, sums]).astype("<u4").tobytes() if lanes else b""
    body = b"".join(words[i, : used[i]].astype("<u2").tobytes() for i in range(lanes))
    return _HEAD.pack(_MAGIC, n, lanes, BLOCK) + head + body


def decode(frame: bytes) -> np.ndarray:
    """The ids of a frame; ValueError where a block's checksum is wrong."""
    magic, n, lanes, block = _HEAD.unpack_from(frame)
    if magic != _MAGIC or block != BLOCK or lanes != -(-n // BLOCK):
        raise ValueError("not a frame of token ids")
    head = np.frombuffer(frame, "<u4", 2 * lanes, _HEAD.size).reshape(lanes, 2)
    body = np.frombuffer(frame, "<u2", offset=_HEAD.size + 8 * lanes)
    ends = np.cumsum(head[:, 0].astype(np.int64))
    if lanes and (int(ends[-1]) != len(body) or int(head[:, 0].min()) < 4):
        raise ValueError("a frame of token ids is cut short")
    # Words past a block's end are never needed; they only keep indexes in range.
    body = np.concatenate([body, np.zeros(4, "<u2")]).astype(np.uint64)
    at = ends - head[:, 0]
    model = Model(lanes)
    span = np.full(lanes, _FULL, dtype=np.uint64)
    code = np.zeros(lanes, dtype=np.uint64)
    for _ in range(4):
        code = (code << _W) | body[at]
        at += 1
    columns = np.zeros((BLOCK, lanes), dtype=np.int64)

    def narrow(odds: Odds, row: np.ndarray, code: np.ndarray, span: np.ndarray):
        """The symbol, and the code and range within it."""
        first = row * odds.width
        total = odds.flat.take(first + odds.n)
        unit = span // total.view(np.uint64)
        at = odds.find(first, np.minimum((code // unit).view(np.int64), total - 1))
        start = odds.flat.take(at)
        size = odds.flat.take(at + 1) - start
        return at - first, code - unit * start.view(np.uint64), unit * size.view(np.uint64)

    for first, last, k in _steps(n):
        for t in range(first, last):
            model.predict(k)
            event, rest, inner = narrow(model.events, model.row, code[:k], span[:k])
            now = np.where(event == 0, model.p2, model.p1)
            lane = np.flatnonzero(event > 1)
            m = event[lane] - 2
            row, left = model.detail_base[lane] + m, np.maximum(m - 4, 0)
            part, inside = inner[lane] >> left.view(np.uint64), rest[lane]
            tail = np.minimum((inside // part).view(np.int64), (1 << left) - 1)
            detail, rest[lane], inner[lane] = narrow(
                model.details, row, inside - tail.view(np.uint64) * part, part
            )
            now[lane] = (1 << m) - 1 + (detail << left) + tail
            columns[t, :k] = now
            small = np.flatnonzero(inner < _TOP)
            while len(small):
                rest[small] = (rest[small] << _W) | body.take(at[small], mode="clip")
                at[small] += 1
                wide = inner[small] << _W
                inner[small] = wide
                small = small[wide < _TOP]
            code[:k], span[:k] = rest, inner
            model.learn_detail(row, detail)
            model.update(k, now, event)
            if t % FRESH == FRESH - 1:
                model.refresh()
    ids = columns.T.reshape(-1)[:n].astype("<u2")
    for i in range(lanes):
        if zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].tobytes()) != int(head[i, 1]):
            raise ValueError(f"block {i} of a frame of token ids has a wrong checksum")
    return ids
