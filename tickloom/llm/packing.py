"""Packing token ids into windows by non-negative least squares over length combinations.

A document's full windows stand alone; its rest has a length below the window. The histogram
of rests (at most one count per length) goes to the driver. Combinations of up to three
lengths that fill a window exactly are enumerated: all pairs, and triples with two of the
``COMMON`` lengths that hold most tokens. Non-negative least squares gives how often to use
each, the numbers are rounded down to what is there, and documents take the slots of their
length by rank. What no combination takes is packed greedily: laid end to end and cut at
window ends. So only the very last sequence has padding, and only residual or over-long
documents are cut.

* A null text is empty and has one token, the end of document. Repeated rows are packed
  separately. An empty table gives no pieces.
* Ids are unsigned 16-bit inside, 32-bit in the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import buckets_for, each, hash_bucket, running_before
from tickloom.llm.tokens import END, word_encoder
from tickloom.session import checkpointed

WINDOW = 4096
COMMON = 128
ITERATIONS = 400

_END = np.array([END], dtype="<u2").tobytes()


def combinations(lengths: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths that sum to the window; 0 stands for no piece."""
    have = np.zeros(window + 1, dtype=bool)
    have[lengths] = True
    low = lengths[(2 * lengths <= window)]
    low = low[have[window - low]]
    pairs = np.column_stack([low, window - low, np.zeros_like(low)])
    top = lengths[np.argsort(-(lengths * counts), kind="stable")][:COMMON]
    a, b = np.meshgrid(top, top, indexing="ij")
    a, b = a[a <= b], b[a <= b]
    c = window - a - b
    ok = c > 0
    a, b, c = a[ok], b[ok], c[ok]
    ok = have[c]
    triples = np.sort(np.column_stack([a[ok], b[ok], c[ok]]), axis=1)
    return np.unique(np.concatenate([pairs, triples]), axis=0)


def non_negative_least_squares(combos: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """x >= 0 that brings the lengths used by x closest to the histogram.

    Accelerated projected gradient; a combination's column has one entry per piece.
    """
    used = combos > 0
    size = len(histogram)

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(combos[used], weights=np.repeat(x, 3).reshape(-1, 3)[used], minlength=size)

    def backward(y: np.ndarray) -> np.ndarray:
        return np.where(used, y[combos], 0.0).sum(axis=1)

    v = np.ones(len(combos))
    for _ in range(20):
        v = backward(forward(v))
        v /= max(np.linalg.norm(v), 1e-12)
    bound = 1.05 * np.linalg.norm(backward(forward(v))) + 1e-9
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(ITERATIONS):
        ahead = np.maximum(y - backward(forward(y) - histogram) / bound, 0.0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = ahead + (t - 1) / t_next * (ahead - x)
        x, t = ahead, t_next
    return x


def plan(lengths: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Slots as rows (length, first rank, first sequence, offset, repeats), by length and rank."""
    histogram = np.zeros(window + 1)
    histogram[lengths] = counts
    combos = combinations(lengths, counts, window)
    slots, sequence = [], 0
    if len(combos):
        repeats = non_negative_least_squares(combos, histogram)
        left = histogram.astype(np.int64)
        taken = np.zeros(window + 1, dtype=np.int64)
        # The rounded numbers first, then once more over what is left.
        for wanted in (np.floor(repeats + 1e-6), np.full(len(combos), np.inf)):
            for i in np.argsort(-repeats, kind="stable"):
                pieces = [int(p) for p in combos[i] if p]
                need = {p: pieces.count(p) for p in pieces}
                n = int(min(wanted[i], min(left[p] // k for p, k in need.items())))
                if n <= 0:
                    continue
                offset = 0
                for p in pieces:
                    slots.append((p, int(taken[p]), sequence, offset, n))
                    taken[p] += n
                    left[p] -= n
                    offset += p
                sequence += n
    out = np.array(slots, dtype=np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def assign(slots: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and offset of rests by length and rank; sequence -1 where no slot is left."""
    if not len(slots):
        return np.full(len(length), -1), np.zeros(len(length), dtype=np.int64)
    # Slots of a length follow each other by rank, so (length, rank) finds the slot.
    scale = int(max(rank.max(initial=0), (slots[:, 1] + slots[:, 4]).max())) + 1
    at = np.searchsorted(slots[:, 0] * scale + slots[:, 1], length * scale + rank, side="right") - 1
    slot = slots[np.maximum(at, 0)]
    within = rank - slot[:, 1]
    found = (at >= 0) & (slot[:, 0] == length) & (within < slot[:, 4])
    return np.where(found, slot[:, 2] + within, -1), np.where(found, slot[:, 3], 0)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """uid, doc_id, ids (16-bit, end of document last) and n of every row, written once."""

    @F.arrow_udf(T.BinaryType())
    def encode(texts: pa.Array) -> pa.Array:
        ids = word_encoder(path).encode
        return pa.array([ids(t) + _END for t in each(texts)], pa.binary())

    rows = docs.select("doc_id", encode("text").alias("ids"))
    return checkpointed(rows.select(F.monotonically_increasing_id().alias("uid"), "*")).withColumn(
        "n", (F.octet_length("ids") / 2).cast("long")
    )


def _placed(slots: np.ndarray):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("rest", "rank"))
            sequence, offset = assign(slots, length, rank)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("uid", "place", "windows", "rest")]
                + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64()), pa.array(np.where(sequence < 0, length, 0), pa.int64())],
                ["uid", "place", "windows", "rest", "sequence", "offset", "residual"],
            )

    return apply


def spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """uid and its pieces (start, length, sequence_id, offset), from rows of (uid, doc_id, n)."""
    place = F.xxhash64("doc_id", "uid")
    buckets = buckets_for(docs.count())
    w = F.lit(window).cast("long")
    rows = docs.select(
        "uid", place.alias("place"), F.floor(F.col("n") / w).alias("windows"), (F.col("n") % w).alias("rest")
    ).withColumns({"bucket": hash_bucket(F.col("place"), buckets), "one": F.lit(1).cast("long")})
    histogram = rows.where("rest > 0").groupBy("rest").agg(F.count(F.lit(1)).alias("c")).toPandas()
    histogram = histogram.sort_values("rest")
    slots = plan(histogram["rest"].to_numpy(np.int64), histogram["c"].to_numpy(np.int64), window)
    combined = int((slots[:, 2] + slots[:, 4]).max()) if len(slots) else 0

    ranked = running_before(rows, ["rest"], "bucket", ["place", "uid"], {"one": "rank"})
    schema = "uid long, place long, windows long, rest long, sequence long, offset long, residual long"
    placed = checkpointed(ranked.select("uid", "place", "windows", "rest", "rank").mapInArrow(_placed(slots), schema))
    placed = placed.withColumn("bucket", hash_bucket(F.col("place"), buckets))
    full = placed.agg(F.coalesce(F.sum("windows"), F.lit(0)).alias("n")).first().n
    laid = running_before(
        placed, [], "bucket", ["place", "uid"], {"windows": "windows_before", "residual": "tokens_before"}
    )

    def piece(start, length, sequence, offset):
        return F.struct(
            start.cast("long").alias("start"), length.cast("long").alias("length"),
            sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"),
        )

    zero = F.lit(0)
    whole = F.transform(
        F.sequence(zero, F.greatest(F.col("windows") - 1, zero)),
        lambda i: piece(i * w, w, combined + F.col("windows_before") + i, zero),
    )
    whole = F.when(F.col("windows") > 0, whole)
    head = F.col("windows") * w
    slotted = F.when(F.col("sequence") >= 0, F.array(piece(head, F.col("rest"), F.col("sequence"), F.col("offset"))))
    first = F.floor(F.col("tokens_before") / w)
    at = F.col("tokens_before") % w
    fits = F.least(F.col("residual"), w - at)
    base = combined + full
    tail = F.filter(
        F.array(
            piece(head, fits, base + first, at),
            piece(head + fits, F.col("residual") - fits, base + first + 1, zero),
        ),
        lambda p: p.length > 0,
    )
    none = F.filter(F.array(piece(zero, zero, zero, zero)), lambda p: p.length > 0)
    pieces = F.concat(*[F.coalesce(x, none) for x in (whole, slotted, tail)])
    return laid.select("uid", pieces.alias("pieces"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {c: [] for c in ("row", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
        lists = batch.column("pieces").to_pylist()
        for row, (ids, pieces) in enumerate(zip(batch.column("ids"), lists)):
            numbers = np.frombuffer(ids.as_buffer(), dtype="<u2")
            for p in pieces:
                part = numbers[p["start"] : p["start"] + p["length"]]
                out["row"].append(row)
                out["ids"].append(part.astype("<u4").tobytes())
                out["doc_tokens"].append(len(numbers))
                for c in ("start", "length", "sequence_id", "offset"):
                    out[c].append(p[c])
        doc_id = batch.column("doc_id").take(pa.array(out.pop("row"), pa.int32()))
        kinds = {"ids": pa.binary()}
        arrays = [pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()]
        yield pa.RecordBatch.from_arrays([doc_id, *arrays], ["doc_id", *out])


def packed(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """The pieces of all sequences.

    doc_id, start and length in the document's ids, the ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id and offset in the sequence. Sequences are gapless from offset 0.
    """
    rows = encoded(docs, path)
    cut = rows.select("uid", "doc_id", "ids").join(spans(rows, window), "uid")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return cut.select("doc_id", "ids", "pieces").mapInArrow(_cut, schema)
