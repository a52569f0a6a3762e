"""Near-duplicates by 64-bit SimHash and the generalised pigeonhole principle.

Fingerprints within two bits of each other are linked. The 64 bits are put in three parts,
correlated bits together. If two fingerprints differ in at most 2 bits, then for any
thresholds t1 + t2 + t3 = 2 - 3 + 1 = 0 (each -1 or more; -1 skips a part) some part i
differs in at most t_i bits. So each fingerprint may choose its own thresholds, and a small
dynamic programme picks the ones with the fewest expected candidates:

* Where all its three buckets are small, (0, 0, 0): the buckets' members are compared.
* Where a bucket is large, unequal thresholds such as (-1, 1, 0): the large part is skipped
  and another is probed with each of its bits flipped as well.
* Where that would cost more than 65 rows too, the fingerprint is dense. Two dense ones
  within two bits share a point at most one bit from both, so each goes to its 65 points, and
  a point has at most 65 distinct fingerprints.

A pair with one dense fingerprint is found by the other, whose probes meet all fingerprints.
No bucket that is compared holds more than ``MAX_BUCKET`` members and none is cut.

* Null, empty and blank texts have fingerprint 0 and are linked like any other.
* Equal fingerprints are one node of the graph, however many rows have them. Repeated rows
  and equal texts thus share a component.
* component_id is the smallest doc_id of the component, null if all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from tickloom.llm.common import each
from tickloom.llm.components import components
from tickloom.session import checkpointed

DISTANCE = 2
WIDTHS = (21, 21, 22)
MAX_BUCKET = 64
SEED = 42
_STEP = 100_000

_hash = partial(xxh64_intdigest, seed=SEED)


def fingerprint(text: str | None) -> int:
    """The SimHash of a text's three-word shingles, as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = (
        map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [b" ".join(words)]
    )
    n = max(1, len(words) - 2)
    hashes = np.fromiter(map(_hash, shingles), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, _STEP):
        bits = np.unpackbits(hashes[i : i + _STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


@F.arrow_udf(T.LongType())
def fingerprints(texts: pa.Array) -> pa.Array:
    """The fingerprint of each text."""
    return pa.array([fingerprint(t) for t in each(texts)], pa.int64())


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def correlations(nodes: DataFrame) -> np.ndarray:
    """The 64 x 64 correlations of the bits of all distinct fingerprints (4096 sums)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((64, 64)), 0
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            both += bits.T.astype(np.float32) @ bits.astype(np.float32)
            n += len(fps)
        cells = np.append(both.ravel(), n).astype("int64")
        yield pa.RecordBatch.from_arrays([pa.array(range(4097), pa.int32()), pa.array(cells)], ["cell", "n"])

    sums = nodes.select("fp").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = np.zeros(4097)
    for row in sums.collect():
        cells[row.cell] = row.n
    total = max(cells[4096], 1.0)
    joint = cells[:4096].reshape(64, 64) / total
    mean = np.diag(joint)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return (joint - np.outer(mean, mean)) / np.outer(spread, spread)


def parts(corr: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> list[list[int]]:
    """Groups of bits: each starts from the closest pair left and takes the closest bit to it."""
    near = np.round(np.abs(corr), 6)
    np.fill_diagonal(near, -1.0)
    left, out = set(range(64)), []
    for width in widths:
        free = sorted(left)
        first = max(combinations(free, 2), key=lambda p: (near[p], -p[0], -p[1])) if len(free) > 1 else free
        group = list(first)
        while len(group) < width:
            group.append(max(left - set(group), key=lambda b: (near[b, group].mean(), -b)))
        out.append(sorted(group))
        left -= set(group)
    return out


def _key(fp: Column, part: int, bits: list[int]) -> Column:
    """The part's number and its bits, in one long."""
    value = F.lit(part << 32).cast("bigint")
    for k, b in enumerate(bits):
        bit = F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1).cast("bigint"))
        value = value.bitwiseOR(F.shiftleft(bit, k))
    return value


def allocate(sizes: np.ndarray, load: np.ndarray, widths=WIDTHS) -> np.ndarray:
    """Thresholds for rows of bucket sizes (n, 3), by dynamic programming over the parts.

    ``load`` is the expected size of another bucket of each part. A threshold costs its probes
    and expected candidates. Rows that would cost more than 65 get -9: they are dense.
    """
    n, m = sizes.shape
    goal = DISTANCE - m + 1
    cost = np.zeros((m, DISTANCE + 2, n))
    for i, w in enumerate(widths):
        cost[i, 1] = sizes[:, i]
        cost[i, 2] = cost[i, 1] + w * (1 + load[i])
        cost[i, 3] = cost[i, 2] + w * (w - 1) / 2 * (1 + load[i])
    low, high = -m, DISTANCE * m
    best = np.full((m + 1, high - low + 1, n), np.inf)
    choice = np.zeros((m, high - low + 1, n), dtype=np.int8)
    best[0, -low] = 0.0
    for i in range(m):
        for total in range(low, high + 1):
            for t in range(-1, DISTANCE + 1):
                if low <= total - t <= high:
                    c = best[i, total - t - low] + cost[i, t + 1]
                    better = c < best[i + 1, total - low]
                    best[i + 1, total - low][better] = c[better]
                    choice[i, total - low][better] = t
    out = np.empty((n, m), dtype=np.int64)
    at, rows = np.full(n, goal), np.arange(n)
    for i in reversed(range(m)):
        out[:, i] = choice[i, at - low, rows]
        at = at - out[:, i]
    out[best[m, goal - low] > 65] = -9
    return out


def _in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Close pairs within small buckets."""
    for batch in batches:
        a, b = [], []
        for members in batch.column("members").to_pylist():
            fps = np.array(members, dtype=np.int64)
            i, j = np.triu_indices(len(fps), 1)
            close = np.bitwise_count(np.bitwise_xor(fps[i], fps[j]).view(np.uint64)) <= DISTANCE
            a.append(fps[i[close]])
            b.append(fps[j[close]])
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"]
            )


def links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within two bits of each other."""
    groups = parts(correlations(nodes))
    fp = F.col("fp")
    own = F.array(*[_key(fp, i, bits) for i, bits in enumerate(groups)])
    keys = nodes.select("fp", F.explode(own).alias("key"))
    counts = checkpointed(
        keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    )
    sized = checkpointed(keys.join(counts, "key"))
    # The expected size of the bucket that a flipped bit leads to, per part.
    part = F.shiftright("key", 32).cast("int")
    squares = counts.groupBy(part.alias("part")).agg(F.sum(F.col("n") * F.col("n")).alias("n2"))
    load, total = np.zeros(len(groups)), max(nodes.count(), 1)
    for row in squares.collect():
        load[row["part"]] = row["n2"] / total

    cold = sized.where(F.col("n") <= MAX_BUCKET).groupBy("key")
    found = cold.agg(F.collect_list("fp").alias("members")).mapInArrow(_in_buckets, "a long, b long")

    # Fingerprints with a large bucket choose other thresholds.
    large = sized.where(F.col("n") > MAX_BUCKET).select("fp").distinct()
    by_part = [F.max(F.when(part == i, F.col("n"))).alias(f"n{i}") for i in range(len(groups))]
    sizes = sized.join(large, "fp", "left_semi").groupBy("fp").agg(*by_part)
    chosen = checkpointed(sizes.na.fill(1).mapInArrow(_allocator(load), "fp long, t array<int>"))
    probes = []
    for i, bits in enumerate(groups):
        key = _key(fp, i, bits)
        one = [F.lit(1 << k).cast("bigint") for k in range(len(bits))]
        two = [F.lit((1 << j) | (1 << k)).cast("bigint") for j, k in combinations(range(len(bits)), 2)]
        t = F.element_at("t", i + 1)
        masks = F.when(t >= 2, F.array(*one, *two)).when(t == 1, F.array(*one))
        probes.append(
            chosen.where(t >= 1).select("fp", F.explode(masks).alias("mask"), key.alias("home"))
            .select("fp", F.col("home").bitwiseXOR(F.col("mask")).alias("key"))
        )
        # A bucket of its own that is large although the programme chose it.
        probes.append(chosen.where(t >= 0).select("fp", key.alias("key")))
    probe = probes[0]
    for p in probes[1:]:
        probe = probe.unionByName(p)
    probe = checkpointed(probe.join(counts.withColumnRenamed("key", "_k"), F.col("key") == F.col("_k"), "left").drop("_k"))
    dense = (
        chosen.where(F.element_at("t", 1) == -9).select("fp")
        .unionByName(probe.where(F.col("n") > MAX_BUCKET).select("fp"))
        .distinct()
    )
    small = probe.where(F.coalesce(F.col("n"), F.lit(1)) <= MAX_BUCKET).select("fp", "key")
    met = small.join(keys.withColumnRenamed("fp", "other"), "key")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= DISTANCE
    probed = met.where((F.col("fp") != F.col("other")) & near).select(
        F.col("fp").alias("a"), F.col("other").alias("b")
    )
    points = F.array(fp, *[fp.bitwiseXOR(F.lit(_signed(1 << b))) for b in range(64)])
    shared = (
        dense.select("fp", F.explode(points).alias("point"))
        .groupBy("point").agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
        .select(F.explode("members").alias("a"), F.array_min("members").alias("b"))
        .where(F.col("a") != F.col("b"))
    )
    return found.unionByName(probed).unionByName(shared)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _allocator(load: np.ndarray):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.column_stack([batch.column(f"n{i}").to_numpy() for i in range(len(load))])
            t = allocate(sizes.astype("float64"), load) if len(sizes) else sizes
            yield pa.RecordBatch.from_arrays(
                [batch.column("fp"), pa.array(t.tolist(), pa.list_(pa.int32()))], ["fp", "t"]
            )

    return apply


def classes(marked: DataFrame) -> DataFrame:
    """(fp, root) of every distinct fingerprint among rows of (doc_id, fp)."""
    nodes = checkpointed(marked.select("fp").distinct())
    linked = components(links(nodes))
    roots = nodes.join(linked, F.col("fp") == F.col("node"), "left")
    return checkpointed(roots.select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every row."""
    marked = checkpointed(docs.select("doc_id", fingerprints("text").alias("fp")))
    cls = classes(marked)
    smallest = (
        marked.groupBy("fp").agg(F.min("doc_id").alias("rep")).join(cls, "fp")
        .groupBy("root").agg(F.min("rep").alias("component_id"))
    )
    known = cls.join(smallest, "root").select("fp", "component_id")
    return marked.join(known, "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The row with the smallest doc_id of each component, null ids last; of equal rows, one.

    The fingerprints are written beside the rows, so they are made once.
    """
    marked = checkpointed(docs.withColumn("__fp", fingerprints("text")))
    slim = marked.select("doc_id", F.col("__fp").alias("fp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("first")
    kept = (
        slim.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("m"))
        .select("fp", "m.doc_id")
        .join(classes(slim), "fp").groupBy("root").agg(first)
        .select(F.col("first.doc_id").alias("__id"), F.col("first.fp").alias("__kept"))
    )
    same = marked["doc_id"].eqNullSafe(F.col("__id")) & (marked["__fp"] == F.col("__kept"))
    one = F.row_number().over(Window.partitionBy("__id", "__kept").orderBy(F.xxhash64("text")))
    rows = marked.join(kept, same).withColumn("__nth", one).where("__nth = 1")
    return rows.select(*[marked[c] for c in docs.columns])
