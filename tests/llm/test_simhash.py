"""SimHash groups against all pairs in plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tickloom.llm import components, simhash

from .conftest import SF, odd_rows


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found, word = [], ""
    for c in text + " ":
        if c in " \t\n\v\f\r":
            if word:
                found.append(word)
            word = ""
        else:
            word += c
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_components(fps, ids):
    """Smallest id reachable over links of at most two bits."""
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    distinct = sorted(parent)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for f, i in zip(fps, ids):
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return [least.get(find(f)) for f in fps]


def test_query_against_all_pairs(spark, documents, queries):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries["op1_simhash_near_dedup"](spark, SF).collect()}
    rows = documents.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    groups = plain_components(fps, [r.doc_id for r in rows])
    assert got == {r.doc_id: (f"{f:016x}", g) for r, f, g in zip(rows, fps, groups)}


def test_odd_rows(odd):
    got = simhash.near_duplicates(odd).collect()
    rows = odd_rows()
    fps = [plain_fingerprint(r[1]) for r in rows]
    groups = plain_components(fps, [r[0] for r in rows])
    want = sorted(((r[0], f"{f:016x}", g) for r, f, g in zip(rows, fps, groups)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_empty_table(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_one(nothing).columns == nothing.columns


def test_keep_one_keeps_columns_and_one_row_of_each_group(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    # 7 copies 1; 5 and 6 are blank like 4; 9 is there twice.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 8, 9, 10, 11, None], key=str)


@pytest.mark.parametrize("bucket", [64, 6])
def test_dense_groups_lose_no_link(spark, monkeypatch, bucket):
    """Large groups within few bits: unequal thresholds and dense fingerprints take part."""
    monkeypatch.setattr(simhash, "MAX_BUCKET", bucket)
    rng = np.random.default_rng(3)
    fps = set()
    for base in rng.integers(-(2**62), 2**62, size=4):
        for i in range(250):
            x = int(base)
            for b in rng.choice(64 if i % 2 else 18, rng.integers(0, 5), replace=False):
                x ^= simhash._signed(1 << int(b))
            fps.add(x)
    fps = sorted(fps | {int(x) for x in rng.integers(-(2**62), 2**62, size=200)})
    table = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = table.join(simhash.classes(table), "fp").groupBy("root").agg(F.min("doc_id").alias("c"))
    found = table.join(simhash.classes(table), "fp").join(got, "root").orderBy("doc_id").collect()
    assert [r.c for r in found] == plain_components(fps, list(range(len(fps))))


def test_allocation_sums_and_prefers_cheap_parts():
    sizes = np.array([[1, 1, 1], [500, 1, 1], [500, 500, 1], [500, 500, 500]], dtype=float)
    t = simhash.allocate(sizes, np.zeros(3))
    assert t[0].tolist() == [0, 0, 0]
    assert t[1, 0] == -1 and t[1].sum() == 0
    assert (t[3] == -9).all()


def test_parts_hold_every_bit_once():
    corr = np.random.default_rng(0).normal(size=(64, 64))
    groups = simhash.parts(corr + corr.T)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert [len(g) for g in groups] == list(simhash.WIDTHS)


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("id * 7 % 61 as a", "(id + 1) * 7 % 61 as b")
    roots = {r.root for r in components.components(edges).collect()}
    assert roots == {0}
    assert components.components(edges.limit(0)).count() == 0
