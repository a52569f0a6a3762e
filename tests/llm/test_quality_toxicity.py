"""Quality counts, the robust estimate, and the toxicity classifier."""

import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import quality, toxicity

from .conftest import SF, odd_rows, words


def plain_counts(text):
    """The base counts by their definitions."""
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside |= {i, i + 1, i + 2}
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(inside),
    )


def test_query_counts(spark, documents, queries):
    got = {r.doc_id: r for r in queries["op5_quality_rules"](spark, SF).collect()}
    for r in documents.collect():
        if len(r.text) > 6000:
            continue
        n = plain_counts(r.text)
        assert tuple(got[r.doc_id][c] for c in quality.COUNTS) == n
        assert got[r.doc_id].base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (got[r.doc_id].base_failed and got[r.doc_id].kept)


def test_counts_of_odd_texts():
    for text in (None, "", " ", "a a a a", "x\x85y z\x1c", "a b c a b c", "q\n\nq\n q\nq", "A|B <é>"):
        assert quality.text_counts(text)[:5] == plain_counts(text)


def test_rare_shapes_go_and_usual_ones_stay(spark):
    """The estimate of a group is not moved by a third of odd rows in it."""
    usual = [(i, words(i, 80 + i % 50), "en", "a") for i in range(120)]
    strange = [(1000 + i, " ".join(w + "###" for w in words(i, 90).split()), "en", "a") for i in range(50)]
    docs = spark.createDataFrame(usual + strange, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality.judged(docs).where("kept").collect()}
    assert kept == set(range(120))
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == kept


def test_estimate_against_numpy(spark):
    """One group's centre is the mean of the half of the rows nearest to it."""
    docs = spark.createDataFrame(
        [(i, words(i, 60 + i % 90), "en", "a") for i in range(200)],
        "doc_id long, text string, lang string, source string",
    )
    rows = quality.checkpointed(quality.measured(docs))
    (estimate,) = quality.usual(rows).collect()
    v = np.array([[r[c] for c in quality.VECTOR] for r in rows.where("not base_failed").collect()])
    inverse = np.array(estimate.inverse).reshape(5, 5)
    d = np.einsum("ij,jk,ik->i", v - estimate.centre, inverse, v - estimate.centre)
    half = v[np.argsort(d)[: len(v) // 2]]
    assert np.abs(half.mean(axis=0) - estimate.centre).max() < 0.02
    assert np.linalg.eigvalsh(inverse).min() > 0


def test_quality_odd_rows(odd, nothing):
    got = quality.judged(odd).collect()
    assert len(got) == len(odd_rows())
    assert all(r.base_failed for r in got if r.doc_id in (4, 5, 6, 9))
    assert all(r.kept for r in got if r.doc_id in (1, 2, 3, 7, 8, None))
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r.doc_id for r in got if r.kept), key=str)
    assert quality.judged(nothing).count() == 0 and quality.keep_good(nothing).count() == 0


def test_toxicity_query_on_held_out_rows(spark, queries):
    sf = SF.replace("0.001", "0.1")
    got = queries["op7_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    toxic = [r.predicted for r in held if r.toxic]
    clean = [r.predicted for r in held if not r.toxic]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.05


def test_toxicity_learns_no_held_out_label(spark, odd):
    """Labels of rows outside the training fold change nothing."""
    few = odd.select("doc_id", "text")
    base = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (7, 1)], "doc_id long, toxic int")
    other = base.union(spark.createDataFrame([(10, 1), (11, 1)], "doc_id long, toxic int"))
    one, two = (toxicity.train(few, x, F.col("doc_id") < 10) for x in (base, other))
    assert one == two


def test_toxicity_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    got = odd.select("doc_id", toxicity.scores(F.col("text"), model).alias("s")).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.s <= 1 for r in got)
    assert len({r.s for r in got if r.doc_id in (4, 5, 6)}) == 1
    assert toxicity.train(nothing, labels.limit(0)) == toxicity.Model()
    assert toxicity.Model().score("anything") < 0.001


def test_negative_part_of_the_risk_stays_out():
    """With a prior above the true share the estimator must not fall apart."""
    bad = [f"fine words here slur{i % 3} and more" for i in range(30)]
    fine = [f"fine words here and more {i % 7}" for i in range(170)]
    model = toxicity.fit(bad, fine + bad, 0.3)
    assert min(map(model.score, bad)) > 0.7 > max(map(model.score, fine))
