"""Fingerprints against generalised Jaccard similarity and edited texts in plain Python."""

import hashlib
from collections import Counter

from tickloom.llm import weighted_sampling

from .conftest import SF, odd_rows


def plain_edits(rows):
    """(id, text) in descending order to id, n_chars, sha256, text, edited, next text."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, after)
    return out


def jaccard(a, b):
    x, y = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_query(spark, documents, queries):
    got = queries["op2_weighted_sampling"](spark, SF).collect()
    want = plain_edits([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == {i: w[:2] for i, w in want.items()}
    by_text = {}
    for r in got:
        assert by_text.setdefault(want[r.doc_id][2], r.fingerprint) == r.fingerprint
    errors = [r.near_edited - jaccard(want[r.doc_id][2], want[r.doc_id][3]) for r in got]
    errors += [r.near_next - jaccard(want[r.doc_id][2], want[r.doc_id][4]) for r in got]
    assert abs(sum(errors) / len(errors)) < 0.02
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.1


def test_odd_rows_have_defined_results(odd):
    got = weighted_sampling.fingerprinted(odd).collect()
    # The repeated row has one result.
    assert len(got) == len(odd_rows()) - 1
    blank = {r.fingerprint for r in got if r.doc_id in (4, 5, 6)}
    assert blank == {"0" * weighted_sampling.DIGITS * weighted_sampling.SLOTS}
    same = {r.fingerprint for r in got if r.doc_id in (1, 7)}
    assert len(same) == 1
    ids = [r[0] for r in odd_rows() if r[0] is not None]
    # Null ids come last, so the smallest id is followed by the null one, that by the largest.
    texts = {r[0]: r[1] or "" for r in odd_rows()}
    cut = len(texts[1]) // 3
    edited = texts[1][: len(texts[1]) - cut] + texts[None][:cut]
    assert hashlib.sha256(edited.encode()).hexdigest() in {r.edited_sha256 for r in got if r.doc_id == min(ids)}


def test_one_row_and_none(spark, nothing):
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    (row,) = weighted_sampling.fingerprinted(one).collect()
    assert row.near_next == 1.0 and row.n_chars == 5
    assert weighted_sampling.fingerprinted(nothing).count() == 0


def test_no_python_in_the_plan(documents):
    plan = weighted_sampling.fingerprinted(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
