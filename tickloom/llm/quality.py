"""Quality rules: base counts, then robust multivariate outliers per language and source.

Each text becomes a vector of transformed rates. For each (lang, source) the minimum-
covariance-determinant estimate of centre and scatter is found by concentration steps: take
the half of the rows that lies nearest, estimate from it, repeat. A row whose Mahalanobis
distance is above the cut is rejected.

Every step covers all rows: a step groups the vectors by (lang, source, distance bin) and
sums counts and moments, so it moves at most ``BINS`` rows per group, and a group with a
third of all rows is summed before the shuffle. The half is then whole bins. The scatter gets
``FLOOR`` squared added on its diagonal: where most texts have no symbols or no repeated
lines at all, the plain estimate is singular and would reject a text for one symbol.

* A null text has no words. Null language or source form groups of their own.
* A group of one row is its own centre, so that row is kept unless the base rules fail it.
* Repeated rows are judged alike; columns other than the four that are read pass through
  ``keep_good`` whatever their names (names starting with two underscores excepted); an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import each
from tickloom.session import checkpointed

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VECTOR = ("v_word_length", "v_symbols", "v_dup_lines", "v_repeat", "v_upper")

# The least spread that counts, in the units of VECTOR: log of word length, log of one plus
# symbols per word, share of repeated lines, share of repeated words, share of capitals.
FLOOR = (0.12, 0.06, 0.08, 0.12, 0.06)
CUT = 6.0
HALF = 0.5
STEPS = 4
BINS_PER_DOUBLING = 16
# Scatter of the nearest half against that of all, for five normal dimensions.
CONSISTENCY = 1.9

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"


def text_counts(text: str | None) -> tuple[int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper of a text.

    n_upper counts the capitals A to Z.
    """
    if not text:
        return (0,) * 7
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        int(np.count_nonzero(np.frombuffer(raw, dtype=np.uint8) - np.uint8(65) < 26)),
    )


def repeat_words(words: list[bytes]) -> int:
    """Words inside a three-word window that occurs at least twice in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    hit = np.fromiter((times[w] > 1 for w in windows), dtype=bool, count=len(windows))
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(hit)] |= hit
    return int(covered.sum())


def vector(c: np.ndarray) -> np.ndarray:
    """The transformed statistics of rows of ``text_counts``."""
    n = np.maximum(c[:, 0], 1.0)
    return np.column_stack(
        [
            np.log((c[:, 1] + 1.0) / n),
            np.log1p(c[:, 2] / n),
            c[:, 3] / np.maximum(c[:, 5], 1.0),
            c[:, 4] / n,
            c[:, 6] / np.maximum(c[:, 1], 1.0),
        ]
    )


_COUNTED = T.StructType(
    [T.StructField(c, T.LongType()) for c in COUNTS]
    + [T.StructField("base_failed", T.BooleanType())]
    + [T.StructField(c, T.DoubleType()) for c in VECTOR]
)


@F.arrow_udf(_COUNTED)
def counted(texts: pa.Array) -> pa.Array:
    """Counts, base verdict and vector of each text."""
    c = np.array([text_counts(t) for t in each(texts)], dtype="int64").reshape(-1, 7)
    v, n = vector(c.astype("float64")), c[:, 0]
    failed = (n < MIN_WORDS) | (100 * c[:, 4] > MAX_REPEAT_PERCENT * n)
    named = {name: c[:, i] for i, name in enumerate(COUNTS)} | {"base_failed": failed}
    named |= {name: v[:, i] for i, name in enumerate(VECTOR)}
    return pa.StructArray.from_arrays([pa.array(x) for x in named.values()], list(named))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, counts, base verdict and vector of every row, in one pass."""
    kept = [F.col(c).cast("string").alias(c) for c in ("lang", "source")]
    rows = docs.select("doc_id", *kept, counted("text").alias("counted"))
    return rows.select("doc_id", "lang", "source", "counted.*")


def _distance(prefix: str = ""):
    """Squared Mahalanobis distance of the vector to the joined estimate."""
    centre, inverse = F.col("__centre"), F.col("__inverse")
    d = [F.col(prefix + c) - centre[i] for i, c in enumerate(VECTOR)]
    k = len(VECTOR)
    return sum(d[i] * d[j] * inverse[i * k + j] for i in range(k) for j in range(k))


def _joined(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with their group's estimate; skewed groups are split by adaptive execution."""
    e = estimates.select([F.col(c).alias(f"__{c}") for c in estimates.columns])
    same = [rows[c].cast("string").eqNullSafe(e[f"__{c}"]) for c in ("lang", "source")]
    return rows.join(e, same, "left").drop("__lang", "__source")


def _binned(d2):
    """A bin of the squared distance: 16 to a doubling, 0 to 1023."""
    b = F.floor(F.log2(d2 + F.lit(2.0**-20)) * BINS_PER_DOUBLING) + 20 * BINS_PER_DOUBLING
    return F.least(F.greatest(b, F.lit(0)), F.lit(1023)).cast("int")


def _moments() -> list:
    out = [F.count(F.lit(1)).alias("n")]
    out += [F.sum(c).alias(f"s{i}") for i, c in enumerate(VECTOR)]
    for i, a in enumerate(VECTOR):
        out += [F.sum(F.col(a) * F.col(b)).alias(f"s{i}_{i + j}") for j, b in enumerate(VECTOR[i:])]
    return out


def _estimate(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centre and inverse scatter from the summed moments of each group's nearest half."""
    k = len(VECTOR)
    for pdf in parts:
        out = []
        for row in pdf.to_dict("records"):
            mean = np.array([row[f"s{i}"] for i in range(k)]) / row["n"]
            cov = np.empty((k, k))
            for i in range(k):
                for j in range(i, k):
                    cov[i, j] = cov[j, i] = row[f"s{i}_{j}"] / row["n"] - mean[i] * mean[j]
            cov = cov * row["scale"] + np.diag(np.square(FLOOR))
            inverse = np.linalg.inv(cov).ravel()
            out.append((row["lang"], row["source"], np.round(mean, 9).tolist(), np.round(inverse, 9).tolist()))
        yield pd.DataFrame(out, columns=["lang", "source", "centre", "inverse"])


def _estimates(summed: DataFrame) -> DataFrame:
    schema = "lang string, source string, centre array<double>, inverse array<double>"
    return checkpointed(summed.mapInPandas(_estimate, schema))


def _start(rows: DataFrame) -> DataFrame:
    """First centre: the median of each coordinate, from counts of rounded values."""
    long = rows.select(
        "lang", "source", F.posexplode(F.array(*[F.floor(F.col(c) * 256) for c in VECTOR]))
    )
    counts = long.groupBy("lang", "source", "pos", "col").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("lang", "source", "pos")
    below = F.sum("n").over(group.orderBy("col").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.select("*", below.alias("upto"), F.sum("n").over(group).alias("all"))
    medians = ranked.where(F.col("upto") * 2 >= F.col("all"))
    centre = medians.groupBy("lang", "source", "pos").agg((F.min("col") / 256).alias("m"))
    k = len(VECTOR)
    spread = [1.0 / FLOOR[i] ** 2 if i == j else 0.0 for i in range(k) for j in range(k)]
    middle = [F.max(F.when(F.col("pos") == i, F.col("m"))) for i in range(k)]
    return checkpointed(
        centre.groupBy("lang", "source")
        .agg(F.array(*middle).alias("centre"))
        .withColumn("inverse", F.array(*[F.lit(x) for x in spread]))
    )


def mcd(rows: DataFrame) -> DataFrame:
    """Centre and inverse scatter of each (lang, source) after ``STEPS`` concentration steps."""
    estimates = _start(rows)
    for _ in range(STEPS):
        d2 = _joined(rows, estimates).withColumn("bin", _binned(_distance()))
        bins = d2.groupBy("lang", "source", "bin").agg(*_moments())
        group = Window.partitionBy("lang", "source")
        before = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
        half = bins.select("*", (before - F.col("n")).alias("_before"), F.sum("n").over(group).alias("_all"))
        near = half.where(F.col("_before") < F.col("_all") * HALF)
        sums = [c for c in bins.columns if c not in ("lang", "source", "bin")]
        share = F.sum("n") / F.max("_all")
        # The scatter of a part is widened to that of all, fully so for one half.
        scale = F.lit(1.0) + (CONSISTENCY - 1.0) * F.greatest(F.lit(0.0), (1 - share) / (1 - HALF))
        summed = near.groupBy("lang", "source").agg(
            scale.alias("scale"), *[F.sum(c).alias(c) for c in sums]
        )
        estimates = _estimates(summed)
    return estimates


def usual(rows: DataFrame) -> DataFrame:
    """The estimates of each (lang, source) among the rows that pass the base rules."""
    return mcd(rows.where(~F.col("base_failed")))


def _verdict(prefix: str, cut: float):
    near = F.coalesce(_distance(prefix) <= cut * cut, F.lit(True))
    return ~F.col(prefix + "base_failed") & near


def judged(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, lang, source, counts, base verdict, distance and final verdict of every row."""
    rows = checkpointed(measured(docs))
    return _joined(rows, usual(rows)).select(
        "doc_id", "lang", "source", *COUNTS, "base_failed", _verdict("", cut).alias("kept"),
        F.sqrt(F.greatest(_distance(), F.lit(0.0))).alias("distance"),
    )


def keep_good(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows that the rules keep, with their columns as they were.

    The texts are counted twice, once for the estimates and once for the verdict: that is
    cheaper than moving them through a shuffle.
    """
    estimates = usual(checkpointed(measured(docs)))
    rows = _joined(docs.withColumn("__counted", counted("text")), estimates)
    return rows.where(_verdict("__counted.", cut)).select(*[docs[c] for c in docs.columns])
