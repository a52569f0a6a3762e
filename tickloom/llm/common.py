"""Reading the tables, words, and positions along a total order without a one-task sort."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A word is a run of anything but space and the controls U+0009 to U+000D. bytes.split()
# of Python cuts at just these.
SPACE = r"[\x20\x09-\x0D]"
NON_SPACE = r"[^\x20\x09-\x0D]+"

ROWS_PER_BUCKET = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    On a cluster, install the package on the workers or ship it with ``--py-files``; a path
    that a machine lacks does no harm.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(filter(None, [*paths, root]))
    return spark


def each(values: pa.Array) -> Iterator:
    """The values of an Arrow array one by one, so that a batch's texts are not held twice."""
    return (v.as_py() for v in values)


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null: the places where a word starts, counted inside the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(NON_SPACE)), F.lit(0)).cast("bigint")


def hash_bucket(h: Column, buckets: int) -> Column:
    """The bucket of a 64-bit hash: non-decreasing in the hash taken as a signed long."""
    return F.least(
        F.floor((h.cast("double") / F.lit(2.0**64) + 0.5) * buckets), F.lit(buckets - 1)
    ).cast("bigint")


def buckets_for(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """How many buckets keep each near ``per_bucket`` rows."""
    return max(1, -(-rows // per_bucket))


def running_before(
    df: DataFrame, by: list[str], bucket: str, order: list[str], values: dict[str, str]
) -> DataFrame:
    """Add sums over the rows before this one within ``by``: ``values`` maps input to output.

    ``bucket`` must not decrease along ``order``. Totals per (key, bucket) are made by a
    partial aggregate and summed along the buckets; rows are sorted only inside a bucket,
    so a key with a third of all rows is spread over its buckets.
    """
    along = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = df.groupBy(*by, bucket).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    offsets = totals.select(
        *[F.col(c).alias(f"__o_{c}") for c in [*by, bucket]],
        *[F.coalesce(F.sum(f"__t_{v}").over(along), F.lit(0)).alias(f"__t_{v}") for v in values],
    )
    match = [F.col(c).eqNullSafe(F.col(f"__o_{c}")) for c in [*by, bucket]]
    sums = {
        out: F.col(f"__t_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))
        for v, out in values.items()
    }
    helpers = [f"__o_{c}" for c in [*by, bucket]] + [f"__t_{v}" for v in values]
    return df.join(offsets, match).withColumns(sums).drop(*helpers)
