"""Broadcast hints for sides that a key bounds.

Other joins carry no hint: adaptive execution broadcasts a side that turns out small and
splits skewed partitions of one that does not. Nothing is run to build a plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sessions that may share a civil date.
MAX_PER_DATE = 4


def by_date(df: DataFrame, key: str) -> DataFrame:
    """Broadcast hint for a table with a few rows per civil date.

    A century has 36,525 dates. A table with more than ``MAX_PER_DATE`` rows of a date, such
    as a calendar of many venues, is an error when the join runs.
    """
    others = [c for c in df.columns if c != key]
    if not others:
        return F.broadcast(df.distinct())
    rows = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.collect_list(F.struct(*others)).alias("_rows")
    )
    crowded = F.raise_error(F.concat(F.lit("too many rows of date "), F.col(key).cast("string")))
    checked = F.when(F.col("_n") > MAX_PER_DATE, crowded.cast("int")).otherwise(F.lit(0))
    return F.broadcast(
        rows.withColumn("_ok", checked).where("_ok = 0").select(key, F.inline("_rows"))
    )


def dated(windows: DataFrame, date: str = "snapshot_date", ticker: str = "ticker") -> DataFrame:
    """Windows with a real date and a ticker.

    Every use of the windows in a plan starts from this one, so that their shuffle is done
    once and reused.
    """
    return windows.where(_real(F.col(date)) & F.col(ticker).isNotNull())


def _real(date: Column) -> Column:
    """True for every real date; Spark prunes by a side only where a comparison filters it."""
    return date > F.lit("0001-01-01").cast("date")


def on_dates(df: DataFrame, date: str, wanted: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` on the dates of ``wanted``, so that a scan opens no other partition.

    Dates are counted, not made distinct: Spark would merge a distinct with that of
    ``wanted`` and so compute ``wanted`` again.
    """
    kind = df.schema[date].dataType
    counted = wanted.where(_real(F.col(column))).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    days = counted.where("_n > 0").select(F.col(column).cast(kind).alias(date))
    return df.join(F.broadcast(days), date, "left_semi")
