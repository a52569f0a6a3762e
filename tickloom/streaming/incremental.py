"""Bookmarks and restartable reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.sources.flat_files import prune_dates


def high_water(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Largest value of ``column`` per key, as ``bookmark``."""
    return df.groupBy(*keys).agg(F.max(column).alias("bookmark"))


def starting_point(*candidates: Column) -> Column:
    """Latest of state, configured start and global start; NULLs are ignored."""
    if len(candidates) == 1:
        return candidates[0]
    return F.greatest(*candidates)


def read_since(df: DataFrame, bookmark: str | None, column: str = "file_date") -> DataFrame:
    """Rows from the bookmark on, the bookmarked value included.

    Re-reading the bookmarked value is safe because sinks replace whole dates.
    """
    return prune_dates(df, bookmark=bookmark, column=column)


def adjust(ranges: DataFrame, interval_ns: int, bookmark: str = "bookmark") -> DataFrame:
    """Ranges (start_ns, end_ns) moved past their bookmark; consumed ones dropped."""
    after = F.col(bookmark) + F.lit(interval_ns).cast("bigint")
    start = F.when(
        F.col(bookmark).isNotNull(), F.greatest("start_ns", after)
    ).otherwise(F.col("start_ns"))
    open_ = F.col(bookmark).isNull() | (
        (F.col("end_ns") > F.col(bookmark)) & (start < F.col("end_ns"))
    )
    return ranges.where(open_).withColumn("start_ns", start)


def advance(bookmarks: DataFrame, batch: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Bookmarks after a batch, each key on its own.

    One aggregate over both: a union needs no join and survives a hot key.
    """
    merged = bookmarks.select(*keys, F.col("bookmark")).unionByName(
        batch.select(*keys, F.col(column).alias("bookmark"))
    )
    return merged.groupBy(*keys).agg(F.max("bookmark").alias("bookmark"))
