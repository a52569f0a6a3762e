"""Earnings dates from one or both of two event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Corporate event types that announce earnings.
EARNINGS_EVENT_TYPES = (
    "earnings_announcement_date",
    "earnings_conference_call",
    "earnings_results_announcement",
)
EARNINGS_SOURCES = ("benzinga", "tmx", "both")
# ---------------------------------------------------------------------------


def distinct_pairs(df: DataFrame, ticker: str = "ticker", date: str = "date") -> DataFrame:
    """Distinct (ticker, date) pairs with both parts present."""
    return (
        df.select(F.col(ticker).alias("ticker"), F.col(date).cast("date").alias("date"))
        .where(F.col("date").isNotNull() & (F.col("ticker") != ""))
        .distinct()
    )


def union_distinct(*tables: DataFrame) -> DataFrame:
    """Rows of all tables once each."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out.distinct()


def earnings_dates(
    releases: DataFrame | None,
    events: DataFrame | None,
    source: str,
    start: str,
    end: str,
) -> DataFrame:
    """Distinct (ticker, date) of earnings between ``start`` and ``end`` inclusive.

    ``releases`` is the earnings table (ticker, date); ``events`` the corporate
    event table (ticker, date, type). Bounds are plain predicates, so a parquet or
    JDBC source applies them itself. One shuffle serves both inputs.
    """
    if source not in EARNINGS_SOURCES:
        raise ValueError(f"source must be one of {EARNINGS_SOURCES}, not {source!r}")
    parts = []
    if source in ("benzinga", "both"):
        parts.append(releases.select("ticker", "date"))
    if source in ("tmx", "both"):
        parts.append(
            events.where(F.col("type").isin(*EARNINGS_EVENT_TYPES)).select("ticker", "date")
        )
    bounded = [
        p.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        for p in parts
    ]
    merged = bounded[0]
    for p in bounded[1:]:
        merged = merged.unionByName(p)
    return distinct_pairs(merged)
