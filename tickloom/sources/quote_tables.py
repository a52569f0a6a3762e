"""Tables of quote bars kept up to date with their quote files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tickloom.operators.quotes import QUOTE_ASSETS, quote_bars
from tickloom.sources.flat_files import scan_quotes
from tickloom.sources.versions import Version, latest, upsert_version
from tickloom.specs.base import TableSpec, conform


def last_date(version: Version, partition: str = "file_date") -> str | None:
    """Last date of a versioned table, from its list of folders: no data is read."""
    dates = [f.removeprefix(f"{partition}=") for f in version.folders if f.startswith(f"{partition}=")]
    return max(dates, default=None)


def update_quote_bars(
    spark: SparkSession,
    files: str | list[str],
    path: str,
    table: TableSpec,
    interval_ns: int,
    asset: str = "option",
    start: str | None = None,
    end: str | None = None,
    header: list[str] | None = None,
) -> Version:
    """Bars of the quote files from the table's last date on, upserted as one version.

    The last date is read again, since its files may have grown: bars whose last quote has
    changed are replaced. Files of earlier dates are not opened, so files that arrive late
    for such a date need a ``start`` of a table of their own. A run without files or rows
    leaves the table's version as it is, and a run may be repeated after any failure.
    """
    now = latest(spark, path)
    quotes = scan_quotes(spark, files, QUOTE_ASSETS[asset].csv, start, end, last_date(now), header)
    bars = conform(quote_bars(quotes, interval_ns, asset, by_file_date=True), table)
    return upsert_version(bars, table, path) if not quotes.isEmpty() else now
