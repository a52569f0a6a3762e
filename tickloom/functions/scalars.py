"""Column functions for dirty text, tickers, timestamps and labels.

Every function takes columns (or column names) and returns a column, so all of
them stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Snapshot sizes by table-name suffix, in nanoseconds.
INTERVAL_NS = {
    "1_second": 1_000_000_000,
    "30_second": 30_000_000_000,
    "1_minute": 60_000_000_000,
    "5_minute": 300_000_000_000,
    "30_minute": 1_800_000_000_000,
}
DAY_NS = 86_400_000_000_000
# Accepted spellings of a status flag.
STATUS_TRUE = ("true", "1", "yes", "y")
STATUS_FALSE = ("false", "0", "no", "n")
# A date inside a file name, and the underlying inside an option ticker.
FILE_DATE_PATTERN = r"(\d{4}-\d{2}-\d{2})"
OPTION_UNDERLYING_PATTERN = r"^O:([A-Z]+)"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank_to_null(c: Column | str) -> Column:
    text = F.trim(_col(c).cast("string"))
    return F.when(text != "", text)


def safe_decimal(c: Column | str) -> Column:
    """Exact decimal, NULL where the text is empty or no number."""
    return _blank_to_null(c).try_cast("decimal(38,10)")


def safe_double(c: Column | str) -> Column:
    """Double, NULL where the text is empty or no number."""
    return _blank_to_null(c).try_cast("double")


def safe_int(c: Column | str) -> Column:
    """Long, read through decimal so that fractions truncate and ``1e3`` is 1000."""
    return safe_decimal(c).try_cast("bigint")


def to_bool(c: Column | str) -> Column:
    """NULL for empty text, true for ``true``/``1`` in any case, false for the rest."""
    text = _col(c).cast("string")
    return F.when(text != "", F.lower(F.trim(text)).isin("true", "1"))


def status_bool(c: Column | str) -> Column:
    """Three-valued status flag: unknown spellings are NULL."""
    text = F.lower(F.trim(_col(c).cast("string")))
    return F.when(text.isin(*STATUS_TRUE), True).when(text.isin(*STATUS_FALSE), False)


def epoch_to_seconds(c: Column | str) -> Column:
    """Epoch number to seconds, the unit judged by magnitude."""
    n = _col(c).cast("double")
    size = F.abs(n)
    return (
        F.when(size > 1e15, n / 1e9)
        .when(size > 1e13, size / 1e6)
        .when(size > 1e10, n / 1e3)
        .otherwise(n)
    )


def epoch_to_timestamp(c: Column | str, unit: str | None = None) -> Column:
    """Epoch number to timestamp; give ``unit`` (s, ms, us, ns) to skip the guess."""
    if unit is None:
        return F.timestamp_micros(F.round(epoch_to_seconds(c) * 1e6).cast("bigint"))
    n = _col(c).cast("bigint")
    scale = {"s": n * 1_000_000, "ms": n * 1_000, "us": n, "ns": floor_div(n, 1_000)}
    return F.timestamp_micros(scale[unit])


def iso_to_unix(c: Column | str, unit: str) -> Column:
    """ISO text to whole s, ms or ns; text without an offset is UTC.

    A timestamp holds six fraction digits, so the seventh to ninth are read from the text.
    """
    text = _col(c)
    micros = F.unix_micros(F.try_to_timestamp(text))
    if unit == "ns":
        further = F.regexp_extract(text, r":\d\d\.\d{6}(\d{1,3})", 1)
        return micros * 1_000 + F.rpad(further, 3, "0").cast("bigint")
    return floor_div(micros, {"s": 1_000_000, "ms": 1_000}[unit])


def whole_div(c: Column, n: int) -> Column:
    """Whole-number division, truncating towards zero."""
    return F.call_function("div", c, F.lit(n).cast("bigint"))


def floor_div(c: Column, n: int) -> Column:
    """Whole-number division, rounding down also below zero."""
    return whole_div(c - F.pmod(c, F.lit(n).cast("bigint")), n)


def ns_to_date(c: Column | str) -> Column:
    """UTC civil date of a nanosecond epoch."""
    return F.date_from_unix_date(floor_div(_col(c), DAY_NS).cast("int"))


def date_to_ns(c: Column | str) -> Column:
    """Nanosecond epoch of a date's UTC midnight."""
    return F.unix_date(_col(c)).cast("bigint") * F.lit(DAY_NS)


def ts_to_ns(c: Column | str) -> Column:
    """Nanosecond epoch of a timestamp, with or without a zone."""
    return F.unix_micros(_col(c).cast("timestamp")) * F.lit(1000).cast("bigint")


def bucket_end(c: Column | str, interval_ns: int) -> Column:
    """End of the ``(T - interval, T]`` bucket; exact multiples keep their value."""
    step = F.lit(interval_ns).cast("bigint")
    return (whole_div(_col(c) - 1, interval_ns) + 1) * step


def canonical_ticker(c: Column | str, market: str | None = None) -> Column:
    """Trim; currency pairs of six letters become ``C:XXXYYY`` unless already so."""
    ticker = F.trim(_col(c))
    if market not in ("fx", "forex"):
        return ticker
    letters = F.regexp_replace(ticker, "[^A-Za-z]", "")
    is_pair = ~ticker.startswith("C:") & (F.length(letters) == 6)
    return F.when(is_pair, F.concat(F.lit("C:"), letters)).otherwise(ticker)


def option_underlying(c: Column | str) -> Column:
    """Underlying symbol of an option ticker, or NULL."""
    found = F.regexp_extract(_col(c), OPTION_UNDERLYING_PATTERN, 1)
    return F.when(found != "", found)


def file_date(c: Column | str) -> Column:
    """First date in a file name, as text, or NULL."""
    found = F.regexp_extract(_col(c), FILE_DATE_PATTERN, 1)
    return F.when(found != "", found)


def interval_ns(c: Column | str) -> Column:
    """Snapshot size of a table name, from its suffix; NULL when it has none."""
    name = _col(c)
    branches = [
        F.when(name.endswith(suffix), F.lit(ns).cast("bigint"))
        for suffix, ns in INTERVAL_NS.items()
    ]
    return F.coalesce(*branches)


def interval_ns_of(name: str) -> int:
    """As :func:`interval_ns` for a plain string; raises when there is no suffix."""
    for suffix, ns in INTERVAL_NS.items():
        if name.endswith(suffix):
            return ns
    raise ValueError(f"no snapshot interval in table name {name!r}")


def series_label(series: Column, timespan: Column, window: Column) -> Column:
    """Label such as ``close_day_10``."""
    return F.concat_ws("_", series, timespan, window.cast("string"))


def snake_case(c: Column | str) -> Column:
    """``_`` before every capital but a leading one, then lower case."""
    return F.lower(F.regexp_replace(_col(c), "(?<!^)(?=[A-Z])", "_"))


def slug(c: Column | str) -> Column:
    """Lower case without underscores."""
    return F.lower(F.replace(_col(c), F.lit("_"), F.lit("")))


def is_us_ticker(c: Column | str) -> Column:
    """True for a non-empty symbol without an exchange suffix."""
    ticker = _col(c)
    return F.coalesce((ticker != "") & ~F.contains(ticker, F.lit(".")), F.lit(False))

