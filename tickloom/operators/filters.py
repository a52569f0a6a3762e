"""Row filters. All are plain predicates or semi-joins, so scans can apply them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import scalars as sc
from tickloom.operators.sizes import dated, on_dates
from tickloom.specs.base import as_schema

# --- fixed values -----------------------------------------------------------
# Config sections by market, and suffixes of range parameters.
MARKET_SECTIONS = {
    "stock": "stock_tickers",
    "stocks": "stock_tickers",
    "fx": "forex_tickers",
    "forex": "forex_tickers",
    "crypto": "crypto_tickers",
    "indices": "indices_tickers",
    "option": "option_tickers",
    "options": "option_tickers",
    "future": "futures_tickers",
    "futures": "futures_tickers",
}
RANGE_SUFFIXES = ("gt", "gte", "lt", "lte")
# ---------------------------------------------------------------------------


def configured_tickers(
    config: dict, sections: tuple[str, ...] = (), market: str | None = None
) -> list[str] | None:
    """First section that names tickers, trimmed; ``*`` or nothing means all (None)."""
    own = MARKET_SECTIONS.get(market, f"{market}_tickers") if market else None
    for section in dict.fromkeys([*sections, *([own] if own else [])]):
        chosen = _listed((config.get(section) or {}).get("select_tickers"))
        if chosen and chosen != ["*"]:
            return chosen
    return None


def select_tickers(
    df: DataFrame,
    tickers: str | list[str] | DataFrame | None,
    key: str = "ticker",
    market: str | None = None,
) -> DataFrame:
    """Keep the chosen tickers; ``None`` or ``*`` keeps all. Case is significant.

    A list is written into the plan as an ``IN`` predicate; a DataFrame is a semi-join.
    """
    if isinstance(tickers, DataFrame):
        name = tickers.columns[0]
        chosen = tickers.select(sc.canonical_ticker(name, market).alias(key)).distinct()
        return df.join(chosen, key, "left_semi")
    chosen = _listed(tickers)
    if chosen in ([], ["*"]):
        return df
    # Constants: the optimizer folds them, so that the scan still gets an IN predicate.
    return df.where(F.col(key).isin(*[sc.canonical_ticker(F.lit(t), market) for t in chosen]))


def _listed(values: str | list[str] | None) -> list[str]:
    parts = values.split(",") if isinstance(values, str) else values or []
    return [str(v).strip() for v in parts if str(v).strip()]


def select_futures(
    df: DataFrame,
    codes: str | list[str] | None = None,
    types: str | list[str] | None = None,
    code_column: str = "product_code",
    type_column: str = "type",
) -> DataFrame:
    """Keep contracts by product code and by type; an empty list keeps all."""
    if _listed(codes):
        df = df.where(F.col(code_column).isin(*_listed(codes)))
    if _listed(types):
        df = df.where(F.col(type_column).isin(*_listed(types)))
    return df


def between_ts(df: DataFrame, column: str, **bounds) -> DataFrame:
    """Keep rows within ``gt``, ``gte``, ``lt`` and ``lte`` bounds on ``column``."""
    tests = {
        "gt": lambda c, v: c > v,
        "gte": lambda c, v: c >= v,
        "lt": lambda c, v: c < v,
        "lte": lambda c, v: c <= v,
    }
    for suffix, value in bounds.items():
        if suffix not in RANGE_SUFFIXES:
            raise ValueError(f"unknown range suffix {suffix!r}")
        if value is not None:
            df = df.where(tests[suffix](F.col(column), F.lit(value)))
    return df


def apply_params(df: DataFrame, params: dict) -> DataFrame:
    """Range and equality parameters such as ``{"filing_date.gte": "2024-01-01"}``.

    ``__`` may stand for the dot.
    """
    for name, value in params.items():
        column, _, suffix = name.replace("__", ".").partition(".")
        if suffix:
            df = between_ts(df, column, **{suffix: value})
        else:
            df = df.where(F.col(column) == F.lit(value))
    return df


def in_window(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Keep rows from ``start`` to ``end``, both included; unset bounds are open."""
    return between_ts(df, column, gte=start, lte=end)


def in_day(ns: Column, day: Column) -> Column:
    """True within a UTC day, the next midnight included."""
    start = sc.date_to_ns(day)
    return (ns >= start) & (ns <= start + F.lit(sc.DAY_NS))


def day_ns_range(df: DataFrame, date: str) -> DataFrame:
    """Add ``start_ns`` and ``end_ns`` (the next midnight) of a date column."""
    start = sc.date_to_ns(date)
    return df.withColumn("start_ns", start).withColumn("end_ns", start + F.lit(sc.DAY_NS))


def filter_earnings(
    df: DataFrame, windows: DataFrame, date: str = "file_date", ticker: str = "ticker"
) -> DataFrame:
    """Rows whose ticker has an earnings window on the row's date.

    ``windows`` is (ticker, snapshot_date). Dates without a window are left out first:
    their partitions are not opened.
    """
    windows = dated(windows)
    df = on_dates(df, date, windows, "snapshot_date")
    wanted = windows.select(
        F.col("snapshot_date").cast(df.schema[date].dataType).alias(date),
        F.col("ticker").alias("_ticker"),
    )
    return df.join(
        wanted, (df[date] == wanted[date]) & (df[ticker] == wanted["_ticker"]), "left_semi"
    )


def filter_option_earnings(
    df: DataFrame, windows: DataFrame, date: str = "file_date", ticker: str = "ticker"
) -> DataFrame:
    """As :func:`filter_earnings`, by the underlying of an option ticker."""
    keyed = df.withColumn("_underlying", sc.option_underlying(ticker))
    return filter_earnings(keyed, windows, date, "_underlying").drop("_underlying")


def schema_diff(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Declared columns the data lacks and data columns not declared: (side, field)."""
    have, want = set(df.columns), set(as_schema(schema).fieldNames())
    rows = [("missing_in_record", n) for n in sorted(want - have)]
    rows += [("missing_in_schema", n) for n in sorted(have - want)]
    return df.sparkSession.createDataFrame(rows, "side string, field string")


def record_drift(records: DataFrame, schema: T.StructType | str, record: str = "record") -> DataFrame:
    """As :func:`schema_diff` for landed records: fields by side, with record counts."""
    names = F.array(*[F.lit(n) for n in as_schema(schema).fieldNames()])
    keys = F.map_keys(F.try_variant_get(record, "$", "map<string,variant>"))
    missing = F.transform(
        F.array_except(names, keys),
        lambda n: F.struct(F.lit("missing_in_record").alias("side"), n.alias("field")),
    )
    extra = F.transform(
        F.array_except(keys, names),
        lambda n: F.struct(F.lit("missing_in_schema").alias("side"), n.alias("field")),
    )
    return (
        records.select(F.inline(F.concat(missing, extra)))
        .groupBy("side", "field")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def live_contracts(contracts: DataFrame, first_window: DataFrame) -> DataFrame:
    """Contracts not expired before their underlying's first earnings window.

    ``first_window`` is (ticker, first_date), one row per underlying. A contract
    without an expiry is kept, one whose underlying has no window is not.
    """
    first = first_window.select(
        F.col("ticker").alias("underlying_ticker"), F.col("first_date").alias("_first")
    )
    return (
        contracts.join(first, "underlying_ticker")
        .where(F.col("expiration_date").isNull() | (F.col("expiration_date") >= F.col("_first")))
        .drop("_first")
    )
