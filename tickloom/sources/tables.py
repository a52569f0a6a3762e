"""Any declared table from its landed pages, cleaned as the table asks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import scalars as sc
from tickloom.operators import project as pr
from tickloom.operators.asof import asof_in_one
from tickloom.operators.bars import TIMESPAN_NS
from tickloom.sources.landed import explode_results, read_records, record_names, record_time
from tickloom.specs import TABLES, TableSpec

# --- fixed values -----------------------------------------------------------
# Key of a record that holds the real records.
INNER = {
    "stock_ticker_snapshot": "ticker",
    "crypto_ticker_snapshot": "ticker",
    "forex_ticker_snapshot": "ticker",
    "stock_full_market_snapshot": "tickers",
    "crypto_full_market_snapshot": "tickers",
    "forex_full_market_snapshot": "tickers",
    "stock_top_market_movers": "tickers",
    "crypto_top_market_movers": "tickers",
    "forex_top_market_movers": "tickers",
    "market_holidays": "response",
}
# Text key parts that may be absent and then are the empty string.
BLANK_KEYS = {
    "stock_8k_disclosures": ["tertiary_category"],
    "stock_disclosure_categories": ["tertiary_category"],
    "stock_13f_filings": ["put_call"],
}
# Columns taken from an object when the record itself lacks them.
FROM_DETAILS = {
    "options_contract_snapshot": ("option_ticker",),
    "options_chain_snapshot": ("ticker",),
    "futures_contracts_snapshot": ("ticker", "product_code"),
}
# Codes inside snapshot objects, by the object's slug.
SNAPSHOT_OBJECTS = {
    "lastquote": pr.SNAPSHOT_QUOTE_CODES,
    "lasttrade": pr.SNAPSHOT_TRADE_CODES,
    "day": pr.SNAPSHOT_BAR_CODES,
    "min": pr.SNAPSHOT_BAR_CODES,
    "prevday": pr.SNAPSHOT_BAR_CODES,
    "lastminute": pr.SNAPSHOT_BAR_CODES,
}
CHANGE_CODES = {
    "todays_change_perc": "todays_change_percent",
    "todaysChangePerc": "todays_change_percent",
}
# Spacing of an indicator's bars by timespan, in nanoseconds, and how many of them one task
# matches of a ticker.
INDICATOR_NS = {
    **TIMESPAN_NS,
    "week": 7 * sc.DAY_NS, "month": 30 * sc.DAY_NS, "quarter": 91 * sc.DAY_NS, "year": 365 * sc.DAY_NS,
}
BUCKET_BARS = 4096
# What an indicator's bars hold beside their time.
BAR_FIELDS = {
    "ticker": "string", **dict.fromkeys(("open", "high", "low", "close", "volume", "vwap"), "double"),
    "transactions": "bigint",
}
# ---------------------------------------------------------------------------


def _codes(name: str) -> dict[str, str]:
    if "_bars_" in name or name.endswith(("_market_summary", "_previous_day_bar")):
        return pr.BAR_CODES
    if name.endswith("_last_trade"):
        return pr.LAST_TRADE_CODES
    if name.endswith("_last_quote"):
        return pr.LAST_QUOTE_CODES
    if name.endswith(("_snapshot", "_movers")):
        return CHANGE_CODES
    return {}


def record_codes(table: TableSpec) -> dict[str, str]:
    """Codes of a table's records; the ticker of an option contract's is the contract."""
    codes = _codes(table.name)
    if "option_ticker" not in table.primary_keys:
        return codes
    return {
        **{c: "option_ticker" if n == "ticker" else n for c, n in codes.items()},
        "ticker": "option_ticker",
    }


def nested_codes(table: TableSpec) -> dict[str, dict[str, str]] | None:
    """Codes inside the objects of a table's records, by the object's slug."""
    return SNAPSHOT_OBJECTS if table.name.endswith(("_snapshot", "_movers")) else None


def _quote_sides(df: DataFrame) -> DataFrame:
    """Settle the exchanges of ``last_quote``: one code is its single exchange.

    Read plainly, ``X`` and ``x`` are the ask and the bid side; that holds only
    where the record has both.
    """
    raw = F.coalesce(
        F.try_variant_get("record", "$['last_quote']", "variant"),
        F.try_variant_get("record", "$['lastQuote']", "variant"),
    )
    read = lambda key: F.try_variant_get(raw, f"$['{key}']", "bigint")
    upper, lower = read("X"), read("x")
    both = upper.isNotNull() & lower.isNotNull()
    lone = F.when(~both, F.coalesce(upper, lower))
    quote = (
        F.col("last_quote")
        .withField("ask_exchange", F.coalesce(read("ask_exchange"), F.when(both, upper)))
        .withField("bid_exchange", F.coalesce(read("bid_exchange"), F.when(both, lower)))
        .withField("exchange", F.coalesce(read("exchange"), lone))
    )
    return df.withColumn("last_quote", F.when(F.col("last_quote").isNotNull(), quote))


def _has_quote_sides(table: TableSpec) -> bool:
    kinds = {f.name: f.dataType for f in table.schema.fields}
    fields = getattr(kinds.get("last_quote"), "names", [])
    return {"ask_exchange", "bid_exchange", "exchange"} <= set(fields)


def load_table(
    pages: DataFrame,
    name: str,
    context: tuple[str, ...] = (),
    status: str | None = None,
) -> DataFrame:
    """Declared table ``name`` from landed ``pages`` (column ``payload``).

    ``context`` lists columns of ``pages`` known from the request rather than the
    record, such as the ticker. ``status`` is the configured active or expired flag
    of bars, used where the context has none.
    """
    table = TABLES[name]
    df = read_records(
        explode_results(pages, inner=INNER.get(name)),
        table.schema,
        record_codes(table),
        context,
        nested_codes(table),
        keep=("record",),
    )
    if _has_quote_sides(table):
        df = _quote_sides(df)
    for column in FROM_DETAILS.get(name, ()):
        leaf = "ticker" if column == "option_ticker" else column
        blank = not name.startswith("futures")
        df = pr.coalesce_nested(df, column, f"details.{leaf}", blank_is_missing=blank)
    df = cleaned(df, table, status)
    return df.select(*table.schema.fieldNames())


def cleaned(df: DataFrame, table: TableSpec, status: str | None = None) -> DataFrame:
    """The clean-ups of one table."""
    name, columns = table.name, table.schema.fieldNames()
    if "_bars_" in name:
        df = df.where(F.col(table.replication_key).isNotNull())
        flag, default = ("expired", False) if "expired" in columns else ("active", True)
        df = df.withColumn(flag, pr.resolve_status(F.col(flag), status, default))
    if "sip_mapping" in columns:
        df = pr.normalize_sip_mapping(df)
    if name == "stock_ipos":
        df = df.withColumn("ipo_status", F.lower("ipo_status"))
    if name in BLANK_KEYS:
        df = pr.fill_key(df, BLANK_KEYS[name])
    if table.surrogate:
        df = pr.with_surrogate_key(df, list(table.surrogate))
    if name.endswith("_trades") and "conditions array" in table.ddl:
        known = F.filter("conditions", lambda c: c.isNotNull())
        df = df.withColumn("conditions", known)
    return df


def load_indicator(
    pages: DataFrame, name: str, series: str, timespan: str, window: int
) -> DataFrame:
    """Indicator table from landed pages (payload and ticker).

    A page holds ``values`` and, under ``underlying``, the bars they were computed
    on. Each value is matched to the last bar at or before its time. Both leave a page
    together, so pages are read and parsed once, and share one shuffle.
    """
    table = TABLES[name]
    extra = [c for c in ("signal", "histogram") if c in table.schema.fieldNames()]

    def records(path: str) -> Column:
        """The records of a list, each as its keys; null for one that is no object."""
        each = F.transform(
            F.try_variant_get("record", path, "array<variant>"),
            lambda r: F.try_variant_get(r, "$", "map<string,variant>"),
        )
        # Opened in one step, unless one of them is no object.
        whole = F.try_variant_get("record", path, "array<map<string,variant>>")
        return F.coalesce(whole, each, F.array().cast("array<map<string,variant>>"))

    opened = (
        explode_results(pages, empty=True)
        .select("ticker", F.array(records("$.values"), records("$.underlying.aggregates")).alias("_lists"))
        .select("ticker", F.size(F.col("_lists")[0]).alias("_values"), F.flatten("_lists").alias("_lists"))
        .select("ticker", "_values", F.posexplode_outer("_lists").alias("_at", "_keys"))
        # Without "outer" a filter on the lists' size is added, for which they are built once more.
        .where(F.col("_at").isNotNull())
        .select("ticker", "_keys", (F.col("_at") < F.col("_values")).alias("_is_value"))
    )

    def read(column: str, kind: str, codes: dict[str, str]) -> Column:
        found = [F.try_element_at("_keys", F.lit(n)) for n in record_names(column, codes)]
        return F.coalesce(*[F.try_variant_get(v, "$", kind) for v in found])

    def either(value: Column, bar: Column) -> Column:
        return F.when(F.col("_is_value"), value).otherwise(bar)

    def when(kind: str) -> Column:
        return either(read("timestamp", kind, {}), read("timestamp", kind, pr.BAR_CODES))

    value = F.struct(*[read(c, "double", {}).alias(c) for c in ("value", *extra)])
    bar = F.struct(*[read(c, kind, pr.BAR_CODES).alias(c) for c, kind in BAR_FIELDS.items()])
    points = opened.select(
        "ticker", when("string").alias("_text"), when("bigint").alias("_epoch"),
        F.when(F.col("_is_value"), value).alias("_value"), F.when(~F.col("_is_value"), bar).alias("_bar"),
    ).select("ticker", record_time(F.col("_text"), F.col("_epoch")).alias("timestamp"), "_value", "_bar")
    bucket = BUCKET_BARS * INDICATOR_NS.get(timespan, INDICATOR_NS["day"])
    matched = asof_in_one(points, "ticker", "timestamp", "_value", "_bar", bucket)
    label = sc.series_label(F.lit(series), F.lit(timespan), F.lit(window))
    out = matched.select(
        "ticker", "timestamp", "_value.*", F.col("mark_time").alias("underlying_timestamp"),
        *[F.col(f"_bar.{c}").alias(f"underlying_{c}") for c in BAR_FIELDS],
    ).withColumns({"indicator": F.lit(name), "series_window_timespan": label})
    if "option_ticker" in table.primary_keys:
        out = out.withColumnRenamed("ticker", "option_ticker")
    return out.select(*table.schema.fieldNames())
