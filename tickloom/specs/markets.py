"""Tables that exist once per market: built from a rule over markets and sizes."""

from __future__ import annotations

from tickloom.specs.base import TableSpec, each, nested, spec

# --- fixed values -----------------------------------------------------------
# Bar and snapshot sizes, and which markets have which tables.
BAR_SIZES = ("1_second", "1_minute", "5_minute", "1_hour", "1_day", "1_week", "1_month")
FINE_BAR_SIZES = (
    "1_second", "30_second", "1_minute", "5_minute", "30_minute",
    "1_hour", "1_day", "1_week", "1_month",
)
SNAPSHOT_SIZES = ("1_second", "30_second", "1_minute", "5_minute", "30_minute", "1_hour")
FLAT_SNAPSHOT_SIZES = ("1_second", "30_second", "1_minute", "5_minute", "30_minute")
BAR_MARKETS = {
    "stock": FINE_BAR_SIZES,
    "options": FINE_BAR_SIZES,
    "crypto": BAR_SIZES,
    "forex": BAR_SIZES,
    "indices": BAR_SIZES,
    "futures": BAR_SIZES,
}
INDICATOR_MARKETS = ("stock", "options", "crypto", "forex", "indices")

OHLC = each("double", "open high low close")
OHLCV = OHLC + ", volume double, decimal_volume string, vwap double"
BARS = (
    f"timestamp timestamp, ticker string, {OHLCV}, transactions bigint, "
    "source_feed string, otc boolean, active boolean"
)
OPTION_BARS = (
    f"timestamp timestamp, ticker string, {OHLC}, volume double, vwap double, "
    "transactions bigint, source_feed string, expired boolean"
)
FUTURE_BARS = (
    f"window_start bigint, ticker string, {OHLC}, volume bigint, transactions bigint, "
    "settlement_price double, session_end_date date, dollar_volume double, active boolean"
)
MARKET_SUMMARY = (
    f"ticker string, timestamp timestamp, {OHLCV}, transactions bigint, otc boolean"
)
TICKER_SUMMARY = (
    f"ticker string, `from` date, {OHLC}, volume double, decimal_volume string, "
    "otc boolean, pre_market double, after_hours double"
)
PREVIOUS_DAY = (
    f"ticker string, timestamp timestamp, {OHLCV}, transactions double, otc boolean"
)
TRADES = (
    "id string, ticker string, sip_timestamp bigint, participant_timestamp bigint, "
    "price double, size double, decimal_size string, tape bigint, sequence_number bigint, "
    "conditions array<bigint>, correction bigint, trf_id bigint, trf_timestamp bigint, "
    "exchange bigint"
)
LAST_TRADE = (
    "ticker string, trf_timestamp bigint, sequence_number bigint, sip_timestamp bigint, "
    "participant_timestamp bigint, conditions array<bigint>, correction bigint, id string, "
    "price double, trf_id bigint, size double, decimal_size string, exchange bigint, "
    "tape bigint"
)
QUOTES = (
    "ticker string, ask_exchange bigint, ask_price double, ask_size double, "
    "bid_exchange bigint, bid_price double, bid_size double, conditions array<bigint>, "
    "indicators array<bigint>, participant_timestamp bigint, sequence_number bigint, "
    "sip_timestamp bigint, tape bigint, trf_timestamp bigint"
)
LAST_QUOTE = (
    "ticker string, trf_timestamp bigint, sequence_number bigint, sip_timestamp bigint, "
    "participant_timestamp bigint, ask_price double, ask_size bigint, ask_exchange bigint, "
    "conditions array<bigint>, indicators array<bigint>, bid_price double, bid_size bigint, "
    "bid_exchange bigint, tape bigint"
)
# The published option trades lack ``id``, which is part of their key.
OPTION_TRADES = (
    "option_ticker string, underlying_ticker string, conditions array<bigint>, "
    "correction bigint, exchange bigint, participant_timestamp bigint, price double, "
    "sip_timestamp bigint, size double, id string"
)
OPTION_QUOTES = (
    "option_ticker string, underlying_ticker string, ask_exchange bigint, ask_price double, "
    "ask_size double, bid_exchange bigint, bid_price double, bid_size double, "
    "sequence_number bigint, sip_timestamp bigint"
)
FUTURE_TRADES = (
    "ticker string, timestamp bigint, price double, size double, sequence_number bigint, "
    "report_sequence bigint, session_end_date date"
)
FUTURE_QUOTES = (
    "ticker string, timestamp bigint, ask_price double, ask_size double, "
    "ask_timestamp bigint, bid_price double, bid_size double, bid_timestamp bigint, "
    "sequence_number bigint, report_sequence bigint, session_end_date date"
)
INDICATOR = (
    "timestamp timestamp, underlying_timestamp timestamp, ticker string, indicator string, "
    "series_window_timespan string, value double, underlying_ticker string, "
    + each(
        "double",
        "underlying_open underlying_high underlying_low underlying_close "
        "underlying_volume underlying_vwap",
    )
    + ", underlying_transactions bigint"
)
MACD_FIELDS = ", signal double, histogram double"

# Flat files.
FLAT_BARS = (
    "file_date string, ticker string, window_start bigint, open double, close double, "
    "high double, low double, volume double, vwap double, transactions bigint, otc boolean"
)
FLAT_TRADES = (
    "file_date string, ticker string, sip_timestamp bigint, participant_timestamp bigint, "
    "trf_timestamp bigint, sequence_number bigint, id string, price double, size double, "
    "conditions string, correction bigint, exchange bigint, tape bigint, trf_id bigint"
)
FLAT_QUOTES = (
    "file_date string, ticker string, sip_timestamp bigint, participant_timestamp bigint, "
    "trf_timestamp bigint, sequence_number bigint, ask_exchange bigint, ask_price double, "
    "ask_size double, bid_exchange bigint, bid_price double, bid_size double, "
    "conditions string, indicators string, tape bigint"
)
FLAT_OPTION_QUOTES = (
    "file_date string, ticker string, sip_timestamp bigint, sequence_number bigint, "
    "ask_exchange bigint, ask_price double, ask_size double, bid_exchange bigint, "
    "bid_price double, bid_size double"
)
FLAT_CRYPTO_TRADES = (
    "file_date string, ticker string, participant_timestamp bigint, id string, "
    "price double, size double, conditions string, exchange bigint"
)
FLAT_FOREX_QUOTES = (
    "file_date string, ticker string, participant_timestamp bigint, ask_price double, "
    "bid_price double, exchange bigint"
)
FLAT_INDEX_VALUES = "file_date string, ticker string, timestamp bigint, value double"
FLAT_OPTION_BARS = (
    "file_date string, ticker string, asof_timestamp bigint, sip_timestamp bigint, "
    "sequence_number bigint, ask_exchange bigint, ask_price double, ask_size double, "
    "bid_exchange bigint, bid_price double, bid_size double"
)
SIP_KEY = "file_date ticker sip_timestamp sequence_number"
# Market, whether it has an earnings subset, and its (table, key, schema) files.
FLAT_FILES = {
    "stocks": (True, (("trades", SIP_KEY, FLAT_TRADES), ("quotes", SIP_KEY, FLAT_QUOTES))),
    "options": (
        True,
        (
            ("trades", "file_date ticker sip_timestamp", FLAT_TRADES),
            ("quotes", SIP_KEY, FLAT_OPTION_QUOTES),
        ),
    ),
    "indices": (False, (("values", "file_date ticker timestamp", FLAT_INDEX_VALUES),)),
    "forex": (
        False,
        (("quotes", "file_date ticker participant_timestamp", FLAT_FOREX_QUOTES),),
    ),
    "crypto": (
        False,
        (("trades", "file_date ticker participant_timestamp id", FLAT_CRYPTO_TRADES),),
    ),
    "futures": (
        False,
        (("trades", SIP_KEY, FLAT_TRADES), ("quotes", SIP_KEY, FLAT_QUOTES)),
    ),
}

# Snapshots.
_DAY = each("double", "open high low close volume vwap")
_MINUTE = _DAY + ", accumulated_volume double, timestamp bigint, transactions bigint"
_TICK_TAIL = (
    "correction bigint, trf_timestamp bigint, sequence_number bigint, trf_id bigint, "
    "participant_timestamp bigint, tape bigint, ticker string"
)
_CHANGES = "ticker string, todays_change double, todays_change_percent double, updated bigint"
_STOCK_DAY = OHLCV + ", otc boolean"
_STOCK_MINUTE = (
    OHLCV + ", accumulated_volume double, decimal_accumulated_volume string, "
    "timestamp bigint, transactions bigint, otc boolean"
)
_QUOTE_TAIL = (
    "timestamp bigint, exchange bigint, ask_exchange bigint, bid_exchange bigint, "
    "indicators array<bigint>, conditions array<bigint>, sequence_number bigint, "
    "participant_timestamp bigint, trf_timestamp bigint, tape bigint, ticker string"
)
STOCK_SNAPSHOT = ", ".join(
    (
        _CHANGES,
        "fmv double",
        nested("day", _STOCK_DAY),
        nested("min", _STOCK_MINUTE),
        nested("prev_day", _STOCK_DAY),
        nested(
            "last_quote",
            "ask_price double, ask_size bigint, bid_price double, bid_size bigint, "
            + _QUOTE_TAIL,
        ),
        nested(
            "last_trade",
            "price double, size bigint, decimal_size string, timestamp bigint, "
            "conditions array<bigint>, id string, exchange bigint, " + _TICK_TAIL,
        ),
    )
)
FOREX_SNAPSHOT = ", ".join(
    (
        _CHANGES,
        "fmv double",
        nested("day", _DAY),
        nested("min", _MINUTE),
        nested("prev_day", _DAY),
        nested("last_quote", "ask_price double, bid_price double, " + _QUOTE_TAIL),
    )
)
CRYPTO_SNAPSHOT = ", ".join(
    (
        _CHANGES,
        "fmv double",
        nested("day", _DAY),
        nested("min", _MINUTE),
        nested("prev_day", _DAY),
        nested(
            "last_trade",
            "price double, size double, timestamp bigint, exchange bigint, "
            "conditions array<bigint>, id string, " + _TICK_TAIL,
        ),
    )
)
_OPEN = "day variant, min variant, prev_day variant"
STOCK_MARKET_SNAPSHOT = (
    f"{_CHANGES}, fmv double, {_OPEN}, last_quote variant, last_trade variant"
)
FOREX_MARKET_SNAPSHOT = f"{_CHANGES}, {_OPEN}, last_quote variant"
CRYPTO_MARKET_SNAPSHOT = f"{_CHANGES}, {_OPEN}, last_trade variant"
_MOVER_DAY = OHLC + ", volume bigint, decimal_volume string, vwap double"
MOVERS = ", ".join(
    (
        "updated bigint, ticker string, direction string",
        nested("day", _MOVER_DAY),
        nested(
            "last_quote",
            "ask_price double, ask_size bigint, bid_price double, bid_size bigint, "
            "timestamp bigint",
        ),
        nested(
            "last_trade",
            "conditions array<bigint>, id string, price double, size bigint, "
            "decimal_size string, timestamp bigint, exchange bigint",
        ),
        nested(
            "min",
            "accumulated_volume bigint, decimal_accumulated_volume string, "
            + _MOVER_DAY
            + ", transactions bigint, timestamp bigint",
        ),
        nested("prev_day", OHLC + ", volume bigint, vwap double"),
        "todays_change double, todays_change_percent double, fmv double",
    )
)
_SESSION_CHANGES = (
    "change change_percent early_trading_change early_trading_change_percent "
    "regular_trading_change regular_trading_change_percent late_trading_change "
    "late_trading_change_percent price open high low close previous_close volume"
)
_UNIFIED_QUOTE = "midpoint double, timeframe string, last_updated bigint"
STOCK_UNIFIED = ", ".join(
    (
        each("string", "ticker type name market_status error message"),
        "fmv double, fmv_last_updated bigint, timeframe string, last_updated bigint",
        nested(
            "last_minute",
            "close double, high double, low double, open double, transactions bigint, "
            "volume double, decimal_volume string, vwap double",
        ),
        nested(
            "session",
            ", ".join(f"{n} double" for n in _SESSION_CHANGES.split())
            + ", decimal_volume string",
        ),
        nested(
            "last_quote",
            "ask double, ask_exchange bigint, ask_size bigint, bid double, "
            "bid_exchange bigint, bid_size bigint, " + _UNIFIED_QUOTE,
        ),
        nested(
            "last_trade",
            "id string, price double, size bigint, decimal_size string, exchange bigint, "
            "conditions array<bigint>, timeframe string, last_updated bigint, "
            "participant_timestamp bigint, sip_timestamp bigint",
        ),
    )
)
_GREEKS = nested("greeks", "delta double, gamma double, theta double, vega double")
_OPTION_QUOTE = nested(
    "last_quote",
    "ask double, ask_size double, bid double, bid_size double, ask_exchange bigint, "
    "bid_exchange bigint, last_updated bigint, midpoint double, timeframe string",
)
_DETAILS = (
    "contract_type string, exercise_style string, expiration_date string, "
    "shares_per_contract double, strike_price double"
)
_UNDERLYING = nested(
    "underlying_asset",
    "ticker string, price double, change_to_break_even double, last_updated bigint, "
    "timeframe string, value double",
)
OPTION_SNAPSHOT = ", ".join(
    (
        "ticker string, break_even_price double, fmv double, fmv_last_updated bigint",
        "implied_volatility double, open_interest double",
        _GREEKS,
        _OPTION_QUOTE,
        nested(
            "last_trade",
            "price double, size bigint, exchange bigint, sip_timestamp bigint, "
            "conditions array<bigint>, timeframe string",
        ),
        nested(
            "day",
            ", ".join(
                f"{n} double"
                for n in "open high low close volume vwap change change_percent "
                "previous_close".split()
            )
            + ", last_updated bigint",
        ),
        nested("details", _DETAILS + ", ticker string"),
        _UNDERLYING,
    )
)
OPTION_UNIFIED = ", ".join(
    (
        each("string", "ticker type name market_status error message"),
        "break_even_price double, open_interest double, fmv double, fmv_last_updated bigint",
        "implied_volatility double, timeframe string, last_updated bigint",
        nested(
            "last_minute",
            "close double, high double, low double, open double, transactions bigint, "
            "volume double, vwap double",
        ),
        nested("session", ", ".join(f"{n} double" for n in _SESSION_CHANGES.split())),
        _OPTION_QUOTE,
        nested(
            "last_trade",
            "id string, price double, size bigint, exchange bigint, sip_timestamp bigint, "
            "participant_timestamp bigint, last_updated bigint, conditions array<bigint>, "
            "timeframe string",
        ),
        _GREEKS,
        nested("details", _DETAILS),
        _UNDERLYING,
    )
)
INDEX_SNAPSHOT = ", ".join(
    (
        "ticker string, name string, type string, market_status string, value double",
        "last_updated bigint, timeframe string",
        nested("session", OHLC + ", change double, change_percent double, previous_close double"),
        "error string, message string",
    )
)
FUTURE_SNAPSHOT = ", ".join(
    (
        "ticker string, product_code string",
        nested(
            "details",
            "ticker string, product_code string, open_interest double, settlement_date string",
        ),
        nested(
            "last_minute",
            "open double, high double, low double, close double, volume double, "
            "last_updated double, timeframe string",
        ),
        nested(
            "last_quote",
            "ask double, ask_size double, ask_timestamp double, bid double, bid_size double, "
            "bid_timestamp double, last_updated double, timeframe string",
        ),
        nested(
            "last_trade", "price double, size double, last_updated double, timeframe string"
        ),
        nested(
            "session",
            "open double, high double, low double, close double, volume double, "
            "change double, change_percent double, previous_settlement double, "
            "settlement_price double",
        ),
    )
)
CONVERSION = ", ".join(
    (
        "`from` string, `to` string, converted double, initial_amount double",
        nested("last", "ask double, bid double, exchange bigint, timestamp bigint"),
    )
)
# ---------------------------------------------------------------------------


def for_options(table: TableSpec) -> TableSpec:
    """The option form of a table: ``option_ticker`` with its underlying."""
    ddl = table.ddl.replace("ticker string", "option_ticker string", 1)
    keys = tuple("option_ticker" if k == "ticker" else k for k in table.primary_keys)
    if "underlying_ticker string" not in ddl:
        ddl += ", underlying_ticker string"
    return TableSpec(
        table.name,
        ddl,
        keys,
        table.replication_key,
        table.surrogate,
    )


def _bars() -> list[TableSpec]:
    out = []
    for market, sizes in BAR_MARKETS.items():
        for size in sizes:
            name = f"{market}_bars_{size}"
            if market == "futures":
                out.append(spec(name, "window_start ticker", FUTURE_BARS, "window_start"))
            elif market == "options":
                out.append(for_options(spec(name, "timestamp ticker", OPTION_BARS, "timestamp")))
            else:
                out.append(spec(name, "timestamp ticker", BARS, "timestamp"))
    return out


def _summaries() -> list[TableSpec]:
    out = [
        spec(f"{m}_daily_market_summary", "timestamp ticker", MARKET_SUMMARY, "timestamp")
        for m in ("stock", "crypto", "forex")
    ]
    for m in ("stock", "options", "crypto", "indices"):
        table = spec(f"{m}_daily_ticker_summary", "from ticker", TICKER_SUMMARY, "from")
        out.append(for_options(table) if m == "options" else table)
    for m in ("stock", "options", "crypto", "forex", "indices"):
        table = spec(f"{m}_previous_day_bar", "timestamp ticker", PREVIOUS_DAY, "timestamp")
        out.append(for_options(table) if m == "options" else table)
    return out


def _ticks() -> list[TableSpec]:
    trade_key, since = "ticker exchange id", "sip_timestamp"
    tick_key = "ticker sip_timestamp sequence_number"
    option_key = "option_ticker sip_timestamp sequence_number"
    future_key = "ticker timestamp sequence_number"
    return [
        spec("stock_trades", trade_key, TRADES, since),
        spec("crypto_trades", trade_key, TRADES, since),
        spec("options_trades", "option_ticker exchange id", OPTION_TRADES, since),
        spec("futures_trades", future_key, FUTURE_TRADES, "timestamp"),
        spec("stock_last_trade", tick_key, LAST_TRADE, since),
        spec("crypto_last_trade", tick_key, LAST_TRADE, since),
        for_options(spec("options_last_trade", tick_key, LAST_TRADE, since)),
        spec("stock_quotes", tick_key, QUOTES, since),
        spec("forex_quotes", tick_key, QUOTES, since),
        spec("options_quotes", option_key, OPTION_QUOTES, since),
        spec("futures_quotes", future_key, FUTURE_QUOTES, "timestamp"),
        spec("stock_last_quote", tick_key, LAST_QUOTE, since),
        spec("forex_last_quote", tick_key, LAST_QUOTE, since),
        spec("stock_earnings_quotes", tick_key, QUOTES, since),
        spec("options_earnings_quotes", option_key, OPTION_QUOTES, since),
    ]


def _indicators() -> list[TableSpec]:
    out = []
    keys = "timestamp ticker indicator series_window_timespan"
    for market in INDICATOR_MARKETS:
        for kind in ("sma", "ema", "macd", "rsi"):
            ddl = INDICATOR + (MACD_FIELDS if kind == "macd" else "")
            table = spec(f"{market}_{kind}", keys, ddl, "timestamp")
            out.append(for_options(table) if market == "options" else table)
    return out


def _quote_snapshots() -> list[TableSpec]:
    out = []
    keys, since = "ticker asof_timestamp", "asof_timestamp"
    sampled = QUOTES + ", asof_timestamp bigint"
    for kind in ("quote_snapshots", "earnings_quote_snapshots"):
        for size in SNAPSHOT_SIZES:
            out.append(spec(f"stock_{kind}_{size}", keys, sampled, since))
            out.append(for_options(spec(f"options_{kind}_{size}", keys, sampled, since)))
    for size in FLAT_SNAPSHOT_SIZES:
        name = f"options_quote_snapshots_flat_files_{size}"
        out.append(
            spec(name, "file_date ticker asof_timestamp", FLAT_OPTION_BARS, "file_date")
        )
    return out


def _flat_files() -> list[TableSpec]:
    out = []
    for market, (has_earnings, files) in FLAT_FILES.items():
        tables = (
            ("eod", "file_date ticker window_start", FLAT_BARS),
            ("1m", "file_date ticker window_start", FLAT_BARS),
            *files,
        )
        for kind, keys, ddl in tables:
            out.append(spec(f"{market}_flat_files_{kind}", keys, ddl, "file_date"))
            if has_earnings:
                name = f"{market}_earnings_flat_files_{kind}"
                out.append(spec(name, keys, ddl, "file_date"))
    return out


def _snapshots() -> list[TableSpec]:
    movers = [
        spec(f"{m}_top_market_movers", "updated ticker", MOVERS, "updated")
        for m in ("stock", "crypto", "forex")
    ]
    contract = for_options(spec("options_contract_snapshot", "ticker", OPTION_SNAPSHOT))
    return [
        *movers,
        spec("stock_ticker_snapshot", "ticker", STOCK_SNAPSHOT),
        spec("stock_full_market_snapshot", "ticker", STOCK_MARKET_SNAPSHOT),
        spec("stock_unified_snapshot", "ticker", STOCK_UNIFIED),
        spec("crypto_ticker_snapshot", "ticker", CRYPTO_SNAPSHOT),
        spec("crypto_full_market_snapshot", "ticker", CRYPTO_MARKET_SNAPSHOT),
        spec("forex_ticker_snapshot", "ticker", FOREX_SNAPSHOT),
        spec("forex_full_market_snapshot", "ticker", FOREX_MARKET_SNAPSHOT),
        spec("forex_currency_conversion", "from to", CONVERSION),
        spec("indices_snapshot", "ticker", INDEX_SNAPSHOT),
        spec("futures_contracts_snapshot", "ticker", FUTURE_SNAPSHOT),
        contract,
        spec("options_chain_snapshot", "ticker", OPTION_SNAPSHOT),
        spec("options_unified_snapshot", "ticker", OPTION_UNIFIED),
    ]


def market_tables() -> list[TableSpec]:
    """All tables of this module."""
    return [
        *_bars(),
        *_summaries(),
        *_ticks(),
        *_indicators(),
        *_quote_snapshots(),
        *_flat_files(),
        *_snapshots(),
    ]
