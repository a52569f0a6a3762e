"""Reference tables: tickers, contracts, exchanges, calendars, corporate actions."""

from __future__ import annotations

from tickloom.specs.base import TableSpec, each, nested, spec
from tickloom.specs.markets import for_options

# --- fixed values -----------------------------------------------------------
TICKERS = (
    "cik string, ticker string, name string, source_feed string, active boolean, "
    + each(
        "string",
        "currency_symbol currency_name base_currency_symbol composite_figi "
        "base_currency_name delisted_utc last_updated_utc locale market "
        "primary_exchange share_class_figi type",
    )
)
PAIR_TICKERS = (
    "ticker string, name string, source_feed string, active boolean, "
    + each(
        "string",
        "market locale currency_symbol currency_name base_currency_symbol "
        "base_currency_name last_updated_utc delisted_utc",
    )
)
INDEX_TICKERS = (
    "ticker string, name string, source_feed string, active boolean, "
    + each(
        "string",
        "market locale type primary_exchange currency_name last_updated_utc delisted_utc",
    )
)
TICKER_DETAILS = ", ".join(
    (
        "active boolean",
        nested(
            "address",
            "address1 string, address2 string, city string, postal_code string, state string",
        ),
        nested("branding", "icon_url string, logo_url string"),
        each("string", "cik composite_figi currency_name delisted_utc description homepage_url"),
        "list_date date, locale string, market string, market_cap double",
        each("string", "name phone_number primary_exchange"),
        "round_lot double, share_class_figi string, share_class_shares_outstanding double",
        each("string", "sic_code sic_description ticker ticker_root ticker_suffix"),
        "total_employees double, type string, weighted_shares_outstanding double",
        each("string", "base_currency_name base_currency_symbol currency_symbol cusip"),
        "last_updated_utc timestamp",
    )
)
TICKER_TYPES = each("string", "asset_class code description locale")
EXCHANGES = "id bigint, " + each(
    "string", "type asset_class locale name acronym mic operating_mic participant_id url"
)
_RULES = "updates_high_low: boolean, updates_open_close: boolean, updates_volume: boolean"
CONDITION_CODES = ", ".join(
    (
        "id bigint, abbreviation string, asset_class string, data_types array<string>",
        "description string, exchange bigint, legacy boolean, name string",
        "sip_mapping map<string,string>, type string",
        f"update_rules struct<consolidated: struct<{_RULES}>, market_center: struct<{_RULES}>>",
    )
)
_ADDITIONAL = (
    "additional_underlyings array<struct<amount: double, type: string, underlying: string>>"
)
CONTRACTS = (
    "ticker string, contract_type string, expiration_date string, strike_price double, "
    "underlying_ticker string, exercise_style string, shares_per_contract double, "
    f"cfi string, correction bigint, primary_exchange string, {_ADDITIONAL}"
)
CONTRACT_OVERVIEW = (
    "contract_type string, exercise_style string, expiration_date string, "
    "strike_price double, shares_per_contract double, primary_exchange string, "
    f"cfi string, correction bigint, {_ADDITIONAL}"
)
FUTURES_CONTRACTS = (
    "ticker string, name string, active boolean, date date, type string, "
    "product_code string, group_code string, trading_venue string, first_trade_date date, "
    "last_trade_date date, settlement_date date, days_to_maturity bigint, "
    "trade_tick_size double, spread_tick_size double, settlement_tick_size double, "
    "min_order_quantity bigint, max_order_quantity bigint"
)
FUTURES_PRODUCTS = (
    "product_code string, name string, date date, "
    + each(
        "string",
        "type asset_class asset_sub_class sector sub_sector trading_venue "
        "settlement_currency_code trade_currency_code settlement_method settlement_type "
        "price_quotation unit_of_measure",
    )
    + ", unit_of_measure_qty double, last_updated string"
)
FUTURES_SCHEDULES = (
    "product_code string, product_name string, trading_venue string, "
    "session_end_date date, event string, timestamp string"
)
FUTURES_EXCHANGES = each("string", "id acronym name mic operating_mic locale type url")
FUTURES_STATUS = (
    "product_code string, name string, market_event string, session_end_date date, "
    "timestamp string, trading_venue string"
)
HOLIDAYS = "close string, date date, exchange string, name string, open string, status string"
MARKET_STATUS = ", ".join(
    (
        "after_hours boolean",
        nested("currencies", "crypto string, fx string"),
        "early_hours boolean",
        nested("exchanges", "nasdaq string, nyse string, otc string"),
        nested(
            "indices_groups",
            "cccy string, cgi string, dow_jones string, ftse_russell string, msci string, "
            "mstar string, mstarc string, nasdaq string, s_and_p string, "
            "societe_generale string",
        ),
        "market string, server_time timestamp",
    )
)
IPOS = (
    "announced_date date, currency_code string, final_issue_price double, "
    "highest_offer_price double, ipo_status string, isin string, issuer_name string, "
    "last_updated timestamp, listing_date date, lot_size bigint, lowest_offer_price double, "
    "max_shares_offered bigint, min_shares_offered bigint, primary_exchange string, "
    "security_description string, security_type string, shares_outstanding bigint, "
    "ticker string, total_offer_size double, us_code string"
)
IPO_STATUSES = (
    "direct_listing_process", "history", "new", "pending", "postponed", "rumor", "withdrawn",
)
SPLITS_OLD = (
    "id string, execution_date date, split_from double, split_to double, ticker string"
)
SPLITS = (
    "id string, ticker string, execution_date date, split_from double, split_to double, "
    "adjustment_type string, historical_adjustment_factor double"
)
_DIVIDEND = (
    "id string, ticker string, ex_dividend_date date, declaration_date date, "
    "pay_date date, record_date date, currency string, cash_amount double"
)
DIVIDENDS_OLD = _DIVIDEND + ", dividend_type string, frequency bigint"
DIVIDENDS = (
    _DIVIDEND + ", distribution_type string, frequency bigint, "
    "historical_adjustment_factor double, split_adjusted_cash_amount double"
)
TICKER_EVENTS = (
    "ticker string, name string, composite_figi string, cik string, "
    "events array<struct<date: date, type: string, ticker_change: variant>>"
)
# ---------------------------------------------------------------------------


def reference_tables() -> list[TableSpec]:
    """All tables of this module."""
    codes = "id asset_class type"
    return [
        spec("all_tickers", "ticker", TICKERS),
        spec("stock_tickers", "ticker", TICKERS),
        spec("crypto_tickers", "ticker", PAIR_TICKERS),
        spec("forex_tickers", "ticker", PAIR_TICKERS),
        spec("indices_tickers", "ticker", INDEX_TICKERS),
        *[
            spec(f"{market}_ticker_details", "ticker", TICKER_DETAILS)
            for market in ("stock", "crypto", "forex", "indices")
        ],
        spec("ticker_types", "code", TICKER_TYPES),
        spec("stock_ticker_types", "code", TICKER_TYPES),
        spec("exchanges", "id", EXCHANGES),
        spec("stock_exchanges", "id", EXCHANGES),
        spec("options_exchanges", "id", EXCHANGES),
        spec("condition_codes", codes, CONDITION_CODES),
        spec("stock_condition_codes", codes, CONDITION_CODES),
        spec("options_condition_codes", codes, CONDITION_CODES),
        spec("stock_related_tickers", "ticker", "ticker string"),
        spec("options_contracts", "ticker", CONTRACTS),
        spec("active_options_contracts", "ticker", CONTRACTS),
        for_options(
            spec("options_contract_overview", "ticker", "ticker string, " + CONTRACT_OVERVIEW)
        ),
        spec("futures_contracts", "ticker date", FUTURES_CONTRACTS, "date"),
        spec("futures_products", "product_code date", FUTURES_PRODUCTS, "date"),
        spec("futures_schedules", "product_code session_end_date event", FUTURES_SCHEDULES),
        spec("futures_exchanges", "id", FUTURES_EXCHANGES),
        spec(
            "futures_market_status", "product_code session_end_date market_event", FUTURES_STATUS
        ),
        spec("market_holidays", "date exchange name", HOLIDAYS),
        spec("market_status", "server_time", MARKET_STATUS),
        spec("stock_ipos", "listing_date ticker", IPOS, "listing_date"),
        spec("stock_splits_deprecated", "id", SPLITS_OLD, "execution_date"),
        spec("stock_splits", "id", SPLITS, "execution_date"),
        spec("stock_dividends_deprecated", "id", DIVIDENDS_OLD, "ex_dividend_date"),
        spec("stock_dividends", "id", DIVIDENDS, "ex_dividend_date"),
        spec("stock_ticker_events", "ticker", TICKER_EVENTS),
    ]
