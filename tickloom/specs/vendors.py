"""Tables stored as their publishers give them: ratings, funds, macro, spending."""

from __future__ import annotations

from tickloom.specs.base import TableSpec, each, spec

# --- fixed values -----------------------------------------------------------
ANALYST_DETAILS = (
    "benzinga_id string, benzinga_firm_id string, firm_name string, full_name string, "
    "last_updated timestamp, "
    + each(
        "double",
        "overall_avg_return overall_avg_return_percentile overall_success_rate "
        "smart_score total_ratings total_ratings_percentile",
    )
)
FIRM_DETAILS = "benzinga_id string, currency string, last_updated timestamp, name string"
CONSENSUS = (
    "ticker string, buy_ratings bigint, consensus_price_target double, "
    "consensus_rating string, consensus_rating_value double, high_price_target double, "
    "hold_ratings bigint, low_price_target double, price_target_contributors bigint, "
    "ratings_contributors bigint, sell_ratings bigint, strong_buy_ratings bigint, "
    "strong_sell_ratings bigint"
)
ANALYST_INSIGHTS = (
    "benzinga_id string, benzinga_firm_id string, benzinga_rating_id string, "
    "company_name string, date date, firm string, insight string, last_updated timestamp, "
    "price_target double, rating string, rating_action string, ticker string"
)
ANALYST_RATINGS = (
    "adjusted_price_target double, "
    + each(
        "string",
        "analyst benzinga_analyst_id benzinga_calendar_url benzinga_firm_id benzinga_id "
        "benzinga_news_url company_name currency",
    )
    + ", date date, firm string, importance bigint, last_updated timestamp, notes string, "
    "previous_adjusted_price_target double, previous_price_target double, "
    "previous_rating string, price_percent_change double, price_target double, "
    "price_target_action string, rating string, rating_action string, ticker string, "
    "time string"
)
BULLS_BEARS = (
    "bear_case string, benzinga_id string, bull_case string, last_updated timestamp, "
    "ticker string"
)
GUIDANCE = (
    "benzinga_id string, company_name string, currency string, date date, "
    "eps_method string, estimated_eps_guidance double, estimated_revenue_guidance double, "
    "fiscal_period string, fiscal_year bigint, importance bigint, last_updated timestamp, "
    + each(
        "double",
        "max_eps_guidance max_revenue_guidance min_eps_guidance min_revenue_guidance",
    )
    + ", notes string, positioning string, "
    + each(
        "double",
        "previous_max_eps_guidance previous_max_revenue_guidance "
        "previous_min_eps_guidance previous_min_revenue_guidance",
    )
    + ", release_type string, revenue_method string, ticker string, time string"
)
EARNINGS = (
    "actual_eps double, actual_revenue double, benzinga_id string, company_name string, "
    "currency string, date date, date_status string, eps_method string, "
    "eps_surprise double, eps_surprise_percent double, estimated_eps double, "
    "estimated_revenue double, fiscal_period string, fiscal_year bigint, "
    "importance bigint, last_updated timestamp, notes string, previous_eps double, "
    "previous_revenue double, revenue_method string, revenue_surprise double, "
    "revenue_surprise_percent double, ticker string, time string"
)
NEWS_WIRE = (
    "author string, benzinga_id bigint, body string, channels array<string>, "
    "images array<string>, last_updated timestamp, published timestamp, "
    "tags array<string>, teaser string, tickers array<string>, title string, url string"
)
CORPORATE_EVENTS = (
    "company_name string, date date, isin string, name string, status string, "
    "ticker string, tmx_company_id bigint, tmx_record_id string, trading_venue string, "
    "type string, url string"
)
FUND_CONSTITUENTS = (
    "_surrogate_key string, asset_class string, composite_ticker string, "
    "constituent_name string, constituent_rank bigint, constituent_ticker string, "
    "country_of_exchange string, currency_traded string, effective_date date, "
    "exchange string, figi string, isin string, market_value double, "
    "processed_date date, security_type string, sedol string, shares_held double, "
    "us_code string, weight double"
)
FUND_CONSTITUENT_IDENTITY = (
    "composite_ticker constituent_ticker constituent_name constituent_rank isin figi "
    "sedol us_code effective_date"
)
FUND_FLOWS = (
    "composite_ticker string, effective_date date, fund_flow double, nav double, "
    "processed_date date, shares_outstanding double"
)
FUND_ANALYTICS = (
    "composite_ticker string, effective_date date, processed_date date, "
    + each(
        "double",
        "quant_composite_behavioral quant_composite_fundamental quant_composite_global "
        "quant_composite_quality quant_composite_sentiment quant_composite_technical "
        "quant_fundamental_div quant_fundamental_pb quant_fundamental_pcf "
        "quant_fundamental_pe quant_global_country quant_global_sector",
    )
    + ", quant_grade string, "
    + each(
        "double",
        "quant_quality_diversification quant_quality_firm quant_quality_liquidity "
        "quant_sentiment_iv quant_sentiment_pc quant_sentiment_si quant_technical_it "
        "quant_technical_lt quant_technical_st quant_total_score reward_score risk_country "
        "risk_deviation risk_efficiency risk_liquidity risk_structure risk_total_score "
        "risk_volatility",
    )
)
_EXPOSURE = "array<struct<key: string, value: double>>"
FUND_PROFILES = (
    "administrator string, advisor string, asset_class string, aum double, "
    "avg_daily_trading_volume double, bid_ask_spread double, call_volume double, "
    f"category string, composite_ticker string, coupon_exposure {_EXPOSURE}, "
    f"creation_fee double, creation_unit_size double, currency_exposure {_EXPOSURE}, "
    "custodian string, description string, development_class string, "
    "discount_premium double, distribution_frequency string, distributor string, "
    "effective_date date, fee_waivers double, fiscal_year_end string, focus string, "
    f"futures_commission_merchant string, geographic_exposure {_EXPOSURE}, "
    f"inception_date date, industry_exposure {_EXPOSURE}, "
    f"industry_group_exposure {_EXPOSURE}, issuer string, lead_market_maker string, "
    "leverage_style string, levered_amount double, listing_exchange string, "
    "management_classification string, management_fee double, "
    f"maturity_exposure {_EXPOSURE}, net_expenses double, num_holdings double, "
    "options_available bigint, options_volume double, other_expenses double, "
    "portfolio_manager string, primary_benchmark string, processed_date date, "
    "product_type string, put_call_ratio double, put_volume double, region string, "
    f"sector_exposure {_EXPOSURE}, short_interest double, subadvisor string, "
    f"subindustry_exposure {_EXPOSURE}, tax_classification string, "
    "total_expenses double, transfer_agent string, trustee string"
)
FUND_TAXONOMIES = ", ".join(
    (
        each(
            "string",
            "asset_class category composite_ticker country credit_quality_rating description "
            "development_class duration",
        ),
        "effective_date date",
        each(
            "string",
            "esg exposure_mechanism factor focus hedge_reset holdings_disclosure_frequency",
        ),
        "inception_date date",
        each("string", "isin issuer leverage_reset leverage_style"),
        "levered_amount double",
        each(
            "string",
            "management_classification management_style maturity objective primary_benchmark",
        ),
        "processed_date date",
        each(
            "string",
            "product_type rebalance_frequency reconstitution_frequency region "
            "secondary_objective selection_methodology selection_universe strategic_focus "
            "targeted_focus tax_classification us_code weighting_methodology",
        ),
    )
)
TREASURY_YIELDS = "date date, " + each(
    "double",
    "yield_1_month yield_3_month yield_6_month yield_1_year yield_2_year yield_3_year "
    "yield_5_year yield_7_year yield_10_year yield_20_year yield_30_year",
)
INFLATION = "date date, " + each(
    "double", "cpi cpi_core cpi_year_over_year pce pce_core pce_spending"
)
INFLATION_EXPECTATIONS = "date date, " + each(
    "double",
    "market_5_year market_10_year model_1_year model_5_year model_10_year model_30_year "
    "forward_years_5_to_10",
)
LABOR_MARKET = "date date, " + each(
    "double",
    "unemployment_rate job_openings labor_force_participation_rate avg_hourly_earnings",
)
MERCHANT_AGGREGATES = (
    "channel string, consumer_type string, eight_day_rolling_category_accounts bigint, "
    "eight_day_rolling_total_accounts bigint, mcc_group string, merchant_industry string, "
    "merchant_ticker string, name string, parent_name string, published_date date, "
    "spend_in_distinct_account_key_count bigint, spend_in_spend double, "
    "spend_in_transaction_count bigint, spend_out_distinct_account_key_count bigint, "
    "spend_out_spend double, spend_out_transaction_count bigint, total_accounts bigint, "
    "total_spend double, total_transactions bigint, transaction_currency string, "
    "transaction_date date, twenty_eight_day_rolling_category_accounts bigint, "
    "twenty_eight_day_rolling_total_accounts bigint, type string, user_country string"
)
MERCHANT_HIERARCHY = "active_from date, active_to date, " + each(
    "string",
    "category grandparent_name grandparent_ticker great_grandparent_name "
    "great_grandparent_ticker industry industry_group listing_status lookup_name "
    "normalized_name parent_name parent_ticker sector sub_industry ticker",
)
# ---------------------------------------------------------------------------


def vendor_tables() -> list[TableSpec]:
    """All tables of this module."""
    fund = "composite_ticker effective_date"
    return [
        spec("benzinga_analyst_details", "benzinga_id", ANALYST_DETAILS),
        spec("benzinga_firm_details", "benzinga_id", FIRM_DETAILS),
        spec("benzinga_consensus_ratings", "ticker", CONSENSUS),
        spec("benzinga_analyst_insights", "benzinga_id", ANALYST_INSIGHTS, "last_updated"),
        spec("benzinga_analyst_ratings", "benzinga_id", ANALYST_RATINGS, "last_updated"),
        spec("benzinga_bulls_bears_say", "benzinga_id", BULLS_BEARS, "last_updated"),
        spec("benzinga_corporate_guidance", "benzinga_id", GUIDANCE, "last_updated"),
        spec("benzinga_earnings", "benzinga_id ticker last_updated", EARNINGS, "last_updated"),
        spec("benzinga_news", "benzinga_id", NEWS_WIRE, "published"),
        spec("tmx_corporate_events", "tmx_record_id", CORPORATE_EVENTS, "date"),
        spec(
            "etf_global_constituents",
            "_surrogate_key",
            FUND_CONSTITUENTS,
            "processed_date",
            FUND_CONSTITUENT_IDENTITY,
        ),
        spec("etf_global_fund_flows", fund, FUND_FLOWS, "processed_date"),
        spec("etf_global_analytics", fund, FUND_ANALYTICS, "processed_date"),
        spec("etf_global_profiles", fund, FUND_PROFILES, "processed_date"),
        spec("etf_global_taxonomies", fund, FUND_TAXONOMIES, "processed_date"),
        spec("treasury_yields", "date", TREASURY_YIELDS, "date"),
        spec("inflation", "date", INFLATION, "date"),
        spec("inflation_expectations", "date", INFLATION_EXPECTATIONS, "date"),
        spec("labor_market", "date", LABOR_MARKET, "date"),
        spec(
            "merchant_aggregates",
            "transaction_date name user_country channel consumer_type",
            MERCHANT_AGGREGATES,
            "transaction_date",
        ),
        spec("merchant_hierarchy", "lookup_name active_from active_to", MERCHANT_HIERARCHY),
    ]
