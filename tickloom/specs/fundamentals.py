"""Company fundamentals, filings and news."""

from __future__ import annotations

from tickloom.specs.base import TableSpec, each, spec

# --- fixed values -----------------------------------------------------------
_METRIC = (
    "struct<label: string, order: bigint, unit: string, value: double, source: string, "
    "derived_from: array<string>, formula: string, xpath: string>"
)
COMPREHENSIVE_INCOME = (
    "comprehensive_income_loss other_comprehensive_income_loss "
    "comprehensive_income_loss_attributable_to_parent "
    "comprehensive_income_loss_attributable_to_noncontrolling_interest "
    "other_comprehensive_income_loss_attributable_to_parent "
    "other_comprehensive_income_loss_attributable_to_noncontrolling_interest"
)
INCOME_METRICS = (
    "revenues cost_of_revenue gross_profit operating_expenses operating_income_loss "
    "income_loss_from_continuing_operations_before_tax "
    "income_loss_from_continuing_operations_after_tax net_income_loss "
    "net_income_loss_attributable_to_parent "
    "net_income_loss_attributable_to_noncontrolling_interest "
    "net_income_loss_available_to_common_stockholders_basic basic_earnings_per_share "
    "diluted_earnings_per_share basic_average_shares diluted_average_shares "
    "preferred_stock_dividends_and_other_adjustments "
    "participating_securities_distributed_and_undistributed_earnings_loss_basic "
    "benefits_costs_expenses depreciation_and_amortization "
    "income_tax_expense_benefit_current research_and_development costs_and_expenses "
    "income_loss_from_equity_method_investments income_tax_expense_benefit_deferred "
    "income_tax_expense_benefit other_operating_expenses interest_expense_operating "
    "income_loss_before_equity_method_investments "
    "selling_general_and_administrative_expenses "
    "income_loss_from_discontinued_operations_net_of_tax nonoperating_income_loss "
    "provision_for_loan_lease_and_other_losses "
    "interest_income_expense_after_provision_for_losses "
    "interest_income_expense_operating_net noninterest_income "
    "undistributed_earnings_loss_allocated_to_participating_securities_basic "
    "net_income_loss_attributable_to_nonredeemable_noncontrolling_interest "
    "interest_and_debt_expense other_operating_income_expenses "
    "net_income_loss_attributable_to_redeemable_noncontrolling_interest "
    "income_loss_from_discontinued_operations_net_of_tax_during_phase_out "
    "income_loss_from_discontinued_operations_net_of_tax_gain_loss_on_disposal "
    "common_stock_dividends interest_and_dividend_income_operating noninterest_expense "
    "income_loss_from_discontinued_operations_net_of_tax_"
    "provision_for_gain_loss_on_disposal "
    "income_loss_from_discontinued_operations_net_of_tax_"
    "adjustment_to_prior_year_gain_loss_on_disposal"
)
BALANCE_METRICS = (
    "assets current_assets noncurrent_assets liabilities current_liabilities "
    "noncurrent_liabilities equity equity_attributable_to_parent "
    "equity_attributable_to_noncontrolling_interest liabilities_and_equity "
    "other_current_liabilities wages intangible_assets prepaid_expenses "
    "noncurrent_prepaid_expenses fixed_assets other_noncurrent_assets "
    "other_current_assets accounts_payable long_term_debt inventory cash "
    "commitments_and_contingencies temporary_equity "
    "temporary_equity_attributable_to_parent accounts_receivable "
    "redeemable_noncontrolling_interest redeemable_noncontrolling_interest_preferred "
    "interest_payable redeemable_noncontrolling_interest_other "
    "redeemable_noncontrolling_interest_common long_term_investments "
    "other_noncurrent_liabilities"
)
CASH_FLOW_METRICS = (
    "net_cash_flow net_cash_flow_continuing net_cash_flow_from_operating_activities "
    "net_cash_flow_from_operating_activities_continuing exchange_gains_losses "
    "net_cash_flow_from_financing_activities "
    "net_cash_flow_from_operating_activities_discontinued "
    "net_cash_flow_from_investing_activities_discontinued "
    "net_cash_flow_from_investing_activities net_cash_flow_discontinued "
    "net_cash_flow_from_investing_activities_continuing "
    "net_cash_flow_from_financing_activities_continuing "
    "net_cash_flow_from_financing_activities_discontinued"
)


def _statement(metrics: str) -> str:
    return "struct<" + ", ".join(f"{m}: {_METRIC}" for m in metrics.split()) + ">"


FINANCIALS = (
    "acceptance_datetime timestamp, cik string, company_name string, end_date date, "
    "filing_date date, fiscal_period string, fiscal_year string, sic string, "
    "source_filing_file_url string, source_filing_url string, start_date string, "
    "tickers array<string>, timeframe string, financials struct<"
    f"comprehensive_income: {_statement(COMPREHENSIVE_INCOME)}, "
    f"income_statement: {_statement(INCOME_METRICS)}, "
    f"balance_sheet: {_statement(BALANCE_METRICS)}, "
    f"cash_flow_statement: {_statement(CASH_FLOW_METRICS)}>"
)
_FILED = (
    "cik string, tickers array<string>, filing_date date, period_end date, "
    "fiscal_year double, fiscal_quarter double, timeframe string, "
)
BALANCE_SHEETS = _FILED + each(
    "double",
    "accounts_payable accrued_and_other_current_liabilities "
    "accumulated_other_comprehensive_income additional_paid_in_capital "
    "cash_and_equivalents commitments_and_contingencies common_stock debt_current "
    "deferred_revenue_current goodwill intangible_assets_net inventories "
    "long_term_debt_and_capital_lease_obligations noncontrolling_interest other_assets "
    "other_current_assets other_equity other_noncurrent_liabilities preferred_stock "
    "property_plant_equipment_net receivables retained_earnings_deficit "
    "short_term_investments total_assets total_current_assets total_current_liabilities "
    "total_equity total_equity_attributable_to_parent total_liabilities "
    "total_liabilities_and_equity treasury_stock",
)
CASH_FLOWS = _FILED + each(
    "double",
    "cash_from_operating_activities_continuing_operations change_in_cash_and_equivalents "
    "change_in_other_operating_assets_and_liabilities_net "
    "depreciation_depletion_and_amortization dividends effect_of_currency_exchange_rate "
    "income_loss_from_discontinued_operations long_term_debt_issuances_repayments "
    "net_cash_from_financing_activities "
    "net_cash_from_financing_activities_continuing_operations "
    "net_cash_from_financing_activities_discontinued_operations "
    "net_cash_from_investing_activities "
    "net_cash_from_investing_activities_continuing_operations "
    "net_cash_from_investing_activities_discontinued_operations "
    "net_cash_from_operating_activities "
    "net_cash_from_operating_activities_discontinued_operations net_income "
    "noncontrolling_interests other_cash_adjustments other_financing_activities "
    "other_investing_activities other_operating_activities "
    "purchase_of_property_plant_and_equipment sale_of_property_plant_and_equipment "
    "short_term_debt_issuances_repayments",
)
INCOME_STATEMENTS = _FILED + each(
    "double",
    "revenue cost_of_revenue gross_profit depreciation_depletion_amortization "
    "selling_general_administrative research_development other_operating_expenses "
    "total_operating_expenses operating_income other_income_expense "
    "total_other_income_expense interest_income interest_expense equity_in_affiliates "
    "extraordinary_items income_before_income_taxes income_taxes "
    "consolidated_net_income_loss net_income_loss_attributable_common_shareholders "
    "preferred_stock_dividends_declared noncontrolling_interest discontinued_operations "
    "basic_earnings_per_share diluted_earnings_per_share basic_shares_outstanding "
    "diluted_shares_outstanding ebitda",
)
RATIOS = "ticker string, cik string, date date, " + each(
    "double",
    "price market_cap enterprise_value earnings_per_share price_to_earnings price_to_book "
    "price_to_sales price_to_cash_flow price_to_free_cash_flow ev_to_sales ev_to_ebitda "
    "dividend_yield return_on_assets return_on_equity debt_to_equity current quick cash "
    "free_cash_flow average_volume",
)
FREE_FLOAT = (
    "effective_date date, free_float bigint, free_float_percent double, ticker string"
)
SHORT_INTEREST = (
    "settlement_date date, ticker string, short_interest bigint, "
    "avg_daily_volume bigint, days_to_cover double"
)
SHORT_VOLUME = (
    "date date, ticker string, short_volume double, short_volume_ratio double, "
    "total_volume double, adf_short_volume bigint, adf_short_volume_exempt bigint, "
    "exempt_volume double, nasdaq_carteret_short_volume bigint, "
    "nasdaq_carteret_short_volume_exempt bigint, nasdaq_chicago_short_volume bigint, "
    "nasdaq_chicago_short_volume_exempt bigint, non_exempt_volume double, "
    "nyse_short_volume bigint, nyse_short_volume_exempt bigint"
)
TENK_SECTIONS = (
    "cik string, ticker string, filing_date date, period_end date, section string, "
    "text string, filing_url string"
)
EIGHTK_DISCLOSURES = (
    "accession_number string, cik string, tickers array<string>, filing_date date, "
    "filing_url string, primary_category string, secondary_category string, "
    "tertiary_category string, supporting_text string"
)
EIGHTK_TEXT = (
    "accession_number string, cik string, ticker string, filing_date date, "
    "filing_url string, form_type string, items_text string"
)
FILINGS_INDEX = (
    "accession_number string, cik string, ticker string, filing_date date, "
    "filing_url string, form_type string, issuer_name string"
)
RISK_FACTORS = (
    "cik string, ticker string, filing_date date, primary_category string, "
    "secondary_category string, tertiary_category string, supporting_text string"
)
_CATEGORY = (
    "primary_category string, secondary_category string, tertiary_category string, "
    "description string"
)
RISK_CATEGORIES = "taxonomy double, " + _CATEGORY
DISCLOSURE_CATEGORIES = "taxonomy string, " + _CATEGORY
HOLDINGS = (
    "accession_number string, cusip string, file_number string, filer_cik string, "
    "filing_date date, filing_url string, film_number string, form_type string, "
    "investment_discretion string, issuer_name string, market_value bigint, "
    "other_managers array<string>, period date, put_call string, "
    "shares_or_principal_amount bigint, shares_or_principal_type string, "
    "title_of_class string, voting_authority_none bigint, voting_authority_shared bigint, "
    "voting_authority_sole bigint"
)
_FOOTNOTES = "footnotes array<struct<id: string, description: string>>"
_OWNER = (
    "form_type string, is_director boolean, is_officer boolean, is_other boolean, "
    "is_ten_percent_owner boolean, issuer_cik string, issuer_name string, "
    "nature_of_ownership string, not_subject_to_section_16 boolean, officer_title string, "
    "owner_cik string, owner_name string, period_of_report date, "
)
FORM3 = (
    "_surrogate_key string, accession_number string, aff_10b5_one boolean, "
    "date_of_original_submission date, direct_or_indirect string, exercise_date date, "
    f"exercise_price double, filing_date date, filing_url string, {_FOOTNOTES}, {_OWNER}"
    "remarks string, security_title string, security_type string, shares_owned double, "
    "tickers array<string>, underlying_security_shares double, "
    "underlying_security_title string"
)
FORM3_IDENTITY = (
    "accession_number security_title security_type direct_or_indirect "
    "nature_of_ownership shares_owned"
)
FORM4 = (
    "_surrogate_key string, accession_number string, aff_10b5_one boolean, "
    "date_of_original_submission date, deemed_execution_date date, "
    "direct_or_indirect string, equity_swap_involved boolean, exercise_date date, "
    "exercise_price double, expiration_date date, filing_date date, filing_url string, "
    f"{_FOOTNOTES}, {_OWNER}"
    "record_type string, remarks string, security_title string, security_type string, "
    "shares_owned_following_transaction double, tickers array<string>, "
    "transaction_acquired_disposed string, transaction_code string, "
    "transaction_date date, transaction_price_per_share double, "
    "transaction_shares double, transaction_timeliness string, transaction_value double, "
    "underlying_security_shares double, underlying_security_title string"
)
FORM4_IDENTITY = (
    "accession_number security_title security_type direct_or_indirect record_type "
    "transaction_date transaction_code transaction_shares"
)
NEWS = (
    "id string, published_utc timestamp, publisher struct<homepage_url: string, "
    "logo_url: string, name: string, favicon_url: string>, tickers array<string>, "
    "title string, insights array<struct<ticker: string, sentiment: string, "
    "sentiment_reasoning: string>>, keywords array<string>, amp_url string, "
    "article_url string, author string, description string, image_url string"
)
# ---------------------------------------------------------------------------


def fundamental_tables() -> list[TableSpec]:
    """All tables of this module."""
    filed, period = "filing_date", "cik period_end timeframe"
    categories = "primary_category secondary_category tertiary_category"
    return [
        spec("stock_financials_deprecated", "cik end_date timeframe", FINANCIALS, filed),
        spec("stock_balance_sheets", period, BALANCE_SHEETS, filed),
        spec("stock_cash_flow_statements", period, CASH_FLOWS, filed),
        spec("stock_income_statements", period, INCOME_STATEMENTS, filed),
        spec("stock_ratios", "ticker date", RATIOS, "date"),
        spec("stock_float", "effective_date ticker", FREE_FLOAT, "effective_date"),
        spec(
            "stock_short_interest", "settlement_date ticker", SHORT_INTEREST, "settlement_date"
        ),
        spec("stock_short_volume", "date ticker", SHORT_VOLUME, "date"),
        spec("stock_10k_sections", "ticker period_end section", TENK_SECTIONS, filed),
        spec(
            "stock_8k_disclosures", f"accession_number {categories}", EIGHTK_DISCLOSURES, filed
        ),
        spec("stock_8k_text", "accession_number", EIGHTK_TEXT, filed),
        spec("stock_filings_index", "accession_number", FILINGS_INDEX, filed),
        spec("stock_risk_factors", "ticker filing_date primary_category", RISK_FACTORS, filed),
        spec("stock_risk_categories", f"taxonomy {categories}", RISK_CATEGORIES),
        spec("stock_disclosure_categories", f"taxonomy {categories}", DISCLOSURE_CATEGORIES),
        spec(
            "stock_13f_filings", "accession_number cusip title_of_class put_call", HOLDINGS, filed
        ),
        spec("stock_form3_filings", "_surrogate_key", FORM3, filed, FORM3_IDENTITY),
        spec("stock_form4_filings", "_surrogate_key", FORM4, filed, FORM4_IDENTITY),
        spec("stock_news", "id", NEWS, "published_utc"),
    ]
