import json
import uuid
from datetime import datetime

import pytest

from tickloom.sources.tables import load_indicator, load_table
from tickloom.specs import TABLES


def pages(spark, *docs, **context):
    names = "".join(f", '{v}' AS {k}" for k, v in context.items())
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")
    return df.selectExpr("payload" + names) if not names else df.selectExpr("payload", *names[2:].split(", "))


def test_bars_with_codes(spark):
    doc = {"results": [{"T": "X", "t": 1700000000000, "o": 1.5, "v": 3, "vw": "2.5", "n": 4, "otc": True}, {"o": 9}]}
    row = load_table(pages(spark, doc, ticker="ABC", active="no"), "stock_bars_1_day", ("ticker", "active")).collect()
    assert len(row) == 1
    got = row[0]
    assert (got.ticker, got.open, got.volume, got.vwap, got.transactions) == ("ABC", 1.5, 3.0, 2.5, 4)
    assert got.timestamp == datetime(2023, 11, 14, 22, 13, 20) and got.otc is True and got.active is False


def test_option_bars_default_flag(spark):
    doc = {"results": [{"t": 1700000000000, "c": 2.0}]}
    df = pages(spark, doc, option_ticker="O:A", underlying_ticker="A")
    row = load_table(df, "options_bars_1_hour", ("option_ticker", "underlying_ticker")).first()
    assert (row.option_ticker, row.underlying_ticker, row.expired, row.close) == ("O:A", "A", False, 2.0)
    assert load_table(df, "options_bars_1_hour", ("option_ticker",), "true").first().expired is True


def test_snapshot_objects(spark):
    record = {
        "ticker": "A",
        "todaysChangePerc": 1.5,
        "prevDay": {"c": 3.0, "vw": 2.0},
        "lastQuote": {"P": 1.1, "p": 1.0, "x": 7, "t": 5},
        "lastTrade": {"p": 1.05, "c": [1, 2], "i": "id"},
        "min": {"av": 10, "n": 2},
    }
    one = load_table(pages(spark, {"status": "OK", "ticker": record}), "stock_ticker_snapshot").first()
    assert one.todays_change_percent == 1.5 and one.prev_day.close == 3.0
    assert (one.last_quote.exchange, one.last_quote.ask_exchange, one.last_quote.ask_price) == (7, None, 1.1)
    assert one.last_trade.conditions == [1, 2] and one["min"].accumulated_volume == 10.0
    record["lastQuote"]["X"] = 8
    two = load_table(pages(spark, {"ticker": record}), "stock_ticker_snapshot").first().last_quote
    assert (two.exchange, two.ask_exchange, two.bid_exchange) == (None, 8, 7)
    many = load_table(pages(spark, {"tickers": [record, {"ticker": "B"}]}), "stock_full_market_snapshot")
    assert sorted(r.ticker for r in many.collect()) == ["A", "B"]


def test_ticker_from_details(spark):
    doc = {"results": [{"details": {"ticker": "O:A"}, "open_interest": 4}]}
    assert load_table(pages(spark, doc), "options_chain_snapshot").first().ticker == "O:A"
    doc = {"results": {"ticker": "", "details": {"ticker": "ES", "product_code": "P"}}}
    row = load_table(pages(spark, doc), "futures_contracts_snapshot").first()
    assert (row.ticker, row.product_code) == ("", "P")


def test_keys(spark):
    doc = {"results": [{"accession_number": "1", "primary_category": "a", "secondary_category": "b"}]}
    assert load_table(pages(spark, doc), "stock_8k_disclosures").first().tertiary_category == ""
    record = {"accession_number": "1", "security_title": "T", "transaction_date": "2024-01-02"}
    row = load_table(pages(spark, {"results": [record]}), "stock_form4_filings").first()
    values = {**record}
    text = "|".join(str(values.get(k)) for k in sorted(TABLES["stock_form4_filings"].surrogate))
    assert row._surrogate_key == str(uuid.uuid5(uuid.NAMESPACE_DNS, text))


def test_reference_tables(spark):
    ipo = {"results": [{"ipoStatus": "NEW", "lastUpdated": "2024-01-02T03:04:05Z", "ticker": "A"}, {"ipoStatus": "history", "lastUpdated": "bad"}]}
    rows = sorted(load_table(pages(spark, ipo), "stock_ipos").collect(), key=lambda r: r.ipo_status)
    assert [r.ipo_status for r in rows] == ["history", "new"]
    assert rows[0].last_updated is None and rows[1].last_updated == datetime(2024, 1, 2, 3, 4, 5)
    holidays = {"response": [{"date": "2024-07-04", "name": "x"}, {"date": "2024-12-25", "name": "y"}]}
    assert load_table(pages(spark, holidays), "market_holidays").count() == 2
    codes = {"results": [{"id": 1, "sip_mapping": {"cta": "A", "zz": "B"}, "data_types": ["trade"]}]}
    assert load_table(pages(spark, codes), "condition_codes").first().sip_mapping == {"CTA": "A"}
    events = {"results": {"name": "N", "events": [{"date": "2024-01-02", "type": "t", "ticker_change": {"ticker": "B"}}]}}
    row = load_table(pages(spark, events, ticker="A"), "stock_ticker_events", ("ticker",)).first()
    assert row.ticker == "A" and row.events[0].type == "t"


def test_trades_drop_dirty_conditions(spark):
    doc = {"results": [{"id": "1", "price": "1.5", "conditions": [1, "x", 3], "sip_timestamp": 1700000000000000001}]}
    row = load_table(pages(spark, doc, ticker="A"), "stock_trades", ("ticker",)).first()
    assert row.sip_timestamp == 1700000000000000001 and row.price == 1.5 and row.conditions == [1, 3]


def test_indicator_matches_bars(spark):
    doc = {
        "results": {
            "underlying": {"aggregates": [{"t": 1000000000000 * 2, "c": 1.0, "T": "A", "n": 3}, {"t": 1000000000000 * 3, "c": 2.0}]},
            "values": [{"timestamp": 2500000000000, "value": 5.5}, {"timestamp": 1500000000000, "value": 1}],
        }
    }
    out = load_indicator(pages(spark, doc, ticker="A"), "stock_sma", "close", "day", 10)
    rows = sorted(out.collect(), key=lambda r: r.timestamp)
    assert rows[0].underlying_close is None and rows[0].value == 1.0
    assert (rows[1].underlying_close, rows[1].underlying_ticker, rows[1].underlying_transactions) == (1.0, "A", 3)
    assert rows[1].series_window_timespan == "close_day_10"


@pytest.mark.parametrize("name", sorted(TABLES))
def test_every_table_loads_an_empty_page(spark, name):
    table = TABLES[name]
    df = load_table(pages(spark, {"results": []}), name)
    assert df.columns == table.schema.fieldNames()


def test_indicator_pages_are_read_and_shuffled_once(spark, tmp_path):
    doc = {"results": {"underlying": {"aggregates": [{"t": 10**12, "c": 1.0}]}, "values": [{"timestamp": 10**12, "value": 5.5}]}}
    pages(spark, doc, ticker="A").write.parquet(str(tmp_path / "pages"))
    out = load_indicator(spark.read.parquet(str(tmp_path / "pages")), "stock_sma", "close", "day", 10)
    for picked in (out, out.select("ticker", "value", "underlying_close")):
        assert [r.underlying_close for r in picked.collect()] == [1.0]
        plan = picked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1, plan


def test_indicator_rows_without_key_time_or_shape(spark):
    def page(values, bars):
        return json.dumps({"results": {"values": values, "underlying": {"aggregates": bars}}})

    at = lambda k: (1_700_000_000 + 86_400 * k) * 1000
    found = [
        # A null ticker and an empty one are not the same; neither knows the other's bars.
        (None, page([{"timestamp": at(1), "value": 1}], [{"t": at(0), "c": 9}])),
        ("", page([{"timestamp": at(1), "value": 2}], [{"t": at(0), "c": 8}, {"t": at(0), "c": 7}])),
        # No time, no object, null; the bar without a time is no one's.
        ("A", page([{"value": 3}, 4, None, {"timestamp": at(5000), "value": "5"}], [{"c": 6}, {"t": at(-5000), "c": 5}, 1])),
        ("A", page([{"timestamp": "2023-11-14T22:13:20Z", "value": 6}], [])),
        ("B", json.dumps({"results": {"values": [{"timestamp": at(0), "value": 7}]}})),
        ("B", json.dumps([{}, {"underlying": {"aggregates": [{"timestamp": at(0), "close": 4}]}}, None])),
        ("C", "no json"),
        ("C", json.dumps({"results": {"values": {"timestamp": at(0)}}})),
    ]
    frame = spark.createDataFrame(found, "ticker string, payload string").repartition(3)
    out = load_indicator(frame, "stock_sma", "close", "day", 10)
    got = sorted(((r.ticker, r.value, r.timestamp is None, r.underlying_close) for r in out.collect()), key=str)
    assert got == sorted([
        (None, 1.0, False, None), ("", 2.0, False, 8.0), ("A", 3.0, True, None), ("A", None, True, None),
        ("A", None, True, None), ("A", 5.0, False, 5.0), ("A", 6.0, False, 5.0), ("B", 7.0, False, 4.0),
    ], key=str)
    assert out.where("underlying_close IS NULL AND underlying_timestamp IS NOT NULL").count() == 0
